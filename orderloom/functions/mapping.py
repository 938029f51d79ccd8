"""Value maps, flags and conditional values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import upper_clean

# --- Fixed values -------------------------------------------------------------------------------
STAGED_STATUS = {"COMP": "COMPLETED"}
ORDER_STATUS = {
    "COMP": "Completed",
    "COMPLETED": "Completed",
    "PENDING": "Pending",
    "CANCELLED": "Cancelled",
    "REFUND": "Refunded",
    "REFUNDED": "Refunded",
}
ORDER_STATUS_DEFAULT = "Unknown"
SALES_CHANNEL = {"WEB": "Web", "MOBILE": "Mobile", "MOBILE APP": "Mobile"}
SALES_CHANNEL_DEFAULT = "Other"
COUNTRY = {"USA": "US", "UNITED STATES": "US"}
SALES_ORDER_STATUS = {"ON HOLD": "ON_HOLD"}
PAYMENT_METHOD = {"WIRE TRANSFER": "WIRE_TRANSFER", "WIRE": "WIRE_TRANSFER"}
FREIGHT_CARRIERS = ("FEDEX FREIGHT", "FEDEX FREIGHT INC")
REGIONS = {
    "Northeast": ("CT", "ME", "MA", "NH", "NJ", "NY", "PA", "RI", "VT"),
    "Southeast": ("AL", "AR", "DE", "DC", "FL", "GA", "KY", "LA", "MD", "MS", "NC", "OK", "SC", "TN", "TX", "VA", "WV"),
    "Midwest": ("IL", "IN", "IA", "KS", "MI", "MN", "MO", "NE", "ND", "OH", "SD", "WI"),
    "West": ("AK", "AZ", "CA", "CO", "HI", "ID", "MT", "NV", "NM", "OR", "UT", "WA", "WY"),
}
REGION_DEFAULT = "Other"
# ------------------------------------------------------------------------------------------------


def map_values(c: Column, values: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Translate trimmed upper-case text; texts not listed give ``default`` (else pass as they are).

    Keys with one target are tested together, so the chain is as long as the targets are many.
    """
    code = upper_clean(c)
    by_target: dict[str, list[str]] = {}
    for key, target in values.items():
        by_target.setdefault(target, []).append(key)
    rules = [(code.isin(keys), F.lit(target)) for target, keys in by_target.items()]
    return map_rules(rules, code if default is None else default)


def map_rules(rules: Sequence[tuple[Column, Column]], default: Column | str) -> Column:
    """First rule whose predicate holds wins."""
    (first, value), *rest = rules
    chain = F.when(first, value)
    for predicate, result in rest:
        chain = chain.when(predicate, result)
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def carrier_of(c: Column) -> Column:
    """Carrier family of a raw carrier text; the freight arm goes before the family prefix."""
    code = upper_clean(c)
    return map_rules(
        [
            (code.isin(*FREIGHT_CARRIERS), F.lit("FedEx Freight")),
            (code.startswith("FEDEX"), F.lit("FedEx")),
            (code == "UPS", F.lit("UPS")),
            (code == "USPS", F.lit("USPS")),
        ],
        "Other",
    )


def region_of(state: Column) -> Column:
    """Sales region of a two-letter state code."""
    rules = [(state.isin(*codes), F.lit(name)) for name, codes in REGIONS.items()]
    return map_rules(rules, REGION_DEFAULT)


def payment_method_of(c: Column) -> Column:
    return map_values(c, PAYMENT_METHOD, default=F.nullif(upper_clean(c), F.lit("")))


def flag(predicate: Column) -> Column:
    """A predicate as true/false; unknown counts as false."""
    return F.coalesce(predicate, F.lit(False))


def value_when(predicate: Column, value: Column) -> Column:
    """``value`` where the predicate holds, else null."""
    return F.when(predicate, value)
