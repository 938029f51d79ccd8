import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from orderloom.functions import mapping, metrics, parsing, text


def each(spark, values, function, kind="string"):
    """``function`` over one column of values, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("c"))).collect()]


def test_title_case_breaks_at_punctuation(spark):
    got = each(
        spark,
        ["  rack mount 24-port ", "ACME (north)/TOOLS", "pat o'NEIL", "a\tb", "x&y co.uk", "[q]{r}\\s^t", None, ""],
        text.title_case,
    )
    assert got == [
        "Rack Mount 24-Port", "Acme (North)/Tools", "Pat O'neil", "A\tB", "X&Y Co.Uk", "[Q]{R}\\S^T", None, "",
    ]


def test_capitalize_first_lowers_the_rest(spark):
    assert each(spark, [" ana-LUCIA ", "d'Arc", "z", "", None], text.capitalize_first) == [
        "Ana-lucia", "D'arc", "Z", "", None,
    ]


def test_blank_and_case(spark):
    assert each(spark, ["  ", "", " x ", None], text.blank_to_null) == [None, None, "x", None]
    assert each(spark, [" aB ", None], text.upper_clean) == ["AB", None]
    assert each(spark, [" aB ", None], text.lower_clean) == ["ab", None]
    assert each(spark, ["a Duplicate b", "none", None], lambda c: text.contains_ci(c, "duplicate")) == [
        True, False, False,
    ]


def test_full_name_is_null_with_a_missing_part(frame):
    df = frame("a string, b string", ("Jo", "Li"), ("Jo", None))
    assert [r[0] for r in df.select(text.full_name(F.col("a"), F.col("b"))).collect()] == ["Jo Li", None]


def test_dates_in_two_formats(spark):
    got = each(
        spark,
        ["2023-02-28", "02/28/2023", "2023-02-30", "28/02/2023", "2/28/2023", " 2023-02-28", "2023-02-28 10:00:00", "", None],
        parsing.parse_date,
    )
    day = dt.date(2023, 2, 28)
    assert got == [day, day, None, None, None, None, None, None, None]


def test_a_caller_may_add_a_format(spark):
    formats = (*parsing.DATE_FORMATS, "dd/MM/yyyy")
    got = each(spark, ["28/02/2023", "02/03/2023"], lambda c: parsing.parse_date(c, formats))
    assert got == [dt.date(2023, 2, 28), dt.date(2023, 2, 3)]
    assert each(spark, ["3 Feb 2023"], lambda c: parsing.parse_date(c, ("d MMM yyyy",))) == [dt.date(2023, 2, 3)]


def test_number_words(spark):
    got = each(spark, ["two", " FIVE ", "six", "2.5", " 12 ", "", None, "-3", "abc"], parsing.word_number)
    assert got == [2, 5, None, 3, 12, None, None, -3, None]


def test_integers_round_and_reject(spark):
    assert each(spark, ["7", "7.6", "x", None, "99999999999"], parsing.parse_int) == [7, 8, None, None, None]


def test_booleans(spark):
    assert each(spark, ["1", "0", "TRUE", "false", "maybe", None], parsing.parse_boolean) == [
        True, False, True, False, None, None,
    ]


def test_strict_mode_fails_on_bad_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        each(spark, ["15/02/2023"], lambda c: parsing.cast_text(c, "date", "strict"))
    with pytest.raises(ValueError, match="mode"):
        parsing.cast_text(F.lit("1"), "int", "lenient")


def test_zero_handling_keeps_types(spark):
    df = spark.sql("select cast(0 as decimal(8,2)) a, cast(null as decimal(5,2)) b")
    out = df.select(parsing.zero_to_null(F.col("a")).alias("a"), parsing.or_zero(F.col("b"), "decimal(5,2)").alias("b"))
    assert out.dtypes == [("a", "decimal(8,2)"), ("b", "decimal(5,2)")]
    assert tuple(out.first()) == (None, D("0.00"))


def test_value_maps(spark):
    raw = [" comp", "Completed", "refund", "odd", None]
    assert each(spark, raw, lambda c: mapping.map_values(c, mapping.STAGED_STATUS)) == [
        "COMPLETED", "COMPLETED", "REFUND", "ODD", None,
    ]
    assert each(spark, raw, lambda c: mapping.map_values(c, mapping.ORDER_STATUS, "Unknown")) == [
        "Completed", "Completed", "Refunded", "Unknown", "Unknown",
    ]
    assert each(spark, ["wire", "Wire Transfer ", "ach", " ", None, "card"], mapping.payment_method_of) == [
        "WIRE_TRANSFER", "WIRE_TRANSFER", "ACH", None, None, "CARD",
    ]


def test_carrier_order_of_rules(spark):
    got = each(spark, ["fedex freight", "FedEx Freight Inc", "FEDEX ground", " ups", "usps", "freight co.", None], mapping.carrier_of)
    assert got == ["FedEx Freight", "FedEx Freight", "FedEx", "UPS", "USPS", "Other", "Other"]


def test_regions(spark):
    assert each(spark, ["NY", "TX", "DC", "OH", "WY", "PR", None], mapping.region_of) == [
        "Northeast", "Southeast", "Southeast", "Midwest", "West", "Other", "Other",
    ]
    codes = [code for codes in mapping.REGIONS.values() for code in codes]
    assert len(codes) == len(set(codes)) == 51


def test_line_amounts_round_once(frame):
    df = frame(
        "q int, p decimal(14,4), c decimal(14,4), d decimal(9,6)",
        (2, D("69.99"), D("22"), D("0.1")),
        (1, D("129.99"), D("48"), D("0.15")),
        (None, D("89.99"), D("30"), D("0")),
        (3, None, D("1"), D("0")),
    )
    amounts = metrics.line_amounts(F.col("q"), F.col("p"), F.col("c"), F.col("d"))
    order = ("revenue", "gross_revenue", "discount_amount", "cost", "gross_profit")
    got = [tuple(r) for r in df.select(*[amounts[n].alias(n) for n in order]).collect()]
    assert got == [
        (D("125.98"), D("139.98"), D("14.00"), D("44.00"), D("81.98")),
        (D("110.49"), D("129.99"), D("19.50"), D("48.00"), D("62.49")),
        (None, None, None, None, None),
        (None, None, None, D("3.00"), None),
    ]


def test_margin_guards_zero_and_null_prices(frame):
    df = frame("p decimal(12,2), c decimal(12,2)", (D(100), D(20)), (D(0), D(5)), (None, D(5)), (D(3), D(2)), (D(3), D(4)))
    got = [r[0] for r in df.select(metrics.margin_pct(F.col("p"), F.col("c"))).collect()]
    assert got == [D("80.00"), None, None, D("33.33"), D("-33.33")]


def test_new_customers(frame):
    df = frame("d date", (dt.date(2024, 3, 3),), (dt.date(2024, 3, 2),), (None,))
    got = [r[0] for r in df.select(metrics.is_new_customer(F.col("d"), "2024-06-01")).collect()]
    assert got == [True, False, False]


def test_receivable_truth_table(frame):
    as_of = dt.date(2024, 6, 1)
    df = frame(
        "i date, due date, s string",
        (dt.date(2024, 4, 1), dt.date(2024, 5, 1), "OVERDUE"),
        (dt.date(2024, 4, 1), dt.date(2024, 5, 1), "PAID"),
        (dt.date(2024, 4, 1), dt.date(2024, 5, 1), None),
        (dt.date(2024, 4, 1), dt.date(2024, 6, 1), "PARTIAL"),
        (dt.date(2024, 4, 1), None, "PARTIAL"),
    )
    got = df.select(
        metrics.days_outstanding(F.col("i"), F.col("s"), as_of), metrics.is_overdue(F.col("due"), F.col("s"), as_of)
    ).collect()
    assert [tuple(r) for r in got] == [(61, True), (None, False), (None, False), (61, False), (61, False)]


def test_aging_bucket_edges(frame):
    as_of = dt.date(2024, 6, 1)
    late = [-1, 0, 1, 30, 31, 60, 61]
    df = frame("due date", *[(as_of - dt.timedelta(days=n),) for n in late], (None,))
    got = [r[0] for r in df.select(metrics.aging_bucket(F.col("due"), as_of)).collect()]
    assert got == [
        "Current", "Current", "1-30 days overdue", "1-30 days overdue", "31-60 days overdue", "31-60 days overdue",
        "60+ days overdue", None,
    ]


def test_flags_turn_unknown_into_false(frame):
    df = frame("a date, b date", (dt.date(2024, 1, 2), dt.date(2024, 1, 2)), (dt.date(2024, 1, 3), dt.date(2024, 1, 2)), (None, dt.date(2024, 1, 2)))
    assert [r[0] for r in df.select(metrics.is_on_time(F.col("a"), F.col("b"))).collect()] == [True, False, False]


def test_dso(frame):
    df = frame("a decimal(18,2), s decimal(18,2)", (D(50), D(200)), (D(50), D(0)), (D(1), D(3)))
    got = [r[0] for r in df.select(metrics.days_sales_outstanding(F.col("a"), F.col("s"), 90)).collect()]
    assert got == [D("22.50"), None, D("30.00")]
