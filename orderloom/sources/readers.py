"""Raw files and declared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"


def read_raw(spark: SparkSession, path: str, schema: StructType, *, multi_line: bool = False) -> DataFrame:
    """CSV with a header row, columns taken by name and cast to ``schema``. Empty fields are null.

    The header of the first file sets the order; every other file is checked against it, so a file with moved columns fails
    instead of filling the wrong ones. Rows with more or fewer fields than the header are not here but in
    ``read_malformed``. ``multi_line`` allows line breaks inside quotes; a file is then read by one task.
    """
    rows, columns = _named(spark, path, multi_line)
    good = rows.filter(~_is_corrupt(columns))
    return good.select(*[F.col(columns[f.name]).cast(f.dataType).alias(f.name) for f in schema])


def read_malformed(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """``line`` and ``file`` of the rows that ``read_raw`` leaves out."""
    rows, columns = _named(spark, path, multi_line)
    bad = rows.filter(_is_corrupt(columns))
    return bad.select(F.col(CORRUPT).alias("line"), F.col("_metadata.file_path").alias("file"))


def parse_raw(
    spark: SparkSession, path: str, schema: StructType, parsed: str, *, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """What ``read_raw`` and ``read_malformed`` give, from one parse: rows are stored under ``parsed`` with the malformed line beside them,
    and both results read that. Nothing that follows parses the text again."""
    rows, columns = _named(spark, path, multi_line)
    bad = _is_corrupt(columns)
    line = F.when(bad, F.col(CORRUPT))
    rows.select(
        *[F.when(~bad, F.col(columns[f.name])).cast(f.dataType).alias(f.name) for f in schema],
        line.alias("_line"),
        F.when(bad, F.col("_metadata.file_path")).alias("_file"),
    ).write.mode("overwrite").parquet(parsed)
    stored = spark.read.parquet(parsed)
    good = stored.filter(F.col("_line").isNull()).select(*[f.name for f in schema])
    return good, stored.filter(F.col("_line").isNotNull()).select(F.col("_line").alias("line"), F.col("_file").alias("file"))


def _is_corrupt(columns: dict[str, str]) -> Column:
    """Not as a null test, which the scan would answer before it has parsed the line; and with nothing of the first
    column added, because Spark wants another column to be read besides."""
    nothing = F.left(F.coalesce(F.col(f"`{next(iter(columns))}`"), F.lit("")), F.lit(0))
    return F.concat(F.coalesce(F.col(CORRUPT), F.lit("")), nothing) != ""


def _named(spark: SparkSession, path: str, multi_line: bool) -> tuple[DataFrame, dict[str, str]]:
    """All rows as text with the malformed line beside them, and the column of each header name."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    header = reader.csv(path).schema
    text = StructType([*header, StructField(CORRUPT, StringType())])
    rows = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)  # fields are only counted where all are parsed
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    return rows, {f.name: f.name for f in header}


def source(
    spark: SparkSession, name: str, root: str | None = None, schema: StructType | str | None = None
) -> DataFrame:
    """A declared input: Parquet under ``root``, or the catalog table ``name``. With a declared
    ``schema`` no file is opened to find it out."""
    if root is None:
        return spark.table(name)
    path = f"{root.rstrip('/')}/{name}.parquet"
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
