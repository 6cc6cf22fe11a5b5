"""Table scans and sinks: CSV, parquet, samples, metrics logs, JSON reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN marks a missing number on input; Spark would treat it as the largest value."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_table(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv") -> DataFrame:
    """Scan with a fixed schema (no inference pass); NaN is NULL in every format, as are empty CSV fields."""
    if fmt != "csv":
        return nan_to_null(spark.read.schema(schema).format(fmt).load(path))
    return nan_to_null(spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def write_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Materialise a stage once; a path that already holds data is left alone."""
    return write_table(df, path, fmt, mode="ignore")


def append_metrics(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Add rows to a metrics log, creating it when absent."""
    return write_table(df, path, fmt, mode="append")


def date_spine(spark: SparkSession, start: date, end: date, name: str = "date", unit: str = "day") -> DataFrame:
    """One row per calendar day (or month), both ends included."""
    step = F.expr(f"interval 1 {unit}")
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), step)).alias(name))


def scatter_key(df: DataFrame, key: str, seed: int) -> Column:
    """A repeatable pseudo-random number in [0, 2147483647) per key.

    Integer keys use a multiplicative generator any engine can repeat; other
    keys use Spark's 64-bit hash.
    """
    prime = F.lit(2147483647).cast("long")
    if isinstance(df.schema[key].dataType, IntegralType):
        base = F.pmod(F.col(key).cast("long"), prime)
        return F.pmod(base * 48271 + F.lit(seed * 7919), prime)
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), prime)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """A repeatable sample of at most ``n`` rows (top-n by a hash of the key)."""
    return df.orderBy(scatter_key(df, key, seed), key).limit(n)


def write_summary_json(tables: dict[str, DataFrame], path: str) -> str:
    """Write report tables as JSON lines, one folder ``section=name`` each.

    Every row is one line, so a table of any size is written by many tasks, and
    ``read_summary_json`` or any JSON reader takes a section back.
    """
    for name, rows in tables.items():
        lines = rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
        lines.write.mode("overwrite").text(f"{path}/section={name}")
    return path


def read_summary_json(spark: SparkSession, path: str, section: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(f"{path}/section={section}")
