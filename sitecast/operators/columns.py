"""Columns chosen by type or name, row filters, and masked overwrites."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType


def columns_by_kind(df: DataFrame) -> dict[str, list[str]]:
    """Column names under ``numeric``, ``categorical`` and ``datetime``."""
    kinds = {
        "numeric": NumericType,
        "categorical": StringType,
        "datetime": (DateType, TimestampType, TimestampNTZType),
    }
    return {k: [f.name for f in df.schema if isinstance(f.dataType, t)] for k, t in kinds.items()}


def columns_matching(
    df: DataFrame, include: Iterable[str] = (), exclude: Iterable[str] = (), prefix: str = ""
) -> list[str]:
    """Names that start with ``prefix``, hold any of ``include`` and none of ``exclude``."""
    inc, exc = list(include), list(exclude)
    return [
        c
        for c in df.columns
        if c.startswith(prefix) and (not inc or any(s in c for s in inc)) and not any(s in c for s in exc)
    ]


def require(df: DataFrame, cols: Sequence[str], strict: bool = True) -> bool:
    """True when all columns exist; else raise (strict) or return False."""
    missing = [c for c in cols if c not in df.columns]
    if missing and strict:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return not missing


def overwrite_where(df: DataFrame, col: str, cond: Column, value) -> DataFrame:
    """``value`` where the condition holds; a NULL condition leaves the cell alone."""
    return df.withColumn(col, F.when(cond, value).otherwise(F.col(col)))


def any_null(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols or df.columns])


def rows_where(df: DataFrame, cond: Column) -> DataFrame:
    return df.filter(cond)


def rows_with_null(df: DataFrame) -> DataFrame:
    return df.filter(any_null(df))


def drop_null_rows(df: DataFrame, max_ratio: float | None = None) -> DataFrame:
    """Drop rows holding a NULL; with ``max_ratio`` only when fewer rows than that have one."""
    if max_ratio is not None:
        ratio = df.agg(F.avg(any_null(df).cast("double")).alias("r")).first()["r"]
        if ratio is None or ratio >= max_ratio:
            return df
    return df.na.drop()


def project(df: DataFrame, mapping: dict[str, str] | None = None, drop: Sequence[str] = (), order: Sequence[str] | None = None) -> DataFrame:
    """Rename, drop, and (when ``order`` is given) reorder columns."""
    out = df.drop(*drop).withColumnsRenamed(mapping or {})
    return out.select(*order) if order else out
