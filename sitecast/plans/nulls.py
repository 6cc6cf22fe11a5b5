"""Finding and filling missing values in a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.operators.cleaning import fill_forward_backward, impute_adaptive, impute_mode
from sitecast.operators.columns import columns_by_kind, drop_null_rows
from sitecast.operators.summary import high_null_columns, null_columns, null_profile, retention

# A numeric column whose name holds one of these is a time series.
TIME_WORDS = ["time", "date", "day", "month", "year"]


def clean_nulls(
    df: DataFrame, order: Sequence[str], partition: Sequence[str] = (), max_drop: float = 0.01, ratio: float = 0.3
) -> dict[str, DataFrame]:
    """Fill, drop what little is left, and report.

    Time-like numeric columns are filled forward and backward in ``order``, the
    other numeric ones by mean or median, text by its mode.  Rows still holding
    a NULL are dropped when they are fewer than ``max_drop`` of all.  Returns
    ``cleaned``, ``profile``, ``high_null`` and ``retention``.
    """
    kinds = columns_by_kind(df)
    holed = null_columns(df, kinds["numeric"] + kinds["categorical"])
    timed = [c for c in kinds["numeric"] if c in holed and any(w in c.lower() for w in TIME_WORDS)]
    plain = [c for c in kinds["numeric"] if c in holed and c not in timed]
    out = impute_mode(impute_adaptive(df, plain), [c for c in kinds["categorical"] if c in holed])
    if timed:
        out = fill_forward_backward(out, timed, list(partition), [F.col(c) for c in order]).select(*df.columns)
    cleaned = drop_null_rows(out, max_drop)
    return {
        "cleaned": cleaned,
        "profile": null_profile(df),
        "high_null": high_null_columns(cleaned, ratio),
        "retention": retention(df, cleaned),
    }
