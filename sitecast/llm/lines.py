"""Line deduplication over overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.llm.tables import checked_side
from sitecast.session import materialize

LINES = 3
#: Characters that a window of lines must have, without white space at its ends.
LEAST_CHARS = 1


def _lines(text: str):
    return F.transform(F.split(F.col(text), "\n", -1), lambda x: F.trim(x))


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, hash, lines)``: the places of lines covered by a later occurrence of a window.

    Every window of three consecutive lines (trimmed) is hashed.  Of equal windows
    the first by (key, text hash, place) stays, null keys last; all others are
    later, and the lines they cover, merged over overlaps, are listed in order.  A
    window of blank lines is none.  A text with fewer than three lines is one window,
    which equals only texts of the same lines.
    """
    size = F.size("l")
    windows = F.transform(
        F.sequence(F.lit(0), F.greatest(size - LINES, F.lit(0))),
        lambda i: F.struct(
            i.alias("at"),
            F.least(size, F.lit(LINES)).alias("n_lines"),
            F.xxhash64(*[F.get("l", i + k) for k in range(LINES)], F.least(size, F.lit(LINES))).alias("w"),
            (F.length(F.concat(*[F.coalesce(F.get("l", i + k), F.lit("")) for k in range(LINES)])) >= LEAST_CHARS).alias("ok"),
        ),
    )
    named = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("doc"), F.xxhash64(text).alias("hash"), _lines(text).alias("l"))
    rows = named.select("doc", "hash", F.inline(windows)).where("ok").drop("ok")
    place = F.struct(F.col("doc").isNull().alias("null"), "doc", "hash", "at")
    twice = rows.groupBy("w").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    twice = materialize(twice.select("w", "first"))
    later = rows.join(checked_side(twice, twice.count()), "w").where(place != F.col("first"))
    covered = later.select("doc", "hash", F.explode(F.sequence("at", F.col("at") + F.col("n_lines") - 1)).alias("line")).distinct()
    # At most the lines of one text.
    return covered.groupBy("doc", "hash").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def dedupe_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text, n_lines, n_removed, removed)`` of each row of ``docs``.

    ``text`` is the text without the lines covered by later windows; a null text
    stays null and has no lines; ``removed`` lists their places.  Rows with equal
    key and text are one text for the order of occurrences, so repeats inside
    them are removed from each.  An empty table gives no rows.
    """
    gone = materialize(repeated_lines(docs, key, text))
    own = docs.select(F.col(key).alias("_k"), F.xxhash64(text).alias("_h"), F.col(text).alias("_t"))
    side = checked_side(gone, gone.count(), 100_000)
    met = own.join(side, own["_k"].eqNullSafe(side["doc"]) & (own["_h"] == side["hash"]), "left")
    lines = F.split("_t", "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("lines"))
    kept = F.transform(places, lambda i: F.get("_l", i))
    return met.withColumn("_l", lines).select(
        F.col("_k").alias(key),
        F.when(F.col("lines").isNull(), F.col("_t")).otherwise(F.array_join(kept, "\n")).alias(text),
        F.when(F.col("_t").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("lines", F.array().cast("array<int>")).alias("removed"),
    )
