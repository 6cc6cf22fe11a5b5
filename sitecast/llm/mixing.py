"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources in code-point order (null last) weigh ``weights`` in turn and share
``share`` of all words; a target stops at ``cap`` times its source's words and
the excess is shared again.  A source is taken in complete epochs first.  What is
left of its target is filled in order of ``-ln(u) / w``: ``u`` is a hash of the
document, ``w`` its quality weight, so better documents come early more often.
The cut is the prefix whose words come nearest to the budget.

DataFrame operations only.  No source is gathered: its keys fall into 2^24
buckets whose sums, 4096 at a time, locate the bucket that holds the cut, and
only that bucket's rows are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecast.llm.tables import checked_side, fresh
from sitecast.operators.ordering import with_positions
from sitecast.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
LEVEL = 4096


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weights(labels: DataFrame) -> DataFrame:
    """``(doc_id, weight)``: 2 for good quality, 0.5 for bad; a document without a label weighs 1."""
    best = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return best.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, cap: float = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes(source, source_size)``.

    Raising one level until the sources below their cap take the rest is the
    limit of sharing the excess again and again.  Each step is one aggregate of
    the source table; only sums come to the driver.
    """
    placed = with_positions(sizes, [F.col("source").asc_nulls_last()], "_pos")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    placed = materialize(
        placed.select("source", "source_size", F.element_at(turn, (F.col("_pos") % len(weights) + 1).cast("int")).alias("_w"))
    )
    limit = F.lit(float(cap)) * F.col("source_size")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while total:
        full = F.col("_w") * level > limit
        if capped < 0:
            full = F.lit(False)
        n, held, rest = placed.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)), F.sum(F.when(~full, F.col("_w")))
        ).first()
        if n == capped or not rest:
            break
        capped, level = n, (share * total - held) / rest
    return placed.select("source", "source_size", F.least(F.col("_w") * level, limit).alias("target"))


def sampling_key(id_: Column, text: Column, weight: Column, seed: str = SEED) -> Column:
    """``-ln(u) / weight`` with ``u`` in (0, 1) from 52 bits of a hash of the id."""
    name = F.coalesce(id_.cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), name)), 1, 13), 16, 10).cast("long")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))) / weight


def mix(
    docs: DataFrame,
    quality: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    cap: int = CAP,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` of each row.

    ``copies`` (complete epochs, plus one for rows before the cut) times ``size``
    is what the mix takes of a row.  A null text or one without words has size 0
    and is taken by epochs only.  A null source is a source.  Rows with equal keys
    (the same id) are ordered by id, size and text hash.  ``quality`` is
    ``(doc_id, weight)`` with one row for each id; a null id weighs 1.  An empty
    table gives no rows.  Columns of ``docs`` with the names added are replaced.
    """
    added = ("size", "source_size", "target", "copies")
    docs = docs.drop(*added)
    key, bucket, tie, w, wid = fresh(docs, "_key", "_bucket", "_tie", "_w", "_wid")
    side = quality.select(F.col("doc_id").alias(wid), F.col("weight").alias(w))
    rows = docs.join(checked_side(side, side.count()), docs["doc_id"] == F.col(wid), "left").drop(wid)
    rows = rows.withColumns(
        {
            "size": word_count(F.col("text")),
            key: sampling_key(F.col("doc_id"), F.col("text"), F.coalesce(F.col(w), F.lit(1.0)), seed),
            tie: F.xxhash64("text"),
        }
    ).drop(w)
    # A monotone map of the key to 0 .. 2^24 - 1.
    top = LEVEL * LEVEL
    rows = rows.withColumn(bucket, F.least(F.floor((1 - F.exp(-F.col(key))) * top), F.lit(top - 1)).cast("long"))

    narrow = materialize(
        rows.select(
            "source", "doc_id", "size", F.col(key).alias("key"), F.col(bucket).alias("b"), F.col(tie).alias("tie"),
            F.floor(F.col(bucket) / LEVEL).cast("long").alias("b1"),
        )
    )
    goal = source_targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("epochs", whole).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    goal = materialize(goal)
    count = goal.count()

    def bound(df: DataFrame, by: str, base: DataFrame) -> DataFrame:
        """The first ``by`` of each source whose running sum passes the budget, and the sum before it."""
        sums = df.groupBy("source", by).agg(F.sum("size").alias("_sum"))
        met = sums.join(checked_side(base, count), sums["source"].eqNullSafe(base["_s"]))
        run = Window.partitionBy("_s").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
        met = met.withColumn("_upto", F.col("_base") + F.sum("_sum").over(run)).where(F.col("_upto") > F.col("_budget"))
        first = met.groupBy("_s", "_budget").agg(F.min(F.struct(by, (F.col("_upto") - F.col("_sum")).alias("_at"))).alias("_f"))
        return first.select("_s", "_budget", F.col(f"_f.{by}").alias("_in"), F.col("_f._at").alias("_base"))

    start = goal.select(F.col("source").alias("_s"), F.col("budget").alias("_budget"), F.lit(0).cast("long").alias("_base"))
    coarse = bound(narrow, "b1", start)
    inside = narrow.join(checked_side(coarse, count), narrow["source"].eqNullSafe(coarse["_s"]) & (narrow["b1"] == coarse["_in"]))
    inside = inside.select("source", "doc_id", "size", "key", "b", "tie")
    fine = materialize(bound(inside, "b", coarse.drop("_in")))
    last = narrow.join(checked_side(fine, count), narrow["source"].eqNullSafe(fine["_s"]) & (narrow["b"] == fine["_in"]))
    order = ["key", "doc_id", "size", "tie"]
    run = Window.partitionBy("_s").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("_before", F.col("_base") + F.coalesce(F.sum("size").over(run), F.lit(0)))
    near = last.where(F.col("_before") * 2 + F.col("size") <= F.col("_budget") * 2)
    cut = near.groupBy(F.col("_s").alias("_cs")).agg(F.max(F.struct(*order)).alias("_cut"))
    plan = goal.join(fine.select(F.col("_s").alias("_fs"), F.col("_in").alias("_cb")), goal["source"].eqNullSafe(F.col("_fs")), "left")
    plan = plan.join(cut, plan["source"].eqNullSafe(cut["_cs"]), "left")
    names = fresh(rows, "_source", "_epochs", "_cb", "_cut")
    plan = materialize(plan.select(F.col("source").alias(names[0]), "source_size", "target", F.col("epochs").alias(names[1]), F.col("_cb").alias(names[2]), F.col("_cut").alias(names[3])))

    out = rows.join(checked_side(plan, count), rows["source"].eqNullSafe(plan[names[0]]))
    mine = F.struct(F.col(key).alias("key"), F.col("doc_id"), F.col("size"), F.col(tie).alias("tie"))
    early = (F.col(bucket) < F.col(names[2])) | ((F.col(bucket) == F.col(names[2])) & (mine <= F.col(names[3])))
    copies = F.col(names[1]) + F.when(F.coalesce(early, F.lit(False)), 1).otherwise(0)
    return out.withColumn("copies", copies.cast("long")).select(*docs.columns, *added)


def repeated(docs: DataFrame, quality: DataFrame) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its columns only."""
    mixed = mix(docs, quality)
    (turn,) = fresh(mixed, "_turn")
    taken = mixed.where("copies > 0").withColumn(turn, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken.select(*docs.columns)
