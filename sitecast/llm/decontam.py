"""Benchmark decontamination by spaced seeds.

Fixed masks over a span of tokens ignore some positions, so a copied passage is
still hit when tokens at those positions were replaced.  Hashes of the masked
tokens at every position of the training texts meet those of the benchmark; at each
hit the benchmark's windows are laid over the text, token by token, and one counts
when enough positions agree, whichever they are.

DataFrame functions only.  Tokens are runs of letters and digits in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecast.llm.tables import checked_side, fresh
from sitecast.session import materialize

#: Token offsets that each mask compares.  Of a window of ``SHORT_SPAN`` to ``WINDOW`` tokens in which a
#: share of ``AGREE`` agrees, wherever the others are, one mask at one place meets agreeing tokens only.
SEEDS = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4))
SEED_SPAN = 5
#: Fewest tokens of an item.
SHORT_SPAN = 6
#: Read by the SQL only: longer masks by length of the item, and one hit compared in so many tokens.
MASKS = ((0, 1, 2, 4, 5, 6, 8, 9, 10), (0, 1, 2, 5, 6, 7, 9, 10, 11), (0, 1, 2, 4, 5, 6, 9, 10, 11))
SHORT_MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 4, 5))
SPAN = 12
STRIDE = 8
#: Tokens of the window compared around a hit, and the share of them that must agree.
WINDOW = 24
AGREE = 0.8
#: Benchmark seeds up to so many are broadcast; more are shuffled.
SEED_ROWS = 2_000_000


def token_hashes(text: Column) -> Column:
    """A 64-bit hash of each token of a text, in order."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def _placed(df: DataFrame, keep: list[str], tokens: str, span: int) -> DataFrame:
    """One row for each token with the ``span`` tokens from there on as ``h0 ..``; null behind the end."""
    n = F.size(tokens)
    shifted = [F.col(tokens).alias("h0")] + [F.slice(tokens, k + 1, n).alias(f"h{k}") for k in range(1, span)]
    places = F.sequence(F.lit(0), n - 1).alias("pos")
    return df.where(n > 0).select(*keep, F.inline(F.arrays_zip(places, *shifted)))


def _seed(number: int, mask: tuple[int, ...]) -> Column:
    """Hash of the masked tokens; null where the span leaves the text."""
    return F.when(F.col(f"h{mask[-1]}").isNotNull(), F.xxhash64(F.lit(number), *[F.col(f"h{k}") for k in mask]))


def _segments(bench: DataFrame, item: str, text: str) -> DataFrame:
    """``(sid, item, segment)``: stretches of the items, ``sid`` alike for equal tokens.

    A segment has two windows' tokens and starts a window after the one before, so
    every window of an item lies in one of its segments.  Items of fewer than
    ``SHORT_SPAN`` tokens have none: so few words cannot be told from chance.
    """
    items = bench.select(F.col(item).alias("item"), token_hashes(F.col(text)).alias("t"))
    items = items.where(F.size("t") >= SHORT_SPAN).groupBy("t").agg(F.min("item").alias("item"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("t") - WINDOW, F.lit(0)), F.lit(WINDOW))
    cut = items.select("item", F.explode(F.transform(starts, lambda s: F.slice("t", s + 1, F.lit(2 * WINDOW)))).alias("segment"))
    return cut.distinct().select(F.xxhash64("segment").alias("sid"), "item", "segment")


def _seeds(df: DataFrame, keep: list[str], tokens: str) -> DataFrame:
    """``(*keep, pos, seed)``: the seeds at each place of the tokens."""
    rows = _placed(df, keep, tokens, SEED_SPAN)
    return rows.select(*keep, "pos", F.explode(F.array(*[_seed(k, m) for k, m in enumerate(SEEDS)])).alias("seed")).where("seed is not null")


def _most_agreeing() -> Column:
    """The most tokens that agree in any window of ``segment`` laid over ``t`` from ``start`` on."""

    def agree(k: Column) -> Column:
        return F.coalesce((F.get("segment", k) == F.get("t", F.col("start") + k)).cast("int"), F.lit(0))

    def step(a: Column, k: Column) -> Column:
        now = a["now"] + agree(k) - agree(k - WINDOW)
        return F.struct(now.alias("now"), F.greatest(a["best"], now).alias("best"))

    places = F.sequence(F.lit(0), F.size("segment") - 1)
    return F.aggregate(places, F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")), step, lambda a: a["best"])


def contaminated(
    docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``(doc, hash, item, n_match, n_window, share)`` of each document and benchmark item found in it.

    ``hash`` is a hash of the text, so rows with equal keys stay apart; ``n_match``
    of ``n_window`` tokens agree in the best window of the item.  Of items with
    equal tokens the least id is named; others that share a passage have a row each.  Null and
    empty texts match nothing; a null key is a key.  Empty tables give no rows.
    Positions of a window before or behind the text count as different.
    """
    owners = materialize(_segments(bench, item, item_text))
    segments = owners.dropDuplicates(["sid"]).select("sid", "segment")
    seeds = materialize(_seeds(segments, ["sid"], "segment"))
    n_seeds = seeds.count()

    named = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("hash"), token_hashes(F.col(text)).alias("t"))
    off = checked_side(seeds.select("seed", "sid", F.col("pos").alias("off")), n_seeds, SEED_ROWS)
    hits = _seeds(named, ["doc", "hash"], "t").join(off, "seed")
    hits = materialize(hits.select("doc", "hash", "sid", (F.col("pos") - F.col("off")).alias("start")).distinct())
    windows = hits.join(checked_side(segments, n_seeds, SEED_ROWS // 20), "sid")

    found = hits.select("doc", "hash").distinct()
    side = checked_side(materialize(found), found.count())
    raw = docs.select(F.col(key).alias("_d"), F.xxhash64(text).alias("_h"), F.col(text).alias("_text"))
    raw = raw.join(side, raw["_d"].eqNullSafe(side["doc"]) & (raw["_h"] == side["hash"]), "left_semi").dropDuplicates(["_d", "_h"])
    tokens = raw.select("_d", "_h", token_hashes(F.col("_text")).alias("t"))
    laid = windows.join(tokens, windows["doc"].eqNullSafe(tokens["_d"]) & (windows["hash"] == tokens["_h"]))
    laid = laid.select("doc", "hash", "sid", F.least(F.size("segment"), F.lit(WINDOW)).alias("n_window"), _most_agreeing().alias("n_match"))
    laid = laid.withColumn("best", F.struct((F.col("n_match") / F.col("n_window")).alias("share"), "n_match", "n_window"))
    best = laid.where(F.col("best.share") >= AGREE).groupBy("doc", "hash", "sid").agg(F.max("best").alias("best"))
    # Equal segments are compared once; here each item that holds one gets its row.
    best = best.join(checked_side(owners.select("sid", "item"), n_seeds, SEED_ROWS), "sid").groupBy("doc", "hash", "item").agg(F.max("best").alias("best"))
    return best.select(
        "doc", "hash", "item", F.col("best.n_match").cast("long").alias("n_match"), F.col("best.n_window").cast("long").alias("n_window"), "best.share"
    )


def without_contaminated(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, with the columns of ``docs``."""
    doc, hash_, own = fresh(docs, "_doc", "_hash", "_own")
    found = materialize(contaminated(docs, bench, key, text).select(F.col("doc").alias(doc), F.col("hash").alias(hash_)).distinct())
    mark = docs.withColumn(own, F.xxhash64(text))
    kept = mark.join(
        checked_side(found, found.count()), mark[key].eqNullSafe(found[doc]) & (mark[own] == found[hash_]), "left_anti"
    )
    return kept.select(*docs.columns)
