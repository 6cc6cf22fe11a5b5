"""N-gram Jaccard join by multiple-global-order filtering.

Two documents link when ``100 * |x & y| >= 75 * |x | y|`` on their sets of
five-word shingles.  A linked pair shares at least ``ceil(0.75 |x|)`` tokens of
each side, so under *any* total order of tokens it shares one of the first
``|x| - ceil(0.75 |x|) + 1`` tokens of ``x``.  Each order here puts rare tokens
first, by a frequency sketch of fixed size, and orders equal classes by a hash
of its own; pairs must pass the filter of every order before their sets are
intersected.

1. One pass fills the sketch: 2^16 to 2^24 counters, growing with the document
   count, summed block by block while rows stream through.
2. One pass stores, per document, its set size, a fingerprint of its set (equal
   sets are one *node*) and its prefix under the first order.
3. Rows (token, node) meet by token.  Every node of a token is compared with one
   leading node only, which joins groups of near copies at linear cost.
4. What is still apart is compared in full: all pairs of nodes that share a
   prefix token and lie in different components so far, less those whose shared
   tokens come too late or are too few.
5. Verified links give components; documents get the least ``doc_id``.

Shingles are 64-bit hashes; a node's fingerprint mixes all of them and their
number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecast.llm.components import connected_components
from sitecast.llm.tables import checked_side, fresh
from sitecast.llm.text import digest, lists, mix, shingle_sets
from sitecast.session import materialize

#: The similarity is at least NUM / DEN.
NUM, DEN = 75, 100
#: One salt for each global order.
ORDERS = (0x51ED270B0A1F39C1, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)
#: Tokens that pairs still apart must share before their cuts, as a share of both sizes.
MARGIN = 0.015
BLOCK = 1 << 16


def _bits(rows: int) -> int:
    """log2 of the number of counters: about eight for each document, within fixed bounds."""
    return min(24, max(16, (8 * max(rows, 1)).bit_length()))


def prefix_length(n: np.ndarray | int):
    """Tokens of a set of ``n`` of which a linked set shares at least one."""
    return n + (NUM * n) // -DEN + 1


def frequency_classes(docs: DataFrame, text: str, bits: int) -> bytes:
    """log2 class of each counter of a sketch of all shingles, one byte each.

    At most 2^24 bytes whatever the input, so it may pass through the driver.
    """
    counters = 1 << bits
    shift = np.uint64(64 - bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, np.uint32)
        held, size = [], 0
        for batch in batches:
            for tokens in shingle_sets(batch.column(0)):
                held.append(tokens)
                size += len(tokens)
                if size >= counters:
                    total += np.bincount((np.concatenate(held) >> shift).astype(np.int64), minlength=counters).astype(np.uint32)
                    held, size = [], 0
        if held:
            total += np.bincount((np.concatenate(held) >> shift).astype(np.int64), minlength=counters).astype(np.uint32)
        # High bytes are mostly zero: laid apart, they compress away in the shuffle.
        for k in range(counters // BLOCK):
            part = total[k * BLOCK : (k + 1) * BLOCK]
            if part.any():
                planes = part.view(np.uint8).reshape(-1, 4).T.tobytes()
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "counts": pa.array([planes], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, planes in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(planes.as_buffer(), np.uint8).reshape(4, -1).T.copy().view(np.uint32)[:, 0]
                sums[k] = sums.get(k, 0) + part.astype(np.uint64)
        for k, part in sums.items():
            classes = np.frexp(part.astype(np.float64))[1].astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "counts": pa.array([classes], pa.binary())})

    schema = "block int, counts binary"
    parts = docs.select(text).mapInArrow(count, schema)
    out = bytearray(counters)
    for row in parts.repartition("block").mapInArrow(merge, schema).collect():
        out[row.block * BLOCK : (row.block + 1) * BLOCK] = row.counts
    return bytes(out)


def order_keys(tokens: np.ndarray, classes: np.ndarray, order: int) -> np.ndarray:
    """Place of each token in one global order: its frequency class, then a hash."""
    shift = np.uint64(64 - (len(classes).bit_length() - 1))
    rank = classes[(tokens >> shift).astype(np.int64)].astype(np.uint64) << np.uint64(56)
    return rank | (mix(tokens ^ np.uint64(ORDERS[order])) >> np.uint64(8))


def prefix(tokens: np.ndarray, classes: np.ndarray, order: int) -> np.ndarray:
    """The first ``prefix_length`` tokens of a sorted set in one global order."""
    size = prefix_length(len(tokens))
    if size >= len(tokens):
        return tokens
    keys = order_keys(tokens, classes, order)
    # A stable sort breaks equal keys by the token itself, the same way everywhere.
    return tokens[np.argsort(keys, kind="stable")[:size]]


def _stored_prefixes(docs: DataFrame, key: str, text: str, classes) -> DataFrame:
    """``key``, a hash of the text, set size, node and first-order prefix of each document, stored."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(classes.value, np.uint8)
        for batch in batches:
            sizes, nodes, prefixes, seen = [], [], [], set()
            for tokens in shingle_sets(batch.column(2)):
                sizes.append(len(tokens))
                nodes.append(digest(tokens) if len(tokens) else None)
                if len(tokens) and nodes[-1] not in seen:  # a copy in the same batch adds nothing
                    seen.add(nodes[-1])
                    prefixes.append(prefix(tokens, table, 0).view(np.int64))
                else:
                    prefixes.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), lists(prefixes, pa.int64())],
                names=["doc", "hash", "n", "node", "prefix"],
            )

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    return materialize(rows.mapInArrow(describe, f"doc {kind}, hash long, n long, node long, prefix array<long>"))


def _verify(pairs: DataFrame, texts: DataFrame, classes) -> DataFrame:
    """The pairs ``(src, dst)`` whose sets are as similar as asked.

    Each pair must share a prefix token under every order before its sets are
    intersected.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(classes.value, np.uint8)
        last_id, last = None, None
        for batch in batches:
            keep = []
            lefts = shingle_sets(batch.column(2))
            for dst, place, x in zip(batch.column(1).to_pylist(), range(len(batch)), lefts, strict=True):
                if dst != last_id:  # rows arrive sorted by dst
                    last_id = dst
                    y = next(shingle_sets(batch.column(3).slice(place, 1)))
                    last = y, [prefix(y, table, k) for k in range(len(ORDERS))]
                y, heads = last
                n, m = len(x), len(y)
                ok = DEN * min(n, m) >= NUM * max(n, m) and all(
                    len(np.intersect1d(prefix(x, table, k), heads[k], True)) for k in range(len(ORDERS))
                )
                if ok:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok = DEN * both >= NUM * (n + m - both)
                keep.append(ok)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("node").alias("src"), F.col("text").alias("a"))
    right = texts.select(F.col("node").alias("dst"), F.col("text").alias("b"))
    met = pairs.join(left, "src").join(right, "dst").select("src", "dst", "a", "b")
    return materialize(met.mapInArrow(check, "src long, dst long"))


def _spot(col: str) -> tuple[Column, Column]:
    """Set size and place that a column packs."""
    return F.shiftright(col, 32), F.col(col).bitwiseAND(F.lit((1 << 32) - 1))


def _alike(n: Column, m: Column) -> Column:
    """Whether sets of these sizes can link."""
    return (n * DEN >= m * NUM) & (m * DEN >= n * NUM)


def _least(n: Column, m: Column) -> Column:
    """Tokens that linked sets of these sizes have in common at least."""
    return F.floor(((n + m) * NUM + NUM + DEN - 1) / F.lit(NUM + DEN))


def jaccard_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, hash, n, node, root, component)`` of each row of ``docs``.

    ``n`` is the set size, ``hash`` a hash of the text, ``root`` names the class
    and ``component`` is its least ``key``.  A row without words or text has no
    node and is a class of its own.  Repeated rows share a class; a null key is
    never the least one unless all are null.  An empty table gives no rows; other
    columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(key, text)
    bits = _bits(docs.count())
    classes = spark.sparkContext.broadcast(frequency_classes(docs, text, bits))
    stored = _stored_prefixes(docs, key, text, classes)

    # Rows (token, node) of tokens that two nodes share.  ``spot`` packs the set size
    # and the token's place in the prefix.  ``lead`` is the node in which the token
    # comes earliest (of a group of near copies, one with few tokens of its own),
    # where this may be the first token that both share.
    rows = stored.select("node", "n", F.posexplode("prefix").alias("i", "token"))
    rows = rows.select("token", "node", (F.shiftleft("n", 32) + F.col("i")).alias("spot"))
    by_token = Window.partitionBy("token")
    earliest = F.min(F.struct(_spot("spot")[1].alias("i"), "node", "spot")).over(by_token)
    met = rows.withColumns({"_lead": earliest, "_least": F.min("node").over(by_token), "_last": F.max("node").over(by_token)})
    met = met.where("_least <> _last")
    n, i = _spot("spot")
    m, j = _spot("_lead.spot")
    first = (F.col("node") != F.col("_lead.node")) & _alike(n, m) & (i <= n - _least(n, m)) & (j <= m - _least(n, m))
    shared = materialize(met.select("token", "node", "spot", F.when(first, F.col("_lead.node")).alias("lead")))

    # The texts of nodes that share a token with another: one row each.
    inside = shared.select("node").distinct()
    firsts = stored.where("node is not null").groupBy("node").agg(F.min(F.struct("doc", "hash")).alias("at"))
    wanted = materialize(firsts.join(inside, "node", "left_semi").select("node", "at.doc", "at.hash"))
    side = checked_side(wanted, wanted.count())
    named = docs.select(F.col(key).alias("_doc"), F.xxhash64(text).alias("_hash"), F.col(text).alias("text"))
    found = named.join(side, F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_hash") == F.col("hash")))
    texts = materialize(found.groupBy("node").agg(F.min("text").alias("text")) if _repeats(stored) else found.select("node", "text"))

    # Links to the leading node of a token, and the components that they give.
    stars = shared.where("lead is not null").select(F.col("node").alias("src"), F.col("lead").alias("dst"))
    stars = materialize(stars.distinct())
    links = _verify(stars, texts, classes)
    parts = connected_components(links)

    # Pairs still apart.  A link needs ``least`` common tokens.  Cut both sets behind
    # their first ``n - least + some`` tokens: the cut that comes first leaves at most
    # ``least - some`` tokens of its set behind it, so linked sets share ``some``
    # tokens before both cuts.
    apart = shared.select("token", "node", "spot").distinct().join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    tokens = apart.groupBy("token").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select("token")
    apart = materialize(apart.join(tokens, "token", "left_semi").select("token", "node", "part", "spot"))

    def ends(node: str, part: str) -> DataFrame:
        n, place = _spot("spot")
        return apart.select("token", F.col("node").alias(node), F.col("part").alias(part), n.alias(node + "_n"), place.alias(node + "_i"))

    n, m = F.col("src_n"), F.col("dst_n")
    behind = lambda n: F.floor((n * NUM - 1) / F.lit(DEN))  # noqa: E731  tokens behind the stored prefix
    some = F.least(1 + F.floor((n + m) * MARGIN), _least(n, m) - behind(n), _least(n, m) - behind(m))
    front = (F.col("src_i") < n - _least(n, m) + some) & (F.col("dst_i") < m - _least(n, m) + some)
    met = ends("src", "p").join(ends("dst", "q"), "token").where((F.col("p") < F.col("q")) & _alike(n, m) & front)
    met = met.groupBy("src", "dst", "src_n", "dst_n").agg(F.count("*").alias("c"))
    more = met.where(F.col("c") >= some).select("src", "dst")
    more = more.join(stars, ["src", "dst"], "left_anti").join(
        stars.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_anti"
    )
    later = _verify(materialize(more), texts, classes)
    if later.isEmpty():
        roots = parts
    else:
        roots = connected_components(links.union(later))

    # The least document of each class.
    least_doc = stored.where("node is not null").groupBy("node").agg(F.min("doc").alias("doc"))
    rooted = least_doc.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("root"), "doc")
    tops = rooted.groupBy("root").agg(F.min("doc").alias("component"))
    classes_of = rooted.drop("doc").join(tops, "root")
    return (
        stored.drop("prefix")
        .join(classes_of, "node", "left")
        .select("doc", "hash", "n", "node", "root", F.when(F.col("node").isNull(), F.col("doc")).otherwise(F.col("component")).alias("component"))
    )


def _repeats(stored: DataFrame) -> bool:
    """Whether a (key, text) occurs more than once."""
    return not stored.groupBy("doc", "hash").count().where("count > 1").isEmpty()


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class of linked documents, with the columns of ``docs``.

    The row with the class's least key stays (of rows with that key, the one
    whose text hash is least; of repeated rows, one).  Rows without words or text
    are linked with nothing and all stay, repeated ones too.
    """
    tagged = jaccard_classes(docs, key, text)
    best = tagged.where("root is not null").groupBy("root").agg(
        F.min(F.struct(F.col("doc").isNull().alias("null"), "doc", "hash")).alias("at")
    )
    keep = best.select(F.col("at.doc").alias("_doc"), F.col("at.hash").alias("_hash"))
    empty = tagged.where("node is null").select(F.col("doc").alias("_doc"), F.col("hash").alias("_hash")).distinct()
    doc, hash_, one = fresh(docs, "_doc", "_hash", "_one")
    keep = materialize(keep.withColumn("_one", F.lit(True)).union(empty.withColumn("_one", F.lit(False))).toDF(doc, hash_, one))
    mark = docs.withColumn(one + "h", F.xxhash64(text))
    kept = mark.join(
        checked_side(keep, keep.count()), mark[key].eqNullSafe(keep[doc]) & (mark[one + "h"] == keep[hash_])
    )
    if _repeats(tagged):
        again = tagged.groupBy("doc", "hash").count().where("count > 1").select(F.col("doc").alias("_rd"), F.col("hash").alias("_rh"))
        twice = kept.join(again, kept[key].eqNullSafe(again["_rd"]) & (kept[hash_] == again["_rh"]), "left_semi")
        once = kept.join(again, kept[key].eqNullSafe(again["_rd"]) & (kept[hash_] == again["_rh"]), "left_anti")
        singles = twice.where(one).dropDuplicates([doc, hash_])
        kept = once.unionByName(singles).unionByName(twice.where(~F.col(one)))
    return kept.select(*[kept[c] for c in docs.columns])
