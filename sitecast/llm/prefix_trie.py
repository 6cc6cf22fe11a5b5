"""Conversation prefix trie by a splitter skeleton.

Conversations are sorted as sequences of (role, text) turns with
``repartitionByRange``: every trie node is then a run of adjacent rows.  A
node whose run crosses a partition border is a common prefix of the rows on
both sides of that border; these prefixes form the *skeleton*, a trie of at
most (partitions - 1) x (depth + 1) nodes, which is found from the first and
last row of each partition and broadcast.  One ordered scan of each partition
then finishes every other node with a stack of open nodes (count, least
member, children, leaves and saved bytes of its subtree, and the SHA-256 of
the ids that end in it).  Skeleton nodes leave a partial row per partition,
and a reduction by node adds them up; their subtree sums add the partials of
their skeleton descendants, reached through the path each partial carries.

Node keys are 128-bit BLAKE2b chains over length-prefixed roles and texts, so
equal paths get equal keys in any partition.  A group of equal conversations
of any size is split by the range sort (the conv_id is part of the sort key)
and meets again only as skeleton partials; the ids that end in one node are
hashed in one task, as SHA-256 is sequential (about 10 bytes an id).

``rebuild`` makes the contract's conversations: the first h original turns of
conversation c - c % 5 (truncating %, as in SQL) and then c's own turns after
its first h, h = crc32(decimal c) % 9.  Turns are ordered by turn, nulls
first, ties by role and text; null role or text is empty; rows with a null
conv_id are left out; an empty table gives no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecast.session import materialize, shared_dir

# Fixed values of the contract.
PREFIX_OF, PREFIX_TURNS = 5, 9

ROOT = hashlib.blake2b(b"root", digest_size=16).hexdigest()
PARTIAL = (
    "skel boolean, depth long, key string, parent string, conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved long, last_bytes long, ends string, part int, path array<string>"
)


def rebuild(convs: DataFrame) -> DataFrame:
    """conv_id, seq (array of role, text): every conversation rebuilt, turnless ones with an empty seq."""
    rows = convs.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    turns = rows.select("conv_id", (F.row_number().over(order) - 1).alias("k"), "role", "text")
    ids = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    ids = ids.select(
        F.col("conv_id").alias("c"),
        (F.crc32(F.col("conv_id").cast("string")) % PREFIX_TURNS).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % PREFIX_OF).alias("b"),
    )
    base = ids.join(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("blen")), ids["b"] == F.col("conv_id"), "left")
    ids = base.select("c", "h", "b", F.least("h", F.coalesce("blen", F.lit(0))).alias("p"))
    head = ids.join(turns, (turns["conv_id"] == ids["b"]) & (turns["k"] < ids["h"])).select("c", F.col("k").alias("pos"), "role", "text")
    own = ids.join(turns, (turns["conv_id"] == ids["c"]) & (turns["k"] >= ids["h"])).select(
        "c", (F.col("p") + F.col("k") - F.col("h")).alias("pos"), "role", "text"
    )
    seqs = head.unionByName(own).groupBy("c").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("s"))
    seq = F.transform(F.coalesce("s", F.array()), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return ids.join(seqs, "c", "left").select(F.col("c").alias("conv_id"), seq.alias("seq"))


def chain(seq) -> list[str]:
    """Keys of the nodes on a conversation's path, depth 0 to its length."""
    out, key = [ROOT], bytes.fromhex(ROOT)
    for role, text in seq:
        h = hashlib.blake2b(key, digest_size=16)
        for part in (role.encode(), text.encode()):
            h.update(len(part).to_bytes(8, "little"))
            h.update(part)
        key = h.digest()
        out.append(key.hex())
    return out


def _turns(seq) -> list[tuple[str, str]]:
    return [(t["role"], t["text"]) for t in seq]


def _borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    first = last = None
    for batch in batches:
        if len(batch) and first is None:
            first = chain(_turns(batch["seq"].iloc[0]))
        if len(batch):
            last = chain(_turns(batch["seq"].iloc[-1]))
    if first is not None:
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "first": [first], "last": [last]})


def skeleton(borders: list) -> set[str]:
    """Keys of the nodes that cross a partition border: common prefixes of the rows beside each border."""
    out: set[str] = set()
    rows = sorted(borders, key=lambda r: r["part"])
    for a, b in zip(rows, rows[1:], strict=False):
        for x, y in zip(a["last"], b["first"], strict=False):
            if x != y:
                break
            out.add(x)
    return out


class _Node:
    __slots__ = ("key", "depth", "parent", "skel", "least", "count", "children", "leaves", "saved", "last_bytes", "ends")

    def __init__(self, key, depth, parent, skel, last_bytes):
        self.key, self.depth, self.parent, self.skel, self.last_bytes = key, depth, parent, skel, last_bytes
        self.least, self.count, self.children, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, []


def _scanner(skel: set[str]):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        stack: list[_Node] = []
        out: list[tuple] = []

        def close(node: _Node) -> None:
            ends = ",".join(str(i) for i in node.ends)
            if node.skel:
                path = [n.key for n in stack[: node.depth]] + [node.key]
                out.append((True, node.depth, node.key, node.parent, node.least, node.count, node.children, node.leaves, node.saved, node.last_bytes, ends, part, path))
                return
            leaves = 1 if node.children == 0 else node.leaves
            saved = node.saved + (node.count - 1) * node.last_bytes
            sha = hashlib.sha256(ends.encode()).hexdigest()
            out.append((False, node.depth, node.key, node.parent, node.least, node.count, node.children, leaves, saved, node.last_bytes, sha, part, None))
            if node.depth > 0:
                up = stack[node.depth - 1]
                up.leaves += leaves
                up.saved += saved

        for batch in batches:
            for conv_id, seq in zip(batch["conv_id"], batch["seq"], strict=True):
                turns = _turns(seq)
                keys = chain(turns)
                same = 0
                while same < len(stack) and same < len(keys) and stack[same].key == keys[same]:
                    same += 1
                while len(stack) > same:
                    close(stack[-1])
                    stack.pop()
                for d in range(same, len(keys)):
                    node = _Node(keys[d], d, keys[d - 1] if d else None, keys[d] in skel, len(turns[d - 1][1].encode()) if d else 0)
                    if d and not node.skel:
                        stack[d - 1].children += 1
                    stack.append(node)
                for node in stack:
                    node.count += 1
                    node.least = conv_id if node.least is None else min(node.least, conv_id)
                stack[-1].ends.append(int(conv_id))
            if len(out) >= 4096:
                yield pd.DataFrame(out, columns=_COLUMNS)
                out.clear()
        while stack:
            close(stack[-1])
            stack.pop()
        yield pd.DataFrame(out, columns=_COLUMNS)

    return scan


_COLUMNS = [f.split(" ")[0] for f in PARTIAL.split(", ")]


def _sorted_shards(convs: DataFrame) -> DataFrame:
    spark = convs.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = convs.repartitionByRange(n, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    return ordered.checkpoint(eager=True)


def trie(convs: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per node.

    ``convs`` holds conv_id and seq (array of role, text), one row per conversation.
    """
    shards = _sorted_shards(convs.select("conv_id", "seq"))
    borders = [r.asDict() for r in shards.mapInPandas(_borders, "part int, first array<string>, last array<string>").collect()]
    skel = skeleton(borders)
    partial = materialize(shards.mapInPandas(_scanner(skel), PARTIAL))
    local = partial.where(~F.col("skel")).select(
        "depth", "key", "parent", "conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")
    )
    sk = partial.where(F.col("skel")).groupBy("key").agg(
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("local_children"),
        F.sum("n_leaves").alias("sub_leaves"),
        F.sum("saved").alias("sub_saved"),
        F.first("last_bytes").alias("last_bytes"),
        F.first("path").alias("path"),
        F.sort_array(F.collect_list(F.struct("part", "ends"))).alias("pieces"),
    )
    kids = sk.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("skel_children"))
    sk = materialize(sk.join(kids, "key", "left").withColumn("n_children", F.col("local_children") + F.coalesce("skel_children", F.lit(0))))
    own = sk.select(
        F.explode("path").alias("key"),
        (F.when(F.col("n_children") == 0, 1).otherwise(0) + F.col("sub_leaves")).alias("l"),
        ((F.col("n_convs") - 1) * F.col("last_bytes") + F.col("sub_saved")).alias("s"),
    )
    sums = own.groupBy("key").agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens"))
    ends = F.array_join(F.filter(F.transform("pieces", lambda p: p["ends"]), lambda e: e != ""), ",")
    skel_rows = sk.join(sums, "key").select(
        "depth", "key", "parent", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.sha2(ends, 256).alias("ends_sha256")
    )
    nodes = materialize(local.unionByName(skel_rows))
    up = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(up, "parent", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("n_leaves").cast("long").alias("n_leaves"),
        F.col("saved_tokens").cast("long").alias("saved_tokens"),
        "ends_sha256",
    )
