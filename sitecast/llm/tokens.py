"""Token ids in ORC: stripes with run-length encoded integers, row indexes and Bloom filters.

Documents are sorted by id across files, so a file, a stripe and a row group
each hold a range of ids; a reader skips them by their minimum, maximum and
Bloom filter, and reads stripes in parallel.  Rows are ``(doc_id, part, place,
start, n_tokens, ids)``: ``part`` is the writer's partition, ``place`` the row
inside it and ``start`` the ids before it inside the part; the sizes of the parts
(one row each) turn that into a position in the whole stream.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitecast.llm.text import chunks, utf8
from sitecast.session import shared_dir

#: Pieces of more bytes than this are encoded but not remembered.
PIECE = 64
#: Remembered pieces of a worker; beyond that it keeps only the frequent ones.
PIECES = 1_000_000
#: Uses after which a piece is kept when the memory is cleared.
OFTEN = 3
#: Pieces handed to the tokenizer at once, and bytes of text taken apart at once.
PIECES_AT_ONCE = 2_000
BATCH_BYTES = 1 << 22
#: Code points of three bytes that count as white space.
_WIDE_SPACES = np.array([c for c in range(0x800, 0x10000) if chr(c).isspace()], np.int32)


def _solid(data: np.ndarray, at: np.ndarray, before: bool) -> np.ndarray:
    """Whether the characters that end at the bytes ``at`` (``before``) or start there are no white space."""
    byte = data[at]
    out = (byte > 32) | (byte < 9) | ((byte > 13) & (byte < 28))
    wide = np.flatnonzero(byte >= 128)
    # All white space beyond ASCII has two bytes (C2 85, C2 A0) or three.
    first = at[wide] - 2 * before
    a, b, c = (data[np.clip(first + k, 0, len(data) - 1)].astype(np.int32) for k in range(3))
    code = ((a & 15) << 12) | ((b & 63) << 6) | (c & 63)
    three = (a >> 4 == 14) & np.isin(code, _WIDE_SPACES)
    lead, tail = (b, c) if before else (a, b)
    two = (lead == 0xC2) & ((tail == 0x85) | (tail == 0xA0))
    out[wide] = ~(three | two)
    return out


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start in UTF-8 texts that lie one after another.

    A piece starts where a text does, at a single space or line end between two
    characters that are no white space, and at a full stop or comma after an ASCII
    letter.  The tokenizer always starts a token there and looks at nothing before,
    so the pieces of a text are encoded alone.
    """
    first = np.zeros(len(data), bool)
    if len(data) > 2:
        blank = (data == 32) | (data == 10)
        at = np.flatnonzero(blank[1:-1]) + 1
        at = at[_solid(data, at - 1, True) & _solid(data, at + 1, False)]
        first[at] = True
        # A blank at either end of a text has no neighbour there.
        ends = offsets[(offsets > 0) & (offsets < len(data))]
        first[ends - 1] = False
        letter = ((data | 32) >= 97) & ((data | 32) <= 122)
        first[1:] |= letter[:-1] & ((data[1:] == 46) | (data[1:] == 44))
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(first)


class PieceEncoder:
    """Encodes texts piece by piece with ``tokenizer``; equal pieces are encoded once."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab()
        self.heads = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.heads[[n for token, n in vocabulary.items() if token[:1] == "\u0120"]] = True  # byte-level BPE writes a space so
        self.heads[tokenizer.encode("\n", add_special_tokens=False).ids] = True
        self.pieces = pa.array([], pa.string())
        self.ids = pa.array([], pa.list_(pa.int32()))
        self.uses = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the pieces that came often since the last time."""
        keep = self.uses >= OFTEN
        keep &= keep.sum() <= PIECES // 2
        self.pieces, self.ids = self.pieces.filter(pa.array(keep)), self.ids.filter(pa.array(keep))
        self.uses = np.zeros(len(self.pieces), np.int64)

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and the number of ids of each.

        Pieces with white space nowhere but at their start go through the tokenizer as
        one text.  Those that start with none follow a line end, whose id is taken out
        again.  So the first token of each, and no other, starts with a space or is a
        line end.
        """
        alone, joined, at, bare = [], [], [], []
        for k, piece in enumerate(pieces):
            words = piece.split()
            lead = piece[0] in " \n"
            if len(words) == 1 and len(words[0]) + lead == len(piece):
                joined.append(piece if lead else "\n" + piece)
                at.append(k)
                bare.append(not lead)
            else:
                alone.append(k)
        sizes, parts = np.zeros(len(pieces), np.int64), []
        for a in range(0, len(joined), PIECES_AT_ONCE):
            (got,) = self.tokenizer.encode_batch_fast(["".join(joined[a : a + PIECES_AT_ONCE])], add_special_tokens=False)
            ids = np.array(got.ids, np.int32)
            starts = np.flatnonzero(self.heads[ids])
            drop = np.array(bare[a : a + PIECES_AT_ONCE])
            assert len(starts) == len(drop)
            sizes[at[a : a + PIECES_AT_ONCE]] = np.diff(starts, append=len(ids)) - drop
            parts.append(np.delete(ids, starts[drop]))
        for k in alone:
            ids = np.array(self.tokenizer.encode(pieces[k], add_special_tokens=False).ids, np.int32)
            sizes[k] = len(ids)
            parts.append(ids)
        # Parts hold the joined pieces, then the others: back in the given order.
        order = np.array(at + alone, np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[order])])
        laid = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts), pa.int32()))
        return laid.take(pa.array(np.argsort(order))).flatten().to_numpy(), sizes

    def _add(self, pieces: pa.Array) -> None:
        ids, sizes = self._encoded(pieces.to_numpy(zero_copy_only=False).tolist())
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.ids = pa.concat_arrays([self.ids, pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32()))])
        self.uses = np.concatenate([self.uses, np.zeros(len(pieces), np.int64)])

    def encode(self, texts: pa.Array | list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end``, and the number of ids of each."""
        if len(self.pieces) > PIECES or len(self.ids.values) > 8 * PIECES:
            self._forget()
        data, offsets = utf8(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        starts = piece_starts(data, offsets)
        if not len(starts):
            return np.full(len(offsets) - 1, end, np.int32), np.ones(len(offsets) - 1, np.int64)
        edges = np.append(starts, len(data)).astype(np.int32)
        cut = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(data)).dictionary_encode()
        known = pc.index_in(cut.dictionary, value_set=self.pieces)
        new, count = known.is_null(), len(self.pieces)
        places = known.fill_null(0).to_numpy().astype(np.int64)
        places[new.to_numpy(zero_copy_only=False)] = np.arange(count, count + known.null_count)
        if known.null_count:
            self._add(cut.dictionary.filter(new))
        numbers = places[cut.indices.to_numpy()]
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        rows = self.ids.take(pa.array(numbers))
        sums = np.concatenate([[0], np.cumsum(rows.value_lengths().to_numpy())])
        last = sums[np.searchsorted(starts, offsets[1:])]
        keep = pc.less_equal(pc.binary_length(self.pieces), PIECE)
        if not pc.all(keep).as_py():
            self.pieces, self.ids = self.pieces.filter(keep), self.ids.filter(keep)
            self.uses = self.uses[keep.to_numpy(zero_copy_only=False)]
        return np.insert(rows.flatten().to_numpy(), last, end), np.diff(last, prepend=0) + 1


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    """This worker's encoder of a tokenizer file; its memory serves all its tasks."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _ENCODERS[path] = PieceEncoder(Tokenizer.from_file(path))
    return _ENCODERS[path]


def encode(docs: DataFrame, tokenizer: str, end: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, part, place, start, n_tokens, ids)`` in ascending order of the key.

    ``tokenizer`` is the path of a tokenizer file that each executor can open.  A
    null text is empty and has the end id only.  Null keys come first; equal keys
    are ordered by a hash of their text.  An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        part, place, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for a, b in chunks(utf8(batch.column(1))[1], BATCH_BYTES):
                ids, counts = encoder.encode(batch.column(1).slice(a, b - a), end)
                ends = np.concatenate([[0], np.cumsum(counts)])
                n = b - a
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, n),
                        pa.array(np.full(n, part), pa.int32()),
                        pa.array(np.arange(place, place + n), pa.int64()),
                        pa.array(start + ends[:-1], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                    ],
                    names=["doc_id", "part", "place", "start", "n_tokens", "ids"],
                )
                place, start = place + n, start + int(ends[-1])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
    return rows.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, part int, place long, start long, n_tokens long, ids array<int>")


def write_orc(encoded: DataFrame, path: str, stripe_bytes: int = 64 << 20, index_rows: int = 10_000) -> None:
    """Write encoded rows as ORC with a Bloom filter on ``doc_id`` and a row index."""
    writer = encoded.write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
    writer = writer.option("orc.create.index", "true").option("orc.row.index.stride", str(index_rows))
    writer.option("orc.stripe.size", str(stripe_bytes)).option("compression", "zstd").orc(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files with ``start`` counted over the whole stream."""
    rows = spark.read.orc(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("_size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each written partition, whatever the number of documents.
    bases = parts.select("part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    out = rows.join(F.broadcast(bases), "part")
    return out.withColumn("start", F.col("start") + F.col("_base")).drop("_base")


def checksums(rows: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``: crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(2)
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(ends), pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.select("doc_id", "start", "ids").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def new_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"


def through_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode ``docs``, write the files, and read them back."""
    spark = docs.sparkSession
    path = new_path(spark)
    write_orc(encode(docs, tokenizer), path)
    return read_orc(spark, path)
