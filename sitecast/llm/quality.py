"""Quality rules: compression bands over whole documents and fixed chunks.

A text that repeats itself compresses far better than prose of its length, and
random text far worse.  Longer prose compresses better, so both limits depend on
the length; they are linear in its logarithm between the knots below.  A document
fails when its whole ratio leaves the band, when more than ``CHUNK_SHARE`` of its
chunks do, or when more than ``NOISE_SHARE`` of its bytes lie in pieces that
compress like noise.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from sitecast.llm.tables import fresh
from sitecast.llm.text import chunks, mix, stream, utf8, word_hashes

LEVEL = 3
#: (bytes, ratio): a whole text of at least the first length is held to these.
UPPER = ((300, 2.10), (1_000, 2.17), (2_000, 2.29), (4_000, 2.36), (8_000, 2.47), (16_000, 2.55), (32_000, 2.61), (64_000, 2.68), (200_000, 2.80))
LOWER = ((150, 1.07), (200, 1.13), (300, 1.20), (400, 1.25), (600, 1.32), (1_000, 1.42), (2_000, 1.50), (4_000, 1.55), (8_000, 1.58), (16_000, 1.60))
CHUNK = 4_096
CHUNK_BAND = (1.55, 2.38)
CHUNK_SHARE = 0.1
#: Pieces held to ``LOWER`` only; the last one takes the rest of the text.
PIECE = 500
NOISE_SHARE = 0.1
#: Fixed values of the base rule.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
WINDOW = 3
REPEAT_PERCENT = 50

_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "n_chunks", "n_bad_chunks", "kept")
_TYPES = ("long", "long", "long", "long", "long", "boolean", "double", "long", "long", "boolean")
_SPARK = {"long": LongType(), "double": DoubleType(), "boolean": BooleanType()}
_ARROW = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def limit(n: int, knots: Sequence[tuple[int, float]]) -> float:
    """The limit for ``n`` bytes, linear in log(n) between knots and level outside."""
    return float(np.interp(np.log(max(n, 1)), [np.log(k) for k, _ in knots], [v for _, v in knots]))


def repeated_window_words(words: np.ndarray) -> int:
    """Words inside windows of ``WINDOW`` words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    weights = stream(WINDOW, 41)
    with np.errstate(over="ignore"):
        grams = words[:n] * weights[0]
        for k in range(1, WINDOW):
            grams += words[k : n + k] * weights[k]
    _, inverse, counts = np.unique(mix(grams), return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[starts + k] = True
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _within(part: bytes, ratio: float) -> bool:
    """Whether the ratio of a chunk is in the band for its length."""
    n = len(part)
    if n == CHUNK:
        return CHUNK_BAND[0] <= ratio <= CHUNK_BAND[1]
    return limit(n, LOWER) <= ratio <= limit(n, UPPER)


def bands(data: bytes, compressor) -> tuple[float, int, int, bool]:
    """Whole ratio (0 for an empty text), chunks with the last partial one, chunks outside their band, and the verdict.

    A text of one chunk has none, and a rest of fewer bytes than ``UPPER`` starts at is none.
    """
    n = len(data)
    if not n:
        return 0.0, 0, 0, False

    def ratio(part: bytes) -> float:
        return len(part) / len(compressor.compress(part))

    whole = ratio(data)
    good = (n < LOWER[0][0] or limit(n, LOWER) <= whole) and (n < UPPER[0][0] or whole <= limit(n, UPPER))
    parts = [p for k in range(0, n, CHUNK) if len(p := data[k : k + CHUNK]) >= UPPER[0][0]] if n > CHUNK else []
    parts = parts if len(parts) > 1 else []
    bad = sum(not _within(p, ratio(p)) for p in parts)
    noise = 0
    if n >= 2 * PIECE:
        starts = range(0, n - PIECE + 1, PIECE)
        pieces = [data[k : k + PIECE if k < starts[-1] else n] for k in starts]
        noise = sum(len(p) for p in pieces if ratio(p) < limit(len(p), LOWER))
    return whole, len(parts), bad, good and bad <= CHUNK_SHARE * len(parts) and noise <= NOISE_SHARE * n


def _describe(column: pa.Array) -> Iterator[tuple]:
    data, offsets = utf8(column)
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    spaces = [chr(c) for c in (32, 9, 10, 11, 12, 13)]
    for first, last in chunks(offsets):
        lo = offsets[first]
        words, before = word_hashes(data[lo : offsets[last]], offsets[first : last + 1] - lo, fold=False)
        for k in range(first, last):
            raw = data[offsets[k] : offsets[k + 1]].tobytes()
            text = raw.decode("utf-8", "replace")
            own = words[before[k - first] : before[k - first + 1]]
            n = len(own)
            repeats = repeated_window_words(own)
            failed = n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n
            ratio, full, bad, good = bands(raw, compressor)
            chars = len(text) - sum(text.count(c) for c in spaces)
            yield n, chars, sum(text.count(c) for c in SYMBOLS), repeated_lines(text), repeats, failed, ratio, full, bad, good and not failed


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the figures and verdicts of each row.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed`` (too few words, or too many in repeated
    windows), ``ratio``, ``n_chunks``, ``n_bad_chunks`` and ``kept``.  A null or
    empty text has no words and fails.  Each row is judged alone, repeated rows
    alike.  Columns of ``docs`` with these names are replaced; an empty table gives
    no rows.
    """
    docs = docs.drop(*_NAMES)
    (raw,) = fresh(docs, "_raw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*_describe(batch.column(batch.num_columns - 1)), strict=True)) or [()] * len(_NAMES)
            more = [pa.array(v, _ARROW[t]) for v, t in zip(found, _TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *more], names=[*batch.schema.names[:-1], *_NAMES])

    schema = StructType([*docs.schema.fields, *[StructField(n, _SPARK[t]) for n, t in zip(_NAMES, _TYPES, strict=True)]])
    return docs.withColumn(raw, F.col(text)).mapInArrow(run, schema)


def passing(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that are kept, with the columns of ``docs``, also such that share a name with a figure."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    flagged = quality_rules(docs.toDF(*names), names[docs.columns.index(text)])
    return flagged.where("kept").select(*names).toDF(*docs.columns)
