"""Language identification by error-correcting output codes.

Each language has a codeword of bits; one linear classifier per bit, on hashed
byte n-grams, says on which side of the bit a text lies.  Decoding adds up the
losses of a codeword's bits, each weighted by how reliable its classifier was on
the training rows, and takes the nearest codeword; a small lead over the second
nearest flags the text as ambiguous.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.llm.text import chunks, utf8

#: Documents that the classifiers are fitted on: about so many, spread over the languages.
SAMPLE = 2_400
#: Least number of documents of a language in the sample, if it has them.
LEAST = 20
BITS = 12
SIZES = (1, 2, 3)
UNKNOWN = "und"
AMBIGUOUS = 0.6
_LETTER = re.compile(r"[^\W\d_]")
#: ASCII letters in lower case and all bytes of other characters; anything else is a space.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint32)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """One row of +1/-1 bits per language, rows and columns far apart.

    Up to five languages get every split of them; more get random splits, drawn
    until their least distance is the best of many draws.
    """
    if n <= 5:
        ids = np.arange(1, max(2, 1 << max(n - 1, 1)))
        return np.array([[1 if (k >> r) & 1 else -1 for k in ids] for r in range(n)], np.float32)
    draw, width = np.random.default_rng(seed), max(15, 6 * int(np.ceil(np.log2(n))))
    best, far = None, -1
    for _ in range(200):
        code = draw.choice(np.array([-1, 1], np.float32), (n, width))
        apart = (width - code @ code.T) / 2 + np.eye(n) * width
        if apart.min() > far and (np.abs(code.sum(0)) < n).all():
            best, far = code, apart.min()
    return best


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """Matrices of square roots of hashed n-gram counts, rows of length 1, in row order."""
    data, offsets = utf8(column)
    dims = 1 << BITS
    for first, last in chunks(offsets, 1 << 20):
        lo = offsets[first]
        codes = _FOLD[data[lo : offsets[last]]]
        grams = []
        for size in SIZES:
            n = max(len(codes) - size + 1, 0)
            value = np.zeros(n, np.uint32)
            for k in range(size):
                value = value * np.uint32(0x01000193) + codes[k : n + k] + np.uint32(size)
            grams.append((value * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
        out = np.zeros((last - first, dims), np.float32)
        for k in range(first, last):
            a, b = offsets[k] - lo, offsets[k + 1] - lo
            for size, values in zip(SIZES, grams, strict=True):
                if b - a >= size:
                    out[k - first] += np.bincount(values[a : b - size + 1], minlength=dims)
        np.sqrt(out, out)
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
        yield out


@dataclass(frozen=True)
class Coder:
    """Languages, their codewords, one weight column per bit, and the weight of each bit's loss."""

    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its share of the likelihood, and whether it is ambiguous."""
        margins = x @ self.weights + self.bias
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None]) @ self.trust
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        best = share.argmax(1)
        score = share[np.arange(len(x)), best]
        return best, score, score < AMBIGUOUS


def fit(texts: list[str], langs: list[str], steps: int = 120, rate: float = 0.5, decay: float = 1e-5) -> Coder:
    """Fit all bit classifiers together by logistic loss and Adam."""
    names = sorted(set(langs))
    code = codewords(len(names))
    x = np.concatenate(list(features(pa.array(texts, pa.string())))) if texts else np.zeros((0, 1 << BITS), np.float32)
    y = code[[names.index(v) for v in langs]]
    share = np.array([langs.count(v) for v in names])
    rows = (len(langs) / (len(names) * share))[[names.index(v) for v in langs]].astype(np.float32)[:, None]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for step in range(1, steps + 1):
        slope = -y * rows / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30))) / len(x)
        for p, g, m, v in ((w, x.T @ slope + decay * w, mw, vw), (b, slope.sum(0), mb, vb)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    right = ((x @ w + b) * y > 0).mean(0)
    trust = np.clip(right, 0.5, 1) * 2 - 1
    return Coder(names, code, w, b, (trust / max(trust.mean(), 1e-9)).astype(np.float32))


def training_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(text, lang)``: about ``SAMPLE`` labelled rows, chosen by a hash of key and text.

    Each language gives an equal number, or all it has.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) > 0))
    counts = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}
    quota = max(LEAST, SAMPLE // max(1, len(counts)))
    place = F.pmod(F.xxhash64(key, text), F.lit(1_000_000)) / 1_000_000
    shares = [(v, min(1.0, quota / n)) for v, n in counts.items()]
    pick = F.lit(False)
    for v, share in shares:
        pick = pick | ((F.col(lang) == v) & (place < share))
    # Equal texts share a place only with equal keys, so the limit is a guard, not a rule.
    return known.where(pick).select(F.col(text).alias("text"), F.col(lang).alias("lang")).limit(2 * max(SAMPLE, LEAST * len(counts)))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Coder | None:
    """A coder from the labelled rows of ``docs``; none without a labelled row."""
    rows = training_rows(docs, key, text, lang).toArrow().sort_by([("lang", "ascending"), ("text", "ascending")])
    if not rows.num_rows:
        return None
    return fit(rows["text"].to_pylist(), rows["lang"].to_pylist())


def predict(docs: DataFrame, coder: Coder | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, lang_pred, score, ambiguous)`` of each row; only the text is looked at.

    A null text or one without a letter is ``und`` with score 0, as is every text
    when nothing was learned.  Repeated rows are judged alike; an empty table gives
    no rows.
    """
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            names, scores, doubts = [], [], []
            if coder is not None:
                for x in features(texts):
                    best, score, doubt = coder.decode(x)
                    names += [coder.langs[k] for k in best]
                    scores += score.tolist()
                    doubts += doubt.tolist()
            else:
                names, scores, doubts = [UNKNOWN] * len(batch), [0.0] * len(batch), [True] * len(batch)
            for k, value in enumerate(texts):
                s = value.as_py()
                if not s or not _LETTER.search(s):
                    names[k], scores[k], doubts[k] = UNKNOWN, 0.0, True
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(np.clip(scores, 0, 1), pa.float64()), pa.array(doubts, pa.bool_())],
                names=[key, "lang_pred", "score", "ambiguous"],
            )

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double, ambiguous boolean")
