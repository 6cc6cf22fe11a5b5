"""Spelling variants: near words found by blocked Gram matrices of letter counts.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased
(other letters are left as they are).  ``noisy_words`` may delete one code
point of a run by a crc32 rule, so that the corpus holds misspellings; words
of at least ``MIN_LEN`` code points seen at least ``MIN_COUNT`` times are kept
with their count ``n``.

Two words are near when one edit (insert, delete or replace one code point)
turns one into the other.  Such words have letter-count vectors at squared
distance 1 (lengths differ by one) or 2 (equal lengths), so they differ in at
most two counts.  The letters are dealt into four groups; a near pair leaves
two groups untouched, so for one of the six pairs of groups both words have
the same sorted letters of those groups.  Words are blocked by that key (six
keys a word), then by length, then by a hash into chunks of about ``BLOCK``
words, so a hot key is split.  Every pair of chunks of one key and of equal or
adjacent lengths meets in one task, which forms the count matrices, takes the
Gram product ``A @ B.T`` with NumPy and reads squared distances as
``|a|^2 + |b|^2 - 2 a.b``.  Only pairs at the right distance are checked for one
edit; pairs found under several keys are kept once.  No pair is a row unless
it is at distance at most two.

A word's form is its near word of largest n (ties: least in code-point order)
if that n is at least twice its own; its root follows forms to the end
(chains are short: n at least doubles a step).  Roots are found by pointer
doubling, each round stored.

Null texts give no runs; a null doc_id makes the noise rule silent for its
runs; empty input gives an empty result.  Repeated rows count again.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.llm.tables import checked_side
from sitecast.session import materialize

# Fixed values of the contract.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOISE_MOD = 97
MIN_LEN, MIN_COUNT = 5, 3
#: Words a block holds, about; a task multiplies two blocks.
BLOCK = 256
#: Letter groups; a block key holds the letters of two of them.
GROUPS = 4
#: a-z by falling frequency in English prose, to spread letters evenly over the groups.
FREQUENT = "etaoinsrhldcumfpgwybvkxjqz"
#: Columns of a count vector: a-z, then U+00C0 to U+00FF.
DIMS = 26 + 64


def noisy_words(docs: DataFrame) -> DataFrame:
    """One row per run of every text: ``word`` after lower-casing and the noise rule."""
    run = F.explode(F.regexp_extract_all(F.col("text"), F.lit(LETTERS), 0)).alias("run")
    runs = docs.select(F.col("doc_id").cast("string").alias("d"), run)
    low = F.translate("run", UPPER, LOWER)
    h = F.crc32(F.concat(F.col("d"), F.lit(":"), low))
    cut = (h % F.char_length(low)).cast("int")
    dropped = F.concat(low.substr(F.lit(1), cut), low.substr(cut + 2, F.lit(1 << 30)))
    return runs.select(F.when((h % NOISE_MOD) == 0, dropped).otherwise(low).alias("word"))


def counted_words(docs: DataFrame) -> DataFrame:
    """word, n: words of at least MIN_LEN code points seen at least MIN_COUNT times."""
    words = noisy_words(docs).where(F.char_length("word") >= MIN_LEN)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def one_edit(a: str, b: str) -> bool:
    """True if one insert, delete or replace of a code point turns ``a`` into ``b``."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i + 1 :] == b[i:]


def counts(words: list[str]) -> np.ndarray:
    """Letter-count matrix, one row per word."""
    out = np.zeros((len(words), DIMS), dtype=np.float64)
    if not words:
        return out
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
    cols = np.where(codes >= 0xC0, codes - 0xC0 + 26, codes - ord("a"))
    np.add.at(out, (rows, cols), 1.0)
    return out


def _near_in_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out_a, out_b = [], []
        for wa, wb, same in zip(batch["wa"], batch["wb"], batch["same"], strict=True):
            wa, wb = list(wa), list(wb)
            a, b = counts(wa), counts(wb)
            d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
            want = 2.0 if len(wa[0]) == len(wb[0]) else 1.0
            hit = np.abs(d2 - want) < 0.5
            if same:
                hit = np.triu(hit, 1)
            for i, j in zip(*np.nonzero(hit), strict=True):
                if one_edit(wa[i], wb[j]):
                    out_a.append(wa[i])
                    out_b.append(wb[j])
        yield pd.DataFrame({"a": out_a, "b": out_b}, dtype=object)


def _group_letters() -> list[str]:
    """The letters of each of ``GROUPS`` groups: a-z dealt by rank in ``FREQUENT``, then U+00C0 to U+00FF in turn."""
    letters = list(FREQUENT) + [chr(c) for c in range(0xC0, 0x100)]
    return ["".join(letters[g::GROUPS]) for g in range(GROUPS)]


def block_keys(word) -> list:
    """For each pair of groups: the word's letters in those groups, sorted.

    Words one edit apart differ in at most two letter counts, so at least two
    of the four groups are untouched and one pair of groups gives both the same key.
    """
    groups = _group_letters()
    alphabet = "".join(groups)
    out = []
    for p, (g, h) in enumerate(itertools.combinations(range(GROUPS), 2)):
        others = "".join(x for k, x in enumerate(groups) if k not in (g, h))
        kept = F.translate(word, others, "")
        out.append(F.struct(F.lit(p).alias("p"), F.array_join(F.array_sort(F.split(kept, "")), "").alias("key")))
    assert len(alphabet) == DIMS
    return out


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b: each unordered pair of near words once (a < b)."""
    keyed = words.select("word", F.char_length("word").alias("len"), F.explode(F.array(*block_keys(F.col("word")))).alias("k"))
    keyed = keyed.select("word", "len", "k.p", "k.key")
    sizes = keyed.groupBy("p", "key", "len").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nk"))
    dealt = keyed.join(sizes, ["p", "key", "len"]).select("p", "key", "len", F.pmod(F.xxhash64("word"), F.col("nk")).alias("blk"), "word")
    blocks = materialize(dealt.groupBy("p", "key", "len", "blk").agg(F.sort_array(F.collect_list("word")).alias("w")))
    # Pairs of blocks of one key: equal length with j >= i, and the next length with any j.
    a = blocks.select("p", "key", "len", F.col("blk").alias("i"), F.col("w").alias("wa"), F.explode(F.array("len", F.col("len") + 1)).alias("len2"))
    b = blocks.select("p", "key", F.col("len").alias("len2"), F.col("blk").alias("j"), F.col("w").alias("wb"))
    met = a.join(b, ["p", "key", "len2"]).where((F.col("len2") > F.col("len")) | (F.col("j") >= F.col("i")))
    met = met.select("wa", "wb", ((F.col("len") == F.col("len2")) & (F.col("i") == F.col("j"))).alias("same"))
    # A block of one word holds no pair with itself.
    met = met.where(~F.col("same") | (F.size("wa") > 1))
    found = met.mapInPandas(_near_in_blocks, "a string, b string")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: forms followed to the end, by pointer doubling; each round stored."""
    step = materialize(forms.select("word", F.coalesce("form", "word").alias("to")))
    while True:
        size = step.count()
        hop = checked_side(step.select(F.col("word").alias("to"), F.col("to").alias("to2")), size)
        nxt = materialize(step.join(hop, "to", "left").select("word", F.coalesce("to2", "to").alias("to")))
        if nxt.join(step, ["word", "to"], "left_anti").isEmpty():
            return nxt.select("word", F.col("to").alias("root"))
        step = nxt


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every counted word of ``docs`` (doc_id, text)."""
    words = materialize(counted_words(docs))
    pairs = materialize(near_pairs(words))
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nb = words.select(F.col("word").alias("b"), F.col("n").alias("nb"))
    near = both.join(nb, "b").groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nb")).alias("neg"), F.col("b").alias("b"))).alias("best")
    )
    out = words.join(near, words["word"] == near["a"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), (-F.col("best.neg")).alias("top"), F.col("best.b").alias("cand")
    )
    good = F.col("top") >= 2 * F.col("n")
    forms = materialize(
        out.select(
            "word",
            F.when(good, F.col("cand")).alias("form"),
            F.col("n").cast("long").alias("n"),
            "n_near",
            F.when(good, F.col("top")).cast("long").alias("form_n"),
        )
    )
    return forms.join(roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
