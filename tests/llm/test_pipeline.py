"""The pipeline against plain Python, stage by stage and as a whole."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_operators import components_of, targets
from test_units import shingles, words

import corpus_pipeline
from sitecast.llm import mixing, quality

public = pytest.importorskip("public_tokenizers")


def prose(draw, n):
    letters, weights = "etaoinshrdlucmfwypvbgk", range(22, 0, -1)
    return " ".join("".join(draw.choices(letters, weights, k=draw.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(3)
    path = str(tmp_path_factory.mktemp("sf"))
    item = prose(draw, 30)
    texts = [prose(draw, draw.randint(60, 160)) for _ in range(40)]
    texts += [texts[0], texts[0].upper(), texts[1].replace(texts[1].split()[9], "edited"), "too short", None, "", "same words " * 200]
    texts += [f"{texts[2][:300]} {item} {texts[3][:200]}"]
    rows = [(i, t, "en", draw.choice(["a", "a", "b", "c", None]), len(t or "")) for i, t in enumerate(texts)]
    draw.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, item), (1, "a b c")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, 30)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, item


def expected(spark, rows, item):
    """Rows that the mix returns, by plain Python on every document."""
    import zstandard

    z = zstandard.ZstdCompressor(level=quality.LEVEL)
    kept = []
    for r in rows:
        w = words(r[1] or "")
        tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        inside = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
        if len(w) >= 50 and 100 * len(inside) <= 50 * len(w) and quality.bands(r[1].encode(), z)[3]:
            kept.append(r)
    roots = components_of([shingles(r[1]) for r in kept])
    first = {}
    for r, root in zip(kept, roots, strict=True):
        first[root] = min(r, first.get(root, r), key=lambda x: x[0])
    kept = [r for r in first.values() if item.lower() not in r[1].lower()]
    sizes = defaultdict(int)
    for r in kept:
        sizes[r[3]] += len(words(r[1]))
    goal = targets(sizes)
    table = spark.createDataFrame(kept, "doc_id long, text string, lang string, source string, n_chars long")
    weight = F.when(F.col("doc_id") >= 30, 1.0).when(F.col("doc_id") % 2 == 1, 2.0).otherwise(0.5)
    keys = {r.doc_id: r.k for r in table.withColumn("k", mixing.sampling_key(F.col("doc_id"), F.col("text"), weight)).collect()}
    out = []
    for s in sizes:
        before = 0
        whole = int(goal[s] // sizes[s])
        for r in sorted((r for r in kept if r[3] == s), key=lambda r: (keys[r[0]], r[0])):
            n = len(words(r[1]))
            out += [r] * (whole + (2 * before + n <= 2 * (goal[s] - whole * sizes[s])))
            before += n
    return out


def test_pipeline_matches_plain_python(spark, folder):
    from tokenizers import Tokenizer

    path, rows, item = folder
    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    want, start = [], 0
    for r in sorted(expected(spark, rows, item), key=lambda r: r[0]):
        ids = [*tokenizer.encode(r[1], add_special_tokens=False).ids, 0]
        want.append((r[0], start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    got = sorted(map(tuple, corpus_pipeline.run(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])
    assert got == want


def test_stages_keep_the_columns(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("kept", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns, name
    assert [re.sub("_", " ", n) for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "decontaminate", "mix sources", "token files"]


def test_empty_documents(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    assert docs.count() == 0
