"""Operators on small tables with awkward rows, against brute force."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from test_units import plain_spans, shingles, words

from sitecast.llm import components, decontam, html_text, langid, lines, mixing, ngram_join, pii, quality, queries, tokens, warc
from sitecast.llm.pii import listed

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, node long, hash long, _key string, h0 long"


def prose(draw, n):
    return " ".join("".join(draw.choices("etaoinshrdlu", k=draw.randint(1, 7))) for _ in range(n))


def awkward(seed=1):
    """Texts with copies, near copies, repeats, blanks, nulls and one very long text."""
    draw = random.Random(seed)
    base = [prose(draw, draw.choice([3, 8, 60, 120])) for _ in range(25)]
    texts = [None, "", "  \n\t ", "one", "one two three four five", *base]
    for t in base:
        w = t.split(" ")
        texts.append(" ".join(w).upper() if draw.random() < 0.3 else t)
        for _ in range(3):
            v = list(w)
            for _ in range(draw.randint(0, max(1, len(w) // 12))):
                v[draw.randrange(len(v))] = "edited"
            texts.append(" ".join(v))
    texts.append(prose(draw, 60_000))
    ids = list(range(100, 100 + len(texts)))
    draw.shuffle(ids)
    rows = [(i, t) for i, t in zip(ids, texts, strict=True)]
    rows += [(None, texts[10]), (None, None), rows[7], rows[7], (rows[8][0], "the same id with another text")]
    langs, sources = ["en", "fr", None], ["src0", "src0", "src0", "b", "é", None]
    return [(i, t, draw.choice(langs), draw.choice(sources), None, -1, None, 5, 6, "x", 7) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def components_of(sets):
    parent = list(range(len(sets)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[root(a)] = root(b)
    return [root(a) for a in range(len(sets))]


def test_connected_components(spark):
    draw = random.Random(2)
    for n, m in ((1, 0), (30, 20), (60, 90), (200, 199)):
        edges = [(draw.randrange(n), draw.randrange(n)) for _ in range(m)] + [(None, 1), (2, None), (3, 3)]
        if m == 199:
            edges = [(k, k + 1) for k in range(m)]  # one long chain
        got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
        near = defaultdict(set)
        for a, b in edges:
            if a is not None and b is not None and a != b:
                near[a].add(b), near[b].add(a)
        want = {}
        for a in sorted(near):
            todo = [a] if a not in want else []
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = a
                    todo += near[x]
        assert got == want


@pytest.mark.parametrize("counters", [None, 2])
def test_jaccard_classes_match_brute_force(docs, monkeypatch, counters):
    if counters:  # a sketch that tells nothing apart must not change the result
        monkeypatch.setattr(ngram_join, "_bits", lambda rows: 16)
        monkeypatch.setattr(ngram_join, "order_keys", lambda tokens, classes, order: tokens * 0)
    rows = plain_rows(docs)
    sets = [shingles(t or "") for _, t in rows]
    roots = components_of(sets)
    least = {}
    for (i, _), r, s in zip(rows, roots, sets, strict=True):
        if s and i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted(((i, len(s), least.get(r) if s else i) for (i, _), s, r in zip(rows, sets, roots, strict=True)), key=repr)
    got = ngram_join.jaccard_classes(docs).select("doc", "n", "component").collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_one_row_of_each_class_stays(docs, none):
    rows = plain_rows(docs)
    sets = [shingles(t or "") for _, t in rows]
    roots = components_of(sets)
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    got = plain_rows(kept)
    assert len(got) == len({r for r, s in zip(roots, sets, strict=True) if s}) + sum(not s for s in sets)
    assert sorted([x for x in got if not shingles(x[1] or "")], key=repr) == sorted([x for x, s in zip(rows, sets, strict=True) if not s], key=repr)
    best = {}
    for (i, _), r, s in zip(rows, roots, sets, strict=True):
        if s and i is not None:
            best[r] = min(i, best.get(r, i))
    assert sorted(i for i, t in got if shingles(t or "") and i is not None) == sorted(best.values())
    assert ngram_join.keep_first(none).count() == 0 and ngram_join.jaccard_classes(none).count() == 0


def test_dense_groups_lose_no_link(spark):
    """Copies with edits at random: many pairs near the threshold, few linked to the first."""
    draw = random.Random(9)
    base = prose(draw, 90).split(" ")
    rows = []
    for k in range(120):
        w = list(base)
        for _ in range(draw.randint(0, 5)):
            w[draw.randrange(len(w))] = f"w{draw.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    draw.shuffle(rows)
    got = {r.doc: r.component for r in ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    roots = components_of([shingles(t) for _, t in rows])
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = min(i, least.get(r, i))
    assert got == {i: least[r] for (i, _), r in zip(rows, roots, strict=True)}


def test_personal_data(docs, none):
    tagger = pii.train_tagger(docs)
    assert tagger is None  # no base span to learn from
    rows = [(1, "a@b.cd and 10.0.0.1"), (1, "a@b.cd and 10.0.0.1"), (None, None), (3, ""), (4, "é+1 (555) 123-4567."), (5, "x" * 200_000 + " 1.2.3.4")]
    some = docs.sparkSession.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))
    got = sorted(map(tuple, pii.find_personal_data(some, pii.train_tagger(some)).select("doc_id", "spans", "n_base").collect()), key=repr)
    assert got == sorted([(i, listed(plain_spans(t or "")), len(plain_spans(t or ""))) for i, t in rows], key=repr)
    assert pii.find_personal_data(none, None).count() == 0


def test_personal_data_counts_of_the_query_are_of_base_spans(spark, tmp_path, monkeypatch):
    """Phone and card side by side are lost to the patterns; the network's spans must not enter the counts."""

    class Tags:
        def decode(self, codes):
            tags = np.zeros(codes.shape, np.int8)
            tags[:, 0], tags[:, 1:17], tags[:, 18], tags[:, 19:37] = 7, 8, 5, 6  # a phone, then a card
            return tags

    monkeypatch.setattr(queries.pii, "train_tagger", lambda docs: Tags())
    lost = "+1 (555) 123-4567 4111 1111 1111 1111 end"
    rows = [(1, lost), (1, lost), (2, "to a.b@c.de"), (3, "4111 1111 1111 1111"), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op1_pii_bilstm_crf(spark, str(tmp_path)).collect()
    assert len(got) == 5 and [r.spans for r in got if r.doc_id == 1] == ["card:18:37,phone:0:17"] * 2
    for r in got:
        base = plain_spans(dict(rows)[r.doc_id] or "")
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()


def test_line_windows(spark, none):
    rows = [
        (1, "a\nb\nc\nd"), (2, "x\na\nb\nc"), (3, "a\n b \nc\nd\na\nb\nc"), (4, "q\nq\nq\nq"), (5, None), (6, ""), (7, "a\nb"),
        (8, "\n\n\n\n"), (None, "a\nb\nc"), (9, "k\nl\nm"), (9, "k\nl\nm"), (10, "k\nl\nm\n"),
        (11, "  keep  \na\nb\nc\n tail "), (12, "a\nb"), (13, " a \n b"), (14, "one line"), (15, " one line "), (16, "a"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lines", F.lit(3))
    first, gone = {}, defaultdict(set)
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        ls = [x.strip(" ") for x in (t or "").split("\n")]
        # A text of one or two lines is one window, equal only to texts of the same lines.
        for k, key in [(k, tuple(ls[k : k + 3])) for k in range(len(ls) - 2)] or [(0, (len(ls), *ls))]:
            if "".join(map(str, key[1:] if len(ls) < 3 else key)) and first.setdefault(key, (i, k)) != (i, k):
                gone[i, t] |= set(range(k, k + min(3, len(ls))))
    want = []
    for i, t in rows:
        out = [] if t is None else t.split("\n")
        left = t if not gone[i, t] else "\n".join(x for k, x in enumerate(out) if k not in gone[i, t])
        want.append((i, left, len(out), len(gone[i, t]), sorted(gone[i, t])))
    assert sorted(map(tuple, lines.dedupe_lines(table).collect()), key=repr) == sorted(want, key=repr)
    assert lines.dedupe_lines(none).count() == 0


def test_copies_of_texts_of_one_or_two_lines(spark):
    rows = [(1, "a b c"), (2, " a b c"), (3, "d\ne"), (4, "d\ne"), (5, "d"), (6, "a b c\nd"), (7, "d\ne\nf"), (8, ""), (9, ""), (10, "\n"), (11, "d\n"), (12, None)]
    got = {r.doc_id: (r.text, r.removed) for r in lines.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: (t, []) for k, t in rows} | {2: ("", [0]), 4: ("", [0, 1])}


def targets(sizes):
    """Shares handed out again until none is above its limit, as the contract says."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(order)}
    got, left, live = dict.fromkeys(sizes, 0.0), float(sum(sizes.values())), set(sizes)
    while left > 1e-9 and live:
        total = sum(weight[s] for s in live)
        for s in live:
            got[s] += left * weight[s] / total
        left = 0.0
        for s in list(live):
            if got[s] >= 3 * sizes[s]:
                left += got[s] - 3 * sizes[s]
                got[s] = 3.0 * sizes[s]
                live.discard(s)
    return got


def test_mixing(docs, none):
    spark = docs.sparkSession
    labels = spark.createDataFrame([(105, 1), (105, 0), (110, 0), (None, 1)], "doc_id long, quality int")
    mixed = mixing.mix(docs, mixing.quality_weights(labels))
    rows = mixed.collect()
    assert len(rows) == docs.count() and mixed.columns == [c for c in docs.columns if c != "size"] + ["size", "source_size", "target", "copies"]
    sizes = defaultdict(int)
    for r in rows:
        assert r.size == len(words(r.text or ""))
        sizes[r.source] += r.size
    want = targets(sizes)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s]) for r in mine)
        whole = int(want[s] // sizes[s]) if sizes[s] else 0
        assert all(whole <= r.copies <= min(3, whole + 1) for r in mine)
        taken = sum(r.size * r.copies for r in mine)
        assert abs(taken - want[s]) <= max(r.size for r in mine)
    again = mixing.mix(docs.repartition(7), mixing.quality_weights(labels)).collect()
    pick = lambda rows: sorted(((r.doc_id, r.text, r.source, r.copies) for r in rows), key=repr)
    assert pick(rows) == pick(again)
    out = mixing.repeated(docs, mixing.quality_weights(labels))
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in rows)
    assert mixing.mix(none, mixing.quality_weights(labels)).count() == 0


def test_mixing_follows_the_sampling_order(spark):
    """Against a sort of all keys of each source."""
    draw = random.Random(6)
    rows = [(k, " ".join(["w"] * draw.randint(0, 30)), draw.choice("aaabc")) for k in range(800)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    quality_of = spark.createDataFrame([(k, draw.choice([0.5, 2.0])) for k in range(0, 800, 3)], "doc_id long, weight double")
    got = mixing.mix(table, quality_of).collect()
    keyed = table.join(quality_of, "doc_id", "left").withColumn(
        "k", mixing.sampling_key(F.col("doc_id"), F.col("text"), F.coalesce("weight", F.lit(1.0)))
    )
    keys = {r.doc_id: r.k for r in keyed.collect()}
    for s in "abc":
        mine = sorted((r for r in got if r.source == s), key=lambda r: (keys[r.doc_id], r.doc_id))
        total, target = mine[0].source_size, mine[0].target
        whole, before = int(target // total), 0
        for r in mine:
            if r.size:
                assert r.copies == whole + (2 * before + r.size <= 2 * (target - whole * total))
            before += r.size


def test_token_files(spark, none):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [(k * 7 % 50, f"text {k}  with words\n" * (k % 5)) for k in range(50)] + [(None, None), (None, "no id"), (51, None), (52, ""), (53, "long " * 40_000), (20, "a repeated id")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit(9)).repartition(5)
    files = tokens.new_path(spark)
    tokens.write_orc(tokens.encode(table, path), files)
    back = tokens.read_orc(spark, files)
    got = sorted(back.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    by_id = defaultdict(list)
    for i, t in rows:
        by_id[i].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids)
        by_id[r.doc_id].remove(list(r.ids))
        start += r.n_tokens
    sums = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in tokens.checksums(back).collect()}
    for r in got:
        data = b"".join(int(x).to_bytes(4, "little") for x in r.ids)
        assert sums[r.doc_id, r.start] == (len(r.ids), zlib.crc32(data))
    assert spark.read.orc(files).where("doc_id = 35").count() == 1
    assert tokens.through_files(none, path).count() == 0


def test_main_text(spark):
    wrap = "<html><body><div>{0}</div><p>shared line</p><p>{1}</p><p>other shared</p></body></html>"
    rows = [
        (1, "http://h.com/a/1", wrap.format("site", "own one")),
        (2, "http://h.com/a/2", wrap.format("site", "own two")),
        (3, "http://h.com/b", wrap.format("other", "own three")),
        (4, "http://alone.com/x", "<p>shared line<p>only"),
        (5, "http://g.com/a/1", "<article><p>shared line</p></article><p>not this</p>"),
        (6, None, "<p>no url</p>"), (7, "http://h.com/z", None), (8, "http://h.com/y", ""), (None, "bad", "<p>x</p>"),
        (1, "http://h.com/a/1", wrap.format("site", "own one")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lines", F.lit(1))
    got = defaultdict(list)
    for r in html_text.main_text(pages).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    assert got[2] == ["own two"] and got[4] == ["shared line\nonly"] and got[5] == ["shared line"]
    assert got[6] == ["no url"] and got[7] == [""] and got[8] == [""] and got[None] == ["x"] and len(got[1]) == 2
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_contaminated(spark, none):
    draw = random.Random(11)
    item = prose(draw, 40).split(" ")
    short = prose(draw, 8).split(" ")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item)), (3, " ".join(short)), (4, "two words"), (5, None), (None, "")], "item_id long, text string")
    swapped = [w if k % 8 else "changed" for k, w in enumerate(item)]
    broken = [w if k % 2 else "changed" for k, w in enumerate(item)]
    clean = prose(draw, 300)
    rows = [
        (10, clean), (11, clean + " " + " ".join(item).upper() + ", " + clean), (12, "intro " + " ".join(swapped)), (13, clean + " ".join(broken)),
        (14, "x " + " ".join(short) + " y"), (15, "two words"), (16, None), (17, ""), (None, "a " + " ".join(item)), (18, " ".join(item[:8])),
        (11, clean), (19, clean[:500] + " " + "; ".join(item[10:36])), (12, "intro " + " ".join(swapped)),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("t", F.lit(1)).withColumn("item", F.lit("i"))
    got = {(r.doc, r.item) for r in decontam.contaminated(table, bench).collect()}
    assert got == {(11, 1), (12, 1), (14, 3), (None, 1), (19, 1)}
    kept = decontam.without_contaminated(table, bench)
    assert kept.columns == table.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [10, 11, 13, 15, 16, 17, 18]
    assert decontam.contaminated(none, bench).count() == 0
    assert decontam.contaminated(table, bench.limit(0)).count() == 0


def plain_contaminated(texts, items):
    """``{(doc, item): (n_match, n_window)}`` of all windows of all items laid at all places, without seeds."""
    out = {}
    for (d, text), (i, item) in itertools.product(texts.items(), items.items()):
        t, b = text.split(" "), item.split(" ")
        n = min(len(b), decontam.WINDOW)
        for at in range(-len(b), len(t)):
            same = [0 <= at + k < len(t) and t[at + k] == w for k, w in enumerate(b)]
            best = max(sum(same[k : k + n]) for k in range(len(b) - n + 1))
            if best / n >= decontam.AGREE:
                out[d, i] = max(out.get((d, i), (0, 0)), (best, n))
    return out


def found_in(spark, texts, items):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    return {(r.doc, r.item): (r.n_match, r.n_window) for r in decontam.contaminated(docs, bench).collect()}


def test_excerpts_at_any_place_of_an_item(spark):
    draw = random.Random(3)
    item = " ".join(f"w{draw.randrange(10**6)}" for _ in range(59))
    cuts = [(k, n) for n in (20, 22, 24) for k in range(59 - n + 1)]
    texts = {d: f"before {' '.join(item.split(' ')[k : k + n])} behind" for d, (k, n) in enumerate(cuts)}
    want = plain_contaminated(texts, {1: item})
    assert len(want) == len(cuts) and found_in(spark, texts, {1: item}) == want


def test_every_agreeing_window_holds_a_seed():
    for n in range(decontam.SHORT_SPAN, decontam.WINDOW + 1):
        places = [{p + o for o in m} for m in decontam.SEEDS for p in range(n - m[-1])]
        most = max(e for e in range(n) if (n - e) / n >= decontam.AGREE)
        assert all(any(p.isdisjoint(wrong) for p in places) for wrong in itertools.combinations(range(n), most))


def test_short_items_with_substitutions(spark):
    draw = random.Random(5)
    items, texts = {}, {}
    for n in (6, 9, 12, 15, 18, 20, 23, 24, 30):
        w = [f"w{draw.randrange(10**6)}" for _ in range(n)]
        items[n] = " ".join(w)
        for k in range(40):
            wrong = draw.sample(range(n), draw.randint(0, n // 5 + 1))
            texts[100 * n + k] = " ".join(["before", *("other" if j in wrong else x for j, x in enumerate(w)), "behind"])
    want = plain_contaminated(texts, items)
    assert 180 < len(want) < len(texts) and found_in(spark, texts, items) == want


def test_items_that_share_a_passage_have_a_row_each(spark):
    draw = random.Random(6)
    own = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    shared, long = own(24), own(60)
    items = {1: f"{shared} {own(30)}", 2: f"{shared} {own(9)}", 3: f"{own(40)} {shared} {own(5)}", 4: f"{long} {own(20)}", 5: f"{long} {own(30)}", 6: own(50)}
    texts = {10: f"before {shared} behind", 11: long, 12: own(80), 13: " ".join(long.split(" ")[:30])}
    want = plain_contaminated(texts, items)
    assert want == {(10, 1): (24, 24), (10, 2): (24, 24), (10, 3): (24, 24), (11, 4): (24, 24), (11, 5): (24, 24), (13, 4): (24, 24), (13, 5): (24, 24)}
    assert found_in(spark, texts, items) == want


def test_quality_rules(docs, none):
    out = quality.quality_rules(docs)
    rows = out.collect()
    assert len(rows) == docs.count() and out.columns == [c for c in docs.columns if c != "kept"] + list(quality._NAMES)
    for r in rows:
        assert r.n_words == len(words(r.text or "")) and r.word_chars == sum(map(len, words(r.text or "")))
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    kept = quality.passing(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows) > 0
    assert quality.quality_rules(none).count() == 0 and quality.passing(none).count() == 0


def test_language(docs, none, spark):
    draw = random.Random(1)
    rows = [(k, " ".join(draw.choices(("lala mumu titi", "zyx qqx xyz")[k % 2].split(), k=20)), ("aa", "bb")[k % 2]) for k in range(80)]
    rows += [(None, "lala mumu", None), (90, None, "aa"), (91, "123 ... !", "bb"), (92, "", None), (92, "", None), (93, "zyx " * 50_000, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(2))
    got = langid.predict(table, langid.train(table)).collect()
    assert len(got) == len(rows)
    named = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert all(named[k][0] == ("aa", "bb")[k % 2] for k in range(80))
    assert named[None][0] == "aa" and named[93][0] == "bb"
    assert named[90] == named[91] == named[92] == ("und", 0.0)
    assert langid.train(none) is None and langid.predict(none, None).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}


def record(rid, kind, url, when, status, head, body="", profile=warc.PROFILE):
    warc_lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}"]
    warc_lines += [f"WARC-Target-URI: {url}"] if url is not None else []
    warc_lines += [f"WARC-Date: 2024-01-01T00:00:{when:02d}Z"] if when is not None else []
    warc_lines += [f"WARC-Profile: http://x/{profile}"] if kind == "revisit" else []
    return Row(record="\r\n\r\n".join(["\r\n".join(warc_lines), "\r\n".join([f"HTTP/1.1 {status} X", *head]), body]))


def test_revisits(spark):
    u = "http://www.h.com/p?b=2&a=1#f"
    rows = [
        record("r1", "response", u, 1, 200, ['ETag: "v1"', "Server: s", "Cache-Control: old", "Last-Modified: m1"], "one\r\n\r\nmore"),
        record("r2", "response", "https://H.com:443/p/?a=1&utm_source=q&b=2", 5, 200, ['ETag: "v2"'], "two"),
        record("r3", "response", u, 6, 206, [], "part"),
        record("v0", "revisit", u, 1, 304, ['ETag: "v1"']),
        record("v1", "revisit", u, 3, 304, ['ETag: W/"v1"', "Cache-Control: new", "Set-Cookie: no", "etag: W/\"v1\""]),
        record("v2", "revisit", u, 7, 304, ['ETag: "v1"']),
        record("v3", "revisit", u, 8, 304, ['ETag: "v2"', "Last-Modified: m9"]),
        record("v4", "revisit", u, 9, 304, []),
        record("v5", "revisit", "http://other.org/", 9, 304, []),
        record("v6", "revisit", None, 9, 304, []),
        record("v7", "revisit", u, None, 304, []),
        record("v8", "revisit", u, 4, 304, ["Last-Modified: m2"]),
        record("v9", "revisit", u, 9, 304, [], profile="identical-payload-digest"),
        record("v1", "revisit", u, 3, 304, ['ETag: W/"v1"', "Cache-Control: new", "Set-Cookie: no", "etag: W/\"v1\""]),
        Row(record=None), Row(record="junk"), Row(record=""),
    ]
    table = spark.createDataFrame(rows, "record string").withColumn("type", F.lit(1))
    out = warc.resolve_revisits(warc.parse_records(table)).collect()
    got = defaultdict(list)
    for r in out:
        got[r.record_id].append((r.outcome, r.target_id))
    assert got == {
        "v0": [("no_response", None)], "v1": [("resolved", "r1")] * 2, "v2": [("etag_mismatch", None)], "v3": [("resolved", "r2")],
        "v4": [("unvalidated", "r2")], "v5": [("no_response", None)], "v6": [("no_url", None)], "v7": [("no_url", None)], "v8": [("modified_mismatch", None)],
    }
    merged = next(r.headers for r in out if r.record_id == "v1").split("\n")
    assert merged == ["cache-control: new", 'etag: W/"v1"', "last-modified: m1", "server: s"]
    assert warc.resolve_revisits(warc.parse_records(table.limit(0))).count() == 0


def test_captures_of_awkward_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c?x=1", "<p>"), (None, None, None), (3, "", ""), (1, "http://a.b/c?x=1", "<p>")], "page_id long, url string, html string")
    assert warc.captures(pages).count() == 16
    assert warc.resolve_revisits(warc.parse_records(warc.captures(pages))).count() == 12


def test_hot_url_is_resolved_across_chunks(spark, monkeypatch):
    from sitecast.operators import ordering

    monkeypatch.setattr(ordering, "PREFIX_CHUNK", 4)
    rows = [(f"p{k:03d}", "response" if k % 10 == 0 else "revisit", k) for k in range(60)]
    table = spark.createDataFrame(rows, "record_id string, type string, k int")
    table = table.select(
        "record_id", "type", F.lit("h.com/").alias("uri"), F.lit("h.com/").alias("canonical"), F.timestamp_seconds("k").alias("date"),
        F.lit(warc.PROFILE).alias("profile"), F.when(F.col("type") == "response", 200).otherwise(304).alias("http_status"),
        F.array(F.struct(F.lit("etag").alias("name"), F.lit("x").alias("value"))).alias("headers"), F.lit("").alias("body"),
    )
    got = {r.record_id: r.target_id for r in warc.resolve_revisits(table).collect()}
    assert got == {f"p{k:03d}": f"p{k // 10 * 10:03d}" for k in range(60) if k % 10}
