"""op11 to op13 on small awkward tables, against plain Python."""

import random

import pytest
from brute_new import trie as plain_trie
from brute_new import variants as plain_variants
from pyspark.sql import functions as F

from sitecast.llm import chat, prefix_trie, spelling

CONV = "conv_id long, turn long, role string, text string, place long, prev string, bad long, parts string, seq string"
NASTY = ["\\### Assistant: </turn> ok", "a\\", "\\</turn>", "<\\/turn>", "#### x", "### ", "x:\ny", "", None, "é" * 50]


def conv_rows():
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
        (2, 0, "user", "a"), (2, 1, "user", "b"),
        (3, 0, "assistant", "first"),
        (None, 0, "user", "no id"), (None, 1, "assistant", "still formatted"),
        (4, 0, None, None), (4, 1, "tool", "x"), (4, 2, "[x]:\n", "y"), (4, 3, "System", "z"),
        (5, None, "user", "null turn comes first"), (5, 0, "assistant", "tie b"), (5, 0, "assistant", "tie a"),
        (6, 0, "user", "q" * 200_000), (6, 1, "assistant", "w " * 100_000),
        (7, 0, "user", "same"), (7, 0, "user", "same"),
    ]
    rows += [(8, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(NASTY)]
    return [(*r, 1, "p", 2, "q", "s") for r in rows]


def plain_chat(rows):
    by = {}
    for c, t, r, x, *_ in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, v in by.items():
        turns = [(r, x) for _, _, r, x in sorted(v)]
        state, bad = "start", None
        for k, (r, _) in enumerate(turns):
            if (state, r) not in chat.TRANSITIONS and bad is None:
                bad = k
            state = r
        valid = bad is None and state in chat.ACCEPTING
        out[c] = (turns, "".join(x for r, x in turns if r == "assistant"), valid)
    return out


@pytest.fixture(scope="module")
def convs(spark):
    return spark.createDataFrame(conv_rows(), CONV).repartition(3)


def test_chat_round_trip(convs):
    out = chat.format_conversations(convs)
    back = {r.conv_id: r for r in chat.read_back(out).collect()}
    fmt = {r.conv_id: r for r in out.collect()}
    want = plain_chat(conv_rows())
    assert set(back) == set(want)
    for c, (turns, loss, valid) in want.items():
        assert [(t.role, t.text) for t in back[c].turns] == turns, c
        assert back[c].loss_text == loss
        assert back[c].valid == valid
        assert back[c].formatted_chars == len(fmt[c].formatted) == sum(len(s.text) for s in fmt[c].segments)
        assert "".join(s.text for s in fmt[c].segments) == fmt[c].formatted
    assert fmt[2].first_invalid == 1 and fmt[3].first_invalid == 0 and fmt[1].first_invalid is None
    # No control string is left inside an escaped text.
    for r in fmt.values():
        for s in r.segments[1::3]:
            assert "</turn>" not in s.text and "### " not in s.text


def test_chat_empty(spark):
    empty = spark.createDataFrame([], CONV)
    assert chat.read_back(chat.format_conversations(empty)).count() == 0


def spelling_rows():
    draw = random.Random(3)
    words = ["colour", "color", "colr", "coloru", "kolour", "Straße", "strasse", "strase", "ÀÉÎÕÜ", "àÉÎÕÜ", "theatre", "theater", "theatres"]
    texts = []
    for _ in range(120):
        texts.append(" ".join(draw.choices(words, weights=[30, 12, 3, 4, 3, 5, 5, 3, 4, 4, 9, 9, 3], k=draw.randint(0, 30))))
    texts += [None, "", "12345 !!!", "colour" * 5000, "x" * 300_000 + " colour colour"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "colour colour color"), (7, texts[7]), (7, texts[7])]
    return [(i, t, "word", 1, "n") for i, t in rows]


def test_spelling_against_brute_force(spark, monkeypatch):
    rows = spelling_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n long, len string").repartition(4)
    want = plain_variants([(i, t) for i, t, *_ in rows])
    for block in (spelling.BLOCK, 2):
        monkeypatch.setattr(spelling, "BLOCK", block)
        got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs).collect()}
        assert got == want
    assert any(v[0] is not None for v in want.values()) and any(v[1] != v[0] and v[0] for v in want.values())


def test_spelling_noise_and_edges(spark):
    assert spelling.one_edit("colour", "color") and spelling.one_edit("color", "colur") and not spelling.one_edit("ab", "ba")
    assert not spelling.one_edit("same", "same") and spelling.one_edit("straße", "strase")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).count() == 0


def trie_rows():
    draw = random.Random(5)
    rows = []
    say = ["hi", "hello", "é", "", None, "bye " * 50]
    for c in range(0, 60):
        for t in range(draw.randint(0, 6)):
            rows.append((c, t, draw.choice(["user", "assistant", None]), draw.choice(say)))
    for c in range(100, 400):  # a hot group of equal conversations
        rows += [(c, 0, "user", "same"), (c, 1, "assistant", "same answer")]
    rows += [(-7, 0, "user", "neg"), (-3, None, "user", "x"), (-3, 0, None, None), (None, 0, "user", "no id"), (5, 0, "user", "tie"), (5, 0, "user", "tie")]
    return rows


@pytest.mark.parametrize("parts", ["1", "7"])
def test_trie_against_brute_force(spark, parts):
    rows = trie_rows()
    df = spark.createDataFrame([(*r, 0, "k") for r in rows], "conv_id long, turn long, role string, text string, seq long, key string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {tuple(r) for r in prefix_trie.trie(prefix_trie.rebuild(df)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == plain_trie(rows)


def test_trie_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(prefix_trie.rebuild(empty)).count() == 0


def test_skeleton_is_common_prefixes():
    a, b, c = ["r", "x", "y"], ["r", "x", "z"], ["r", "q"]
    sk = prefix_trie.skeleton([{"part": 2, "first": c, "last": c}, {"part": 0, "first": a, "last": a}, {"part": 1, "first": b, "last": b}])
    assert sk == {"r", "x"}
    assert F is not None
