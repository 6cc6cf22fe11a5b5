"""Helpers of the training-data operators against plain Python."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sitecast.llm import html_text, langid, pii, quality, text, tokens

WORDS = "the of and To THE a é über ñandú x1 foo, bar. ba-r ###".split()


def some_texts(n=60, seed=1):
    draw = random.Random(seed)
    out = ["", " ", "one", "one two three four", "A b C d E", "a b c d e f", "x" * 5000, "\n\n \t\v\f\r"]
    out += [draw.choice([" ", "\n", "  "]).join(draw.choices(WORDS, k=draw.randint(1, 80))) for _ in range(n)]
    return out


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingles(t):
    w = words(fold(t))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_shingle_sets_have_the_size_and_overlap_of_real_sets():
    texts = some_texts() + [None]
    got = list(text.shingle_sets(pa.array(texts, pa.string())))
    want = [shingles(t or "") for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    for a in range(0, len(texts), 7):
        for b in range(len(texts)):
            assert len(np.intersect1d(got[a], got[b])) == len(want[a] & want[b])


def test_shingle_sets_do_not_depend_on_chunks_or_slices(monkeypatch):
    column = pa.array(["left out", *some_texts()], pa.string()).slice(1)
    whole = [text.digest(s) for s in text.shingle_sets(column)]
    monkeypatch.setattr(text, "CHUNK_BYTES", 1)
    parts = [text.digest(next(text.shingle_sets(pa.array([t], pa.string())))) for t in some_texts()]
    assert whole == parts


def luhn(s):
    d = [int(c) for c in s if c.isdigit()]
    return (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0


def plain_spans(t):
    """The base patterns as they are stated."""
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= sum(map(str.isdigit, m[0])) <= 19 and luhn(m[0])]
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def test_base_spans_match_the_stated_patterns():
    draw = random.Random(5)
    pieces = ["a.b", "@", "x@y.z", ".", "-", " ", "1", "255", "256", "10.0.0.1", "4", "4111 1111 1111 1111", "4111111111111111", "+", "+1 (555) 123-4567", "(", "é", "\n", "_%"]
    for _ in range(4000):
        t = "".join(draw.choices(pieces, k=draw.randint(1, 9)))
        assert sorted(pii.base_spans(t)) == sorted(plain_spans(t)), t


def test_base_spans_are_linear_on_long_runs():
    assert pii.base_spans("a" * 300_000 + " @") == []
    assert pii.base_spans("1" * 300_000) == []
    assert pii.base_spans("@a" * 50_000) == []


def test_tagger_gradient_is_the_slope_of_its_loss():
    tagger = pii.Tagger.new()
    draw = np.random.default_rng(0)
    codes, gold = draw.integers(0, pii.N_CLASSES, (3, 9)), draw.integers(0, pii.N_TAGS, (3, 9))
    for k in tagger.p:
        tagger.p[k] = tagger.p[k].astype(np.float64)
    _, grad = tagger.gradient(codes, gold)
    for name in ("hf", "xb", "out", "trans", "first", "bias"):
        flat = tagger.p[name].reshape(-1)
        for at in draw.integers(0, len(flat), 4):
            keep = flat[at]
            flat[at] = keep + 1e-4
            up, _ = tagger.gradient(codes, gold)
            flat[at] = keep - 1e-4
            down, _ = tagger.gradient(codes, gold)
            flat[at] = keep
            assert abs((up - down) / 2e-4 - grad[name].reshape(-1)[at]) < 2e-2


def test_tagger_finds_spans_that_patterns_lose():
    draw = random.Random(2)

    def card():
        while True:
            s = "4" + "".join(draw.choices("0123456789", k=15))
            if luhn(s):
                return s

    make = {
        0: lambda: f"{''.join(draw.choices('abcdef', k=5))}.{draw.randint(10, 99)}@mail{draw.randint(1, 9)}.example.com",
        1: lambda: ".".join(str(draw.randint(1, 255)) for _ in range(4)),
        2: card,
        3: lambda: f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}",
    }
    prose = lambda: " ".join(draw.choices("the of ing tion and ereth thand. whon".split(), k=6))
    texts = [f"{prose()} {make[k % 4]()} {prose()}" for k in range(240)]
    tagger = pii.Tagger.new()
    codes, gold = pii.training_windows(texts)
    tagger.train(codes, gold)
    tests = [f"{prose()} {make[3]()} {make[2]()} {prose()}" for _ in range(40)]
    found = pii.find_spans(tests, tagger)
    assert sum(len(base) for base, _ in found) < 8
    assert sum(len(spans) for _, spans in found) >= 60
    for t, (base, spans) in zip(tests, found, strict=True):
        assert set(base) <= set(spans)
        flat = sorted((a, b) for _, a, b in spans)
        assert all(x[1] <= y[0] for x, y in zip(flat, flat[1:], strict=False))
    clean = pii.find_spans([prose() + " 3.0 and 12 4" for _ in range(20)], tagger)
    assert all(spans == [] for _, spans in clean)


def test_quality_figures_match_plain_counts():
    for t in some_texts(80, 3):
        (row,) = list(quality._describe(pa.array([t], pa.string())))
        w = words(t)
        tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        many = {g for g in tri if tri.count(g) > 1}
        covered = {k + j for k, g in enumerate(tri) if g in many for j in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        dup = sum(x in lines[:k] for k, x in enumerate(lines))
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        assert row[:6] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed)


def test_compression_bands_tell_prose_from_repeats_and_noise():
    import zstandard

    draw = random.Random(4)
    z = zstandard.ZstdCompressor(level=quality.LEVEL)
    letters, weights = "etaoinshrdlucmfwypvbgk", range(22, 0, -1)
    prose = " ".join("".join(draw.choices(letters, weights, k=draw.randint(1, 9))) for _ in range(1500))
    assert quality.bands(prose.encode(), z)[3]
    assert not quality.bands(b"same words again " * 500, z)[3]
    assert not quality.bands(draw.randbytes(9000), z)[3]
    # Repeats in most chunks of an otherwise ordinary text.
    assert not quality.bands((prose[:5000] + "x y z " * 3000).encode(), z)[3]
    assert quality.bands(b"", z) == (0.0, 0, 0, False)


def test_noise_of_any_length_leaves_the_band():
    import string

    import zstandard

    draw = random.Random(8)
    z = zstandard.ZstdCompressor(level=quality.LEVEL)
    noise = lambda n: " ".join("".join(draw.choices(string.ascii_letters + string.digits, k=draw.randint(2, 9))) for _ in range(n))[:n].encode()
    letters, weights = "etaoinshrdlucmfwypvbgk", range(22, 0, -1)
    prose = " ".join("".join(draw.choices(letters, weights, k=draw.randint(1, 9))) for _ in range(7000)).encode()
    for n in (200, 300, 400, 600, 1000, 1500, 2000, 3000, 4096, 5000, 9000):
        assert not any(quality.bands(noise(n), z)[3] for _ in range(20)), n
        assert quality.bands(prose[:n], z)[3], n
    for n in (1000, 2000, 4000, 8191, 16384, 32768):
        assert not quality.bands(prose[: n // 2] + noise(n - n // 2), z)[3], n
        assert not quality.bands(noise(n - n // 2) + prose[: n // 2], z)[3], n


def test_piece_encoder_equals_the_tokenizer(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = some_texts(60, 9) + [
        " lead", "trail ", "two  spaces", "tab\t x", "x \n y", "it's they'll we'd", "a  b", " x 　y", "\x1c a \x85 b",
        "<|endoftext|> in <|endoftext|>text", "é" * 200 + " z", "日本語 テキスト です", "🙂 🙂🙂", "᠎ x", "a ​ b", "123 4567.89",
    ]
    for limit in (400_000, 20):
        monkeypatch.setattr(tokens, "PIECES", limit)
        encoder = tokens.PieceEncoder(tokenizer)
        for part in (texts, texts[::-1], ["", ""], []):
            ids, counts = encoder.encode(part, 0)
            want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in part]
            assert counts.tolist() == [len(w) for w in want]
            assert ids.tolist() == [x for w in want for x in w]


def test_piece_encoder_cuts_at_any_white_space():
    """Random texts of letters, marks and all kinds of white space, in slices with null rows."""
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    draw = random.Random(12)
    parts = [" ", " ", "\n", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000", "\u200b", "\u0120", "\0"]
    parts += ["a", "It", "'s", "'", ".", ",", "...", "7", "\u00e9", "\u0660", "\u65e5\u672c", "\U0001f642", "\u0301", "<|endoftext|>", "x" * 70]
    texts = [None if k % 40 == 9 else "".join(draw.choices(parts, k=draw.randint(0, 12))) for k in range(3000)]
    want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    for kind in (pa.string(), pa.large_string()):
        encoder = tokens.PieceEncoder(tokenizer)
        column = pa.array(["left out", *texts], kind)
        for a in range(0, len(texts), 700):
            ids, counts = encoder.encode(column.slice(1 + a, 700), 0)
            assert counts.tolist() == [len(w) for w in want[a : a + 700]]
            assert ids.tolist() == [x for w in want[a : a + 700] for x in w]
        assert max(map(len, encoder.pieces.to_pylist())) <= tokens.PIECE


def test_words_reach_the_tokenizer_once_whatever_follows():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.characters = tokenizer, 0

        def get_vocab(self):
            return self.tokenizer.get_vocab()

        def encode(self, text, **settings):
            self.characters += len(text)
            return self.tokenizer.encode(text, **settings)

        def encode_batch_fast(self, texts, **settings):
            self.characters += sum(map(len, texts))
            return self.tokenizer.encode_batch_fast(texts, **settings)

    draw = random.Random(13)
    words = ["".join(draw.choices("abcdefgh", k=8)) for _ in range(100)]
    counted = Counted(Tokenizer.from_file(public.path("byte_bpe_50k.json")))
    encoder = tokens.PieceEncoder(counted)
    for _ in range(5):
        texts = ["".join(draw.choice(words) + draw.choice([" ", "\n", ", ", ".\n", ",\n"]) for _ in range(200)) for _ in range(20)]
        ids, _ = encoder.encode(texts, 0)
        assert ids.tolist() == [x for t in texts for x in [*counted.tokenizer.encode(t, add_special_tokens=False).ids, 0]]
    # Each word at the start, after a space and after a line end; last ones with their end.
    assert counted.characters < 6_000


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_lines_is_a_longest_common_subsequence():
    draw = random.Random(8)
    for size in (0, 1, 5, 30, 150):
        for _ in range(30):
            a, b = (draw.choices(range(draw.choice([2, 5, 40])), k=draw.randint(0, size)) for _ in range(2))
            at = html_text.common_lines(a, b)
            assert len(at) == lcs_length(a, b) and at == sorted(set(at))
            rest = iter(b)
            assert all(any(v == a[k] for v in rest) for k in at)


def test_text_lines_keep_the_article_only():
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p><p>x';</script></head><body class='has-sidebar'>"
        "<nav><ul><li><a href='/a'>menu</a></li></ul></nav><div class=\"ad\">buy</div><article><h1>He&amp;ad</h1><p><b>one<br><p>two\n  three</p>"
        "<!-- <p>hidden --><div class='share'>share</div><blockquote>four <i>f</i>ive &lt;x&gt;</blockquote><form><p>mail</p></form>"
        "<section id='comments'><p>first!</p></section><p>a < b</article><aside>side</aside><footer>&copy; f</footer>"
    )
    lines, kinds = html_text.text_lines(page)
    assert [x for x, k in zip(lines, kinds, strict=True) if k == 0] == ["He&ad", "one", "two three", "four five <x>", "a < b"]
    assert 1 not in kinds and "x" not in lines
    assert html_text.text_lines("") == ([], [])
    assert html_text.text_lines("plain <p>text") == (["plain", "text"], [1, 1])
    assert html_text.text_lines("<p>a<script>never closed <p>b")[0] == ["a"]


def test_codewords_keep_their_distance():
    for n in (1, 2, 4, 5, 9, 30):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n
        if n > 2:
            apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
            assert min(apart) >= 2


def test_fit_tells_languages_apart():
    draw = random.Random(3)
    kinds = {"aa": "lala mumu titi".split(), "bb": "xyz zyx qqx".split(), "cc": "lala zyx ñoño".split()}
    rows = [(lang, " ".join(draw.choices(ws, k=30))) for lang, ws in kinds.items() for _ in range(30)]
    coder = langid.fit([t for _, t in rows], [v for v, _ in rows])
    tests = [(lang, " ".join(draw.choices(ws, k=10))) for lang, ws in kinds.items() for _ in range(10)]
    best, score, _ = coder.decode(np.concatenate(list(langid.features(pa.array([t for _, t in tests])))))
    assert [coder.langs[k] for k in best] == [v for v, _ in tests]
    assert ((score >= 0) & (score <= 1)).all()


def test_listed_orders_by_kind_and_start():
    spans = [(3, 0, 9), (0, 20, 30), (0, 5, 8)]
    assert pii.listed(spans) == "email:5:8,email:20:30,phone:0:9"
    assert hashlib.sha256(pii.listed([]).encode()).hexdigest().startswith("e3b0c442")
