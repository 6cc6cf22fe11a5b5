"""Personal data: fixed patterns, and a character-level BiLSTM with CRF transitions.

The patterns give base spans.  They drop a match that fails its check without a
second try, so a phone number followed by a card number is lost; the network finds
such spans.  It is trained in numpy on the base spans of a bounded sample of
documents (two of them set side by side as well).  A text is covered by
overlapping windows; each is decoded by Viterbi, spans that touch an inner edge of
their window are left to its neighbour, and the rest are reconciled over the whole
text: base spans stay, then the spans that most windows agree on.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Documents with base spans that the network is trained on, at most.
SAMPLE = 400
#: Documents searched for that sample, about.
SCANNED = 50_000
WIDTH = 64
STRIDE = 24
HIDDEN = 12
STEPS = 160
BATCH = 64

# The base patterns.  Lookbehinds and possessive repeats only keep
# them from trying the same run of characters again.
_EMAIL_NAME = re.compile(r"[A-Za-z0-9._%+-]+")
_EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_EMAIL = re.compile(_EMAIL_NAME.pattern + "@" + _EMAIL_HOST.pattern)
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HINT = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # kind, start, end


def _luhn(text: str) -> bool:
    digits = [int(c) for c in text if c.isdigit()]
    twice = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
    return 16 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(twice)) % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def _phone(text: str) -> bool:
    return 8 <= sum(c.isdigit() for c in text) <= 15


_CHECKS = (lambda s: bool(_EMAIL.fullmatch(s)), lambda s: bool(_IP.fullmatch(s)) and _octets(s), lambda s: bool(_CARD.fullmatch(s)) and _luhn(s), lambda s: bool(_PHONE.fullmatch(s)) and _phone(s))


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each ``@`` so that no run is scanned twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _NAME_CHARS:
            start -= 1
        host = _EMAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            yield 0, start, host.end()
            done = host.end()
        at = text.find("@", max(at + 1, done))
        if not host:
            done = max(done, 0)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and start."""
    out = list(_emails(text)) if "@" in text else []
    for kind, pattern, check in ((1, _IP, _octets), (2, _CARD, _luhn), (3, _PHONE, _phone)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if check(m[0])]
    return out


# -- characters and tags -------------------------------------------------------

_OWN = "@.-_+%() ,:;/#=\"'\n"


def _char_classes() -> np.ndarray:
    """Class of each ASCII code: digits, small, capital, each sign of its own, other."""
    table = np.full(128, 3, np.int64)
    for c in range(128):
        ch = chr(c)
        table[c] = 0 if ch.isdigit() else 1 if ch.islower() else 2 if ch.isupper() else 4 + _OWN.index(ch) if ch in _OWN else 3
    return table


_CLASSES = _char_classes()
N_CLASSES = 4 + len(_OWN) + 2  # other letters, and outside the text
N_TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind


def char_codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CLASSES[np.minimum(points, 127)], N_CLASSES - 2)


def window_starts(n: int) -> np.ndarray:
    return np.arange(0, max(n - WIDTH + STRIDE, 1), STRIDE)


def windows(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``WIDTH`` codes from each start; positions behind the end have a class of their own."""
    places = starts[:, None] + np.arange(WIDTH)
    padded = np.append(codes, N_CLASSES - 1)
    return padded[np.minimum(places, len(codes))]


# -- the network ---------------------------------------------------------------


@dataclass
class Tagger:
    """Weights of two LSTMs, the output layer, and the CRF."""

    p: dict[str, np.ndarray]

    @staticmethod
    def new(seed: int = 3) -> Tagger:
        draw = np.random.default_rng(seed)
        p = {}
        for side in "fb":
            p["x" + side] = (draw.normal(0, 0.3, (N_CLASSES, 4 * HIDDEN))).astype(np.float32)
            p["h" + side] = (draw.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))).astype(np.float32)
            p["x" + side][:, HIDDEN : 2 * HIDDEN] += 1  # remember at first
        p["out"] = draw.normal(0, 0.3, (2 * HIDDEN, N_TAGS)).astype(np.float32)
        p["bias"] = np.zeros(N_TAGS, np.float32)
        p["trans"] = np.zeros((N_TAGS, N_TAGS), np.float32)
        p["first"] = np.zeros(N_TAGS, np.float32)
        return Tagger(p)

    def _lstm(self, side: str, codes: np.ndarray, keep: list | None):
        """Hidden states of each step; ``keep`` gets what the way back needs."""
        n, t = codes.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.empty((t, n, HIDDEN), np.float32)
        table, recur = self.p["x" + side], self.p["h" + side]
        for k in range(t) if side == "f" else range(t - 1, -1, -1):
            z = table[codes[:, k]] + h @ recur
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, last = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[k] = h
            if keep is not None:
                keep.append((k, i, f, o, g, before, tc, last))
        return out

    def scores(self, codes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Tag scores ``(step, window, tag)``."""
        tapes = {s: [] for s in "fb"} if keep is not None else {s: None for s in "fb"}
        both = np.concatenate([self._lstm(s, codes, tapes[s]) for s in "fb"], axis=2)
        if keep is not None:
            keep["tapes"], keep["both"] = tapes, both
        return both @ self.p["out"] + self.p["bias"]

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The best tag sequence of each window, ``(window, step)``."""
        emit = self.scores(codes)
        t, n, _ = emit.shape
        best = emit[0] + self.p["first"]
        back = np.empty((t, n, N_TAGS), np.int8)
        for k in range(1, t):
            paths = best[:, :, None] + self.p["trans"]
            back[k] = paths.argmax(1)
            best = paths.max(1) + emit[k]
        tags = np.empty((n, t), np.int8)
        tags[:, -1] = best.argmax(1)
        rows = np.arange(n)
        for k in range(t - 1, 0, -1):
            tags[:, k - 1] = back[k, rows, tags[:, k]]
        return tags

    def gradient(self, codes: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the gold tags, and its gradient."""
        p, keep = self.p, {}
        emit = self.scores(codes, keep).astype(np.float64)
        t, n, _ = emit.shape
        trans = p["trans"].astype(np.float64)

        def lse(x, axis):
            top = x.max(axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))

        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[0] = emit[0] + p["first"]
        for k in range(1, t):
            alpha[k] = emit[k] + lse(alpha[k - 1][:, :, None] + trans, 1)
        for k in range(t - 2, -1, -1):
            beta[k] = lse(trans + (emit[k + 1] + beta[k + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        slope = np.exp(alpha + beta - z[None, :, None])
        d_trans = np.zeros_like(trans)
        for k in range(1, t):
            d_trans += np.exp(alpha[k - 1][:, :, None] + trans + (emit[k] + beta[k])[:, None, :] - z[:, None, None]).sum(0)
        rows = np.arange(n)
        steps = np.arange(t)[:, None]
        loss = z.sum() - emit[steps, rows, gold.T].sum() - p["first"][gold[:, 0]].sum() - trans[gold[:, :-1], gold[:, 1:]].sum()
        slope[steps, rows, gold.T] -= 1
        np.subtract.at(d_trans, (gold[:, :-1], gold[:, 1:]), 1)
        d = {"trans": d_trans, "first": slope[0].sum(0)}
        s = slope.astype(np.float32)
        both = keep["both"]
        d["out"] = both.reshape(-1, 2 * HIDDEN).T @ s.reshape(-1, N_TAGS)
        d["bias"] = s.sum((0, 1))
        d_both = s @ p["out"].T
        for a, side in enumerate("fb"):
            d_own = d_both[:, :, a * HIDDEN : (a + 1) * HIDDEN]
            dx, dh_w = np.zeros_like(p["x" + side]), np.zeros_like(p["h" + side])
            dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for k, i, f, o, g, before, tc, last in reversed(keep["tapes"][side]):
                dh = dh + d_own[k]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
                np.add.at(dx, codes[:, k], dz)
                dh_w += last.T @ dz
                dh = dz @ p["h" + side].T
                dc = dc * f
            d["x" + side], d["h" + side] = dx, dh_w
        return loss / n, {k: (v / n).astype(np.float32) for k, v in d.items()}

    def train(self, codes: np.ndarray, gold: np.ndarray, steps: int = STEPS, rate: float = 0.03, seed: int = 4) -> float:
        """Adam over random batches; the last mean loss."""
        draw = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        loss = 0.0
        for step in range(1, steps + 1):
            pick = draw.integers(0, len(codes), BATCH)
            now, grad = self.gradient(codes[pick], gold[pick])
            loss = 0.9 * loss + 0.1 * now if step > 1 else now
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                self.p[k] -= rate * (1 - step / (steps + 1)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        return loss


# -- training rows -------------------------------------------------------------


def training_windows(texts: list[str], seed: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Windows and gold tags from texts and their base spans.

    For each span: the text around it, and the same place with a second span of the
    sample beside it.  As many windows start anywhere, most of them without a span.
    """
    draw = np.random.default_rng(seed)
    found = [(text, spans) for text in texts if (spans := base_spans(text))]
    pieces = [(k, text[a:b]) for text, spans in found for k, a, b in spans]
    codes, gold = [], []

    def add(text: str, spans: list[Span], start: int) -> None:
        part = char_codes(text[start : start + WIDTH])
        tags = np.zeros(WIDTH, np.int64)
        for kind, a, b in spans:
            if b > start and a < start + WIDTH:
                tags[max(a - start, 0) : b - start] = 2 + 2 * kind
                if a >= start:
                    tags[a - start] = 1 + 2 * kind
        codes.append(windows(part, np.zeros(1, np.int64))[0])
        gold.append(tags)

    for text, spans in found:
        for kind, a, b in spans:
            if b - a > WIDTH - 8:
                continue
            add(text, spans, int(np.clip(a - draw.integers(0, max(1, WIDTH - (b - a))), 0, max(0, len(text) - 1))))
            other, piece = pieces[draw.integers(len(pieces))]
            left, right = text[max(0, a - 20) : a], text[b : b + 20]
            if draw.integers(2):
                mixed, own, new = left + text[a:b] + " " + piece + right, (kind, len(left), len(left) + b - a), (other, len(left) + b - a + 1, len(left) + b - a + 1 + len(piece))
            else:
                mixed, own, new = left + piece + " " + text[a:b] + right, (kind, len(left) + len(piece) + 1, len(left) + len(piece) + 1 + b - a), (other, len(left), len(left) + len(piece))
            add(mixed, [own, new], int(draw.integers(0, max(1, len(mixed) - WIDTH + 1))))
        add(text, spans, int(draw.integers(0, max(1, len(text) - WIDTH))))
    if not codes:
        return np.zeros((0, WIDTH), np.int64), np.zeros((0, WIDTH), np.int64)
    return np.array(codes), np.array(gold)


def sample_texts(docs: DataFrame, text: str = "text") -> list[str]:
    """At most ``SAMPLE`` pieces of text around base spans.

    They come from about ``SCANNED`` documents, chosen by a hash of the text.
    """
    likely = r"@[A-Za-z0-9-]+\.|[0-9]\.[0-9]{1,3}\.[0-9]|[0-9]{16}|\+[0-9]"
    place = F.pmod(F.xxhash64(text), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.where(place < SCANNED / max(docs.count(), 1)).where(F.col(text).rlike("[0-9@]")).where(F.col(text).rlike(likely))
    rows = rows.select(F.xxhash64(text).alias("h"), F.col(text).alias("t")).orderBy("h", "t").limit(SAMPLE)
    found = rows.select(F.regexp_extract("t", rf"(?s)(.{{0,200}}(?:{likely}).{{0,200}})", 1).alias("part")).collect()
    return [r.part for r in found if r.part]


def train_tagger(docs: DataFrame, text: str = "text") -> Tagger | None:
    """A tagger trained on ``docs``; none when the sample has no base span."""
    codes, gold = training_windows(sample_texts(docs, text))
    if not len(codes):
        return None
    tagger = Tagger.new()
    tagger.train(codes, gold)
    return tagger


# -- decoding ------------------------------------------------------------------


def tag_spans(tags: np.ndarray, start: int, n: int) -> Iterator[Span]:
    """Spans of one window that do not touch an inner edge of it."""
    flat = tags.tolist()
    k, width = 0, min(WIDTH, n - start)
    while k < width:
        if flat[k] == 0:
            k += 1
            continue
        kind, first = (flat[k] - 1) // 2, k
        k += 1
        while k < width and flat[k] == 2 + 2 * kind:
            k += 1
        if (first > 0 or start == 0) and (k < width or start + width == n):
            yield kind, start + first, start + k


def reconcile(text: str, base: list[Span], votes: Counter[Span]) -> list[Span]:
    """Base spans, and network spans that pass their kind's check and overlap no span taken before.

    Most votes first, then the longer and the earlier span.
    """
    taken = sorted((a, b) for _, a, b in base)
    out = list(base)
    for span, _ in sorted(votes.items(), key=lambda x: (-x[1], x[0][1] - x[0][2], x[0])):
        kind, a, b = span
        while a < b and text[a] in " ,.;:":
            a += 1
        while a < b and text[b - 1] in " ,.;:":
            b -= 1
        if a < b and _CHECKS[kind](text[a:b]) and not any(x < b and a < y for x, y in taken):
            taken.append((a, b))
            out.append((kind, a, b))
    return sorted(out)


def find_spans(texts: list[str], tagger: Tagger | None, most: int = 4096) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text.

    Windows with neither a digit nor ``@`` cannot hold a span of these kinds: all
    their tags are O and they are not decoded.
    """
    out = []
    held: list[tuple[int, int, int, np.ndarray]] = []  # text, start, length, codes
    votes: dict[int, Counter[Span]] = {}

    def flush() -> None:
        if held:
            tags = tagger.decode(np.array([h[3] for h in held]))
            for (k, start, n, _), row in zip(held, tags, strict=True):
                if row.any():
                    votes.setdefault(k, Counter()).update(tag_spans(row, start, n))
            held.clear()

    for k, text in enumerate(texts):
        if not _HINT.search(text):
            out.append(([], []))
            continue
        base = base_spans(text)
        out.append((base, base))
        if tagger is None:
            continue
        codes = char_codes(text)
        hints = np.append(0, np.cumsum((codes == 0) | (codes == 4)))
        starts = window_starts(len(codes))
        full = hints[np.minimum(starts + WIDTH, len(codes))] > hints[starts]
        starts = starts[full]
        for part in range(0, len(starts), most):
            some = starts[part : part + most]
            held.extend((k, int(s), len(codes), row) for s, row in zip(some, windows(codes, some), strict=True))
            if len(held) >= most:
                flush()
    flush()
    for k, counted in votes.items():
        base = out[k][0]
        out[k] = base, reconcile(texts[k], base, counted)
    return out


def listed(spans: list[Span]) -> str:
    """``kind:start:end`` by kind and start, comma-joined; code points, end exclusive."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_personal_data(docs: DataFrame, tagger: Tagger | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_base, base_spans)`` of each row.

    Counts are of all spans; ``base_sha256`` is of the base ones, which
    ``base_spans`` lists.  A null text is empty and has none.  Repeated rows give
    equal results; an empty table none.
    """
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find_spans([v.as_py() or "" for v in batch.column(1)], tagger)
            counts = [[sum(s[0] == k for s in spans) for _, spans in found] for k in range(len(KINDS))]
            plain = [listed(base) for base, _ in found]
            sums = [hashlib.sha256(b.encode()).hexdigest() for b in plain]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(sums, pa.string()),
                    pa.array([listed(s) for _, s in found], pa.string()), pa.array([len(b) for b, _ in found], pa.int64()), pa.array(plain, pa.string()),
                ],
                names=[key, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_base", "base_spans"],
            )

    schema = f"`{key}` {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_base long, base_spans string"
    return docs.select(key, text).mapInArrow(run, schema)


def base_counts(found: DataFrame) -> DataFrame:
    """``find_personal_data`` with the counts of the base spans, which do not depend on what the network learned."""
    return found.withColumns({f"n_{kind}": F.regexp_count("base_spans", F.lit(f"{kind}:")).cast("long") for kind in KINDS})
