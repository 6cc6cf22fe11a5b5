"""Plain-Python statements of the op11 to op13 contracts, for tests."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def variants(rows):
    """rows: (doc_id, text) -> {word: (form, root, n, n_near, form_n)}."""
    n = Counter()
    for doc_id, text in rows:
        for run in LETTERS.findall(text or ""):
            w = run.translate(FOLD)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{w}".encode())
                if h % 97 == 0:
                    k = h % len(w)
                    w = w[:k] + w[k + 1 :]
            if len(w) >= 5:
                n[w] += 1
    words = sorted(w for w, c in n.items() if c >= 3)
    nbr = defaultdict(list)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if near(a, b):
                nbr[a].append(b)
                nbr[b].append(a)
    form = {}
    for w in words:
        best = min(nbr[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in words:
        r = w
        while form[r] is not None:
            r = form[r]
        out[w] = (form[w], r, n[w], len(nbr[w]), n[form[w]] if form[w] else None)
    return out


def rebuilt(rows):
    """rows: (conv_id, turn, role, text) -> {conv_id: tuple of (role, text)}."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t if t is not None else 0, r or "", x or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in by.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        b = c - int(__import__("math").fmod(c, 5))
        head = turns.get(b, [])[:h]
        out[c] = tuple(head + own[h:])
    return out


def trie(rows):
    """Rows of the op13 contract, as a set of tuples (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    nodes = set(members)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    least = {p: min(m) for p, m in members.items()}

    def sub(p):
        leaves, saved = (0 if kids[p] else 1), (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        for k in kids[p]:
            a, b = sub(k)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    import sys

    sys.setrecursionlimit(10000)
    out = set()
    for p in nodes:
        leaves, saved = sub(p)
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(convs[c]) == len(p)))
        out.add((least[p], len(p), least[p[:-1]] if p else None, len(members[p]), len(kids[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out
