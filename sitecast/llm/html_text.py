"""Main text of HTML pages, with nearest-URL page differencing.

Pages of a host are ordered by URL path and each is paired with the neighbour
whose path shares the longer beginning.  Their text lines are aligned by longest
common subsequence; lines that both have belong to the site, not to the page.
Markup tells more than a twin page where it is there: lines inside an article are
the page's own even when a neighbour repeats them, and lines inside menus,
headers, footers, sidebars, notices, adverts, forms and comments never are.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.llm.tables import checked_side
from sitecast.operators.ordering import OWN, framed
from sitecast.session import materialize

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Elements whose content is no text, up to their end tag.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template", "svg", "math", "select", "object", "canvas"}
#: Elements that never hold the main text.
_ASIDE = {"nav", "header", "footer", "aside", "form", "head", "menu", "dialog", "button", "label", "fieldset"}
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark meter output picture q s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words in a class, id or role that name what is not the main text.
_ASIDE_WORDS = set(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion "
    "related replies search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
_MAIN_WORDS = {"main"}
#: Words beside them that name a page layout instead, as in "has-sidebar".
_LAYOUT_WORDS = {"has", "layout", "no", "page", "with", "without"}
_OWN_LINE, _PLAIN, _SITE = 0, 1, 2


def _names(attributes: str) -> set[str]:
    words: set[str] = set()
    for found in _ATTRIBUTE.finditer(attributes):
        words.update(re.split(r"[^a-z0-9]+", (found[2] or found[3] or found[4] or "").lower()))
    return words


def text_lines(page: str) -> tuple[list[str], list[int]]:
    """Text blocks of a page in order, and of each whether it is the page's own, plain, or the site's.

    A block ends at any element that is not inline and at a line break.  White
    space becomes one space; blocks without text are left out.
    """
    lines: list[str] = []
    kinds: list[int] = []
    buffer: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements: name, and 0, or 1 in the article, or 2 aside
    opened: Counter[str] = Counter()
    state = 0
    found_main = False

    def flush() -> None:
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                lines.append(text)
                kinds.append(_SITE if state == 2 else _OWN_LINE if state == 1 else _PLAIN)

    def close_from(k: int) -> int:
        opened.subtract(name for name, _ in stack[k:])
        del stack[k:]
        return stack[-1][1] if stack else 0

    at, end, low = 0, len(page), None
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            buffer.append(page[at:])
            break
        if lt > at:
            buffer.append(page[at:lt])
        if page.startswith("<!--", lt):
            close = page.find("-->", lt + 4)
            at = end if close < 0 else close + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            close = page.find(">", lt)
            at = end if close < 0 else close + 1
            continue
        tag = _TAG.match(page, lt)
        if not tag:
            buffer.append("<")
            at = lt + 1
            continue
        at = tag.end()
        name = tag[2].lower()
        if name not in _INLINE:
            flush()
        if tag[1]:
            if opened[name] > 0:
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                if name in _INLINE and state != (stack[k - 1][1] if k else 0):
                    flush()
                state = close_from(k)
            continue
        if name in _RAW:
            low = page.lower() if low is None else low
            close = low.find("</" + name, at)
            if close < 0 or len(low) != end:
                again = re.compile("</" + name, re.I).search(page, at)
                close = again.start() if again else -1
            shut = -1 if close < 0 else page.find(">", close)
            at = end if shut < 0 else shut + 1
            continue
        if name in _VOID or tag[3].endswith("/") and name not in _INLINE:
            continue
        if name not in _INLINE and opened["p"] > 0:  # an open paragraph ends here
            k = len(stack) - 1
            while stack[k][0] in _INLINE:
                k -= 1
            if stack[k][0] == "p":
                state = close_from(k)
        words = _names(tag[3]) if "=" in tag[3] else set()
        if words & _LAYOUT_WORDS:
            words -= _ASIDE_WORDS
        inner = state
        if state != 2:
            if name in _ASIDE or words & _ASIDE_WORDS and name not in ("html", "body"):
                inner = 2
            elif name in ("article", "main") or words & _MAIN_WORDS:
                inner, found_main = 1, True
        if inner != state:
            if name in _INLINE:
                flush()
            state = inner
        stack.append((name, state))
        opened[name] += 1
    flush()
    if found_main:
        kinds = [_SITE if k == _PLAIN else k for k in kinds]
    return lines, kinds


def common_lines(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``.

    Common ends are cut off and lines of one side only are left out first; what is
    left is split in halves (bit-parallel length rows, linear memory) until it is
    small enough for a table.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    known = set(b[head : len(b) - tail])
    x = [k for k in range(head, len(a) - tail) if a[k] in known]
    mine = {a[k] for k in x}
    y = [v for v in b[head : len(b) - tail] if v in mine]
    inside = [x[k] for k in _subsequence([a[k] for k in x], y)]
    return [*range(head), *inside, *range(len(a) - tail, len(a))]


def _subsequence(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    n, m = len(a), len(b)
    if n * m <= 4096 or m == 1:
        table = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            for j in range(m - 1, -1, -1):
                table[i][j] = table[i + 1][j + 1] + 1 if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
        out, i, j = [], 0, 0
        while i < n and j < m:
            if a[i] == b[j]:
                out.append(i)
                i, j = i + 1, j + 1
            elif table[i + 1][j] >= table[i][j + 1]:
                i += 1
            else:
                j += 1
        return out
    half = m // 2
    best = _lengths(a, b[:half]) + _lengths(a[::-1], b[half:][::-1])[::-1]
    cut = int(best.argmax())
    return _subsequence(a[:cut], b[:half]) + [cut + k for k in _subsequence(a[cut:], b[half:])]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of a longest common subsequence of each beginning of ``a`` with all of ``b``."""
    masks: dict[int, int] = {}
    for k, v in enumerate(a):
        masks[v] = masks.get(v, 0) | (1 << k)
    full = (1 << len(a)) - 1
    row = full
    for v in b:
        met = row & masks.get(v, 0)
        row = ((row + met) | (row - met)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(a)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _hash_lines(lines: list[str]) -> list[int]:
    from xxhash import xxh64_intdigest

    return [xxh64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for x in lines]


def paired_pages(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(page, hash, lines, other)``: hashes of the lines of each page and of its nearest page.

    The nearest page of a host is the neighbour in path order whose path shares the
    longer beginning, the earlier one if equal; a page alone on its host, or
    without a URL, has none.  A host of any size is cut into chunks of pages.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_hash_lines(text_lines(v.as_py() or "")[0]) for v in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.list_(pa.int64()))], names=["page", "hash", "host", "path", "lines"])

    kind = dict(pages.dtypes)[key]
    parts = F.col(url)
    rows = pages.select(
        F.col(key).alias("page"),
        F.xxhash64(url, page).alias("hash"),
        F.lower(F.regexp_extract(parts, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(parts, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"),
        F.col(page).alias("html"),
    )
    rows = rows.mapInArrow(hashes, f"page {kind}, hash long, host string, path string, lines array<long>")
    spread, near, _ = framed(rows, ["host"], [F.col("path"), F.col("page"), F.col("hash")], back=1, ahead=1)

    def alike(other: str):
        """Length of the common beginning of two paths."""
        n = F.least(F.length("path"), F.length(other))
        return F.aggregate(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
            F.lit(0),
            lambda got, k: F.when((got == k - 1) & (k <= n) & (F.substr("path", k, F.lit(1)) == F.substr(F.col(other), k, F.lit(1))), k).otherwise(got),
        )

    sides = spread.withColumns(
        {
            "_p": F.lag("path").over(near), "_pl": F.lag("lines").over(near),
            "_n": F.lead("path").over(near), "_nl": F.lead("lines").over(near),
        }
    ).where(OWN)
    nearer = F.when(F.col("_pl").isNull(), F.col("_nl")).when(F.col("_nl").isNull(), F.col("_pl"))
    nearer = nearer.when(alike("_p") >= alike("_n"), F.col("_pl")).otherwise(F.col("_nl"))
    return sides.select("page", "hash", "lines", F.when(F.col("host") != "", nearer).alias("other"))


def shared_lines(pairs: DataFrame) -> DataFrame:
    """``(page, hash, shared)``: places of the lines that a page shares with its nearest page.

    A copy of the page says nothing about its site and counts as sharing none.
    """
    kind = dict(pairs.dtypes)["page"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            found = [common_lines(a, b) if a and b and a != b else [] for a, b in both]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.int32()))], names=["page", "hash", "shared"])

    return pairs.mapInArrow(align, f"page {kind}, hash long, shared array<int>")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(key, url, text, n_chars, n_lines, n_shared)`` of each page.

    ``text`` joins the page's own lines by a line feed.  Inside an article (or main
    element) every line is kept but those of aside elements; on a page without one,
    plain lines are kept unless the nearest page shares them.  A null or empty page
    has no text (empty).  Repeated rows give equal results; an empty table none.
    """
    kind = dict(pages.dtypes)[key]
    shared = materialize(shared_lines(paired_pages(pages, key, url, page)).dropDuplicates(["page", "hash"]))
    own = pages.select(F.col(key).alias("_k"), F.col(url).alias("_u"), F.xxhash64(url, page).alias("_h"), F.col(page).alias("_html"))
    side = checked_side(shared, shared.count())
    met = own.join(side, own["_k"].eqNullSafe(side["page"]) & (own["_h"] == side["hash"]), "left").select("_k", "_u", "_html", "shared")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines_of, shared_of = [], [], []
            for value, places in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                lines, kinds = text_lines(value.as_py() or "")
                twin = set(places or ())
                keep = [x for k, (x, kind) in enumerate(zip(lines, kinds, strict=True)) if kind == _OWN_LINE or kind == _PLAIN and k not in twin]
                texts.append("\n".join(keep))
                lines_of.append(len(lines))
                shared_of.append(len(twin))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64()), pa.array(lines_of, pa.int64()), pa.array(shared_of, pa.int64())],
                names=[key, "url", "text", "n_chars", "n_lines", "n_shared"],
            )

    return met.mapInArrow(extract, f"`{key}` {kind}, url string, text string, n_chars long, n_lines long, n_shared long")
