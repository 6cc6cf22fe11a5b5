"""SQL that states what some of the queries return."""

from __future__ import annotations

from sitecast.llm import decontam, mixing

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NGRAM_JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[k:k + 4], ' ') for k in range(1, len(w) - 3)]) END AS s FROM words
), tokens AS (SELECT doc_id, unnest(s) AS t FROM sets
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM met JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * c >= 75 * (len(x.s) + len(y.s) - c)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.b) AS component_id FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, len(s.s)
"""

LINE_WINDOWS = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS raw, [trim(x) for x in string_split(text, chr(10))] AS l FROM documents),
w AS (
  SELECT doc_id, k AS place, least(len(l), 3) AS n,
    CASE WHEN len(l) < 3 THEN len(l) || chr(2) ELSE '' END
      || l[k + 1] || chr(1) || coalesce(l[k + 2], '') || chr(1) || coalesce(l[k + 3], '') AS key
  FROM l, unnest(range(0, greatest(len(l) - 2, 1))) AS u(k)
  WHERE text IS NOT NULL AND length(l[k + 1] || coalesce(l[k + 2], '') || coalesce(l[k + 3], '')) > 0
), later AS (SELECT doc_id, place, n FROM w QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, place) > 1
), gone AS (SELECT DISTINCT doc_id, place + k AS line FROM later, unnest(range(0, n)) AS u(k)
), lists AS (SELECT doc_id, list(line ORDER BY line) AS gone FROM gone GROUP BY doc_id)
SELECT l.doc_id, coalesce(len(raw), 0) AS n_lines, coalesce(len(gone), 0) AS n_removed,
  coalesce(array_to_string(gone, ','), '') AS removed,
  sha256(CASE WHEN gone IS NULL THEN text
    ELSE array_to_string([l.raw[k + 1] for k in range(0, len(l.raw)) if NOT list_contains(gone, k)], chr(10)) END) AS text_sha256
FROM l LEFT JOIN lists USING (doc_id)
"""

MIX_SOURCES = rf"""
WITH best AS (SELECT doc_id, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
rows AS (
  SELECT d.doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size,
    -ln((CAST('0x' || md5('{mixing.SEED}:' || d.doc_id)[1:13] AS BIGINT) + 0.5) / 4503599627370496.0)
      / CASE q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS key
  FROM documents d LEFT JOIN best ON d.doc_id = best.doc_id
), sources AS (
  SELECT source, sum(size)::BIGINT AS s, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM rows GROUP BY source
), steps AS (
  SELECT *, ((SELECT sum(s) FROM sources)::DOUBLE - coalesce(sum(3.0::DOUBLE * s) OVER before, 0)) / sum(w) OVER after AS level,
    row_number() OVER (ORDER BY 3.0 * s / w, source) AS turn
  FROM sources WINDOW before AS (ORDER BY 3.0 * s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY 3.0 * s / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (SELECT arg_min(level, turn) FILTER (WHERE level * w <= 3.0 * s) AS level FROM steps
), goals AS (
  SELECT source, s, least(w * level.level, 3.0::DOUBLE * s) AS target, CASE WHEN s > 0 THEN floor(least(w * level.level, 3.0::DOUBLE * s) / s) ELSE 0 END AS epochs
  FROM sources, level
), placed AS (
  SELECT rows.*, s, target, epochs,
    coalesce(sum(size) OVER (PARTITION BY rows.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows JOIN goals ON rows.source IS NOT DISTINCT FROM goals.source
)
SELECT doc_id, size, s AS source_size, target::DOUBLE AS target,
  (size * (epochs + CASE WHEN 2 * before + size <= 2 * (target - epochs * s) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""


def _masked(tokens: str, at: str, first: int, masks) -> str:
    """A list with one string for each mask, NULL where the span leaves the tokens."""
    return "[" + ", ".join(
        f"CASE WHEN {at} + {m[-1]} < len({tokens}) THEN '{first + k}' || " + " || ".join(f"' ' || {tokens}[{at} + {o + 1}]" for o in m) + " END"
        for k, m in enumerate(masks)
    ) + "]"


SPACED_SEEDS = rf"""
WITH items AS (
  SELECT min(item_id) AS item, t, len(t) AS n
  FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS t FROM benchmark WHERE text IS NOT NULL)
  WHERE len(t) >= {decontam.SHORT_SPAN} GROUP BY t
), placed AS (
  SELECT item, t, n, j, greatest(0, least(j - {(decontam.WINDOW - decontam.SPAN) // 2}, n - {decontam.WINDOW})) AS w0
  FROM items, unnest(range(0, n)) AS u(j)
), seeds AS (
  SELECT seed, t[w0 + 1:w0 + {decontam.WINDOW}] AS win, j - w0 AS off, min({{'item': item, 'j': j}}) AS hit
  FROM (SELECT *, unnest(CASE WHEN n >= {decontam.SPAN} THEN {_masked("t", "j", 0, decontam.MASKS)}
    ELSE {_masked("t", "j", len(decontam.MASKS), decontam.SHORT_MASKS)} END) AS seed FROM placed)
  WHERE seed IS NOT NULL GROUP BY ALL
), docs AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS t FROM documents WHERE text IS NOT NULL
), places AS (
  SELECT doc_id, pos, unnest({_masked("t", "pos", 0, decontam.MASKS + decontam.SHORT_MASKS)}) AS seed
  FROM docs, unnest(range(0, len(t))) AS u(pos)
), hits AS (
  SELECT doc_id, hit.item AS item, pos - hit.j AS diagonal, hit.j // {decontam.STRIDE} AS step, min(pos) AS pos
  FROM places JOIN seeds USING (seed) GROUP BY ALL
), laid AS (
  SELECT DISTINCT h.doc_id, h.item, pos - off AS start, win
  FROM hits h JOIN seeds s ON s.hit.item = h.item AND pos - s.hit.j = diagonal
), scored AS (
  SELECT doc_id, item, len(win) AS n_window,
    list_sum([CASE WHEN start + k >= 0 AND t[start + k + 1] = win[k + 1] THEN 1 ELSE 0 END for k in range(0, len(win))]) AS n_match
  FROM laid JOIN docs USING (doc_id)
), best AS (
  SELECT doc_id, item, max({{'share': n_match / n_window, 'n_match': n_match, 'n_window': n_window}}) AS b FROM scored GROUP BY ALL
)
SELECT doc_id, item AS item_id, b.n_match::BIGINT AS n_match, b.n_window::BIGINT AS n_window FROM best WHERE b.share >= {decontam.AGREE}
"""

#: The conversation that every op11 run adds: control strings inside both texts.
CHAT_EXTRA_TEXT = r"\### Assistant: </turn> ok"


def _sql_escape(x: str, name: bool = False) -> str:
    out = f"replace(replace(replace({x}, '\\', '\\\\'), '</turn>', '<\\/turn>'), '### ', '#\\## ')"
    return f"replace({out}, ':' || chr(10), ':\\' || chr(10))" if name else out


CHAT_TEMPLATE = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CHAT_EXTRA_TEXT}'
  UNION ALL SELECT -7, 1, 'assistant', '{CHAT_EXTRA_TEXT}'
), o AS (
  SELECT *, row_number() OVER w - 1 AS k, coalesce(lag(role) OVER w, 'start') AS prev FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, role, text)
), e AS (
  SELECT *, {_sql_escape("text")} AS esc,
    CASE role WHEN 'system' THEN '### System:' WHEN 'user' THEN '### User:' WHEN 'assistant' THEN '### Assistant:'
      ELSE '### [' || {_sql_escape("role", True)} || ']:' END || chr(10) AS head,
    (prev = 'start' AND role IN ('system', 'user')) OR (prev = 'system' AND role = 'user')
      OR (prev = 'user' AND role = 'assistant') OR (prev = 'assistant' AND role = 'user') AS ok
  FROM o
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(head) + length(esc) + 8) AS BIGINT) AS formatted_chars,
  bool_and(ok) AND arg_max(role, k) = 'assistant' AS valid
FROM e GROUP BY conv_id
"""
