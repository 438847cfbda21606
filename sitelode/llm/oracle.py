"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from . import licenses


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit with the reversed polynomial."""
    return f"""xor(4294967295::BIGINT, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, bit: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))))"""


def _record(*fields: str) -> str:
    return " || ".join(
        f"coalesce(octet_length(encode(({f})::VARCHAR))::VARCHAR || ':' || ({f})::VARCHAR, '-')" for f in fields
    )


def _tree(name: str, leaves: str) -> str:
    """All nodes above ``leaves (grp, idx, node, n)`` with what stands beside them in their run of three."""
    run = "PARTITION BY grp, lvl, idx // 3 ORDER BY idx ROWS BETWEEN"
    return f"""
{name}_nodes(grp, lvl, idx, node, n) AS (
  SELECT grp, 0::BIGINT, idx, node, n FROM {leaves}
  UNION ALL
  SELECT grp, lvl + 1, idx // 3, sha256(string_agg(node, '' ORDER BY idx)), (n + 2) // 3
  FROM {name}_nodes WHERE n > 1 GROUP BY grp, lvl, idx // 3, n
),
{name}_roots AS (SELECT grp, node, lvl AS levels FROM {name}_nodes WHERE n = 1),
{name}_beside AS (
  SELECT grp, lvl, idx,
    coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}_nodes WHERE n > 1
)"""


_OP11 = f"""
WITH RECURSIVE rows_ AS (
  SELECT *, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS grp,
    sha256({_record("doc_id", "source", "lang", "n_chars", "text")}) AS leaf,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0
      THEN sha256({_record("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')")}) END AS tampered
  FROM documents
),
leaves AS (
  SELECT doc_id, grp, leaf AS node, coalesce(tampered, leaf) AS start,
    row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n
  FROM rows_
),
{_tree("low", "leaves")},
sources AS (
  SELECT 0 AS grp, grp AS name, node, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM low_roots
),
{_tree("top", "sources")},
walk(doc_id, leaf, idx, grp, tier, lvl, node, proof) AS (
  SELECT doc_id, node, idx, grp, 0, 0::BIGINT, start, '' FROM leaves
  UNION ALL
  SELECT w.doc_id, w.leaf,
    CASE WHEN l.idx IS NOT NULL OR w.tier = 1 THEN w.idx // 3 ELSE s.idx END, w.grp,
    CASE WHEN l.idx IS NULL THEN 1 ELSE 0 END,
    CASE WHEN l.idx IS NULL AND w.tier = 0 THEN 0 ELSE w.lvl + 1 END,
    CASE WHEN l.idx IS NOT NULL THEN sha256(l.before || w.node || l.after)
      WHEN w.tier = 1 THEN sha256(t.before || w.node || t.after) ELSE w.node END,
    w.proof || CASE WHEN l.idx IS NOT NULL THEN l.before || l.after WHEN w.tier = 1 THEN t.before || t.after ELSE '' END
  FROM walk w
  JOIN sources s ON s.name = w.grp
  LEFT JOIN low_beside l ON w.tier = 0 AND l.grp = w.grp AND l.lvl = w.lvl AND l.idx = w.idx
  LEFT JOIN top_beside t ON w.tier = 1 AND t.lvl = w.lvl AND t.idx = w.idx
  WHERE w.tier = 0 OR t.idx IS NOT NULL
)
SELECT w.doc_id, w.leaf, r.node AS subroot, t.node AS root, sha256(w.proof) AS proof_sha256,
  w.node AS folded_root, w.node = t.node AS verified
FROM walk w JOIN low_roots r ON r.grp = w.grp CROSS JOIN top_roots t
WHERE w.tier = 1 AND w.lvl = t.levels
"""


def _edit(value: str, cost: str, initial: str, when: str = "true") -> str:
    return f"CASE WHEN {when} AND {value} IS NOT NULL THEN {{'c': {value}.c + {cost}, 'a': '{initial}' || {value}.a}} END"


def _least(*values: str) -> str:
    return f"list_min([{', '.join(values)}])"


def _past_row(state: str) -> str:
    """The best end of the audit from a state (nothing yet, system, user, assistant) before a row, by those after it."""
    kept = {"s": (("s", "y"), ("u", "u")), "y": (("u", "u"),), "u": (("a", "a"),), "a": (("u", "u"),)}[state]
    following = "a" if state == "u" else "u"
    return _least(
        _edit(f"b.{state}", "2", "D"),
        *[_edit(f"b.{to}", "r.late", "K", f"r.stays AND r.initial = '{initial}'") for initial, to in kept],
        _edit(f"b.{following}", "1 + r.late", "R", "r.stays"),
    )


_OP12 = rf"""
WITH RECURSIVE kinds AS (
  SELECT CASE WHEN conv_id IS NULL THEN '' ELSE '=' || conv_id::VARCHAR END AS conv, turn,
    coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations
),
hurt AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
),
said AS (SELECT *, sha256(octet_length(encode(role))::VARCHAR || ':' || role || text) AS said FROM hurt),
placed AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv) AS n, left(role, 1) AS initial,
    left(role, 1) || left(lead(role) OVER w, 1) AS pair
  FROM said WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, said)
),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN pos > min(pos) OVER (PARTITION BY conv, said) THEN 'duplicate'
    WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM placed
),
rows_ AS (
  SELECT *, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS late
  FROM judged
),
past(conv, pos, s, y, u, a) AS (
  SELECT DISTINCT conv, n, {{'c': 0::BIGINT, 'a': ''}}, {{'c': 10::BIGINT, 'a': 'II'}},
    {{'c': 5::BIGINT, 'a': 'I'}}, {{'c': 0::BIGINT, 'a': ''}} FROM rows_
  UNION ALL
  SELECT conv, pos - 1,
    {_least("s", _edit("u2", "5", "I"))}, {_least("y", _edit("u2", "5", "I"))}, u2, {_least("a", _edit("u", "5", "I"))}
  FROM (SELECT *, {_least("u", _edit("a", "5", "I"))} AS u2 FROM (
    SELECT b.conv, b.pos, {", ".join(f"{_past_row(state)} AS {state}" for state in "syua")}
    FROM past b JOIN rows_ r ON r.conv = b.conv AND r.pos = b.pos))
),
best AS (SELECT conv, s.c AS cost, s.a AS audit FROM past WHERE pos = 0),
edits AS (
  SELECT conv, i, substr(audit, i, 1) AS edit, (length(audit) - length(replace(audit, 'D', ''))) AS gone, length(audit) AS size
  FROM best, range(1, length(audit) + 1) AS t(i)
),
lines AS (
  SELECT *, (size - gone) % 2 AS odd, count(*) FILTER (WHERE edit <> 'D') OVER w - 1 AS line,
    count(*) FILTER (WHERE edit <> 'I') OVER w AS pos
  FROM edits WINDOW w AS (PARTITION BY conv ORDER BY i ROWS UNBOUNDED PRECEDING)
),
digests AS (
  SELECT l.conv, sha256(string_agg(
    CASE WHEN edit = 'K' THEN r.role WHEN (line - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':'
    || CASE WHEN edit = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY line)) AS digest
  FROM lines l LEFT JOIN rows_ r ON r.conv = l.conv AND r.pos = l.pos WHERE edit <> 'D' GROUP BY l.conv
),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE pos < n AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv
)
SELECT i.conv_id, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))},
  coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, CASE WHEN conv_id IS NULL THEN '' ELSE '=' || conv_id::VARCHAR END AS conv FROM conversations) i
LEFT JOIN counts USING (conv) LEFT JOIN best USING (conv) LEFT JOIN digests USING (conv)
"""


def _licenses(settings: licenses.Settings) -> str:
    """Every block against every template of its class."""
    phrases = ", ".join(f"('{p}', {len(p.split())}, '{label}')" for p, label in settings.phrases.items())
    notices = [
        f"({i}, {size}, '{label}', {sorted(set(text.split()))}, ceil({settings.threshold} * {len(set(text.split()))} - 1e-9)::BIGINT)"
        for i, ((text, label), size) in enumerate(zip(settings.notices, licenses.template_sizes(settings), strict=True))
    ]
    return rf"""
WITH phrases(phrase, k, label) AS (VALUES {phrases}),
notices(notice, size, label, words, needed) AS (VALUES {", ".join(notices)}),
texts AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
    translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
places AS (
  SELECT row, label, unnest(list_filter(range(1, len(t.words) + 1), lambda i: array_to_string(t.words[i:i + k - 1], ' ') = phrase)) - 1 AS place
  FROM texts t, phrases
),
base AS (
  SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list_sort(list(DISTINCT label)) AS labels
  FROM places GROUP BY row
),
blocks AS (
  SELECT row, size, spot, list_distinct(words[spot + 1:spot + 2 * size]) AS held
  FROM (SELECT row, words, s.size, unnest(range(0, len(words), s.size)) AS spot FROM texts, (SELECT DISTINCT size FROM notices) s)
),
met AS (
  SELECT row, spot, n.*, len(list_intersect(held, n.words)) AS shared
  FROM blocks b JOIN notices n ON n.size = b.size AND len(list_intersect(held, n.words)) >= needed
),
alone AS (
  SELECT * FROM met m WHERE NOT EXISTS (
    SELECT 1 FROM met w WHERE w.row = m.row AND w.size = m.size AND w.spot = m.spot AND len(w.words) > len(m.words) AND list_has_all(w.words, m.words))
),
best AS (SELECT row, list(DISTINCT label) AS labels, max(shared / len(words)) AS score FROM alone GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(b.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0)::DOUBLE END AS score
FROM texts t LEFT JOIN base b USING (row) LEFT JOIN best m USING (row)
"""


ORACLE: dict[str, str] = {
    "op11_manifest": _OP11,
    "op12_conversations": _OP12,
    "op13_licenses": _licenses(licenses.Settings()),
}
