"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), steps AS (
  SELECT *, lag(role, 1, '') OVER w AS before, row_number() OVER w AS nth
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(role) + length(regexp_replace(text, '<(&*)\|', '<&\1|', 'g'))) AS BIGINT) AS formatted_chars,
       bool_and((before, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user'))) AS valid
FROM steps GROUP BY conv_id
"""

_EXACT = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""

_NEAR = r"""
WITH RECURSIVE ws AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + 4), ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS s FROM ws WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT reach.node, edges.b FROM reach JOIN edges ON edges.a = reach.other
), least_of AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least_of ON node = doc_id LEFT JOIN sizes USING (doc_id)
"""

_DECON = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), sized AS (SELECT item_id, ws, least(10, len(ws)) AS width FROM iw WHERE len(ws) > 0),
item_windows AS (
  SELECT DISTINCT item_id, width, array_to_string(list_slice(ws, s, s + width - 1), ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, len(ws) - width + 1)) AS s FROM sized)
), doc_windows AS (
  SELECT doc_id, width, s, array_to_string(list_slice(ws, s, s + width - 1), ' ') AS phrase
  FROM (SELECT doc_id, ws, width, unnest(generate_series(1, len(ws) - width + 1)) AS s
        FROM dw, (SELECT DISTINCT width FROM sized) WHERE len(ws) >= width)
), found AS (SELECT doc_id, item_id, s, width FROM doc_windows JOIN item_windows USING (width, phrase)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + width - 1)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
),
-- proximity: the two rarest terms of each window that occur, within five positions of their places
it AS (SELECT item_id, len(ws) AS size, least(10, len(ws)) AS width, unnest(ws) AS term, unnest(generate_series(0, len(ws) - 1)) AS p FROM iw WHERE len(ws) > 0),
dt AS (
  SELECT * FROM (SELECT doc_id, unnest(ws) AS term, unnest(generate_series(0, len(ws) - 1)) AS pos FROM dw WHERE len(ws) > 0)
  WHERE term IN (SELECT term FROM it)
),
df AS (SELECT term, count(*) AS df FROM dt GROUP BY term),
ranked AS (
  SELECT item_id, s, term, p, row_number() OVER (PARTITION BY item_id, s ORDER BY df, p) AS r
  FROM (SELECT item_id, term, p, unnest(generate_series(greatest(p - width + 1, 0), least(p, size - width))) AS s FROM it) JOIN df USING (term)
),
probes AS (
  SELECT DISTINCT a.item_id, a.term AS t1, a.p AS p1, coalesce(b.term, a.term) AS t2, coalesce(b.p, a.p) AS p2
  FROM (SELECT * FROM ranked WHERE r = 1) a LEFT JOIN (SELECT * FROM ranked WHERE r = 2) b ON a.item_id = b.item_id AND a.s = b.s
),
met AS (
  SELECT DISTINCT x.doc_id, item_id, x.pos - p1 AS delta, y.pos = x.pos - p1 + p2 AS exact
  FROM probes JOIN dt x ON x.term = t1 JOIN dt y ON y.doc_id = x.doc_id AND y.term = t2 AND abs(y.pos - (x.pos - p1 + p2)) <= 5
),
near AS (SELECT doc_id, count(DISTINCT item_id) AS n_near_items FROM met GROUP BY doc_id),
best AS (
  SELECT doc_id, max(m * 10000 // size) AS best_match_bp
  FROM (SELECT met.doc_id, met.item_id, delta, any_value(size) AS size, count(*) AS m
        FROM met JOIN it ON it.item_id = met.item_id JOIN dt ON dt.doc_id = met.doc_id AND dt.term = it.term AND dt.pos = delta + it.p
        WHERE exact GROUP BY ALL)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near_items, 0) AS n_near_items, coalesce(best_match_bp, 0) AS best_match_bp
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN near USING (doc_id) LEFT JOIN best USING (doc_id)
"""

#: Fixed values of op6: kind, pattern, group whose length counts, least length; written out
#: here again, so that a wrong constant of the operator shows.
_BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
)
#: kind, pattern, bits of the best window of 20, patterns that have to match.
_ENTROPY = (
    ("entropy_mixed", r"[0-9a-zA-Z+/_=\-]{20,}", 3.83, ("[0-9]", "[a-z]", "[A-Z]")),
    ("entropy_hex", "[0-9A-F]{20,}", 3.03, ("[0-9]", "[A-F]")),
    ("entropy_lower", "[0-9a-z]{20,}", 3.6, ("[0-9].*[0-9]", "[g-z]")),
    ("entropy_upper", "[0-9A-Z]{20,}", 3.6, ("[0-9].*[0-9]", "[G-Z]")),
)
_ALLOWED = ("(?i)example", "(?i)placeholder", "0123456789", "(?i)abcdefgh")


def _secrets_sql() -> str:
    """One branch a kind: matches and the texts between them add up to positions."""

    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def branch(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
        return rf"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, start, start + length(m) AS stop, m
  FROM (
    SELECT doc_id, ms[i] AS m, ks[i] AS k,
           list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in ms[1:i - 1]]), 0) AS start
    FROM (
      SELECT *, unnest(generate_series(1, len(ms))) AS i FROM (
        SELECT doc_id, regexp_extract_all(t, {quoted(pattern)}) AS ms,
               regexp_extract_all(t, {quoted(pattern)}, {group}) AS ks,
               string_split_regex(t, {quoted(pattern)}) AS gaps
        FROM d WHERE regexp_matches(t, {quoted(pattern)})
      )
    )
  ) WHERE length(k) >= {least}"""

    base = " UNION ALL ".join(branch(k, i, p, g, n) for i, (k, p, g, n) in enumerate(_BASE))
    more = []
    for i, (kind, pattern, bits, musts) in enumerate(_ENTROPY, len(_BASE)):
        must = "".join(f" AND regexp_matches(m, '{p}')" for p in musts)
        allow = "".join(f" AND NOT regexp_matches(m, {quoted(p)})" for p in _ALLOWED)
        best = "list_max([list_entropy(string_split(m[j:j + 19], '')) for j in generate_series(1, length(m) - 19)])"
        more.append(
            f"SELECT * FROM ({branch(kind, i, pattern, 0, 20)}) c WHERE {best} >= {bits}{must}{allow} AND NOT EXISTS "
            "(SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.start < c.stop AND c.start < b.stop)"
        )
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS ({base}),
every AS (SELECT * FROM base UNION ALL {' UNION ALL '.join(more)}),
b AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS txt
  FROM base GROUP BY doc_id
),
e AS (SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans FROM every GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(txt, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN e USING (doc_id)
"""


ORACLES: dict[str, str] = {
    "op1_chat_format": _CHAT,
    "op3_near_dedup": _NEAR,
    "op5_decontaminate": _DECON,
    "op6_secrets": _secrets_sql(),
    "op7_exact_dedup": _EXACT,
}
