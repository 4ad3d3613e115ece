"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(i)
), e AS (
  SELECT *,
    replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c') AS role_out,
    replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t') AS text_out
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role_out) + length(text_out) + 14) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text in SQL, as an unsigned integer."""
    bits = "list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(c, b))"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: {bits}, 4294967295::BIGINT), 4294967295)"


def _framed(expr: str) -> str:
    return f"CASE WHEN {expr} IS NULL THEN '-' ELSE strlen({expr}::VARCHAR) || ':' || {expr}::VARCHAR END"


_ROW = " || ".join(_framed(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op11_merkle"] = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({_ROW} || {_framed('text')}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND ({crc32('doc_id::VARCHAR')}) % 3 = 0 THEN sha256({_ROW} || {_framed(_LOWERED)}) END AS tampered
  FROM documents
), p AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM l
), low AS (
  SELECT g, 0 AS lvl, pos, n, leaf AS v FROM p
  UNION ALL
  SELECT g, lvl + 1, pos >> 3, (n + 7) >> 3, sha256(string_agg(v, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY g, lvl, pos >> 3, n
), tops AS (
  SELECT g, v, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1
), high AS (
  SELECT 0 AS lvl, pos, n, v FROM tops
  UNION ALL
  SELECT lvl + 1, pos >> 3, (n + 7) >> 3, sha256(string_agg(v, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY lvl, pos >> 3, n
), path AS (
  SELECT p.g, p.pos, s.lvl,
    coalesce(string_agg(s.v, '' ORDER BY s.pos) FILTER (s.pos < p.pos >> (3 * s.lvl)), '') AS before,
    coalesce(string_agg(s.v, '' ORDER BY s.pos) FILTER (s.pos > p.pos >> (3 * s.lvl)), '') AS after
  FROM p JOIN low s ON s.g = p.g AND s.n > 1 AND s.pos >> 3 = p.pos >> (3 * s.lvl + 3) GROUP BY p.g, p.pos, s.lvl
  UNION ALL
  SELECT p.g, p.pos, 1000 + s.lvl,
    coalesce(string_agg(s.v, '' ORDER BY s.pos) FILTER (s.pos < t.pos >> (3 * s.lvl)), ''),
    coalesce(string_agg(s.v, '' ORDER BY s.pos) FILTER (s.pos > t.pos >> (3 * s.lvl)), '')
  FROM p JOIN tops t USING (g) JOIN high s ON s.n > 1 AND s.pos >> 3 = t.pos >> (3 * s.lvl + 3) GROUP BY p.g, p.pos, s.lvl
), steps AS (
  SELECT *, row_number() OVER (PARTITION BY g, pos ORDER BY lvl) AS k FROM path
), fold AS (
  SELECT g, pos, 0 AS k, coalesce(tampered, leaf) AS acc FROM p
  UNION ALL
  SELECT f.g, f.pos, f.k + 1, sha256(s.before || f.acc || s.after) FROM fold f JOIN steps s ON s.g = f.g AND s.pos = f.pos AND s.k = f.k + 1
), folded AS (
  SELECT g, pos, max_by(acc, k) AS acc FROM fold GROUP BY g, pos
), proofs AS (
  SELECT g, pos, string_agg(before || after, '' ORDER BY k) AS proof FROM steps GROUP BY g, pos
)
SELECT p.doc_id, p.leaf, t.v AS subroot, r.v AS root, sha256(coalesce(proof, '')) AS proof_sha256,
  acc AS folded_root, acc = r.v AS verified
FROM p JOIN tops t USING (g) JOIN folded f ON f.g = p.g AND f.pos = p.pos
LEFT JOIN proofs x ON x.g = p.g AND x.pos = p.pos, (SELECT v FROM high WHERE n = 1) r
"""

ORACLES["op13_filter_audit"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * list_unique(ws) < 65 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN known USING (doc_id)
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT x AS filter_order FROM letters
  UNION ALL
  SELECT filter_order || x FROM o, letters WHERE NOT contains(filter_order, x)
), steps AS (
  SELECT filter_order, i AS step, filter_order[i] AS x, filter_order[:i - 1] AS earlier FROM o, range(1, 6) r(i) WHERE length(filter_order) = 5
), s AS (
  SELECT part, filter_order, step, x, n, good, toxic, fails = x AS alone, contains(fails, x) AS failing,
    length(translate(fails, earlier, '')) < length(fails) AS gone
  FROM c, steps
), counted AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, x,
    sum(n) FILTER (NOT gone AND NOT failing) AS kept, sum(n) FILTER (NOT gone AND failing) AS removed, sum(n) FILTER (gone AND failing) AS redundant,
    sum(n) FILTER (alone) AS unique_fails, sum(good) FILTER (NOT gone AND failing) AS good_lost, sum(toxic) FILTER (NOT gone AND failing) AS toxic_lost
  FROM s GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, step, """ + ", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in (
    "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "sum(removed) OVER (PARTITION BY part, x)")).replace(
    "AS sum(removed) OVER (PARTITION BY part, x)", "AS shapley") + "\nFROM counted\n"
