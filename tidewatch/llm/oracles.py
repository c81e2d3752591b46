"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

# Union of the spans of repeats of k words or more = words in k-word windows found twice;
# a repeat longer than m words exists exactly if an (m + 1)-word window is found twice.
SQL["op8_quality_rules"] = r"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^ \t\n\x0B\f\r]+') AS ws FROM base),
pos AS (
  SELECT rid, unnest(range(1, len(ws) + 1)) AS i, ws FROM w),
win AS (
  SELECT rid, i, k, list_slice(ws, i, i + k - 1) AS g
  FROM pos, (VALUES (3), (8), (101)) AS s(k) WHERE i + k - 1 <= len(ws)),
rep AS (
  SELECT rid, i, k FROM (SELECT rid, i, k, count(*) OVER (PARTITION BY rid, k, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT rid, k, count(DISTINCT p) AS n FROM (SELECT rid, k, unnest(range(i, i + k)) AS p FROM rep) GROUP BY rid, k),
lines AS (
  SELECT rid, line FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM base)
  WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]')),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(c3.n, 0)::BIGINT AS n_repeat_words, coalesce(c8.n, 0)::BIGINT AS covered_words,
    coalesce(cm.n, 0) > 0 AS too_long
  FROM w LEFT JOIN dup USING (rid)
  LEFT JOIN cov c3 ON c3.rid = w.rid AND c3.k = 3
  LEFT JOIN cov c8 ON c8.rid = w.rid AND c8.k = 8
  LEFT JOIN cov cm ON cm.rid = w.rid AND cm.k = 101)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
   AND NOT (covered_words > 0.25 * n_words OR too_long)) AS kept
FROM m
"""

# Five-word shingles of lower-cased word runs; a shorter text is one shingle, and documents are also cut into windows of
# the widths of shorter items.
SQL["op9_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS ws FROM documents),
b AS (SELECT row_number() OVER () AS iid, item_id, ws FROM (
  SELECT DISTINCT item_id, text, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS ws FROM benchmark)),
ds AS (SELECT DISTINCT rid, doc_id, g FROM (
  SELECT rid, doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: list_slice(ws, i, i + 4)) END) AS g FROM d
  UNION ALL SELECT rid, doc_id, unnest(list_transform(range(1, len(ws) - w + 2), lambda i: list_slice(ws, i, i + w - 1))) AS g
  FROM d, (SELECT DISTINCT len(ws) AS w FROM b WHERE len(ws) BETWEEN 1 AND 4) WHERE len(d.ws) > w)),
bs AS (SELECT DISTINCT iid, item_id, g FROM (
  SELECT iid, item_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: list_slice(ws, i, i + 4)) END) AS g FROM b)),
n AS (SELECT iid, count(*) AS n_item FROM bs GROUP BY iid),
hit AS (SELECT rid, any_value(doc_id) AS doc_id, iid, any_value(item_id) AS item_id, count(*) AS n_shared
  FROM ds JOIN bs USING (g) GROUP BY rid, iid)
SELECT doc_id, item_id, n_shared::BIGINT AS n_shared, n_item::BIGINT AS n_item, n_shared / n_item AS containment
FROM hit JOIN n USING (iid) WHERE n_shared >= 0.8 * n_item
"""

# formatted_chars: per turn "### " role ": " text " </turn>\n"; a text that holds a control string or reads
# as escaped is lengthened by the weakest escape that keeps it (ends only, else everything).
SQL["op1_chat_formatting"] = r"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (SELECT *,
    CASE WHEN role IN ('system', 'user', 'assistant') THEN role ELSE '=' || upper(hex(encode(role))) END AS shown,
    regexp_matches(t, '### (System|User|Assistant|=[0-9A-F]*): ') OR contains(t, '##\# ') OR contains(t, '<\/turn>') OR contains(t, '\\') AS strong,
    contains(t, '</turn>') AS ends FROM src),
r AS (SELECT *, length(shown) + 15 + length(t) + CASE
    WHEN strong THEN length(t) - length(replace(t, '\', ''))
      + (length(t) - length(replace(t, '</turn>', ''))) // 7 + (length(t) - length(replace(t, '### ', ''))) // 4
    WHEN ends THEN (length(t) - length(replace(t, '</turn>', ''))) // 7 ELSE 0 END AS shown_chars FROM f)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(shown_chars)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""

SQL["op3_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""


def _code_rounds(parts: int, entries: int, scale: int, rounds: int) -> str:
    """Plain assignment and means, round by round, over (row, part) pairs."""
    w = f"(len(v) // {parts})"
    steps = [f"""
WITH k AS (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT rid, part, list_slice(v, part * {w} + 1, (part + 1) * {w}) AS x FROM k, range({parts}) AS r(part)),
f AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM k),
c0 AS (SELECT part, entry, x AS c FROM p JOIN f USING (rid) WHERE entry < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (SELECT rid, part, any_value(x) AS x, min(struct_pack(d := list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := entry)) AS m
  FROM p JOIN c{r} USING (part) GROUP BY rid, part)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (SELECT part, entry, i, sum(y) AS s, count(*) AS n FROM (
    SELECT part, m.e AS entry, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS y FROM a{r}) GROUP BY part, entry, i),
m{r} AS (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{r} GROUP BY part, entry),
c{r + 1} AS (SELECT c{r}.part, c{r}.entry, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (part, entry))""")
    return ",".join(steps)


SQL["op11_vector_codes"] = _code_rounds(16, 64, 256, 2) + """,
h AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256 FROM (
  SELECT part, entry, unnest(range(1, len(c) + 1)) AS i, unnest(c) AS y FROM c2)),
o AS (SELECT rid, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a2 GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM k JOIN o USING (rid), h
"""

# Edits row by row: the cheapest way into each state of the role sequence (0 nothing yet, 1 after system, 2 after
# user, 3 after assistant), ties by the least audit, with up to two inserts before a row; all other ways into the state
# are dropped after each row.  DuckDB has no crc32, so the byte table is made first.
SQL["op12_conversation_repair"] = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), b)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
src AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_transform(string_split(k, ''), lambda x: ord(x)::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS kind FROM keyed, tab),
dam AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM src WHERE kind <> 0),
num AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id) AS ck,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen, left(role, 1) AS ini FROM dam),
fault AS (
  SELECT *, CASE WHEN seen = '' THEN 'b' WHEN row_number() OVER (PARTITION BY ck, role, text ORDER BY i) > 1 THEN 'd'
      WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS f,
    lag(ini) OVER (PARTITION BY ck ORDER BY i) AS before FROM num),
sizes AS (SELECT ck, any_value(conv_id) AS conv_id, max(i) AS n FROM num GROUP BY ck),
path AS (
  SELECT ck, 0::BIGINT AS i, 0 AS st, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM sizes
  UNION ALL
  SELECT ck, i, st, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY ck, st ORDER BY cost, audit) AS rank FROM (
      SELECT ck, r_i AS i, CASE op WHEN 'D' THEN pre WHEN 'K' THEN CASE ini WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
          ELSE CASE WHEN pre = 2 THEN 3 ELSE 2 END END AS st,
        cost + CASE op WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN op <> 'D' AND f = 't' THEN 5 ELSE 0 END AS cost,
        audit || op AS audit,
        CASE op WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
          ELSE list_append(lines, CASE WHEN pre = 2 THEN 'assistant:' ELSE 'user:' END || text) END AS lines
      FROM (
        SELECT p.ck, r.i AS r_i, r.ini, r.f, r.role, r.text, ins.n,
          CASE ins.n WHEN 0 THEN p.st WHEN 1 THEN CASE WHEN p.st = 2 THEN 3 ELSE 2 END ELSE CASE WHEN p.st = 2 THEN 2 ELSE 3 END END AS pre,
          p.cost + 5 * ins.n AS cost, p.audit || repeat('I', ins.n) AS audit,
          list_concat(p.lines, CASE WHEN p.st = 2 THEN ['assistant:', 'user:'][1:ins.n] ELSE ['user:', 'assistant:'][1:ins.n] END) AS lines
        FROM path p JOIN fault r ON r.ck = p.ck AND r.i = p.i + 1, (VALUES (0), (1), (2)) AS ins(n)) w,
        (VALUES ('D'), ('K'), ('R')) AS ops(op)
      WHERE op = 'D' OR f NOT IN ('b', 'd') AND (op = 'R' OR ini = 's' AND pre = 0 OR ini = 'u' AND pre <> 2 OR ini = 'a' AND pre = 2)))
  WHERE rank = 1),
ended AS (
  SELECT ck, cost + 5 * n AS cost, audit || repeat('I', n) AS audit,
    list_concat(lines, CASE WHEN st = 2 THEN ['assistant:'] ELSE ['user:', 'assistant:'][1:n] END) AS lines
  FROM (SELECT p.*, CASE p.st WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS n FROM path p JOIN sizes s ON s.ck = p.ck AND s.n = p.i)),
best AS (SELECT * FROM ended QUALIFY row_number() OVER (PARTITION BY ck ORDER BY cost, audit) = 1),
facts AS (
  SELECT ck, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank,
    count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
    count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM fault GROUP BY ck),
done AS (SELECT s.conv_id, facts.*, cost, audit, sha256(array_to_string(lines, chr(10))) AS sha
  FROM sizes s JOIN facts USING (ck) JOIN best USING (ck))
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done ON o.conv_id IS NOT DISTINCT FROM done.conv_id
"""
