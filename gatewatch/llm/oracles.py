"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from gatewatch.llm import conversation, line_dedup, mixing, sharding, vector_codes


def op2_sql(limit: int = sharding.SHARD_BYTES, depth: int = 24) -> str:
    """Every prefix of up to ``depth`` bits with its bytes; a row's shard is the shortest that
    fits (or has one row)."""
    return f"""
WITH d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes,
         lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT), 60, '0') AS bits
  FROM documents),
p AS (SELECT substr(bits, 1, k::INT) AS prefix, k, sum(n_bytes) AS b, count(*) AS n
      FROM d, range(0, {depth + 1}) t(k) GROUP BY ALL),
fit AS (SELECT prefix, k FROM p WHERE b <= {limit} OR n = 1)
SELECT d.doc_id, any_value(d.n_bytes) AS n_bytes, min_by(f.prefix, f.k) AS shard, min(f.k)::INT AS shard_depth
FROM d JOIN fit f ON substr(d.bits, 1, f.k::INT) = f.prefix GROUP BY d.doc_id"""


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, w[i:i + least(10, len(w)) - 1] AS ww
        FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM win),
cand AS (SELECT doc_id, ks.k, i, w[i:i + ks.k - 1] AS ww FROM d, ks, LATERAL (SELECT unnest(range(1, len(w) - ks.k + 2)) AS i) WHERE len(w) >= ks.k),
hit AS (SELECT c.doc_id, c.i, c.k, win.item_id FROM cand c JOIN win ON c.k = win.k AND c.ww = win.ww),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(pos.n_hit, 0)::BIGINT AS n_hit, coalesce(it.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(it.items, '')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN it ON d.doc_id = it.doc_id"""

_WS = r"[^\x20\x09-\x0D]+"

OP8 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WS}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM d, LATERAL (SELECT unnest(range(1, len(w) - 6)) AS i) WHERE len(w) >= 8),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM dup) GROUP BY doc_id),
lin AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{_WS}') GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
      FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN lin ON d.doc_id = lin.doc_id),
f AS (SELECT *, (n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
             + 8 * (word_chars < 2 * n_words)::INT + 16 * (word_chars > 15 * n_words)::INT
             + 32 * (10 * n_dup_lines > 3 * n_lines AND n_lines > 0)::INT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
       failed = 0 AS kept, failed::BIGINT AS failed_rules FROM f"""

OP9 = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WS}'))::BIGINT AS size,
                  (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|{mixing.SEED}'), 1, 12))::BIGINT::DOUBLE + 0.5) / {float(1 << 48)} AS u
           FROM documents),
q AS (SELECT doc_id, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
k AS (SELECT d.*, -ln(u) / CASE q WHEN 1 THEN {mixing.QUALITY[1]} WHEN 0 THEN {mixing.QUALITY[0]} ELSE {mixing.QUALITY[None]} END AS key
      FROM d LEFT JOIN q ON d.doc_id = q.doc_id),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w FROM k GROUP BY source),
r AS (SELECT *, 3 * source_size / w AS r FROM s),
l AS (SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS rate
      FROM r WINDOW b AS (ORDER BY r, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(3 * source_size::DOUBLE, (SELECT arg_min(rate, r) FROM l WHERE rate <= r) * w) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
x AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
             sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id) AS upto
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       ((epochs + CASE WHEN size > 0 AND upto - size / 2 <= rest AND epochs < 3 THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM x"""

OP10 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS s FROM p),
g AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(s, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest
      FROM h),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS best FROM g)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to FROM m"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP11 = f"""
WITH l AS (SELECT doc_id, i, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_BLANKS}) AS key
           FROM (SELECT doc_id, unnest(range(1, len(a) + 1)) AS i, unnest(a) AS line
                 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents))),
c AS (SELECT key FROM l WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS})
SELECT doc_id, count(*)::BIGINT AS n_lines, count(c.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN c ON l.key = c.key GROUP BY doc_id"""


def op12_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """Every round as two tables: the assignment of all parts, then the next codebooks. A
    squared distance times ``entries`` plus the entry's index orders entries with their ties."""
    part = f"v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})]"
    sql = f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, p, {part} AS s FROM k, range({parts}) t(p)),
seed AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS e, v FROM k ORDER BY vec_id LIMIT {entries}),
b0 AS MATERIALIZED (SELECT p, e, {part} AS c FROM seed, range({parts}) t(p))"""
    for n in range(rounds + 1):
        sql += f""",
a{n} AS MATERIALIZED (
  SELECT r, p, s, min(list_sum(list_transform(range(1, len(s) + 1), lambda i: (s[i] - c[i]) * (s[i] - c[i]))) * {entries} + e)::BIGINT AS m
  FROM x JOIN b{n} b USING (p) GROUP BY r, p, s)"""
        if n < rounds:
            sql += f""",
b{n + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(u.c, b.c) AS c FROM b{n} b LEFT JOIN (
    SELECT p, e, list(floor(t::DOUBLE / n)::BIGINT ORDER BY i) AS c FROM (
      SELECT p, m % {entries} AS e, i, sum(s[i]) AS t, count(*) AS n FROM a{n}, LATERAL (SELECT unnest(range(1, len(s) + 1)) AS i) GROUP BY ALL)
    GROUP BY p, e) u ON b.p = u.p AND b.e = u.e)"""
    return sql + f""",
f AS (SELECT r, string_agg('0' || substr('0123456789abcdef', (m % {entries})::INT + 1, 1), '' ORDER BY p) AS code,
             sum(m // {entries})::BIGINT AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM k JOIN f USING (r)"""


def op13_sql() -> str:
    """Row by row, the least (cost, edits) of every automaton state; up to two inserts may
    stand before a row and at the end."""
    c = conversation
    role = {q: to for q, (_, to) in c.WANTED.items()}
    inserts = [(q, q, 0, "") for q in range(4)] + [(q, role[q], c.INSERT, "I") for q in range(4)] + [(q, role[role[q]], 2 * c.INSERT, "II") for q in range(4)]
    edits = [(code, q, to, w, name) for (code, q), es in c.EDITS.items() if code for name, w, n, to in es if n]
    values = lambda rows: ", ".join(str(r) for r in rows)  # noqa: E731
    return rf"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 20 AS kind FROM t),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE kind <> 0),
o AS (SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
f AS (SELECT *, NOT regexp_matches(text, '{_WS}') AS blank, NOT regexp_matches(text, '[.!?][ 	-]*\z') AS cut FROM o),
g AS MATERIALIZED (
  SELECT *, CASE WHEN blank OR nth > 1 THEN '-' WHEN cut THEN upper(k) ELSE k END AS code
  FROM (SELECT *, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'x' END AS k FROM f)),
n AS MATERIALIZED (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE NOT blank AND nth > 1) AS duplicate, count(*) FILTER (WHERE NOT blank AND nth = 1 AND cut) AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND (before[1] || role[1]) NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id),
ins(q, q2, w, e) AS (VALUES {values(inserts)}),
ed(code, q, q2, w, e) AS (VALUES {values(edits)}),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0::BIGINT, 'audit': ''}} AS best FROM n
  UNION ALL
  SELECT dp.conv_id, dp.i + 1, ed.q2, min({{'cost': (dp.best.cost + ins.w + ed.w)::BIGINT, 'audit': dp.best.audit || ins.e || ed.e}})
  FROM dp JOIN g ON g.conv_id IS NOT DISTINCT FROM dp.conv_id AND g.i = dp.i + 1
  JOIN ins ON ins.q = dp.q JOIN ed ON ed.q = ins.q2 AND ed.code = g.code GROUP BY ALL),
done AS (
  SELECT dp.conv_id, min({{'cost': (dp.best.cost + ins.w)::BIGINT, 'audit': dp.best.audit || ins.e}}) AS best
  FROM dp JOIN n ON n.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = n.n JOIN ins ON ins.q = dp.q AND ins.q2 IN (0, 3) GROUP BY dp.conv_id),
a AS (SELECT conv_id, best.cost AS cost, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS j FROM done),
p AS (SELECT *, audit[j] AS e, count(*) FILTER (WHERE audit[j] <> 'I') OVER w AS i, count(*) FILTER (WHERE audit[j] <> 'D') OVER w AS place
      FROM a WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
r AS (SELECT p.conv_id, p.j, p.e, p.place, g.role, g.text, max(CASE WHEN p.place = 1 AND p.e = 'K' AND g.role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS s
      FROM p LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.i = p.i AND p.e <> 'I'),
z AS (SELECT conv_id, string_agg(CASE e WHEN 'K' THEN role ELSE CASE (place - s) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END
             || ':' || CASE e WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS out FROM r WHERE e <> 'D' GROUP BY conv_id),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, coalesce(n.gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0)::BIGINT AS blank, coalesce(n.duplicate, 0)::BIGINT AS duplicate,
       coalesce(n.truncated, 0)::BIGINT AS truncated, coalesce(n.illegal, 0)::BIGINT AS illegal, coalesce(done.best.cost, 0)::BIGINT AS cost,
       coalesce(done.best.audit, '') AS audit, sha256(coalesce(z.out, '')) AS repaired_sha256
FROM c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id"""


ORACLES = {
    "op2_sharding": op2_sql(),
    "op3_decontamination": OP3,
    "op8_quality_rules": OP8,
    "op9_source_mixing": OP9,
    "op10_warc": OP10,
    "op11_line_dedup": OP11,
    "op12_vector_codes": op12_sql(),
    "op13_conversation_repair": op13_sql(),
}
