"""SQL checks for the queries that SQL can express."""

from __future__ import annotations


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd rounds one by one; every assignment looks at all entries."""
    assigned = """
a{r} AS MATERIALIZED (
  SELECT row_id, p, any_value(x) AS x, min({{'d': d, 'e': e}}) AS best FROM (
    SELECT w.row_id, w.p, w.x, c.e,
      list_sum(list_transform(range(1, len(w.x) + 1), lambda i: (w.x[i] - c.x[i]) * (w.x[i] - c.x[i])))::BIGINT AS d
    FROM parts w JOIN c{r} c ON w.p = c.p) GROUP BY row_id, p)"""
    moved = """
s{r} AS MATERIALIZED (
  SELECT p, best.e AS e, i, sum(x[i]) AS s, count(*) AS n FROM a{r}, range(1, 1 + (SELECT any_value(len(x)) FROM parts)) t(i) GROUP BY ALL),
c{next} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT p, e, list((s // n - CASE WHEN s < 0 AND s % n <> 0 THEN 1 ELSE 0 END)::BIGINT ORDER BY i) AS x FROM s{r} GROUP BY p, e
  ) m ON c.p = m.p AND c.e = m.e)"""
    steps = []
    for r in range(rounds + 1):
        steps.append(assigned.format(r=r))
        if r < rounds:
            steps.append(moved.format(r=r, next=r + 1))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS MATERIALIZED (
  SELECT row_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) t(p)),
c0 AS MATERIALIZED (
  SELECT w.p, f.e, w.x FROM parts w JOIN (SELECT row_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}) f ON w.row_id = f.row_id),
{",".join(steps)},
coded AS (
  SELECT row_id, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY row_id)
SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256
FROM kept k JOIN coded c ON k.row_id = c.row_id
"""


def chat_format(marks: str) -> str:
    """Conversations and one that says ``marks``; lengths count the escapes."""
    escaped = lambda c, more: f"regexp_replace({c}, '\\\\|###|</turn>|<\\|{more}', '\\\\\\0', 'g')"
    return f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{marks}' UNION ALL SELECT -7, 1, 'assistant', '{marks}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### : </turn>' || chr(10)) + length({escaped('role', '|:')}) + length({escaped('text', '')}))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""


def substring_dedup(window: int = 20) -> str:
    """Windows of words by their text; the first of equal ones stays."""
    return f"""
WITH split AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
windows AS MATERIALIZED (
  SELECT row_id, doc_id, i, array_to_string(words[i : i + {window - 1}], ' ') AS said
  FROM (SELECT *, unnest(range(1, len(words) - {window - 2})) AS i FROM split)),
firsts AS (SELECT said, min({{'doc_id': doc_id, 'i': i}}) AS place FROM windows GROUP BY said HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT row_id, i + unnest(range({window})) AS i FROM windows w JOIN firsts f ON w.said = f.said
  WHERE {{'doc_id': doc_id, 'i': i}} > place),
numbered AS (SELECT row_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split),
kept AS (
  SELECT row_id, string_agg(word, ' ' ORDER BY i) AS said, count(*) AS n
  FROM numbered ANTI JOIN gone USING (row_id, i) GROUP BY row_id)
SELECT s.doc_id, len(s.words)::BIGINT AS n_words, (len(s.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.said, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (row_id)
"""


def suffix_array_dedup(length: int = 400) -> str:
    """Strings of bytes by a digest; all that occur twice go, as runs that meet."""
    return f"""
WITH bytes AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (
  SELECT row_id, s // 2 AS base, substr(h, s + 1, {4 * length}) AS h
  FROM (SELECT row_id, h, unnest(range(0, length(h), {2 * length})) AS s FROM bytes)),
starts AS MATERIALIZED (
  SELECT row_id, base + i AS i, md5_number(substr(h, 2 * i + 1, {2 * length})) AS name
  FROM (SELECT *, unnest(range(0, least({length}, length(h) // 2 - {length - 1}))) AS i FROM pieces)),
repeated AS (SELECT row_id, i FROM starts SEMI JOIN (SELECT name FROM starts GROUP BY name HAVING count(*) > 1) USING (name)),
runs AS (
  SELECT row_id, min(i) AS a, max(i) + {length} AS b FROM (
    SELECT *, sum(CASE WHEN i > before + {length} THEN 1 ELSE 0 END) OVER (PARTITION BY row_id ORDER BY i) AS run
    FROM (SELECT *, lag(i, 1, i) OVER (PARTITION BY row_id ORDER BY i) AS before FROM repeated))
  GROUP BY row_id, run),
ends AS (
  SELECT row_id, a, b, lag(b, 1, 0) OVER (PARTITION BY row_id ORDER BY a) AS since,
    row_number() OVER (PARTITION BY row_id ORDER BY a DESC) = 1 AS last FROM runs),
cut AS (
  SELECT row_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed,
    string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) || any_value(substr(h, 2 * b + 1)) FILTER (last) AS kept
  FROM ends JOIN bytes USING (row_id) GROUP BY row_id)
SELECT y.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM bytes y LEFT JOIN cut USING (row_id)
"""


def spelling_variants(length: int = 5, least: int = 3, one_of: int = 97, times: int = 2) -> str:
    """Words that are one edit apart by what is left of them without one character."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    polynomial = 0xEDB88320
    return f"""
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {polynomial}) ELSE c >> 1 END)) AS crc),
runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT run, times, xor(list_reduce(list_concat([{0xFFFFFFFF}::BIGINT],
      list_transform(range(0, length(h), 2), lambda i: ('0x' || substr(h, i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])), {0xFFFFFFFF}) AS crc
  FROM (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs), bits),
words AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN crc % {one_of} = 0
      THEN substr(run, 1, (crc % length(run))::INTEGER) || substr(run, (crc % length(run))::INTEGER + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= {length} GROUP BY word HAVING sum(times) >= {least}),
rests AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
shorter AS (SELECT DISTINCT r.word AS a, w.word AS b, r.n AS a_n, w.n AS b_n FROM rests r JOIN words w ON r.rest = w.word),
near AS MATERIALIZED (
  SELECT a, b, b_n FROM shorter UNION ALL SELECT b, a, a_n FROM shorter UNION ALL
  SELECT r.word, s.word, s.n FROM rests r JOIN rests s ON r.i = s.i AND r.rest = s.rest AND r.word <> s.word),
best AS (SELECT a AS word, count(*) AS n_near, min({{'less': -b_n, 'form': b}}) AS best FROM near GROUP BY a),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= {times} * n THEN best.form END AS form,
    CASE WHEN -best.less >= {times} * n THEN -best.less END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
followed AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT f.word, f.next, g.form FROM followed f JOIN formed g ON f.next = g.word WHERE f.next IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN followed r ON f.word = r.word AND r.next IS NULL
"""
