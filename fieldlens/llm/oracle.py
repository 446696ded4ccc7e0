"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

# words of a text: A-Z lower-cased, everything else in ASCII but 0-9 a-z separates
_WORDS = r"""regexp_extract_all(
  translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def words(t: str) -> str:
    return _WORDS.format(t=t)


def license_sql() -> str:
    from fieldlens.llm.license_scan import COVER, SLACK, gram_positions

    rows = ",".join("({t},'{label}',{base},{tpos},{grams},'{gram}')".format(**r) for r in gram_positions())
    return f"""
WITH t(t, label, base, tpos, grams, gram) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, {words('text')} AS w FROM documents),
g AS (SELECT r, p, array_to_string(w[p:p + 2], ' ') AS gram
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM d)),
v AS (SELECT DISTINCT r, t, label, base, grams, p - 1 - tpos AS at_, p, tpos FROM g JOIN t USING (gram)),
o AS (SELECT r, t, label, base, grams, at_, count(*) = grams AND base AS is_base FROM v GROUP BY r, t, label, base, grams, at_),
n AS (SELECT o.*, list({{'p': v.p::BIGINT, 't': v.tpos::BIGINT, 'n': 0::BIGINT}} ORDER BY v.p, v.tpos) AS hits
  FROM o JOIN v ON v.r = o.r AND v.t = o.t AND v.at_ BETWEEN o.at_ - {SLACK} AND o.at_ + {SLACK} GROUP BY ALL),
m AS (SELECT *, list_reduce([{{'p': -1::BIGINT, 't': -1::BIGINT, 'n': 0::BIGINT}}] || hits, lambda a, x:
    CASE WHEN x.p > a.p AND x.t > a.t THEN {{'p': x.p, 't': x.t, 'n': a.n + 1}} ELSE a END).n::DOUBLE / grams AS cover
  FROM n),
f AS (SELECT r, count(*) FILTER (is_base) AS n_base, min(at_) FILTER (is_base) AS first_word,
  max(at_) FILTER (is_base) AS last_word, max(cover) AS score,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base OR (NOT base AND cover >= {COVER})) AS labels
  FROM m GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN f USING (r)
"""


def line_dedup_sql() -> str:
    from fieldlens.llm.line_dedup import MIN_SITES, MIN_WORDS, WORD

    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
l AS (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) AS p FROM d),
z AS (SELECT count(*) AS k, sum(n) / count(*) / sum(sum(n)) OVER () AS p
  FROM (SELECT count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source) GROUP BY length(bin(n))),
c AS (SELECT trim(line) AS k, min(doc_id) AS first, count(DISTINCT source) AS sites,
  count(DISTINCT r) FILTER (source IS NOT NULL) AS n FROM l
  WHERE len(regexp_extract_all(trim(line), '{WORD}')) >= {MIN_WORDS} GROUP BY 1
  HAVING count(DISTINCT source) >= {MIN_SITES}),
b AS (SELECT k, first FROM c WHERE sites >= round((SELECT sum(z.k * (1 - pow(1 - p, n)))
  - 2 * sqrt(sum(z.k * pow(1 - p, n) * (1 - pow(1 - p, n)))) FROM z), 6)),
j AS (SELECT l.*, b.k IS NOT NULL AND l.doc_id IS DISTINCT FROM b.first AS cut FROM l LEFT JOIN b ON trim(line) = b.k),
s AS (SELECT r, count(*) FILTER (cut) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT cut), '') AS kept FROM j GROUP BY r)
SELECT doc_id, coalesce(n_removed, 0) AS n_removed, strlen(kept) AS n_bytes, sha256(kept) AS kept_sha256
FROM d LEFT JOIN s USING (r)
"""


ORACLE: dict[str, str] = {"op3_license_scan": license_sql(), "op4_line_dedup": line_dedup_sql()}

ORACLE["op7_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words('text')} AS w FROM documents),
i AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS id, {words('text')} AS w FROM benchmark),
win AS (SELECT id, len(w) AS n, array_to_string(w, ' ') AS g FROM i WHERE len(w) BETWEEN 1 AND 9
  UNION ALL
  SELECT id, 10, array_to_string(w[p:p + 9], ' ')
  FROM (SELECT id, w, unnest(range(1, len(w) - 8)) AS p FROM i WHERE len(w) >= 10)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes)),
hit AS (SELECT DISTINCT r, n, p, id FROM grams JOIN win USING (n, g)),
pos AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r),
ids AS (SELECT r, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS s
  FROM hit WHERE id IS NOT NULL GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN ids USING (r)
"""

ORACLE["op8_topk"] = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
c AS (SELECT r, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM e),
bad AS (SELECT DISTINCT r FROM c WHERE x IS NULL OR NOT isfinite(x)),
v AS (SELECT r, vec_id, i, CAST(floor(256 * x) AS BIGINT) AS x FROM c WHERE r NOT IN (SELECT r FROM bad)),
q AS (SELECT * FROM v WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, v.r, CAST(sum(q.x * v.x) AS BIGINT) AS score
  FROM q JOIN v ON q.i = v.i AND q.vec_id <> v.vec_id GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5
"""

# code points are DuckDB's characters; the cuts come from the id's sha256
ORACLE["op12_fim"] = """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
g AS (SELECT *, ('0x' || substr(d, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(d, 9, 8))::BIGINT % (n + 1) AS c2,
  ('0x' || substr(d, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(d, 25, 8))::BIGINT % 100 AS h4 FROM h),
f AS (SELECT doc_id, t, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
       WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
         ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

# crc32 bit by bit over the id's digits, Merkle levels by recursion
ORACLE["op11_merkle"] = """
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS r, *, CAST(doc_id AS VARCHAR) AS k FROM documents),
c AS (SELECT r, xor(list_reduce([4294967295] || list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT)),
    lambda a, x: list_reduce([xor(a, x)] || [0, 0, 0, 0, 0, 0, 0, 0],
      lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)), 4294967295) % 7 = 0 AS tampered FROM d),
f AS (SELECT r, doc_id, lang, tampered, n_chars, coalesce(strlen(k) || ':' || k, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail FROM d JOIN c USING (r)),
l AS (SELECT r, doc_id, coalesce('=' || lang, '') AS g,
    sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(CAST(n_chars + CAST(coalesce(tampered, FALSE) AS INT) AS VARCHAR)) || ':'
      || CAST(n_chars + CAST(coalesce(tampered, FALSE) AS INT) AS VARCHAR), '-') || tail) AS seen FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
  count(*) OVER (PARTITION BY g) AS n FROM l),
t(g, lev, pos, n, h) AS (
  SELECT g, 0, pos, n, leaf FROM p
  UNION ALL
  SELECT g, lev + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1
  GROUP BY g, lev, pos // 2, n),
s AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(lev, pos, n, h) AS (
  SELECT 0, pos, n, subroot FROM s
  UNION ALL
  SELECT lev + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1
  GROUP BY lev, pos // 2, n),
steps AS (
  SELECT p.r, t.lev AS lev, CASE (p.pos >> t.lev) % 2 WHEN 1 THEN 'L' ELSE 'R' END AS side, b.h
  FROM p JOIN t ON t.g = p.g AND t.pos = p.pos >> t.lev AND t.n > 1
  LEFT JOIN t b ON b.g = t.g AND b.lev = t.lev AND b.pos = xor(t.pos, 1)
  UNION ALL
  SELECT p.r, 1000 + u.lev, CASE (s.pos >> u.lev) % 2 WHEN 1 THEN 'L' ELSE 'R' END, b.h
  FROM p JOIN s USING (g) JOIN u ON u.pos = s.pos >> u.lev AND u.n > 1
  LEFT JOIN u b ON b.lev = u.lev AND b.pos = xor(u.pos, 1)),
paths AS (SELECT r, list(side || coalesce(h, '') ORDER BY lev) AS path, string_agg(coalesce(h, ''), '' ORDER BY lev) AS proof
  FROM steps GROUP BY r),
z AS (SELECT doc_id, leaf, subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
  list_reduce([seen] || coalesce(path, []), lambda a, x: CASE WHEN x[1] = 'L' THEN sha256(x[2:] || a) ELSE sha256(a || x[2:]) END)
    AS folded_root FROM p JOIN s USING (g) LEFT JOIN paths USING (r))
SELECT *, folded_root = root AS verified FROM z
"""
