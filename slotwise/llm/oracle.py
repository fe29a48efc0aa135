"""DuckDB statements of the operators that SQL can express."""

from __future__ import annotations

#: Words of a text, for use inside the statements.
WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

OP4 = f"""
WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
starts AS (
  SELECT doc_id, unnest(range(1, len(words) - 11)) AS i, words FROM w WHERE len(words) >= 13
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS win FROM starts
), marked AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY win) AS lo FROM windows) WHERE doc_id > lo
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM marked
), each AS (
  SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM w
), kept AS (
  SELECT e.doc_id, count(*) AS n, string_agg(e.word, ' ' ORDER BY e.i) AS kept
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP10 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS g
  FROM w
), e AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM s),
often AS (SELECT gram, row_number() OVER () AS id FROM (SELECT gram FROM e GROUP BY gram HAVING count(*) > 1)),
t AS MATERIALIZED (SELECT doc_id, n, id FROM e JOIN often USING (gram)),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM t a JOIN t b ON a.id = b.id AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT doc_id AS node, doc_id AS low FROM s
  UNION
  SELECT p.b, r.low FROM reach r JOIN pairs p ON p.a = r.node
)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, l.low AS component_id
FROM s JOIN (SELECT node, min(low) AS low FROM reach GROUP BY node) l ON l.node = s.doc_id
"""

#: Integers per row, part and place; one round assigns and then moves the used entries.
_NEAR = """
SELECT rid, part, min([d, entry]) AS best FROM (
  SELECT x.rid, x.part, e.entry, CAST(sum((x.q - e.c) * (x.q - e.c)) AS BIGINT) AS d
  FROM x JOIN {book} e USING (part, place) GROUP BY x.rid, x.part, e.entry
) GROUP BY rid, part
"""
_MOVED = """
SELECT part, entry, place, coalesce(m.c, e.c) AS c FROM {book} e LEFT JOIN (
  SELECT part, entry, place, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS c FROM (
    SELECT x.part, a.best[2] AS entry, x.place, CAST(sum(x.q) AS BIGINT) AS s, count(*) AS n
    FROM x JOIN {near} a USING (rid, part) GROUP BY x.part, a.best[2], x.place)
) m USING (part, entry, place)
"""

OP13 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), flat AS (
  SELECT rid, len(embedding) // 16 AS size, unnest(range(0, len(embedding))) AS i, unnest(embedding) AS v FROM kept
), x AS MATERIALIZED (
  SELECT rid, i // size AS part, i % size AS place, CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT) AS q FROM flat
), b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, place, q AS c FROM x WHERE rid <= 64),
a0 AS MATERIALIZED ({_NEAR.format(book="b0")}),
b1 AS MATERIALIZED ({_MOVED.format(book="b0", near="a0")}),
a1 AS MATERIALIZED ({_NEAR.format(book="b1")}),
b2 AS MATERIALIZED ({_MOVED.format(book="b1", near="a1")}),
a2 AS MATERIALIZED ({_NEAR.format(book="b2")}),
coded AS (
  SELECT rid, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a2 GROUP BY rid
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) FROM b2) AS codebooks_sha256
FROM kept JOIN coded USING (rid)
"""

def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"


#: crc32 of a decimal number: a shift register over its digits' bits, lowest first.
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: list_transform(range(8), lambda k: CAST((ascii(c) >> k) & 1 AS BIGINT))))),
  lambda r, bit: xor(r >> 1, 3988292384 * (xor(r, bit) & 1))), 4294967295)"""


def _levels(name: str, base: str) -> str:
    """Recursive levels of the trees in ``base`` (tree, place, n, h); n counts the level's nodes."""
    return f"""{name} AS (
  SELECT 0 AS level, tree, place, h, n FROM {base}
  UNION ALL
  SELECT level + 1, tree, place // 3, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY level, tree, place // 3
)"""


OP12 = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, source, source AS tree, {_leaf("text")} AS h,
    {_leaf("replace(text, chr(10), '')")} AS other, coalesce({_CRC} % 2 = 0, false) AS tampered FROM documents
), numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), {_levels("nodes", "numbered")},
subroots AS MATERIALIZED (
  SELECT tree AS source, h AS subroot, h, 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1
), {_levels("top", "subroots")},
climb AS (
  SELECT doc_id, source, tree, h AS leaf, if(tampered, other, h) AS folded, place, n, 0 AS level, '' AS proof FROM numbered
  UNION ALL
  SELECT c.doc_id, c.source, c.tree, c.leaf, sha256(string_agg(if(s.place = c.place, c.folded, s.h), '' ORDER BY s.place)), c.place // 3,
    (any_value(c.n) + 2) // 3, c.level + 1, c.proof || coalesce(string_agg(s.h, '' ORDER BY s.place) FILTER (s.place <> c.place), '')
  FROM climb c JOIN nodes s ON s.tree IS NOT DISTINCT FROM c.tree AND s.level = c.level AND s.place // 3 = c.place // 3 WHERE c.n > 1
  GROUP BY c.doc_id, c.source, c.tree, c.leaf, c.folded, c.place, c.level, c.proof
), met AS MATERIALIZED (
  SELECT c.doc_id, c.leaf, s.subroot, c.folded, s.place, s.n, c.proof FROM climb c JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source WHERE c.n = 1
), finish AS (
  SELECT *, 0 AS level FROM met
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, sha256(string_agg(if(s.place = c.place, c.folded, s.h), '' ORDER BY s.place)), c.place // 3,
    (any_value(c.n) + 2) // 3, c.proof || coalesce(string_agg(s.h, '' ORDER BY s.place) FILTER (s.place <> c.place), ''), c.level + 1
  FROM finish c JOIN top s ON s.level = c.level AND s.place // 3 = c.place // 3 WHERE c.n > 1
  GROUP BY c.doc_id, c.leaf, c.subroot, c.folded, c.place, c.proof, c.level
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM finish, (SELECT h AS root FROM top WHERE n = 1) WHERE n = 1
"""


def oracle_queries() -> dict[str, str]:
    return {"op1_exact_topk": OP1, "op4_substring_dedup": OP4, "op10_ngram_join": OP10, "op12_merkle_manifest": OP12, "op13_vector_codes": OP13}
