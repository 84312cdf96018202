"""Queries of the training-data operators, over the whole given tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from relcast.llm import cuckoo, embeddings, licenses, merkle, minhash, mixing, packing, phrases, pii, quality, secrets, suffix, warc
from relcast.llm.common import table


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_salvage_warc": _over("pages", warc.op1_query),
    "op2_compression_bands": _over("documents", quality.op2_query),
    "op3_variable_best_fit": _over("documents", packing.pack_documents),
    "op4_window_entropy": _over("documents", secrets.op4_query),
    "op5_diagonal_voting": _over("documents", licenses.op5_query),
    "op6_circulant_minhash": _over("documents", minhash.op6_query),
    "op7_pivot_permutation": _over("embeddings", embeddings.op7_query),
    "op8_anchor_expansion": _over("documents", pii.op8_query),
    "op9_longest_previous_factor": _over("documents", suffix.op9_query),
    "op10_pivotal_mixing": _over("documents", mixing.op10_query),
    "op11_midstate_tree": _over("documents", merkle.op11_query),
    "op12_cuckoo_index": _over("documents", cuckoo.op12_query),
    "op13_son_partitioning": _over("documents", phrases.op13_query),
}

def _license_rows() -> str:
    """The phrases and templates as SQL rows (fixed values only; the rules are spelled out below)."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = [(f"base:{label}:{i}", text, "2") for i, (text, label) in enumerate(licenses.PHRASES)]
    rows += [(f"text:{label}", text, "3") for label, text in licenses.TEMPLATES]
    return ", ".join(f"({quoted(n)}, {quoted(x)}, {k})" for n, x, k in rows)


def _merkle_levels(nodes: str, key: str, name: str, levels: int) -> str:
    """CTEs of the levels over ``nodes`` (key, pos, d, n): a node alone passes on, others become the hash of their run of 16."""
    out, below = "", nodes
    for k in range(1, levels + 1):
        out += f"""{name}{k} AS (SELECT {key}, pos // 16 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d, any_value((n + 15) // 16) AS n
FROM {below} GROUP BY {key}, pos // 16),
"""
        below = f"{name}{k}"
    return out


def _merkle_climb(below: str, key: str, name: str, climb: str, first: str, levels: int) -> str:
    """CTEs that take the rows of ``first`` (r, key, pos, sibs, d) up the levels: siblings are added, the digest is hashed among them."""
    out = ""
    for k in range(levels):
        level = below if k == 0 else f"{name}{k}"
        out += f"""{climb}{k + 1} AS (SELECT r, {key}, p // 16 AS pos, sibs || CASE WHEN n = 1 THEN '' ELSE l || x END AS sibs, CASE WHEN n = 1 THEN d ELSE sha256(l || d || x) END AS d
FROM (SELECT c.r, c.{key}, c.pos AS p, any_value(c.sibs) AS sibs, any_value(c.d) AS d, any_value(t.n) AS n,
             coalesce(string_agg(t.d, '' ORDER BY t.pos) FILTER (t.pos < c.pos), '') AS l, coalesce(string_agg(t.d, '' ORDER BY t.pos) FILTER (t.pos > c.pos), '') AS x
      FROM {first if k == 0 else f"{climb}{k}"} c JOIN {level} t ON t.{key} = c.{key} AND t.pos // 16 = c.pos // 16 GROUP BY c.r, c.{key}, c.pos)),
"""
    return out


def _merkle_leaf(text: str) -> str:
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Levels of the SQL's trees: 16 ** 6 leaves a source, 16 ** 4 sources.
_LEAF_LEVELS, _SOURCE_LEVELS = 6, 4

#: CRC-32 in SQL: bit by bit over the digits of the id.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, b:
  list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295::BIGINT)"""

_LICENSE_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES: dict[str, str] = {
    "op5_diagonal_voting": f"""
WITH templates(name, text, k) AS (VALUES {_license_rows()}),
tw AS (SELECT name, k, {_LICENSE_WORDS} AS w FROM templates),
tg AS (SELECT name, k, t, len(w) - k + 1 AS grams, CASE WHEN len(w) <= 12 THEN len(w) - k + 1 ELSE ceil(0.6 * (len(w) - k + 1)) END AS need,
              array_to_string(w[t + 1:t + k], ' ') AS g
       FROM (SELECT name, k, w, unnest(range(0, len(w) - k + 1)) AS t FROM tw)),
dw AS (SELECT row_number() OVER () AS r, doc_id, {_LICENSE_WORDS} AS w FROM documents),
places AS (SELECT r, w, unnest(range(0, len(w))) AS p FROM dw),
dg AS (SELECT r, p, 2 AS k, array_to_string(w[p + 1:p + 2], ' ') AS g FROM places WHERE p + 2 <= len(w)
       UNION ALL SELECT r, p, 3, array_to_string(w[p + 1:p + 3], ' ') FROM places WHERE p + 3 <= len(w)),
hits AS (SELECT r, name, grams, need, t, p - t AS diagonal FROM dg JOIN tg ON dg.k = tg.k AND dg.g = tg.g),
lines AS (SELECT r, name, grams, need, diagonal, lag(diagonal) OVER (PARTITION BY r, name ORDER BY diagonal) AS before FROM (SELECT DISTINCT r, name, grams, need, diagonal FROM hits)),
runs AS (SELECT r, name, diagonal, sum(CASE WHEN need = grams OR before IS NULL OR diagonal - before > 4 THEN 1 ELSE 0 END) OVER (PARTITION BY r, name ORDER BY diagonal) AS run FROM lines),
spans AS (SELECT h.r, h.name, min(h.diagonal) AS start, count(DISTINCT h.t) / any_value(h.grams)::DOUBLE AS score
          FROM hits h JOIN runs u ON u.r = h.r AND u.name = h.name AND u.diagonal = h.diagonal
          GROUP BY h.r, h.name, u.run HAVING count(DISTINCT h.t) >= any_value(h.need)),
found AS (SELECT r, count(*) FILTER (name LIKE 'base:%') AS n_base, min(start) FILTER (name LIKE 'base:%') AS first_word, max(start) FILTER (name LIKE 'base:%') AS last_word,
                 string_agg(DISTINCT split_part(name, ':', 2), ',' ORDER BY split_part(name, ':', 2)) FILTER (name LIKE 'base:%') AS base_labels,
                 string_agg(DISTINCT split_part(name, ':', 2), ',' ORDER BY split_part(name, ':', 2)) AS labels, max(score) AS score
          FROM spans GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM dw LEFT JOIN found ON found.r = dw.r
""",
    "op9_longest_previous_factor": """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
strings AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS i FROM d WHERE len(x) >= 100)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM strings) WHERE first < doc_id),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b
  FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
        FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh FROM hit))
  GROUP BY doc_id, run),
parts AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
         list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends
  FROM runs GROUP BY doc_id)
SELECT d.doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN starts IS NULL THEN x ELSE list_aggregate(
         list_transform(range(0, len(starts) + 1), lambda k: substr(x, CASE WHEN k = 0 THEN 1 ELSE 2 * ends[k] + 1 END,
           CASE WHEN k = len(starts) THEN len(x) ELSE 2 * (starts[k + 1] - CASE WHEN k = 0 THEN 0 ELSE ends[k] END) END)), 'string_agg', '') END)) AS kept_sha256
FROM d LEFT JOIN parts USING (doc_id)
""",
    "op7_pivot_permutation": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_aggregate(list_transform(embedding, lambda x: abs(x)), 'max') > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
parts AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT p.vec_id, (SELECT count(*) FROM links WHERE links.a = p.vec_id) AS n_links, p.component_id, p.vec_id = p.component_id AS kept
FROM parts p
""",
    "op1_salvage_warc": """
SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN strlen(h) >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(h) >= 1000 AND last <> page_id THEN last END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
""",
    "op6_circulant_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, e.b FROM reach r JOIN sym e ON e.a = r.b),
parts AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(sizes.n, 0) AS n_shingles, parts.component_id, w.doc_id = parts.component_id AS kept
FROM w LEFT JOIN sizes ON sizes.doc_id = w.doc_id JOIN parts ON parts.doc_id = w.doc_id
""",
    "op11_midstate_tree": f"""
WITH d AS (SELECT row_number() OVER () AS r, *, CASE WHEN {_CRC32} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS given FROM documents),
leaves AS (SELECT r, doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS sid, {_merkle_leaf('text')} AS d, {_merkle_leaf('given')} AS g FROM d),
n0 AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY doc_id, d) - 1 AS pos, count(*) OVER (PARTITION BY sid) AS n FROM leaves),
{_merkle_levels('n0', 'sid', 'up', _LEAF_LEVELS)}s0 AS (SELECT 0 AS one, sid AS pos, d, count(*) OVER () AS n FROM up{_LEAF_LEVELS}),
{_merkle_levels('s0', 'one', 'top', _SOURCE_LEVELS)}c0 AS (SELECT r, sid, pos, '' AS sibs, g AS d FROM n0),
{_merkle_climb('n0', 'sid', 'up', 'c', 'c0', _LEAF_LEVELS)}e0 AS (SELECT r, 0 AS one, sid AS pos, sibs, d FROM c{_LEAF_LEVELS}),
{_merkle_climb('s0', 'one', 'top', 'e', 'e0', _SOURCE_LEVELS)}root AS (SELECT d AS root FROM top{_SOURCE_LEVELS})
SELECT n0.doc_id, n0.d AS leaf, s0.d AS subroot, root, sha256(e.sibs) AS proof_sha256, e.d AS folded_root, e.d = root AS verified
FROM n0 JOIN e{_SOURCE_LEVELS} e ON e.r = n0.r JOIN s0 ON s0.pos = n0.sid CROSS JOIN root
""",
    "op12_cuckoo_index": r"""
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY x) AS group_size, row_number() OVER w = 1 AS kept, sha256(x) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
WINDOW w AS (PARTITION BY x ORDER BY doc_id NULLS LAST)
""",
    "op13_son_partitioning": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0),
grams AS (SELECT lang, w[i:i + k - 1] AS g, k, count(*) AS a FROM places, range(1, 6) ks(k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
longer AS (SELECT lang, g[s:s + j - 1] AS g, max(a) AS a FROM grams, range(2, 5) js(j), range(1, 5) ss(s) WHERE j < k AND s + j - 1 <= k GROUP BY ALL),
cuts AS (SELECT c.lang, c.g, c.a, h.a AS l, t.a AS r, x.n, j, ((1000 * c.a::HUGEINT * x.n) // (h.a::HUGEINT * t.a))::BIGINT AS score
  FROM grams c JOIN range(1, 5) js(j) ON j < c.k JOIN grams h ON h.lang = c.lang AND h.g = c.g[:j] JOIN grams t ON t.lang = c.lang AND t.g = c.g[j + 1:] JOIN totals x ON x.lang = c.lang
  WHERE NOT EXISTS (SELECT 1 FROM longer b WHERE b.lang = c.lang AND b.g = c.g AND b.a >= c.a)),
best AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
""",
}
