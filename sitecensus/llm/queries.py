"""The queries of this package, each over a whole table, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, filter_audit, html_extract, jaccard_join, license_scan, mixing, packing, quality, secret_scan, topk_search, toxicity, url_filter, vector_codes
from .common import table


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op2_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_cover_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_count_vector_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.schedule(docs, mixing.target_weights(docs))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_subset_zeta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_exponion_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents")).drop("blob")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return own | {"pipeline": corpus_pipeline.run}


OP4_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/7') THEN 'example.com/en/7'
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/de/8') THEN 'example.net/de/8'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/en/') THEN 'com/en/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/de/') THEN 'net/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/es/') THEN 'org/es/' END AS rule
  FROM split
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""

OP5_SQL = """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM fine q JOIN fine c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP7_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingled AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM worded
), sets AS (
  SELECT s, min(doc_id) AS node, len(s) AS n FROM shingled WHERE len(s) > 0 GROUP BY s
), items AS (
  SELECT node, n, unnest(s) AS shingle FROM sets
), met AS (
  SELECT x.node AS a, y.node AS b, count(*) AS common, any_value(x.n + y.n) AS total FROM items x JOIN items y ON x.shingle = y.shingle AND x.node <> y.node GROUP BY x.node, y.node
), links AS (
  SELECT a, b FROM met WHERE 100 * common >= 80 * (total - common)
), reached AS (
  SELECT node, node AS other FROM sets UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other
), components AS (
  SELECT s.s, min(r.other) AS component_id FROM reached r JOIN sets s ON s.node = r.node GROUP BY s.s
)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id FROM shingled d LEFT JOIN components c ON c.s = d.s
"""

OP10_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id, count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

OP11_SQL = r"""
WITH worded AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), known AS (
  SELECT doc_id, coalesce(max((quality = 1)::INTEGER), 0) AS good, coalesce(max((toxic = 1)::INTEGER), 0) AS toxic FROM labels GROUP BY doc_id
), masked AS (
  SELECT part, doc_id, (len(w) < 50)::INTEGER + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INTEGER
    + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t))::INTEGER + 8 * regexp_matches(t, '[#$%&*|]')::INTEGER
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INTEGER AS mask
  FROM worded
), counted AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM masked LEFT JOIN known USING (doc_id) GROUP BY part, mask
), letters(l, bit) AS (
  VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step])::INTEGER AS after FROM orders, range(1, 6) s(step)
), told AS (
  SELECT part, filter_order, step::INTEGER AS step, bit,
         coalesce(sum(n) FILTER (mask & after = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & (after - bit) = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & (after - bit) <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & (after - bit) = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & (after - bit) = 0), 0)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, bit
)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM told
"""


def _op12_round(number: int) -> str:
    """Assignment to the codebooks c<number>, and the codebooks that follow from it."""
    means = ", ".join(f"floor(sum(x[{i}]) / count(*))::BIGINT" for i in range(1, 5))
    return f"""a{number} AS MATERIALIZED (
  SELECT vec_id, q, min({{'d': (x[1] - y[1]) ** 2 + (x[2] - y[2]) ** 2 + (x[3] - y[3]) ** 2 + (x[4] - y[4]) ** 2, 'e': e}}) AS best
  FROM cut JOIN c{number} USING (q) GROUP BY vec_id, q
), c{number + 1} AS MATERIALIZED (
  SELECT c.q, c.e, coalesce(m.y, c.y) AS y FROM c{number} c LEFT JOIN (
    SELECT q, best.e AS e, [{means}] AS y FROM a{number} JOIN cut USING (vec_id, q) GROUP BY q, best.e) m ON m.q = c.q AND m.e = c.e
)"""


OP12_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT vec_id, label, q, v[4 * q + 1 : 4 * q + 4] AS x FROM kept, range(0, 16) s(q)
), c0 AS MATERIALIZED (
  SELECT q, (row_number() OVER (PARTITION BY q ORDER BY vec_id) - 1)::INTEGER AS e, x AS y FROM cut QUALIFY e < 64
), {_op12_round(0)}, {_op12_round(1)}, {_op12_round(2)}, told AS (
  SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY q) AS code, sum(best.d)::BIGINT AS error FROM a2 GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(y[1] || ',' || y[2] || ',' || y[3] || ',' || y[4], ',' ORDER BY q, e)) AS codebooks_sha256 FROM c2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM told JOIN kept USING (vec_id), books
"""


def _op13_kind(number: int, rule: secret_scan.Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    value = f"regexp_extract(m, '{pattern}', {rule.group})" if rule.group else "m"
    return f"""SELECT doc_id, {number} AS rank, '{rule.kind}' AS kind, begins + length(m) AS finish, begins AS start FROM (
  SELECT doc_id, f[i] AS m, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS begins
  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS f, string_split_regex(t, '{pattern}') AS g FROM texts), unnest(range(1, len(f) + 1)) u(i)
) WHERE length({value}) >= {rule.least}"""


#: Of all kinds, base ones first.
OP13_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), spans AS (
  {" UNION ALL ".join(_op13_kind(i, r) for i, r in enumerate(secret_scan.RULES))}
), told AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN told USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_url_cascade": OP4_SQL,
        "op5_cover_tree_topk": OP5_SQL,
        "op7_count_vector_jaccard": OP7_SQL,
        "op10_exact_dedup": OP10_SQL,
        "op11_subset_zeta": OP11_SQL,
        "op12_exponion_codes": OP12_SQL,
        "op13_blob_ledger": OP13_SQL,
    }
