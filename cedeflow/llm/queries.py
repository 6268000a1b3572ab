"""One query for each operator over its whole table, and SQL for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cedeflow.llm import (
    covering_simhash,
    digest_index,
    fill_middle,
    fuzzy_lines,
    grid_order_join,
    html_density,
    license_scan,
    ordinal_toxicity,
    pfair_mix,
    robust_quality,
    suffix_pieces,
    url_rules,
    va_clusters,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.main_texts(_table(spark, sf_dir, "pages"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = pfair_mix.mixed(_table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mix.select("row.doc_id", "row.source", "block", "slot", "position")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels")
    return url_rules.url_verdicts(pages, labels)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_rows(_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fuzzy_lines.deduplicated(_table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "text", "n_lines", "n_dropped")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covering_simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_quality.quality_verdicts(_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_index.exact_duplicates(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return ordinal_toxicity.graded(docs, ordinal_toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_pieces.round_trips(_table(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = va_clusters.clustered(_table(spark, sf_dir, "embeddings"))
    numbers = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return rows.withColumn("centroid_sha256", F.sha2(numbers, 256)).drop("centroid")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    text = fill_middle.restored(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_order_join.linked_vectors(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_source_mixing": op2_source_mixing,
    "op3_url_filter": op3_url_filter,
    "op4_license_scan": op4_license_scan,
    "op5_line_dedup": op5_line_dedup,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Fixed rules by their length, then rules by counting every set of tokens.
_URL_SQL = f"""
    WITH parsed AS (
        SELECT page_id, coalesce(url, '') AS url,
               translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                         '{_UPPER}', '{_UPPER.lower()}') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM pages),
    tokened AS (
        SELECT page_id, host, path, CASE WHEN host = '' THEN [] ELSE list_sort(list_distinct(list_filter(
            list_concat(
                ['scheme:' || lower(regexp_extract(url, '^(\\w+)://', 1)),
                 'site:' || regexp_extract(host, '([^.]+\\.[^.]+)$', 1),
                 'host:' || host,
                 'first:' || regexp_extract(host, '^([^.]+)', 1),
                 'dir:' || regexp_extract(path, '^/([^/0-9]+)/', 1),
                 'ending:' || regexp_extract(path, '\\.([A-Za-z]+)$', 1),
                 CASE WHEN contains(url, '#') THEN 'has:fragment' ELSE ':' END],
                list_transform(string_split(regexp_extract(url, '(?s)\\?([^#]*)', 1), '&'),
                               lambda k: 'key:' || split_part(k, '=', 1))),
            lambda t: NOT suffix(t, ':')))) END AS tokens,
            try_cast(regexp_extract(path, '/(\\d{{1,18}})(?:\\.[A-Za-z]+)?/?$', 1) AS BIGINT) AS number
        FROM parsed),
    known AS (
        SELECT doc_id, bool_or(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS bad
        FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
    one AS (SELECT page_id, unnest(tokens) AS t FROM tokened),
    sets AS (
        SELECT page_id, [t] AS tokens FROM one
        UNION ALL
        SELECT a.page_id, [a.t, b.t] FROM one a JOIN one b ON a.page_id = b.page_id AND a.t < b.t
        UNION ALL
        SELECT a.page_id, [a.t, b.t, c.t] FROM one a JOIN one b ON a.page_id = b.page_id AND a.t < b.t
        JOIN one c ON c.page_id = a.page_id AND b.t < c.t),
    labelled AS (
        SELECT page_id, bad FROM tokened JOIN known ON number = doc_id WHERE len(tokens) > 0),
    good AS (
        SELECT tokens, sum(bad::INT) / count(*) AS confidence FROM sets JOIN labelled USING (page_id)
        GROUP BY tokens
        HAVING sum(bad::INT) >= greatest(20, ceil(0.002 * (SELECT count(*) FROM labelled)))
           AND sum(bad::INT) / count(*) >= 0.5),
    rules AS (
        SELECT * FROM good g WHERE NOT EXISTS (
            SELECT 1 FROM good h WHERE len(h.tokens) < len(g.tokens) AND list_has_all(g.tokens, h.tokens))),
    held AS (
        SELECT page_id, max({{'c': confidence, 'r': array_to_string(tokens, ' ')}}).r AS mined
        FROM sets JOIN rules USING (tokens) GROUP BY page_id),
    ruled AS (
        SELECT *, CASE
            WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND prefix(path, '/en/1')
                THEN 'example.org/en/1'
            WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND prefix(path, '/es/')
                THEN 'example.org/es/'
            WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/fr/') THEN 'com/fr/'
            WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/de/') THEN 'com/de/'
            WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/') THEN 'org/'
            END AS rule
        FROM tokened)
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN mined IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
           CASE WHEN rule IS NULL THEN mined END AS mined_rule
    FROM ruled LEFT JOIN held USING (page_id)
"""



def _assigned_sql(number: int) -> str:
    """Every vector's nearest centroid of one round, as ``best`` with its distance."""
    return f"""a{number} AS MATERIALIZED (
        SELECT vec_id, any_value(q.v) AS v, min({{'d': list_sum(list_transform(list_zip(q.v, c.v),
               lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'c': c.c}}) AS best
        FROM q, c{number} c GROUP BY vec_id)"""


def _moved_sql(number: int) -> str:
    """The centroids after a round; one without vectors stays."""
    return f"""c{number + 1} AS MATERIALIZED (
        SELECT c.c, coalesce(m.v, c.v) AS v FROM c{number} c LEFT JOIN (
            SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
                SELECT best.c AS c, i, sum(v[i])::BIGINT AS s, count(*) AS n
                FROM a{number}, unnest(range(1, 65)) AS u(i) GROUP BY best.c, i)
            GROUP BY c) m ON m.c = c.c)"""


_CLUSTER_ROUNDS = ",\n".join(f"{_assigned_sql(i)},\n{_moved_sql(i)}" for i in range(5))
_CLUSTER_SQL = f"""
    WITH q AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE len(embedding) = 64
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v
        FROM q ORDER BY sha256('2:' || vec_id) LIMIT 40),
    {_CLUSTER_ROUNDS},
    {_assigned_sql(5)}
    SELECT a.vec_id, a.best.c::INTEGER AS cluster, a.best.d::BIGINT AS distance,
           (sum(a.best.d) OVER (PARTITION BY a.best.c))::BIGINT AS cluster_inertia,
           (sum(a.best.d) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM a5 a JOIN c5 c ON c.c = a.best.c
"""

_MIDDLE_SQL = """
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
               regexp_extract_all(coalesce(text, ''),
                   '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units
        FROM documents),
    drawn AS (
        SELECT *, len(units) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
               ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4
        FROM cut),
    formed AS (
        SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                         OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                       WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
               least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high
        FROM drawn),
    parted AS (
        SELECT *, array_to_string(list_slice(units, 1, low), '') AS p,
               array_to_string(list_slice(units, low + 1, high), '') AS m,
               array_to_string(list_slice(units, high + 1, n), '') AS s
        FROM formed)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                  ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parted
"""

_VECTOR_LINKS_SQL = """
    WITH RECURSIVE unit AS (
        SELECT vec_id, label, len(embedding) AS dim, embedding::DOUBLE[] AS v,
               sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
          ON a.label = b.label AND a.dim = b.dim AND a.vec_id <> b.vec_id
        WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
    reach AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings
        UNION
        SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
    counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM least LEFT JOIN counts USING (vec_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op3_url_filter": _URL_SQL,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_centroid_clustering": _CLUSTER_SQL,
    "op12_fill_in_middle": _MIDDLE_SQL,
    "op13_embedding_near_dedup": _VECTOR_LINKS_SQL,
}
