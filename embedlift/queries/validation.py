"""Validation, reconciliation, distances and search on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.functions.vectors import METRICS, vector_distance, vector_distance_arrow
from embedlift.operators import validate as D
from embedlift.operators.search import rank_topk, recall_at_k, search
from embedlift.queries import query
from embedlift.queries.tables import (CENTROID_SQL, COSINE_SQL, SRC_SQL, TGT_SQL, centroids, source_records, table,
                                      target_records)

SIDES = f"WITH {SRC_SQL},\n{TGT_SQL}"
PAIRS_SQL = f"""{SIDES},
pairs AS (
  SELECT s.id, t.id IS NOT NULL AS found, s.lang AS s_lang, t.lang AS t_lang, s.vec AS a, t.vec AS b
  FROM src s LEFT JOIN tgt t ON s.id = t.id),
sims AS (SELECT *, {COSINE_SQL} AS sim FROM pairs)"""
SUMMARY_SQL = """SELECT count(*) AS total_records, count(*) FILTER (WHERE coalesce(sim >= 0.98, false)) AS valid_records,
  count(*) FILTER (WHERE NOT coalesce(sim >= 0.98, false)) AS invalid_records,
  round(avg(sim), 6) AS avg_similarity, round(min(sim), 6) AS min_similarity, round(max(sim), 6) AS max_similarity FROM sims"""


def _rounded(summary):
    return summary.select("total_records", "valid_records", "invalid_records",
                          *[F.round(c, 6).alias(c) for c in ("avg_similarity", "min_similarity", "max_similarity")])


def _pairs(spark, sf, **options):
    return D.with_similarity(D.pair_records(source_records(spark, sf), target_records(spark, sf), **options))


@query("collection_stats", """
SELECT count(*) AS total_records, max(len(embedding)) AS dimensions, 'flat' AS index_type,
       round(count(*) * max(len(embedding)) * 4 / 1048576.0, 6) AS est_vector_mb FROM embeddings""")
def stats_of_embeddings(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return D.collection_stats(rows, "flat").withColumn("est_vector_mb", F.round("est_vector_mb", 6))


@query("cosine_pairs", f"{PAIRS_SQL}\nSELECT id, found, round(sim, 6) AS similarity FROM sims")
def cosine_pairs(spark, sf):
    return _pairs(spark, sf).select("id", "found", F.round("similarity", 6).alias("similarity"))


@query("validation_summary", f"{PAIRS_SQL}\n{SUMMARY_SQL}")
def summary_of_all(spark, sf):
    summary, _ = D.validate_migration(source_records(spark, sf), target_records(spark, sf), sample_rate=None)
    return _rounded(summary)


@query("validate_migration_sampled", f"""{PAIRS_SQL.replace('sims AS', 'all_sims AS')},
sims AS (SELECT * FROM all_sims WHERE ('0x' || substr(md5(id), 1, 15))::BIGINT < {int(0.1 * (1 << 60))})
{SUMMARY_SQL}""")
def summary_of_sample(spark, sf):
    summary, _ = D.validate_migration(source_records(spark, sf), target_records(spark, sf), sample_rate=0.1)
    return _rounded(summary)


@query("validate_migration_sample_size", f"""{PAIRS_SQL.replace('sims AS', 'all_sims AS')},
sims AS (SELECT * FROM all_sims ORDER BY ('0x' || substr(md5(id), 1, 15))::BIGINT, id LIMIT 100)
{SUMMARY_SQL}""")
def summary_of_fixed_sample(spark, sf):
    summary, _ = D.validate_migration(source_records(spark, sf), target_records(spark, sf), sample_rate=None, sample_size=100)
    return _rounded(summary)


@query("validation_errors", f"""{PAIRS_SQL}
SELECT id AS record_id, CASE WHEN found THEN 'vector' ELSE 'id' END AS field,
       CASE WHEN NOT found THEN 'Record missing in target' ELSE 'Cosine similarity below threshold' END AS message
FROM sims WHERE NOT found OR sim < 0.98
UNION ALL SELECT id, 'lang', 'Metadata value differs' FROM sims WHERE found AND s_lang <> t_lang""")
def errors_of_all(spark, sf):
    return D.validate_migration(source_records(spark, sf), target_records(spark, sf), sample_rate=None,
                                fields=["lang", "source"])[1]


@query("validate_all_fields", f"""{PAIRS_SQL}
SELECT id AS record_id, CASE WHEN found THEN 'vector' ELSE 'id' END AS field,
       CASE WHEN NOT found THEN 'Record missing in target' ELSE 'Cosine similarity below threshold' END AS message
FROM sims WHERE NOT found OR sim < 0.98
UNION ALL SELECT s.id, f.field, 'Metadata value differs' FROM src s JOIN tgt t ON s.id = t.id, LATERAL (VALUES
  ('lang', s.lang IS DISTINCT FROM t.lang), ('source', s.source IS DISTINCT FROM t.source), ('label', s.label IS DISTINCT FROM t.label),
  ('text', s.text IS DISTINCT FROM t.text), ('n_chars', s.n_chars IS DISTINCT FROM t.n_chars)) AS f(field, differs) WHERE f.differs""")
def errors_of_all_fields(spark, sf):
    """Without a list of fields every metadata field is compared."""
    return D.validate_migration(source_records(spark, sf), target_records(spark, sf), sample_rate=None)[1]


@query("reconcile_copies", """
WITH o AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_linenumber = 1) AS ones FROM lineitem GROUP BY 1)
SELECT CAST(l_orderkey AS VARCHAR) AS id, CASE WHEN ones > 0 AND l_orderkey % 10 = 0 AND n = ones THEN 'missing_in_target'
  WHEN ones > 0 AND l_orderkey % 10 IN (0, 1) THEN 'changed' ELSE 'matched' END AS status FROM o""")
def reconcile_copies(spark, sf):
    """Line items by order: an order has many; some lose their first lines in the target, some have them twice."""
    rows = table(spark, sf, "lineitem").withColumn("id", F.col("l_orderkey").cast("string"))
    first, last = F.col("l_linenumber") == 1, F.col("l_orderkey") % 10
    target = rows.filter(~(first & (last == 0))).unionByName(rows.filter(first & (last == 1)))
    content = F.xxhash64("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return D.reconcile(rows, target, content).select("id", "status")


RECONCILE_SQL = f"""{SIDES},
both_sides AS (
  SELECT coalesce(s.id, t.id) AS id,
         CASE WHEN t.id IS NULL THEN 'missing_in_target' WHEN s.id IS NULL THEN 'extra_in_target'
              WHEN s.vec = t.vec AND s.lang IS NOT DISTINCT FROM t.lang THEN 'matched' ELSE 'changed' END AS status
  FROM src s FULL JOIN tgt t ON s.id = t.id)"""


@query("reconcile_status", f"{RECONCILE_SQL}\nSELECT id, status FROM both_sides")
def reconcile_all(spark, sf):
    return D.reconcile(source_records(spark, sf), target_records(spark, sf)).select("id", "status")


@query("missing_ids", f"""{RECONCILE_SQL}
SELECT id, CASE WHEN status = 'missing_in_target' THEN 'source' ELSE 'target' END AS side
FROM both_sides WHERE status IN ('missing_in_target', 'extra_in_target')""")
def ids_on_one_side(spark, sf):
    return D.missing_ids(source_records(spark, sf), target_records(spark, sf))


@query("metadata_completeness", f"""{SIDES},
pairs AS (SELECT s.lang AS s_lang, t.lang AS t_lang, s.source AS s_source, t.source AS t_source, s.text AS s_text, t.text AS t_text
          FROM src s JOIN tgt t ON s.id = t.id)
SELECT 'lang' AS field, count(*) AS in_source, count(*) AS in_target,
       count(*) FILTER (WHERE s_lang IS NOT DISTINCT FROM t_lang) AS equal, 0 AS missing FROM pairs
UNION ALL SELECT 'source', count(*), count(*), count(*) FILTER (WHERE s_source IS NOT DISTINCT FROM t_source), 0 FROM pairs
UNION ALL SELECT 'text', count(*), count(*), count(*) FILTER (WHERE s_text IS NOT DISTINCT FROM t_text), 0 FROM pairs""")
def completeness(spark, sf):
    pairs = D.pair_records(source_records(spark, sf), target_records(spark, sf))
    return D.metadata_completeness(pairs, ["lang", "source", "text"])


@query("content_checksum", f"""WITH {SRC_SQL}
SELECT label, count(*) AS n_records, CAST(sum(('0x' || substr(md5(id || '|' || coalesce(lang, '') || '|' || coalesce(text, '') || '|'
       || array_to_string(list_transform(vec, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',')), 1, 8))::BIGINT)
       AS BIGINT) AS checksum FROM src GROUP BY label""")
def checksum_by_label(spark, sf):
    numbers = F.array_join(F.transform("vector", lambda x: F.round(x.cast("double") * 1000000).cast("bigint").cast("string")), ",")
    text = lambda f: F.coalesce(V.field(F.col("metadata"), f, "string"), F.lit(""))
    digest = F.md5(F.concat_ws("|", "id", text("lang"), text("text"), numbers))
    row_hash = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    label = V.field(F.col("metadata"), "label", "int").alias("label")
    return D.content_checksum(source_records(spark, sf), [label], row_hash).withColumn(
        "checksum", F.col("checksum").cast("bigint"))


@query("validation_report", f"""{PAIRS_SQL}, summary AS ({SUMMARY_SQL}), {RECONCILE_SQL[RECONCILE_SQL.index('both_sides AS'):]}
SELECT total_records, valid_records, min_similarity, 'lang' AS first_field,
       (SELECT count(*) FROM both_sides WHERE status = 'matched') AS matched,
       (SELECT count(*) FROM both_sides WHERE status = 'changed') AS changed FROM summary""")
def report(spark, sf):
    source, target = source_records(spark, sf), target_records(spark, sf)
    pairs = D.with_similarity(D.pair_records(source, target))
    made = D.validation_report(D.validation_summary(pairs), D.metadata_completeness(pairs, ["lang", "source"]),
                               D.reconcile(source, target))
    get = lambda path, kind: F.get_json_object("report", path).cast(kind)
    return made.select(
        get("$.summary.total_records", "bigint").alias("total_records"),
        get("$.summary.valid_records", "bigint").alias("valid_records"),
        F.round(get("$.summary.min_similarity", "double"), 6).alias("min_similarity"),
        get("$.fields[0].field", "string").alias("first_field"),
        get("$.reconciliation.matched", "bigint").alias("matched"), get("$.reconciliation.changed", "bigint").alias("changed"))


@query("rollback_alert", f"""{PAIRS_SQL}, by_lang AS (
  SELECT coalesce(s_lang, 'none') AS lang, count(*) AS n, count(*) FILTER (WHERE NOT coalesce(sim >= 0.98, false)) AS bad,
         min(sim) AS low FROM sims GROUP BY 1)
SELECT lang, CASE WHEN low < 0.98 THEN 'min similarity below threshold' ELSE 'failure rate too high' END AS reason,
       round(low, 6) AS min_similarity, round(bad / n, 6) AS failure_rate FROM by_lang WHERE low < 0.98 OR bad / n > 0.01""")
def alert_by_language(spark, sf):
    pairs = _pairs(spark, sf).withColumn("lang", F.coalesce(V.field(F.col("source_metadata"), "lang", "string"), F.lit("none")))
    valid = F.coalesce(F.col("similarity") >= 0.98, F.lit(False))
    summary = pairs.groupBy("lang").agg(F.count(F.lit(1)).alias("total_records"), F.count_if(~valid).alias("invalid_records"),
                                        F.min("similarity").alias("min_similarity"))
    return D.rollback_alert(summary, keys=("lang",)).select(
        "lang", "reason", F.round("min_similarity", 6).alias("min_similarity"), F.round("failure_rate", 6).alias("failure_rate"))


# -- distances -------------------------------------------------------------
_A, _B = "CAST(s.vec AS DOUBLE[])", "CAST(t.vec AS DOUBLE[])"
_DISTANCE_SQL = {
    "cosine": COSINE_SQL.replace("len(a)", "len(s.vec)").replace("len(b)", "len(t.vec)").replace("(a ", "(s.vec ").replace("(b ", "(t.vec "),
    "dot": f"list_inner_product({_A}, {_B})",
    "euclidean": f"list_distance({_A}, {_B})",
    "l2-squared": f"pow(list_distance({_A}, {_B}), 2)",
    "manhattan": f"list_sum(list_transform(list_zip({_A}, {_B}), lambda p: abs(p[1] - p[2])))",
    "hamming": f"CAST(len(list_filter(list_zip({_A}, {_B}), lambda p: p[1] <> p[2])) AS DOUBLE)",
}


def _distance_query(metric: str) -> None:
    name = f"distance_{metric.replace('-', '_')}"

    @query(name, f"{SIDES}\nSELECT s.id, round({_DISTANCE_SQL[metric]}, 5) AS arrow_value, "
                 f"round({_DISTANCE_SQL[metric]}, 5) AS value FROM src s JOIN tgt t ON s.id = t.id")
    def run(spark, sf):
        pairs = D.pair_records(source_records(spark, sf), target_records(spark, sf)).filter("found")
        a, b = F.col("source_vector"), F.col("target_vector")
        return pairs.select("id", F.round(vector_distance_arrow(a, b, metric), 5).alias("arrow_value"),
                            F.round(vector_distance(a, b, metric), 5).alias("value"))


for _metric in METRICS:
    _distance_query(_metric)


# -- search ----------------------------------------------------------------
def _hits_sql(name: str, rows: str, condition: str = "true") -> str:
    return f"""{name} AS (
  SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) AS rank FROM (
    SELECT query_id, id, {COSINE_SQL.replace('CAST(a AS', 'CAST(q AS').replace('CAST(b AS', 'CAST(vec AS').replace('len(a)', 'len(q)').replace('len(b)', 'len(vec)')} AS score
    FROM cent, {rows} WHERE {condition})
  QUALIFY rank <= 10)"""


@query("vector_search_topk", f"""WITH {SRC_SQL}, {CENTROID_SQL}, {_hits_sql('hits', 'src')}
SELECT query_id, id, rank, round(score, 6) AS score FROM hits""")
def search_by_centroid(spark, sf):
    return search(centroids(spark, sf), source_records(spark, sf), 10).select(
        "query_id", "id", "rank", F.round("score", 6).alias("score"))


@query("vector_search_blocks", f"""WITH {SRC_SQL}, {CENTROID_SQL}, {_hits_sql('hits', 'src')}
SELECT query_id, id, rank, round(score, 6) AS score FROM hits""")
def search_by_blocks(spark, sf):
    return search(centroids(spark, sf), source_records(spark, sf), 10, broadcast_bytes=0).select(
        "query_id", "id", "rank", F.round("score", 6).alias("score"))


@query("vector_search_filtered", f"""WITH {SRC_SQL}, {CENTROID_SQL}, {_hits_sql('hits', 'src', "lang = 'en'")}
SELECT query_id, id, rank, round(score, 6) AS score FROM hits WHERE rank > 5""")
def search_with_filter(spark, sf):
    return search(centroids(spark, sf), source_records(spark, sf), 5, offset=5, conditions=[("lang", "eq", "en")]).select(
        "query_id", "id", "rank", F.round("score", 6).alias("score"))


@query("search_mixed_dimensions", f"""WITH {SRC_SQL}, {CENTROID_SQL}, {_hits_sql('hits', 'src')}
SELECT query_id, id, rank, round(score, 6) AS score FROM hits""")
def search_mixed(spark, sf):
    """A longer query that no record can match takes nothing away from the others."""
    asked = centroids(spark, sf).select(F.col("query_id").cast("string").alias("query_id"), "vector")
    longer = asked.limit(1).select(F.lit("longer").alias("query_id"), F.concat("vector", "vector").alias("vector"))
    return search(asked.unionByName(longer), source_records(spark, sf), 10).select("query_id", "id", "rank", F.round("score", 6).alias("score"))


@query("recall_at_10", f"""{SIDES}, {CENTROID_SQL}, {_hits_sql('s_hits', 'src')}, {_hits_sql('t_hits', 'tgt')}
SELECT s.query_id, count(t.id) AS common, round(count(t.id) / least(count(*), 10), 4) AS recall
FROM s_hits s LEFT JOIN t_hits t ON s.query_id = t.query_id AND s.id = t.id GROUP BY s.query_id""")
def recall(spark, sf):
    asked = centroids(spark, sf)
    found = recall_at_k(search(asked, source_records(spark, sf), 10), search(asked, target_records(spark, sf), 10), 10)
    return found.select("query_id", "common", F.round("recall", 4).alias("recall"))


@query("rank_topk", """
SELECT o_orderpriority AS query_id, CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS score,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, CAST(o_orderkey AS VARCHAR)) AS rank
FROM orders QUALIFY rank <= 10""")
def top_orders(spark, sf):
    hits = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("query_id"), F.col("o_orderkey").cast("string").alias("id"),
                                             F.col("o_totalprice").alias("score"))
    return rank_topk(hits, 10).select("query_id", "id", "score", "rank")
