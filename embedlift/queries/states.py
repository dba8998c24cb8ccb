"""Migration states and checkpoints on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from embedlift.functions.text import valid_database_type, valid_status
from embedlift.operators import state as S
from embedlift.operators.ordered import with_context
from embedlift.queries import query
from embedlift.queries.tables import (LATEST_CHECKPOINT_SQL, ORDER_CHECKPOINTS_SQL, ORDER_EVENTS_SQL, STATE_EVENTS_SQL,
                                      id_text, order_checkpoints, order_events, state_events, table)


@query("migration_latest_state", f"""WITH {STATE_EVENTS_SQL}
SELECT migration_id, arg_max(state, seq) AS state, min(ts) AS created_at, arg_max(ts, seq) AS updated_at
FROM state_events GROUP BY migration_id""")
def latest_states(spark, sf):
    return S.current_states(state_events(spark, sf)).drop("reason")


@query("get_state", f"""WITH {STATE_EVENTS_SQL},
latest_state AS (SELECT migration_id, arg_max(state, seq) AS state FROM state_events GROUP BY migration_id)
SELECT 'mig-' || c_custkey AS migration_id, coalesce(state, 'not_started') AS state
FROM customer LEFT JOIN latest_state ON 'mig-' || c_custkey = migration_id""")
def states_of_customers(spark, sf):
    ids = table(spark, sf, "customer").select(F.concat(F.lit("mig-"), F.col("c_custkey").cast("string")).alias("migration_id"))
    return S.get_state(ids, state_events(spark, sf))


@query("set_state", f"""WITH {STATE_EVENTS_SQL}, changed AS (
  SELECT migration_id, state, seq FROM state_events UNION ALL
  SELECT 'mig-' || c_custkey, 'rolled_back', 1000000000 + c_custkey FROM customer WHERE c_acctbal < 0)
SELECT migration_id, arg_max(state, seq) AS state FROM changed GROUP BY migration_id""")
def roll_back_poor_customers(spark, sf):
    poor = table(spark, sf, "customer").filter(F.col("c_acctbal") < 0).select(
        F.concat(F.lit("mig-"), F.col("c_custkey").cast("string")).alias("migration_id"),
        (F.col("c_custkey") + 1000000000).alias("seq"), F.lit("rolled_back").alias("state"),
        F.lit(None).cast("string").alias("reason"), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("ts"))
    return S.current_states(S.set_state(state_events(spark, sf), poor)).select("migration_id", "state")


@query("save_checkpoint", f"""WITH {ORDER_EVENTS_SQL}, {ORDER_CHECKPOINTS_SQL},
finished AS (SELECT migration_id, state FROM order_events WHERE state = 'completed')
SELECT migration_id, coalesce(state, 'in_progress') AS state FROM (
  SELECT migration_id FROM order_checkpoints UNION SELECT migration_id FROM finished) LEFT JOIN finished USING (migration_id)""")
def save_line_checkpoints(spark, sf):
    finished = order_events(spark, sf).filter(F.col("state") == "completed")
    new = order_checkpoints(spark, sf)
    events, _ = S.save_checkpoints(finished, new.limit(0), new)
    return S.current_states(events).select("migration_id", "state")


@query("latest_checkpoint", f"""WITH {ORDER_CHECKPOINTS_SQL}, {LATEST_CHECKPOINT_SQL}
SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS migration_id, seq, batch_no, last_processed_id, processed_count, checkpoint_at
FROM orders LEFT JOIN latest ON lpad(CAST(o_orderkey AS VARCHAR), 10, '0') = migration_id""")
def latest_line_checkpoints(spark, sf):
    ids = table(spark, sf, "orders").select(id_text("o_orderkey").alias("migration_id"))
    return S.get_checkpoint(ids, order_checkpoints(spark, sf)).select(
        "migration_id", "seq", "batch_no", "last_processed_id", "processed_count", "checkpoint_at")


@query("delete_checkpoint", f"""WITH {ORDER_CHECKPOINTS_SQL}, {LATEST_CHECKPOINT_SQL}
SELECT migration_id, seq FROM latest WHERE migration_id NOT IN (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') FROM orders WHERE o_orderstatus = 'F')""")
def delete_finished_checkpoints(spark, sf):
    done = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(id_text("o_orderkey").alias("migration_id"))
    rest = S.delete_checkpoints(order_checkpoints(spark, sf), done)
    return S.latest_checkpoints(rest).select("migration_id", "seq")


@query("purge_orphans", f"""WITH {ORDER_CHECKPOINTS_SQL}, {ORDER_EVENTS_SQL}
SELECT migration_id, seq, processed_count FROM order_checkpoints
WHERE migration_id IN (SELECT migration_id FROM order_events WHERE state <> 'failed')""")
def purge_failed(spark, sf):
    live = order_events(spark, sf).filter(F.col("state") != "failed")
    return S.purge_orphans(order_checkpoints(spark, sf), live).select("migration_id", "seq", "processed_count")


@query("migration_status", f"""WITH {ORDER_EVENTS_SQL}, {ORDER_CHECKPOINTS_SQL}, {LATEST_CHECKPOINT_SQL}
SELECT migration_id, state AS status, coalesce(total_records, 0) AS total_records,
       coalesce(processed_count, 0) AS migrated_records, coalesce(round(processed_count / total_records * 100, 4), 0) AS percentage,
       coalesce(batch_no, 0) AS batches_processed, coalesce(processed_count, 0) // 100 AS batches_est,
       strftime(started_at, '%Y-%m-%dT%H:%M:%SZ') AS started_at,
       CASE WHEN state IN ('completed', 'failed') THEN strftime(checkpoint_at, '%Y-%m-%dT%H:%M:%SZ') END AS ended_at
FROM order_events LEFT JOIN latest USING (migration_id)""")
def status_of_orders(spark, sf):
    ids = table(spark, sf, "orders").select(id_text("o_orderkey").alias("migration_id"))
    return S.migration_status(ids, order_events(spark, sf), order_checkpoints(spark, sf)).withColumn(
        "percentage", F.round("percentage", 4))


def _page_sql(where: str, order: str, limit: int, offset: int) -> str:
    return f"""WITH {ORDER_EVENTS_SQL}, {ORDER_CHECKPOINTS_SQL}, {LATEST_CHECKPOINT_SQL}
SELECT migration_id, state AS status, ts AS created_at, total_records AS progress_total, processed_count AS progress_current,
       round(processed_count / total_records * 100, 4) AS progress_percent,
       (SELECT count(*) FROM order_events WHERE {where}) AS total
FROM order_events LEFT JOIN latest USING (migration_id) WHERE {where} ORDER BY {order} LIMIT {limit} OFFSET {offset}"""


@query("list_migrations", _page_sql("true", "ts DESC, migration_id DESC", 50, 0))
def list_newest(spark, sf):
    return S.list_migrations(order_events(spark, sf), order_checkpoints(spark, sf)).withColumn(
        "progress_percent", F.round("progress_percent", 4))


@query("list_migrations_page", _page_sql("state = 'failed'", "migration_id", 100, 30))
def list_failed_page(spark, sf):
    return S.list_migrations(order_events(spark, sf), order_checkpoints(spark, sf), "FAILED", 100, 30, "migration_id",
                             "asc").withColumn("progress_percent", F.round("progress_percent", 4))


@query("migration_stats", f"""WITH {ORDER_CHECKPOINTS_SQL}
SELECT migration_id, max(total_records) AS total_records, max(processed_count) AS migrated_records,
       max(failed_count) AS failed_records, max(batch_no) AS batches_processed, min(started_at) AS start_time,
       max(checkpoint_at) AS end_time FROM order_checkpoints GROUP BY migration_id""")
def stats_of_orders(spark, sf):
    return S.migration_stats(order_checkpoints(spark, sf))


@query("transition_violations", f"""WITH {STATE_EVENTS_SQL}, moves AS (
  SELECT migration_id, seq, coalesce(lag(state) OVER (PARTITION BY migration_id ORDER BY seq), 'not_started') AS prev_state, state
  FROM state_events)
SELECT * FROM moves WHERE prev_state <> state AND (prev_state, state) NOT IN (
  ('not_started', 'in_progress'), ('in_progress', 'completed'), ('in_progress', 'failed'), ('in_progress', 'rolled_back'),
  ('failed', 'rolled_back'), ('completed', 'rolled_back'), ('failed', 'in_progress'), ('completed', 'not_started'),
  ('failed', 'not_started'), ('rolled_back', 'not_started'))""")
def violations(spark, sf):
    return S.transition_violations(state_events(spark, sf))


def progress_log(spark, sf):
    """Checkpoints of one migration per user, with running totals of records and the total to come."""
    ev = table(spark, sf, "events").select(
        F.concat(F.lit("mig-"), F.col("user_id").cast("string")).alias("migration_id"), F.col("event_id").alias("seq"),
        F.col("ts").alias("checkpoint_at"), F.ceil("value").cast("bigint").alias("records"))
    totals = ev.groupBy("migration_id").agg(F.sum("records").alias("total_records"))
    return with_context(ev, "migration_id", "seq", running={"processed_count": "records"}).join(totals, "migration_id")


@query("throughput_eta", """WITH p AS (
  SELECT 'mig-' || user_id AS migration_id, event_id AS seq, ts, CAST(ceil(value) AS BIGINT) AS records,
         sum(CAST(ceil(value) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id) AS processed_count,
         sum(CAST(ceil(value) AS BIGINT)) OVER (PARTITION BY user_id) AS total_records,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS step,
         epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY event_id) AS gap FROM events),
r AS (SELECT *, CASE WHEN gap > 0 THEN records / (gap / 1000000) END AS rate FROM p),
m AS (SELECT *, avg(rate) OVER (PARTITION BY migration_id ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS avg_rate FROM r)
SELECT migration_id, seq, step, CAST(processed_count AS BIGINT) AS processed_count, round(rate, 6) AS rate,
       round(avg_rate, 6) AS avg_rate,
       round(CASE WHEN avg_rate > 0 THEN (total_records - processed_count) / avg_rate END, 2) AS eta_seconds FROM m""")
def eta(spark, sf):
    return S.throughput_eta(progress_log(spark, sf)).select(
        "migration_id", "seq", "step", "processed_count", F.round("rate", 6).alias("rate"),
        F.round("avg_rate", 6).alias("avg_rate"), F.round("eta_seconds", 2).alias("eta_seconds"))


@query("valid_status", """
SELECT o_orderpriority AS status, count(*) AS n, false AS valid FROM orders GROUP BY 1
UNION ALL SELECT upper(CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in_progress' ELSE 'pending' END), count(*),
                 o_orderstatus IN ('F', 'O') FROM orders GROUP BY o_orderstatus""")
def check_statuses(spark, sf):
    o = table(spark, sf, "orders")
    named = F.upper(F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "in_progress")
                    .otherwise("pending"))
    words = o.select(F.explode(F.array("o_orderpriority", named)).alias("status"))
    return words.groupBy("status").agg(F.count(F.lit(1)).alias("n")).withColumn("valid", valid_status(F.col("status")))


@query("validate_database_type", """
SELECT p_partkey, p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4') AS in_cli, p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AS in_mapper
FROM part""")
def check_database_types(spark, sf):
    p = table(spark, sf, "part")
    number = F.expr("substring(p_brand, 7)")
    name = (F.when(number == "1", "pinecone").when(number == "2", "qdrant").when(number == "3", "weaviate")
            .when(number == "4", "milvus").otherwise(F.col("p_brand")))
    return p.select("p_partkey", valid_database_type(name).alias("in_cli"),
                    valid_database_type(name, ("pinecone", "qdrant", "weaviate")).alias("in_mapper"))
