"""Request log operators on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from embedlift.functions.text import (bearer_key, mask_api_key, mask_secret, parse_rfc3339, percentage, rfc3339,
                                      rpc_outcome, same_name)
from embedlift.operators.audit import audit_rollup, audit_windows, mask_audit
from embedlift.operators.ratelimit import rate_limit
from embedlift.queries import query
from embedlift.queries.tables import AUDIT_SQL, audit_log, table


def _rollup_sql(by: str) -> str:
    return f"""WITH {AUDIT_SQL}
SELECT {by}, count(*) AS requests, count(*) FILTER (WHERE status_code >= 400) AS errors,
       quantile_disc(duration_ms, 0.5) AS p50_ms, quantile_disc(duration_ms, 0.95) AS p95_ms,
       quantile_disc(duration_ms, 0.99) AS p99_ms, quantile_disc(duration_ms, 0.95) < 500 AS meets_slo
FROM audit GROUP BY {by}"""


@query("audit_rollup", _rollup_sql("tool, status_code"))
def rollup_by_tool(spark, sf):
    return audit_rollup(audit_log(spark, sf), ("tool", "status_code"))


@query("audit_rollup_by_key", _rollup_sql("user_id"))
def rollup_by_user(spark, sf):
    return audit_rollup(audit_log(spark, sf), ("user_id",))


@query("audit_windows", f"""WITH {AUDIT_SQL}
SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour AS window_end, tool,
       count(*) AS requests, count(*) FILTER (WHERE status_code >= 400) AS errors, quantile_disc(duration_ms, 0.95) AS p95_ms
FROM audit GROUP BY 1, 2, 3""")
def windows_by_tool(spark, sf):
    rolled = audit_windows(audit_log(spark, sf), "1 hour", ("tool",))
    return rolled.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz"))


@query("mask_keys", """
SELECT event_id, CASE WHEN length(event_type) <= 4 THEN '****' ELSE '****' || right(event_type, 4) END AS masked,
       CASE WHEN length('key-' || user_id || '-' || event_type) <= 8 THEN '****'
            ELSE left('key-' || user_id || '-' || event_type, 4) || '...' || right('key-' || user_id || '-' || event_type, 4) END AS shown,
       '****' || right('key-' || user_id || '-' || event_type, 4) AS api_key FROM events""")
def mask_all(spark, sf):
    log = audit_log(spark, sf).withColumn("shown", mask_api_key(F.col("api_key"))).withColumn("masked", mask_secret(F.col("tool")))
    return mask_audit(log).select("event_id", "masked", "shown", "api_key")


@query("bearer_key", """
SELECT event_id, CASE event_type WHEN 'error' THEN 'Bearer ' WHEN 'view' THEN 'bearer ' || user_id ELSE CAST(user_id AS VARCHAR) END AS api_key
FROM events""")
def bearer_keys(spark, sf):
    user = F.col("user_id").cast("string")
    header = (F.when(F.col("event_type") == "error", "Bearer ").when(F.col("event_type") == "view", F.concat(F.lit("bearer "), user))
              .when(F.col("event_type") == "click", user).otherwise(F.concat(F.lit("Bearer "), user)))
    return table(spark, sf, "events").select("event_id", bearer_key(header).alias("api_key"))


@query("rfc3339", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS text, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate END AS back
FROM orders""")
def times_as_text(spark, sf):
    o = table(spark, sf, "orders").withColumn("text", rfc3339(F.col("o_orderdate")))
    broken = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("no time "), "text")).otherwise(F.col("text"))
    # The text carries its zone, so the session zone must not shift it on the way back.
    back = F.to_utc_timestamp(parse_rfc3339(broken), F.current_timezone()).cast("timestamp_ntz")
    return o.select("o_orderkey", "text", back.alias("back"))


@query("percentage", """
SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN l_tax = 0 THEN 0 ELSE l_discount / l_tax * 100 END, 4) AS percent FROM lineitem""")
def percentages(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(
        percentage(F.col("l_discount"), F.col("l_tax")), 4).alias("percent"))


@query("same_name", """
SELECT c_custkey, lower(c_mktsegment) = lower(n_name) AS same_as_nation, true AS same_as_self
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def same_names(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", same_name(F.col("c_mktsegment"), F.col("n_name")).alias("same_as_nation"),
        same_name(F.col("c_mktsegment"), F.lower("c_mktsegment")).alias("same_as_self"))


@query("rpc_outcome", """
SELECT event_id, CASE WHEN user_id % 10 = 0 THEN -32000 WHEN user_id % 10 = 1 THEN -32001 WHEN value > 200 THEN -32002
       WHEN event_type = 'error' THEN -32700 WHEN event_type = 'click' THEN -32600 WHEN event_type = 'signup' THEN -32603 ELSE 0 END AS code
FROM events""")
def outcomes(spark, sf):
    kind = F.col("event_type")
    version = F.when(kind == "click", "1.0").otherwise("2.0")
    method = F.when(kind == "signup", "unknown_tool").otherwise("list_migrations")
    body = F.to_json(F.struct(version.alias("jsonrpc"), method.alias("method"), "props"))
    request = F.when(kind == "error", F.concat(F.lit("{"), body)).otherwise(body)
    key = F.when(F.col("user_id") % 10 == 0, "").otherwise(F.col("user_id").cast("string"))
    return table(spark, sf, "events").select("event_id", rpc_outcome(
        request, ("list_migrations", "migration_status", "schema_recommendation"), key, F.col("user_id") % 10 != 1,
        F.col("value") > 200).alias("code"))


# The log is replayed sixty times as fast, so that buckets of 3 tokens with 2 a minute run dry.
_FAST = "epoch_us(TIMESTAMP '2024-01-01') + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 60"


def fast_requests(spark, sf):
    start = 1704067200000000
    us = F.unix_micros(F.col("ts").cast("timestamp")) - start
    return table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "view", None).otherwise(F.col("event_type")).alias("api_key"),
        F.timestamp_micros(F.floor(us / 60) + start).alias("ts"))


def _bucket_sql(out: str) -> str:
    return f"""WITH RECURSIVE e AS (
  SELECT CASE WHEN event_type = 'view' THEN 'anonymous' ELSE event_type END AS k, event_id, {_FAST} AS t,
         row_number() OVER (PARTITION BY event_type ORDER BY {_FAST}, event_id) AS rn FROM events),
b AS (
  SELECT k, rn, event_id, t, true AS allowed, t * 2 - 3 * 60000000 + 60000000 AS v FROM e WHERE rn = 1
  UNION ALL
  SELECT e.k, e.rn, e.event_id, e.t, e.t * 2 - greatest(b.v, e.t * 2 - 180000000) >= 60000000,
         greatest(b.v, e.t * 2 - 180000000)
           + CASE WHEN e.t * 2 - greatest(b.v, e.t * 2 - 180000000) >= 60000000 THEN 60000000 ELSE 0 END
  FROM b JOIN e ON e.k = b.k AND e.rn = b.rn + 1)
SELECT {out} FROM b"""


@query("rate_limit", _bucket_sql("event_id, allowed, CASE WHEN allowed THEN 0 ELSE -32002 END AS code"))
def limited(spark, sf):
    return rate_limit(fast_requests(spark, sf), per_minute=2, burst=3).select("event_id", "allowed", "code")


@query("rate_limit_one_key", """WITH RECURSIVE e AS (
  SELECT event_id, epoch_us(ts) AS t, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events),
b AS (
  SELECT rn, event_id, t, true AS allowed, t - 120000000 + 60000000 AS v FROM e WHERE rn = 1
  UNION ALL
  SELECT e.rn, e.event_id, e.t, e.t - greatest(b.v, e.t - 120000000) >= 60000000,
         greatest(b.v, e.t - 120000000) + CASE WHEN e.t - greatest(b.v, e.t - 120000000) >= 60000000 THEN 60000000 ELSE 0 END
  FROM b JOIN e ON e.rn = b.rn + 1)
SELECT event_id, allowed FROM b""")
def limited_as_one_key(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.lit(None).cast("string").alias("api_key"), "ts")
    return rate_limit(rows, per_minute=1, burst=2).select("event_id", "allowed")
