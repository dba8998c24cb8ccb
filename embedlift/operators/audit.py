"""Reports over request logs: ``ts, api_key, tool, status_code, duration_ms``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from embedlift.functions.text import mask_secret

ACCURACY = 100_000


def _measures() -> list:
    return [F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("status_code") >= 400).alias("errors"),
            F.percentile_approx("duration_ms", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), ACCURACY).alias("_p")]


def audit_rollup(audit: DataFrame, by: tuple[str, ...] = ("tool",), slo_p95_ms: float = 500.0) -> DataFrame:
    """Requests, errors and exact latency percentiles per group.

    Requests are first counted per group and duration; a percentile is the smallest duration
    that so many requests do not exceed. Equal durations are one row by then, and running
    counts need one row at a time in memory.
    """
    keys = list(by)
    counted = audit.groupBy(*keys, "duration_ms").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status_code") >= 400).alias("e"))
    totals = counted.groupBy(*keys).agg(F.sum("n").alias("requests"), F.sum("e").alias("errors"), F.sum(F.when(F.col("duration_ms").isNotNull(), F.col("n"))).alias("timed"))
    up_to = Window.partitionBy(*keys).orderBy("duration_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.where("duration_ms is not null").withColumn("upto", F.sum("n").over(up_to))
    same = [ranked[k].eqNullSafe(totals[k]) for k in keys]
    joined = (totals.join(ranked.drop("e"), same, "left") if keys else totals.join(ranked.drop("e"), how="left")).select(
        *[totals[k] for k in keys], "requests", "errors", "timed", "duration_ms", "upto")
    at = lambda share, name: F.min(F.when(F.col("upto") >= F.ceil(F.col("timed") * share), F.col("duration_ms"))).alias(name)
    rolled = joined.groupBy(*keys, "requests", "errors").agg(at(0.5, "p50_ms"), at(0.95, "p95_ms"), at(0.99, "p99_ms"))
    return rolled.select(*keys, "requests", "errors", "p50_ms", "p95_ms", "p99_ms", (F.col("p95_ms") < slo_p95_ms).alias("meets_slo"))


def mask_audit(audit: DataFrame, column: str = "api_key") -> DataFrame:
    return audit.withColumn(column, mask_secret(F.col(column)))


def audit_windows(audit: DataFrame, width: str = "1 minute", by: tuple[str, ...] = (),
                  late: str = "10 minutes") -> DataFrame:
    """Tumbling-window rollup of a log table or a log stream.

    The 95th percentile comes from a sketch that keeps state small: its rank is off by at most
    one in ``ACCURACY``.
    """
    rows = audit.withColumn("ts", F.col("ts").cast("timestamp"))
    if audit.isStreaming:
        rows = rows.withWatermark("ts", late)
    rolled = rows.groupBy(F.window("ts", width).alias("w"), *by).agg(*_measures())
    return rolled.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "requests",
                         "errors", F.col("_p")[1].alias("p95_ms"))
