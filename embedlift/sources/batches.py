"""Keyset pages, batch numbers and resuming, all in id order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from embedlift.workspace import write_once

DEFAULT_BATCH = 100
HOT_COPIES = 1_000_000


def get_batch(df: DataFrame, after_id: str | None = None, limit: int = DEFAULT_BATCH) -> DataFrame:
    """The next ``limit`` records after ``after_id``; an empty result is the end of the data."""
    rest = df.filter(F.col("id") > after_id) if after_id else df
    return rest.orderBy("id").limit(limit)


def resume_filter(df: DataFrame, last_processed_id: str | None) -> DataFrame:
    """Records still to do; on id-sorted files the scan skips finished row groups."""
    return df if not last_processed_id else df.filter(F.col("id") > last_processed_id)


def number_in_order(df: DataFrame, *order: str, name: str = "row_no", partitions: int | None = None,
                    hot_copies: int = HOT_COPIES) -> DataFrame:
    """Number all rows from 0 in a global order without gathering them anywhere.

    Rows are range partitioned, sorted and numbered inside each partition; only
    the row count of each partition is combined. The ranged rows are written
    once so that both passes see the same boundaries.

    Rows with equal ``order`` values share a partition. Where more than
    ``hot_copies`` of them exist, the rows are written with a tie-breaker first,
    which then splits them over partitions as well.
    """
    most = df.groupBy(*order).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    keys = list(order)
    if (most or 0) > hot_copies:
        df = write_once(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")
        keys.append("_tie")
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    local = (ranged.sortWithinPartitions(*keys)
             .withColumn("_pid", F.spark_partition_id())
             .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    stored = write_once(local, "numbered")
    # One row per range partition: the window below never sees record rows.
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
               .select("_pid", F.coalesce(before, F.lit(0)).alias("_offset")))
    return (stored.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_offset") + F.col("_pos"))
            .drop("_pid", "_pos", "_offset", "_tie"))


def range_bounds(df: DataFrame, parts: int, multiple_of: int = 1) -> list[str]:
    """Last id of each of at most ``parts`` ranges of about equal size, but for the last range.

    Only ids are read and numbered; copies of an id are counted, not numbered,
    so they always fall into one range. At most ``parts`` ids reach the driver.
    """
    per_id = df.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    total = per_id.agg(F.sum("n")).first()[0] or 0
    size = max(1, -(-total // (parts * multiple_of))) * multiple_of
    ranged = write_once(per_id.repartitionByRange("id").sortWithinPartitions("id")
                        .withColumn("_pid", F.spark_partition_id()), "id-counts")
    sums = ranged.groupBy("_pid").agg(F.sum("n").alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(sums.select("_pid", F.coalesce(before, F.lit(0)).alias("_offset")))
    inside = Window.partitionBy("_pid").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    ends = (ranged.join(offsets, "_pid").withColumn("_end", F.sum("n").over(inside) + F.col("_offset"))
            .withColumn("_part", F.floor((F.col("_end") - 1) / size)))
    last = ends.groupBy("_part").agg(F.max("id").alias("id")).orderBy("_part").collect()
    return [row["id"] for row in last[:-1]]


def assign_batches(df: DataFrame, batch_size: int = DEFAULT_BATCH, partitions: int | None = None) -> DataFrame:
    """Give every record the number of its batch of ``batch_size`` records in id order."""
    numbered = number_in_order(df, "id", name="_row", partitions=partitions)
    return numbered.withColumn("batch_no", F.floor(F.col("_row") / batch_size)).drop("_row")
