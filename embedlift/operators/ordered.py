"""Window results over ordered rows of a key, however many rows one key has.

A plain window puts all rows of a key into one task. Here rows are range
partitioned by key and sequence number, whatever numbers those are, so a busy
key spans several partitions. Windows run per key and partition, and what
crosses a border is carried over by a second window that only sees one row per
key and partition. ``seq`` must be unique within a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from embedlift.workspace import checkpointed

CHUNK_ROWS = 1_000_000


def with_context(df: DataFrame, key: str, seq: str, previous: tuple[str, ...] = (), running: dict[str, str] | None = None,
                 position: str | None = None, chunks: int | None = None) -> DataFrame:
    """Add values that depend on the earlier rows of a key.

    ``previous`` adds ``prev_<name>`` from the row before; ``running`` maps new
    columns to columns to sum up to and including the row; ``position`` names a
    column with the number of the row, from 0. ``chunks`` sets the number of partitions.
    """
    running = running or {}
    ranged = df.repartitionByRange(chunks, key, seq) if chunks else df.repartitionByRange(key, seq)
    # borders and rows must see the same partitions, so these are stored
    chunked = checkpointed(ranged.withColumn("_chunk", F.spark_partition_id()))
    inside = Window.partitionBy(key, "_chunk").orderBy(seq)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = chunked
    if previous:
        rows = rows.withColumn("_prev", F.lag(F.struct(*previous)).over(inside))
    for name, value in running.items():
        rows = rows.withColumn(f"_run_{name}", F.sum(value).over(so_far))
    if position:
        rows = rows.withColumn("_pos", F.row_number().over(inside) - 1)

    measures = [F.count(F.lit(1)).alias("_rows")]
    if previous:
        measures.append(F.max_by(F.struct(*previous), seq).alias("_last"))
    measures += [F.sum(value).alias(f"_sum_{name}") for name, value in running.items()]
    across = Window.partitionBy(key).orderBy("_chunk")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")]
    if previous:
        carried.append(F.lag("_last").over(across).alias("_carry"))
    carried += [F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_base_{name}") for name in running]
    borders = chunked.groupBy(key, "_chunk").agg(*measures).select(key, "_chunk", *carried)

    borders = borders.withColumnsRenamed({key: "_key", "_chunk": "_its"})
    joined = rows.join(borders, rows[key].eqNullSafe(borders["_key"]) & (rows["_chunk"] == borders["_its"]))
    if previous:
        before = F.coalesce("_prev", "_carry")
        joined = joined.select("*", *[before[name].alias(f"prev_{name}") for name in previous])
    for name in running:
        joined = joined.withColumn(name, F.col(f"_run_{name}") + F.col(f"_base_{name}"))
    if position:
        joined = joined.withColumn(position, F.col("_pos") + F.col("_before"))
    kept = [*df.columns, *[f"prev_{name}" for name in previous], *running, *([position] if position else [])]
    return joined.select(*kept)


def moving_average(df: DataFrame, key: str, position: str, value: str, name: str, width: int,
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Average of a row and the ``width - 1`` rows before it.

    ``position`` counts the rows of a key without gaps (see ``with_context``),
    so the rows a chunk needs from the one before are known and are copied over.
    """
    at = F.col(position)
    own = df.withColumn("_chunk", F.floor(at / chunk_rows)).withColumn("_own", F.lit(True))
    copied = (df.filter(F.pmod(at, F.lit(chunk_rows)) >= chunk_rows - (width - 1))
              .withColumn("_chunk", F.floor(at / chunk_rows) + 1).withColumn("_own", F.lit(False)))
    frame = Window.partitionBy(key, "_chunk").orderBy(position).rowsBetween(-(width - 1), 0)
    return (own.unionByName(copied).withColumn(name, F.avg(value).over(frame))
            .filter("_own").drop("_chunk", "_own"))
