"""What the operators of this package share: inputs, the query catalogue, Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from embedlift.queries import Query
from embedlift.workspace import write_once

QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    """Put a function ``(spark, sf_dir) -> DataFrame`` into this package's catalogue."""
    def add(run):
        QUERIES[name] = Query(run, sql)
        return run
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns called like one of ``names`` in any case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def pack(batch: pa.RecordBatch) -> bytes:
    """One batch as compressed bytes, so that many rows travel through a shuffle as one value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


#: What a batch of rows that goes to a Python function holds at most.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def in_small_batches(df: DataFrame, label: str) -> DataFrame:
    """:func:`write_once` for a frame made by Python functions of whole texts: an executor holds each batch several times over, beside its heap.

    What Spark reads ahead for them at its default of 10,000 rows grows with the texts. The session's settings are put back.
    """
    conf = df.sparkSession.conf
    before = {key: conf.get(key) for key in BATCH}
    for key, value in BATCH.items():
        conf.set(key, value)
    try:
        return write_once(df, label)
    finally:
        for key, value in before.items():
            conf.set(key, value)
