"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_watching: list[list[str]] = []


def build_session(app: str = "embedlift", cores: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; every setting can be overridden.

    The master is what the session was submitted with; ``cores`` asks for a local one instead.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if cores:
        builder = builder.master(f"local[{cores}]")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the one set on the context.

    Only a local session (tests) gets a temporary folder where neither is set; a cluster has to name one.
    """
    context = spark.sparkContext
    set_already = context._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or (set_already.get() if set_already.isDefined() else None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="embedlift-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call uses."""
    path = os.path.join(shared_dir(spark), "embedlift", f"{label}-{uuid.uuid4().hex}")
    for made in _watching:
        made.append(path)
    return path


@contextmanager
def scratch_made() -> Iterator[list[str]]:
    """Collects the scratch paths handed out inside the block, for :func:`remove_scratch`."""
    made: list[str] = []
    _watching.append(made)
    try:
        yield made
    finally:
        _watching.remove(made)


def remove_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables once every result that reads them has been written."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like a checkpoint does, but keeps column pruning and
    filter pushdown for the readers, and survives the loss of any executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint; unlike :func:`write_once` it keeps the partitions."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; stops reading after that."""
    return df.limit(max_rows + 1).count() <= max_rows


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly projections over a table of very few files.

    A table of any size has more partitions than that and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df
