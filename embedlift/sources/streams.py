"""New and changed records arriving as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from embedlift.model import RECORD_DDL

CHANGE_DDL = f"{RECORD_DDL}, op string, seq bigint"


def stream_records(spark: SparkSession, path: str, ddl: str = RECORD_DDL, file_format: str = "parquet",
                   files_per_batch: int = 1000, glob: str | None = None) -> DataFrame:
    """Stream a folder; ``files_per_batch`` bounds the size of one micro-batch."""
    reader = (spark.readStream.schema(ddl).format(file_format)
              .option("maxFilesPerTrigger", files_per_batch))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
