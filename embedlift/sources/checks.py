"""Checks of a source before anything is moved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from embedlift.model import profile


def check_source(df: DataFrame, store_type: str) -> DataFrame:
    """One row of findings: null or empty ids, repeated ids, null vectors, dimensions.

    Copies of an id are counted after a map-side count per id, so that one id
    with very many copies is no hot spot.
    """
    profile(store_type)
    per_id = df.groupBy("id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(F.col("vector").isNull()).alias("null_vectors"),
        F.min(F.size("vector")).alias("min_dim"),
        F.max(F.size("vector")).alias("max_dim"))
    has_id = F.col("id").isNotNull() & (F.col("id") != "")
    found = per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.when(~has_id, F.col("copies"))), F.lit(0)).alias("missing_ids"),
        F.count_if(has_id & (F.col("copies") > 1)).alias("repeated_ids"),
        F.coalesce(F.sum("null_vectors"), F.lit(0)).alias("null_vectors"),
        F.min(F.when(F.col("min_dim") >= 0, F.col("min_dim"))).alias("min_dim"),
        F.max("max_dim").alias("max_dim"))
    clean = ((F.col("missing_ids") == 0) & (F.col("repeated_ids") == 0) & (F.col("null_vectors") == 0)
             & F.coalesce(F.col("min_dim") == F.col("max_dim"), F.lit(True)))
    return found.withColumn("ok", clean)
