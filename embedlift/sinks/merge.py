"""Upsert and delete as plain DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_last_write(df: DataFrame, seq: str = "seq", key: str = "id") -> DataFrame:
    """One row per key: the one with the highest ``seq``.

    ``max_by`` combines copies before the shuffle, so a key with very many
    copies stays cheap. Rows that tie on ``seq`` are told apart by content.
    """
    rest = [c for c in df.columns if c != key]
    types = dict(df.dtypes)
    content = [F.to_json(c) if types[c] == "variant" else F.col(c) for c in rest if c != seq]
    rank = F.struct(F.col(seq), F.xxhash64(*content)) if content else F.struct(F.col(seq))
    newest = df.groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("_r"))
    return newest.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def has_unique_ids(df: DataFrame, key: str = "id") -> bool:
    """True when no key repeats; reads and shuffles the key column only."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).isEmpty()


def upsert(target: DataFrame, delta: DataFrame, seq: str | None = None) -> DataFrame:
    """Whole records replaced or added by id; metadata is not merged.

    One record per id is added: the one with the highest ``seq``, or without it the one with the largest content.
    """
    if seq:
        delta = dedupe_last_write(delta, seq).drop(seq)
    elif not has_unique_ids(delta):
        delta = dedupe_last_write(delta.withColumn("_one", F.lit(1)), "_one").drop("_one")
    delta = delta.select(*target.columns)
    return target.join(delta.select("id"), "id", "left_anti").unionByName(delta)


def delete_by_ids(target: DataFrame, ids: DataFrame) -> DataFrame:
    """Remove records by id; unknown ids are ignored."""
    return target.join(ids.select("id"), "id", "left_anti")
