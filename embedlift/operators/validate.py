"""Proof that a migration kept everything: pairs, reconciliation, completeness, checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.functions.vectors import vector_distance, vector_distance_arrow
from embedlift.model import SIMILARITY_THRESHOLD
from embedlift.sinks.merge import dedupe_last_write, has_unique_ids
from embedlift.workspace import write_once

_POINTS = 1 << 60


def sample_point(record_id: Column) -> Column:
    """A number in [0, 2^60) that depends on the id alone."""
    return F.conv(F.substring(F.md5(record_id), 1, 15), 16, 10).cast("bigint")


def sampled(df: DataFrame, rate: float) -> DataFrame:
    """The same share of ids on every run and on both sides of a comparison."""
    return df if rate >= 1 else df.filter(sample_point(F.col("id")) < int(rate * _POINTS))


def _chosen(source: DataFrame, sample_size: int) -> DataFrame:
    """``sample_size`` ids, the smallest by :func:`sample_point`.

    A share of the ids that most likely holds enough is taken first, so a task hands on few;
    where it does not hold enough, all are looked at.
    """
    ids = source.select("id").distinct()
    total = ids.count()
    share = ids
    if total > 4 * sample_size:
        share = sampled(ids, 2 * sample_size / total)
        share = share if share.limit(sample_size).count() == sample_size else ids
    return share.orderBy(sample_point(F.col("id")), "id").limit(sample_size)


def pair_records(source: DataFrame, target: DataFrame, sample_rate: float | None = None,
                 sample_size: int | None = None) -> DataFrame:
    """Source records with the target record of the same id.

    Sampling is by id, so it is applied to both sides before they are shuffled.
    ``found`` is false for records the target lacks; an id that a side holds more
    than once is paired once (``reconcile`` compares the copies), and records
    without an id are not paired: no target record can be theirs.
    """
    source, target = source.filter(F.col("id").isNotNull()), target.filter(F.col("id").isNotNull())
    if sample_rate is not None:
        source, target = sampled(source, sample_rate), sampled(target, sample_rate)
    if sample_size is not None:
        ids = write_once(_chosen(source, sample_size), "sampled-ids")
        source, target = source.join(ids, "id", "left_semi"), target.join(ids, "id", "left_semi")
    left = _one_per_id(source.select("id", F.col("vector").alias("source_vector"), F.col("metadata").alias("source_metadata")))
    right = _one_per_id(target.select("id", F.col("vector").alias("target_vector"), F.col("metadata").alias("target_metadata")))
    right = right.withColumn("_found", F.lit(True))
    return left.join(right, "id", "left").withColumn("found", F.coalesce("_found", F.lit(False))).drop("_found")


def _one_per_id(df: DataFrame) -> DataFrame:
    """Of repeated ids the record with the largest content; a table of unique ids is left as it is."""
    return df if has_unique_ids(df) else dedupe_last_write(df.withColumn("_one", F.lit(1)), "_one").drop("_one")


def with_similarity(pairs: DataFrame, engine: str = "arrow") -> DataFrame:
    measure = vector_distance_arrow if engine == "arrow" else vector_distance
    return pairs.withColumn("similarity", measure(F.col("source_vector"), F.col("target_vector"), "cosine"))


def validation_summary(pairs: DataFrame, threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    """One row: total, valid, invalid, avg, min and max similarity. Reads ``similarity`` only."""
    valid = F.coalesce(F.col("similarity") >= threshold, F.lit(False))
    return pairs.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(valid).alias("valid_records"),
        F.count_if(~valid).alias("invalid_records"),
        F.avg("similarity").alias("avg_similarity"),
        F.min("similarity").alias("min_similarity"),
        F.max("similarity").alias("max_similarity"))


def validation_errors(pairs: DataFrame, threshold: float = SIMILARITY_THRESHOLD,
                      fields: list[str] | None = None) -> DataFrame:
    """One row per discrepancy: ``record_id, field, message``.

    Without ``fields`` all top-level metadata fields of the source record are compared.
    """
    source, target = F.col("source_vector"), F.col("target_vector")
    unequal = F.size(source) != F.size(target)
    vector_message = (F.when(~F.col("found"), "Record missing in target")
                      .when(source.isNull() | target.isNull(), "Vector is missing")
                      .when(unequal, "Vector dimensions differ")
                      .when(F.col("similarity").isNull(), "Cosine similarity is undefined")
                      .when(F.col("similarity") < threshold, "Cosine similarity below threshold"))
    vector_field = F.when(F.col("found"), "vector").otherwise("id")
    found = [F.when(vector_message.isNotNull(), F.struct(vector_field.alias("field"), vector_message.alias("message")))]
    everything = F.array().cast("array<struct<field:string,message:string>>")
    if fields is None:
        mine, theirs = V.as_map(F.col("source_metadata")), V.as_map(F.col("target_metadata"))
        differing = F.filter(F.transform(F.map_keys(mine), lambda k: F.struct(k.alias("field"), F.when(
            ~F.map_contains_key(theirs, k), "Metadata field missing in target").when(
            ~F.to_json(F.try_element_at(mine, k)).eqNullSafe(F.to_json(F.try_element_at(theirs, k))), "Metadata value differs").alias("message"))),
            lambda e: e["message"].isNotNull())
        everything = F.when(F.col("found"), differing).otherwise(everything)
    for name in fields or []:
        a, b = V.field(F.col("source_metadata"), name), V.field(F.col("target_metadata"), name)
        message = (F.when(a.isNotNull() & b.isNull(), "Metadata field missing in target")
                   .when(a.isNotNull() & (F.to_json(a) != F.to_json(b)), "Metadata value differs"))
        found.append(F.when(F.col("found") & message.isNotNull(),
                            F.struct(F.lit(name).alias("field"), message.alias("message"))))
    rows = V.rows_of(pairs, F.concat(F.array_compact(F.array(*found)), everything), "e", [F.col("id").alias("record_id")])
    return rows.select("record_id", "e.field", "e.message")


def validate_migration(source: DataFrame, target: DataFrame, sample_rate: float | None = 0.1,
                       sample_size: int | None = None, threshold: float = SIMILARITY_THRESHOLD,
                       fields: list[str] | None = None, engine: str = "arrow") -> tuple[DataFrame, DataFrame]:
    """Summary (one row) and discrepancies of a sampled or full comparison."""
    pairs = with_similarity(pair_records(source, target, sample_rate, sample_size), engine)
    summary = validation_summary(pairs, threshold)
    return summary, validation_errors(pairs, threshold, fields)


def content_hash(with_vector: bool = True) -> Column:
    """Hash of a record's content; metadata goes in as canonical JSON text."""
    parts = [F.col("id"), F.to_json("metadata")]
    return F.xxhash64(*([F.col("vector")] if with_vector else []), *parts)


def reconcile(source: DataFrame, target: DataFrame, content: Column | None = None) -> DataFrame:
    """``id, status``: matched, changed, missing_in_target or extra_in_target.

    Instead of a full outer join the two sides are stacked as ``(id, side,
    hash)`` and grouped: one narrow shuffle, combined before it, so records
    themselves do not move and an id with many copies is no hot spot. Sides
    that hold an id more than once match when they hold the same contents
    equally often: counts and two independent sums of hashes agree.
    """
    digest = content if content is not None else content_hash()
    stacked = (source.select("id", F.lit(True).alias("_src"), digest.alias("_hash"))
               .unionByName(target.select("id", F.lit(False).alias("_src"), digest.alias("_hash"))))
    signed = F.when(F.col("_src"), 1).otherwise(-1)
    total = lambda value: F.sum((value * signed).cast("decimal(38,0)"))
    again = F.xxhash64("_hash", F.lit("second"))
    sides = stacked.groupBy("id").agg(
        F.count_if(F.col("_src")).alias("source_copies"), F.count_if(~F.col("_src")).alias("target_copies"),
        total(F.coalesce(F.col("_hash"), F.lit(0)).cast("decimal(20,0)")).alias("rest"), total(again.cast("decimal(20,0)")).alias("rest2"))
    same = (F.col("source_copies") == F.col("target_copies")) & (F.col("rest") == 0) & (F.col("rest2") == 0)
    status = (F.when(F.col("target_copies") == 0, "missing_in_target")
              .when(F.col("source_copies") == 0, "extra_in_target")
              .when(same, "matched").otherwise("changed"))
    return sides.select("id", status.alias("status"), "source_copies", "target_copies")


def reconcile_summary(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("status").agg(F.count(F.lit(1)).alias("n_records"))


def missing_ids(source: DataFrame, target: DataFrame) -> DataFrame:
    """Ids that only one side has: ``id, side``."""
    sides = reconcile(source.select("id"), target.select("id"), content=F.lit(0))
    return (sides.filter(F.col("status").isin("missing_in_target", "extra_in_target"))
            .select("id", F.when(F.col("status") == "missing_in_target", "source").otherwise("target").alias("side")))


def metadata_completeness(pairs: DataFrame, fields: dict[str, str] | list[str]) -> DataFrame:
    """Per field: in source, in target, equal, missing. ``fields`` maps source to target names.

    All fields are counted in one aggregate; records are not multiplied.
    """
    names = {f: f for f in fields} if isinstance(fields, list) else fields
    counts, rows = [], []
    for i, (src, dst) in enumerate(sorted(names.items())):
        a, b = V.field(F.col("source_metadata"), src), V.field(F.col("target_metadata"), dst)
        measures = {"in_source": a.isNotNull(), "in_target": b.isNotNull(), "equal": F.coalesce(F.to_json(a) == F.to_json(b), F.lit(False)),
                    "missing": a.isNotNull() & b.isNull()}
        counts += [F.count_if(flag).alias(f"_{i}_{name}") for name, flag in measures.items()]
        rows.append(F.struct(F.lit(src).alias("field"), *[F.col(f"_{i}_{name}").alias(name) for name in measures]))
    return pairs.filter("found").agg(*counts).select(F.inline(F.array(*rows)))


def content_checksum(df: DataFrame, by: list[Column] | None = None, row_hash: Column | None = None) -> DataFrame:
    """Order-independent checksum and count of a collection, or of parts of it."""
    hashed = content_hash() if row_hash is None else row_hash
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.coalesce(F.sum(hashed.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("checksum"))


def validation_report(summary: DataFrame, completeness: DataFrame, reconciled: DataFrame) -> DataFrame:
    """One JSON document with summary, completeness per field and reconciliation counts."""
    per_field = completeness.agg(F.sort_array(F.collect_list(F.struct(*completeness.columns))).alias("fields"))
    counts = reconcile_summary(reconciled).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("status", "n_records")))).alias("reconciliation"))
    one = summary.select(F.struct(*summary.columns).alias("summary"))
    return one.select(F.to_json(F.struct(
        "summary", per_field.scalar().alias("fields"), counts.scalar().alias("reconciliation"))).alias("report"))


def rollback_alert(summary: DataFrame, threshold: float = SIMILARITY_THRESHOLD, max_failure_rate: float = 0.01,
                   keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a summary (one, or one per ``keys``) that call for a rollback, with the reason."""
    rate = F.col("invalid_records") / F.nullif(F.col("total_records"), F.lit(0))
    reason = (F.when(F.col("min_similarity") < threshold, "min similarity below threshold")
              .when(rate > max_failure_rate, "failure rate too high"))
    return summary.select(*keys, reason.alias("reason"), "min_similarity",
                          rate.alias("failure_rate")).filter(F.col("reason").isNotNull())


def collection_stats(df: DataFrame, index_type: str = "unknown") -> DataFrame:
    """One row: record count, dimensions, index label and the size of the vectors in MB."""
    stats = df.agg(F.count(F.lit(1)).alias("total_records"),
                   F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dimensions"))
    return stats.withColumn("index_type", F.lit(index_type)).withColumn(
        "est_vector_mb", F.col("total_records") * F.col("dimensions") * 4 / float(1 << 20))
