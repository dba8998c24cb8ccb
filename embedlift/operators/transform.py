"""Record transforms: mapping, conversion, shape changes and whole migration paths.

All of them are projections: one pass, no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field as dataclass_field
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.functions.converters import converter, registrations
from embedlift.functions.vectors import cast_vector, dense_to_sparse, sparse_to_dense
from embedlift.model import Profile, profile

ERRORS = "_errors"


@dataclass(frozen=True)
class FieldRule:
    """One mapped field; ``default_json`` is JSON text and applies where the field is absent."""

    source: str
    target: str
    convert: str | None = None
    default_json: str | None = None


@dataclass(frozen=True)
class Mapping:
    """Which metadata fields survive, under which names and as what."""

    source_type: str
    target_type: str
    rules: tuple[FieldRule, ...] = dataclass_field(default=())

    @staticmethod
    def identity(source_type: str, target_type: str, fields: list[str], convert: str | None = None) -> Mapping:
        return Mapping(source_type, target_type, tuple(FieldRule(f, f, convert) for f in fields))

    @staticmethod
    def from_frame(mapping: DataFrame, source_type: str, target_type: str) -> Mapping:
        """Rules of one collection from a mapping table: one rule per field, so as many rows as the collection has fields."""
        columns = mapping.columns
        wanted = mapping.filter(F.col("target_field").isNotNull()).select(
            "source_field", "target_field",
            *[F.col(c) if c in columns else F.lit(None).cast("string").alias(c) for c in ("converter", "default_json")])
        rows = wanted.collect()
        return Mapping(source_type, target_type, tuple(FieldRule(*row) for row in rows))


def check_mapping(mapping: Mapping | None) -> Mapping:
    """Raise on the first broken rule of a mapping."""
    error = mapping_error(mapping)
    if error:
        raise ValueError(error)
    return mapping


def mapping_error(mapping: Mapping | None) -> str | None:
    from embedlift.operators.mapping import MAPPING_RULES

    if mapping is None:
        return "mapping cannot be nil"
    for failed, message in MAPPING_RULES:
        if failed(mapping.source_type, mapping.target_type):
            return message(mapping.source_type, mapping.target_type)
    return None


def _entry(target: str, convert: str | None):
    return lambda v: F.struct(F.lit(target).alias("key"), v.alias("raw"),
                              (converter(convert)(v) if convert else v).alias("value"))


def _mapped_fields(metadata: Column, mapping: Mapping) -> Column:
    """Entries ``(key, raw, value)`` of the target fields that have a value."""
    by_target: dict[str, list[FieldRule]] = {}
    for rule in mapping.rules:
        by_target.setdefault(rule.target, []).append(rule)
    entries = []
    for target in sorted(by_target):
        # Two sources for one target: the last by source name wins.
        rules = sorted(by_target[target], key=lambda r: r.source, reverse=True)
        options = [V.field(metadata, r.source) for r in rules]
        options += [F.parse_json(F.lit(r.default_json)) for r in rules if r.default_json is not None]
        raw = F.coalesce(*options)
        convert = next((r.convert for r in rules if r.convert), None)
        entries.append(V.let(raw, _entry(target, convert)))
    if not entries:
        return F.array().cast("array<struct<key:string,raw:variant,value:variant>>")
    return F.filter(F.array(*entries), lambda e: e["raw"].isNotNull())


@lru_cache(maxsize=256)
def _mapped_column(mapping: Mapping, depth: int | None, registered: int, gateway: int) -> Column:
    """The mapping as one column ``struct<metadata, failed>``.

    Building a column of many lambdas takes the driver about a second, so that
    of a mapping is kept for the next step or micro-batch.
    """
    def build(entries: Column) -> Column:
        good = F.filter(entries, lambda e: e["value"].isNotNull())
        failed = F.filter(entries, lambda e: e["value"].isNull())
        fields = F.map_from_entries(F.transform(good, lambda e: V.pair(e["key"], e["value"])))
        if depth is not None:
            fields = shaped_fields(fields, mapping.source_type, mapping.target_type, depth)
        return F.struct(V.to_object(fields).alias("metadata"), F.transform(failed, lambda e: e["key"]).alias("failed"))

    return V.let(_mapped_fields(F.col("metadata"), mapping), build)


def apply_mapping(df: DataFrame, mapping: Mapping, depth: int | None = None) -> DataFrame:
    """Metadata holds only mapped fields; failed conversions are listed in ``_errors``.

    With a ``depth`` the fields also take the form the target type needs.
    """
    check_mapping(mapping)
    column = _mapped_column(mapping, depth, registrations(), id(SparkContext._gateway))
    mapped = V.with_once(df, "_m", column)
    return (mapped.withColumn("metadata", F.col("_m.metadata"))
            .withColumn(ERRORS, F.col("_m.failed")).drop("_m"))


def map_records(df: DataFrame, mapping: Mapping, on_error: str = "fail", depth: int | None = None) -> DataFrame:
    """Rename and prune metadata, fill defaults, convert values.

    ``on_error="fail"`` stops the job at a value that cannot be converted,
    ``"drop"`` leaves such records out (see :func:`rejected_records`).
    """
    mapped = apply_mapping(df, mapping, depth)
    if on_error == "drop":
        return mapped.filter(F.size(ERRORS) == 0).drop(ERRORS)
    if on_error != "fail":
        raise ValueError("on_error is 'fail' or 'drop'")
    message = F.concat(F.lit("failed to convert field "), F.array_join(ERRORS, ", "), F.lit(" of record "), F.col("id"))
    guarded = F.when(F.size(ERRORS) > 0, F.raise_error(message).cast("variant")).otherwise(F.col("metadata"))
    return mapped.withColumn("metadata", guarded).drop(ERRORS)


def rejected_records(df: DataFrame, mapping: Mapping) -> DataFrame:
    """One row per failed conversion: ``record_id, field, message``."""
    failed = apply_mapping(df, mapping).filter(F.size(ERRORS) > 0)
    return failed.select(F.col("id").alias("record_id"), F.explode(ERRORS).alias("field")).withColumn(
        "message", F.concat(F.lit("failed to convert field "), F.col("field")))


def default_values(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Add absent fields; a field that is present with JSON null stays null."""
    if not defaults:
        return df
    extra = F.create_map(*[c for k, v in sorted(defaults.items()) for c in (F.lit(k), F.parse_json(F.lit(v)))])
    merged = V.let(V.as_map(F.col("metadata")), lambda m: F.map_concat(
        F.map_filter(extra, lambda k, _: ~F.map_contains_key(m, k)), m))
    return df.withColumn("metadata", V.to_object(merged))


def _rewrite(df: DataFrame, build) -> DataFrame:
    return df.withColumn("metadata", V.to_object(build(V.as_map(F.col("metadata")))))


def narrow_numbers(df: DataFrame) -> DataFrame:
    return _rewrite(df, lambda m: F.transform_values(m, lambda _, v: V.narrow_number(v)))


def flatten_metadata(df: DataFrame, sep: str = ".", depth: int = 1) -> DataFrame:
    return _rewrite(df, lambda m: V.flatten_map(m, sep, depth))


def unflatten_metadata(df: DataFrame, sep: str = ".", depth: int = 1) -> DataFrame:
    return _rewrite(df, lambda m: V.unflatten_map(m, sep, depth))


def arrays_to_json(df: DataFrame) -> DataFrame:
    return _rewrite(df, V.arrays_to_json)


def derive_uuid(df: DataFrame) -> DataFrame:
    """UUID ids; the id a record had is kept as ``source_id``."""
    return df.withColumn("source_id", F.col("id")).withColumn("id", V.derive_uuid(F.col("id")))


def map_namespace(df: DataFrame, mode: str, name: str = "namespace") -> DataFrame:
    """Namespace as a partition column, or as a metadata field to filter on."""
    if mode == "partition":
        return df.withColumnRenamed("namespace", "partition_name")
    if mode != "payload":
        raise ValueError("mode is 'partition' or 'payload'")
    extra = F.when(F.col("namespace").isNotNull(),
                   F.create_map(F.lit(name), F.col("namespace").cast("variant"))).otherwise(V.empty_map())
    own = F.map_filter(V.as_map(F.col("metadata")), lambda k, _: F.col("namespace").isNull() | (k != name))
    return df.withColumn("metadata", V.to_object(F.map_concat(own, extra))).drop("namespace")


def coerced_fields(fields: Column, target: str) -> Column:
    """Every top-level value as a type the target can hold, by the type matrix."""
    rules = profile(target)

    def coerce(_: Column, v: Column) -> Column:
        def by_type(name: Column) -> Column:
            array = F.startswith(name, F.lit("ARRAY"))
            out = F.when(F.lit(False), v)
            if rules.integers_as_double:
                out = out.when(name == "BIGINT", converter("to_double")(v))
            if rules.arrays == "strings":
                out = out.when(array & (name != "ARRAY<STRING>"), converter("to_string_list")(v))
            elif rules.arrays == "json":
                out = out.when(array, V.to_json_text(v))
            elif rules.arrays == "typed":
                out = out.when((name == "STRING") & V.is_date_text(v), converter("to_iso_date")(v))
            return F.coalesce(out, v)
        return V.let(V.type_text(v), by_type)

    return fields if rules.arrays == "any" else F.transform_values(fields, coerce)


def coerce_types(df: DataFrame, target: str) -> DataFrame:
    return _rewrite(df, lambda m: coerced_fields(m, target))


def cast_vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("vector", cast_vector(F.col("vector")))


def sparse_vectors_to_dense(df: DataFrame, dims: int) -> DataFrame:
    """Fill in dense vectors for records that only have a sparse one."""
    return df.withColumn("vector", F.coalesce("vector", sparse_to_dense(F.col("sparse"), dims))).drop("sparse")


def dense_vectors_to_sparse(df: DataFrame) -> DataFrame:
    return df.withColumn("sparse", dense_to_sparse(F.col("vector")))


Shaper = Callable[[Column, int], Column]
_SHAPERS: dict[tuple[str, str], Shaper] = {("pinecone", "qdrant"): lambda fields, _: V.flatten_map(fields, ".", 1)}


def register_shaper(source: str, target: str, shaper: Shaper) -> None:
    """How nested fields are laid out on one path: a function of the field map and its depth."""
    _SHAPERS[source, target] = shaper
    _mapped_column.cache_clear()


def shaper(source: str, target: str) -> Shaper:
    """The registered layout of a path, else flat names where the target holds no objects."""
    def default(fields: Column, depth: int) -> Column:
        return fields if profile(target).nested else V.flatten_map(fields, "_", depth)

    return _SHAPERS.get((source, target), default)


def shaped_fields(fields: Column, source: str, target: str, depth: int) -> Column:
    """Field rules that follow from what source and target can hold.

    Nested objects (``depth`` levels of them) and arrays take the form the target
    allows; numbers of a store that keeps everything as float are narrowed where
    the target knows integers.
    """
    src, dst = profile(source), profile(target)
    fields = shaper(source, target)(fields, depth)
    if src.integers_as_double and not dst.integers_as_double:
        fields = F.transform_values(fields, lambda _, v: V.narrow_number(v))
    return coerced_fields(fields, target)


def _shape_rest(df: DataFrame, source: str, target: str) -> DataFrame:
    """UUID ids where required, and the namespace where the target keeps it."""
    if profile(target).id_rule == "uuid":
        df = derive_uuid(df)
    return _place_namespace(df, profile(source), profile(target))


def _levels(df: DataFrame, source: str, target: str, depth: int | None) -> int:
    """Levels to lift for a target without objects: all there are, counted first, unless given."""
    if depth is not None:
        return depth
    if profile(target).nested or (source, target) in _SHAPERS and df.isStreaming:
        return 1
    if df.isStreaming:
        raise ValueError("a stream cannot be measured; give the depth of its metadata, or map each micro-batch")
    return max(1, V.nesting(df))


def shape_for(df: DataFrame, source: str, target: str, depth: int | None = None) -> DataFrame:
    """Records of one store type in the form another one wants, all fields kept."""
    depth = _levels(df, source, target, depth)
    return _shape_rest(_rewrite(df, lambda m: shaped_fields(m, source, target, depth)), source, target)


def _place_namespace(df: DataFrame, src: Profile, dst: Profile) -> DataFrame:
    if "namespace" not in df.columns or dst.namespace == src.namespace:
        return df
    return map_namespace(df, "payload" if dst.namespace == "payload" else "partition")


def migrate_records(df: DataFrame, mapping: Mapping, on_error: str = "fail", depth: int | None = None) -> DataFrame:
    """Source records as the target wants them: mapping first, then the rules of the pair."""
    check_mapping(mapping)
    depth = _levels(df, mapping.source_type, mapping.target_type, depth)
    mapped = map_records(df, mapping, on_error, depth)
    return _shape_rest(mapped, mapping.source_type, mapping.target_type)
