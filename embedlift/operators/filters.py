"""Target rules and metadata filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.model import profile


def _violation(failed: Column, name: str, message: Column | str) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(failed, F.struct(F.lit(name).alias("field"), text.alias("message")))


def _broken_fields(metadata: Column, failed, message: str) -> Column:
    found = F.map_filter(metadata, lambda _, v: failed(v))
    return F.transform(F.map_keys(found), lambda k: F.struct(k.alias("field"), F.lit(message).alias("message")))


def check_target_constraints(df: DataFrame, target: str) -> DataFrame:
    """One row per broken rule of the target: ``record_id, field, message``."""
    rules = profile(target)
    metadata = V.as_map(F.col("metadata"))
    rows = [
        _violation(F.col("id").isNull() | (F.col("id") == ""), "id", "id is empty"),
        _violation(F.col("vector").isNull() | (F.size("vector") == 0), "vector", "vector is empty"),
        _violation(F.size("vector") > rules.max_dims, "vector",
                   F.concat(F.lit("dimension "), F.size("vector").cast("string"), F.lit(f" exceeds {rules.max_dims}"))),
    ]
    if rules.id_rule == "uuid":
        rows.append(_violation(~V.is_uuid(F.col("id")), "id", "id is not a UUID"))
    if rules.max_id_bytes:
        rows.append(_violation(F.octet_length("id") > rules.max_id_bytes, "id",
                               f"id exceeds {rules.max_id_bytes} bytes"))
    if rules.max_metadata_bytes:
        rows.append(_violation(F.octet_length(F.to_json("metadata")) > rules.max_metadata_bytes, "metadata",
                               f"metadata exceeds {rules.max_metadata_bytes} bytes"))
    checks = F.array_compact(F.array(*rows))
    per_field = []
    if not rules.nested:
        per_field.append((lambda v: V.is_object(v), "nested object is not allowed"))
    if rules.arrays == "strings":
        per_field.append((lambda v: V.is_array(v) & ~F.schema_of_variant(v).isin("ARRAY<STRING>", "ARRAY<VOID>"),
                          "array elements must be strings"))
    if rules.arrays == "json":
        per_field.append((lambda v: V.is_array(v), "array must be JSON text"))
    for failed, message in per_field:
        checks = F.concat(checks, _broken_fields(metadata, failed, message))
    found = V.rows_of(df, checks, "v", [F.col("id").alias("record_id")])
    return found.select("record_id", "v.field", "v.message")


def payload_condition(name: str, op: str, value, as_type: str | None = None) -> Column:
    """A condition on one metadata field; absent or differently typed values do not match."""
    sql_type = as_type or _type_of(value)
    got = V.field(F.col("metadata"), name, sql_type)
    if op == "eq":
        return F.coalesce(got == F.lit(value), F.lit(False))
    if op == "in":
        return F.coalesce(got.isin(*value), F.lit(False))
    if op == "range":
        low, high = value
        ok = F.lit(True)
        if low is not None:
            ok = ok & (got >= F.lit(low))
        if high is not None:
            ok = ok & (got <= F.lit(high))
        return F.coalesce(got.isNotNull() & ok, F.lit(False))
    if op == "contains":
        items = F.coalesce(V.field(F.col("metadata"), name, "array<string>"), F.array().cast("array<string>"))
        text = F.coalesce(V.field(F.col("metadata"), name, "string"), F.lit(""))
        listed = F.array_contains(items, F.lit(str(value)))
        inside = ~V.is_array(V.field(F.col("metadata"), name)) & text.contains(str(value))
        return F.coalesce(listed | inside, F.lit(False))
    raise ValueError(f"unknown condition: {op!r}; known: eq, in, range, contains")


def _type_of(value) -> str:
    probe = next((v for v in value if v is not None), None) if isinstance(value, (list, tuple)) else value
    if isinstance(probe, bool):
        return "boolean"
    if isinstance(probe, int):
        return "bigint"
    return "double" if isinstance(probe, float) else "string"


def payload_filter(df: DataFrame, conditions: list[tuple]) -> DataFrame:
    """Records whose metadata meets all ``(field, op, value)`` conditions."""
    for condition in conditions:
        df = df.filter(payload_condition(*condition))
    return df


def skip_fields(fields: DataFrame, reserved: tuple[str, ...] = ("id", "vector")) -> DataFrame:
    """Field tables without the parts of a record that are never mapped."""
    return fields.filter(~F.col("field").isin(*reserved))
