"""Records in the request shape of each store type, as JSON files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from embedlift.functions import variants as V


def pinecone_fields(df: DataFrame, class_name: str) -> list[Column]:
    fields = [F.col("id"), F.col("vector").alias("values"), F.col("metadata")]
    return fields + ([F.col("sparse").alias("sparse_values")] if "sparse" in df.columns else [])


def qdrant_fields(df: DataFrame, class_name: str) -> list[Column]:
    return [F.col("id"), F.col("vector"), F.col("metadata").alias("payload")]


def weaviate_fields(df: DataFrame, class_name: str) -> list[Column]:
    return [F.lit(class_name).alias("class"), F.col("id"), F.col("vector"), F.col("metadata").alias("properties")]


def milvus_fields(df: DataFrame, class_name: str, json_field: str = "metadata_json") -> list[Column]:
    """Scalars as fields of the entity, nested objects below the JSON field, arrays as JSON text."""
    fields = V.arrays_to_json(V.as_map(F.col("metadata")))
    scalars = F.map_filter(fields, lambda k, v: ~V.is_object(v) & ~k.isin("id", "embedding", json_field))
    nested = F.map_filter(fields, lambda k, v: V.is_object(v) | k.isin("id", "embedding", json_field))
    base = F.create_map(F.lit("id"), F.col("id").cast("variant"),
                        F.lit("embedding"), F.to_variant_object("vector"),
                        F.lit(json_field), V.to_object(nested))
    return [V.to_object(F.map_concat(base, scalars)).alias(ENTITY)]


ENTITY = "entity"
Fields = Callable[[DataFrame, str], list[Column]]
_WRITERS: dict[str, tuple[Fields, str, tuple[str, ...]]] = {}


def register_writer(store_type: str, fields: Fields, member: str, keeps: tuple[str, ...] = ()) -> None:
    """Teach exports a store type.

    ``fields(records, class name)`` gives the fields of a record as columns, or one variant column
    named ``entity``; ``member`` names the list in a request document; ``keeps`` the columns beside
    a record's own three that the store can hold.
    """
    _WRITERS[store_type] = (fields, member, keeps)


register_writer("pinecone", pinecone_fields, "vectors", ("sparse", "namespace"))
register_writer("qdrant", qdrant_fields, "points")
register_writer("weaviate", weaviate_fields, "objects")
register_writer("milvus", milvus_fields, "data")


def write_export(df: DataFrame, store_type: str, path: str, class_name: str = "Record", mode: str = "errorifexists",
                 per_request: bool = False) -> None:
    """Write one record per line, or one request document per batch.

    ``per_request`` needs a ``batch_no`` column (see ``assign_batches``), which
    bounds the number of records gathered into one document. A sparse vector or
    namespace that the store type cannot hold is refused: map it first.
    """
    if store_type not in _WRITERS:
        raise ValueError(f"unknown database type: {store_type!r}")
    fields_of, member, keeps = _WRITERS[store_type]
    lost = [c for c in ("sparse", "namespace") if c in df.columns and c not in keeps]
    if lost:
        raise ValueError(f"an export to {store_type} holds no {' and no '.join(lost)}")
    fields = fields_of(df, class_name)
    space = [F.col("namespace")] if "namespace" in df.columns else []
    text = F.to_json(F.struct(*fields)) if len(fields) > 1 else F.to_json(fields[0])
    if per_request:
        _requests(df.select("batch_no", "id", *(space or [F.lit(None).cast("string").alias("namespace")]), text.alias("body")), member).write.mode(mode).text(path)
    elif len(fields) > 1:
        df.select(*fields, *space).write.mode(mode).json(path)
    else:
        df.select(text.alias("value")).write.mode(mode).text(path)


def _requests(rows: DataFrame, member: str) -> DataFrame:
    """One document per batch, and per namespace where records have one: it stands beside the records."""
    gathered = rows.groupBy("batch_no", "namespace").agg(F.sort_array(F.collect_list(F.struct("id", "body"))).alias("rows"))
    joined = F.array_join(F.transform("rows", lambda r: r["body"]), ",")
    beside = F.coalesce(F.concat(F.lit(',"namespace":'), F.regexp_extract(F.to_json(F.struct("namespace")), '^\\{"namespace":(.*)\\}$', 1)), F.lit(""))
    beside = F.when(F.col("namespace").isNull(), "").otherwise(beside)
    return gathered.select(F.concat(F.lit('{"%s":[' % member), joined, F.lit("]"), beside, F.lit("}")).alias("value"))


def write_pinecone(df: DataFrame, path: str, **options) -> None:
    write_export(df, "pinecone", path, **options)


def write_qdrant(df: DataFrame, path: str, **options) -> None:
    write_export(df, "qdrant", path, **options)


def write_weaviate(df: DataFrame, path: str, class_name: str = "Record", **options) -> None:
    write_export(df, "weaviate", path, class_name=class_name, **options)


def write_milvus(df: DataFrame, path: str, **options) -> None:
    write_export(df, "milvus", path, **options)
