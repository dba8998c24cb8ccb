"""Canonical records from exports of each store type, from parquet and from any table.

The exports are JSON: whole pages as the store's API returns them, or one
record per line. ``multiline=True`` reads one JSON document per file. What a
reader cannot take for a record, :func:`read_rejects` lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.functions.vectors import cast_vector
from embedlift.model import RECORD_DDL, SPARSE_DDL

_PINECONE = f"id string, values array<float>, sparse_values {SPARSE_DDL}, metadata variant"
_QDRANT = "id variant, vector array<float>, payload variant"


def _json(spark: SparkSession, path: str, ddl: str, multiline: bool) -> DataFrame:
    return spark.read.schema(ddl).option("multiLine", multiline).json(path)


def _one_or_many(record: Column, page: Column) -> Column:
    """A page's records, or the line itself where it is a single record."""
    return F.explode(F.when(page.isNotNull(), page).otherwise(F.array(record)))


def _present(value: Column) -> Column:
    """A JSON null in place of the metadata means that there is none."""
    return F.when(~F.is_variant_null(value), value)


def _known_id(df: DataFrame) -> DataFrame:
    return df.filter(F.col("id").isNotNull() & (F.col("id") != ""))


def read_pinecone(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Pages ``{vectors: [...]}`` or one record per line; keeps sparse values and namespace."""
    raw = _json(spark, path, f"{_PINECONE}, namespace string, vectors array<struct<{_PINECONE}>>", multiline)
    own = F.struct("id", "values", "sparse_values", "metadata")
    rows = raw.select("namespace", _one_or_many(own, F.col("vectors")).alias("r"))
    return _known_id(rows.select(
        F.col("r.id").alias("id"), F.col("r.values").alias("vector"), _present(F.col("r.metadata")).alias("metadata"),
        F.col("r.sparse_values").alias("sparse"), "namespace"))


def read_qdrant(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Pages ``{result: {points: [...]}}`` or one point per line; ids may be numbers or text."""
    raw = _json(spark, path, f"{_QDRANT}, result struct<points: array<struct<{_QDRANT}>>>", multiline)
    rows = raw.select(_one_or_many(F.struct("id", "vector", "payload"), F.col("result.points")).alias("r"))
    return _known_id(rows.select(
        V.scalar_text(F.col("r.id")).alias("id"), F.col("r.vector").alias("vector"),
        _present(F.col("r.payload")).alias("metadata")))


def read_weaviate(spark: SparkSession, path: str, class_name: str | None = None,
                  multiline: bool = False) -> DataFrame:
    """GraphQL pages ``{data: {Get: [{Class: [...]}]}}`` or one object per line.

    ``id`` and ``vector`` come from ``_additional`` (or the top level of a plain
    object with ``properties``). Items that are no objects and items without an
    id are dropped, vector slots that are no numbers become 0, and a page that
    reports errors fails the read.
    """
    text = spark.read.text(path, wholetext=multiline)
    page = text.select(F.try_parse_json("value").alias("page")).filter(F.col("page").isNotNull())
    errors = F.try_variant_get("page", "$.errors", "array<variant>")
    message = F.coalesce(F.try_variant_get("page", "$.errors[0].message", "string"), F.lit("unknown error"))
    checked = page.select(
        F.when(F.size(errors) > 0, F.raise_error(F.concat(F.lit("page reports an error: "), message)).cast("variant"))
        .otherwise(F.col("page")).alias("page"))
    by_class = V.as_map(F.try_variant_get("page", "$.data.Get[0]", "variant"))
    if class_name is None:
        lists = F.flatten(F.transform(F.map_values(by_class), _items))
    else:
        lists = _items(F.try_element_at(by_class, F.lit(class_name)))
    is_page = F.try_variant_get("page", "$.data", "variant").isNotNull()
    items = checked.select(
        F.explode(F.when(is_page, lists).otherwise(F.array("page"))).alias("item")
    ).filter(V.is_object(F.col("item")))
    plain = F.try_variant_get("item", "$._additional", "variant").isNull()
    record_id = F.coalesce(F.try_variant_get("item", "$._additional.id", "string"),
                           F.when(plain, F.try_variant_get("item", "$.id", "string")))
    raw_vector = F.coalesce(F.try_variant_get("item", "$._additional.vector", "array<variant>"),
                            F.when(plain, F.try_variant_get("item", "$.vector", "array<variant>")))
    properties = F.try_variant_get("item", "$.properties", "variant")
    own = V.to_object(F.map_filter(V.as_map(F.col("item")), lambda k, _: k != "_additional"))
    return _known_id(items.select(
        record_id.alias("id"),
        F.transform(raw_vector, _float_or_zero).alias("vector"),
        F.when(plain & properties.isNotNull(), properties).otherwise(own).alias("metadata")))


def _items(value: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"),
                      F.array().cast("array<variant>"))


def _float_or_zero(x: Column) -> Column:
    number = F.when(V.kind(x).isin("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"), F.try_variant_get(x, "$", "double"))
    return F.coalesce(number, F.lit(0.0)).cast("float")


def read_milvus(spark: SparkSession, path: str, json_field: str = "metadata_json",
                multiline: bool = False) -> DataFrame:
    """Pages ``{data: [...]}`` or one entity per line, with ``id`` and ``embedding``; scalar, dynamic and JSON fields become metadata.

    The JSON field is merged in; a field of its own beats a member of the same name.
    """
    text = spark.read.text(path, wholetext=multiline)
    pages = text.select(F.try_parse_json("value").alias("page")).filter(F.col("page").isNotNull())
    rows = pages.select(_one_or_many(F.col("page"), F.try_variant_get("page", "$.data", "array<variant>")).alias("item"))
    reserved = ("id", "embedding", json_field)
    own = F.map_filter(V.as_map(F.col("item")), lambda k, _: ~k.isin(*reserved))
    inside = V.as_map(V.field(F.col("item"), json_field))
    merged = V.let(own, lambda o: F.map_concat(F.map_filter(inside, lambda k, _: ~F.map_contains_key(o, k)), o))
    return _known_id(rows.select(
        V.scalar_text(F.try_variant_get("item", "$.id", "variant")).alias("id"),
        cast_vector(F.try_variant_get("item", "$.embedding", "array<double>")).alias("vector"),
        V.to_object(merged).alias("metadata")))


_ITEMS = {"pinecone": "$.vectors", "qdrant": "$.result.points", "milvus": "$.data"}


def read_rejects(spark: SparkSession, path: str, store_type: str, multiline: bool = False) -> DataFrame:
    """What the reader of a store type leaves out: ``source_file, message, raw``.

    Lines (or files) that are no JSON, and records without an id. Together with the records of the
    reader this is everything in the export.
    """
    text = spark.read.text(path, wholetext=multiline).select(F.input_file_name().alias("source_file"), F.col("value").alias("raw"))
    pages = text.filter(F.trim("raw") != "").withColumn("page", F.try_parse_json("raw"))
    broken = pages.filter(F.col("page").isNull()).select("source_file", F.lit("not valid JSON").alias("message"), "raw")
    if store_type == "weaviate":
        by_class = V.as_map(F.try_variant_get("page", "$.data.Get[0]", "variant"))
        listed = F.when(F.try_variant_get("page", "$.data", "variant").isNotNull(), F.flatten(F.transform(F.map_values(by_class), _items)))
        record_id = F.coalesce(F.try_variant_get("item", "$._additional.id", "string"), F.try_variant_get("item", "$.id", "string"))
    elif store_type in _ITEMS:
        listed = F.try_variant_get("page", _ITEMS[store_type], "array<variant>")
        record_id = V.scalar_text(F.try_variant_get("item", "$.id", "variant"))
    else:
        raise ValueError(f"unknown database type: {store_type!r}")
    items = pages.filter(F.col("page").isNotNull()).select("source_file", F.explode(F.coalesce(listed, F.array("page"))).alias("item"))
    nameless = items.filter(F.coalesce(record_id, F.lit("")) == "").select("source_file", F.lit("record has no id").alias("message"), F.to_json("item").alias("raw"))
    return broken.unionByName(nameless)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Canonical records stored as parquet."""
    return spark.read.schema(RECORD_DDL).parquet(path)


def records_from(df: DataFrame, record_id: Column | str, vector: Column | str,
                 meta: list[str] | dict[str, Column], keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical records from any table: metadata built from columns."""
    fields = {name: F.col(name) for name in meta} if isinstance(meta, list) else meta
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    packed = F.struct(*[value.alias(name) for name, value in fields.items()])
    return df.select(
        as_column(record_id).cast("string").alias("id"),
        as_column(vector).cast("array<float>").alias("vector"),
        F.to_variant_object(packed).alias("metadata"), *keep)


def records_with_rejects(df: DataFrame, metadata_json: str = "metadata") -> tuple[DataFrame, DataFrame]:
    """Parse JSON text metadata; unreadable text goes to a rejects table."""
    parsed = df.withColumn("_parsed", F.try_parse_json(metadata_json))
    bad = F.col("_parsed").isNull() & F.col(metadata_json).isNotNull()
    good = parsed.filter(~bad).withColumn("metadata", F.col("_parsed")).drop("_parsed")
    rejects = parsed.filter(bad).select(
        F.col("id").alias("record_id"), F.lit("metadata").alias("field"),
        F.lit("metadata is not valid JSON").alias("message"))
    return good, rejects
