"""Field tables to mappings: matching, conversions, recommendations, target schemas.

A field table is ``(collection, field, type)``. Many collections are handled in
one plan; keys always include the field name, so one large collection spreads
over all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.functions.text import valid_database_type
from embedlift.model import (OTHER_FIELD, OTHER_PATH, PROFILES, common_field_frame, index_frame, path_frame,
                             type_frame)
from embedlift.operators.filters import skip_fields

# Checked in this order; the first that fails is the one reported.
MAPPING_RULES = [
    (lambda s, t: not s, lambda s, t: "source database type must be specified"),
    (lambda s, t: not t, lambda s, t: "target database type must be specified"),
    (lambda s, t: s == t, lambda s, t: "source and target databases must be different"),
    (lambda s, t: s not in PROFILES, lambda s, t: f"invalid source database type: {s}"),
    (lambda s, t: t not in PROFILES, lambda s, t: f"invalid target database type: {t}"),
]


def _empty(c: Column) -> Column:
    return c.isNull() | (c == "")


def create_mapping(source_fields: DataFrame, target_fields: DataFrame, fuzzy_distance: int = 0) -> DataFrame:
    """``collection, source_field, target_field, match_kind`` for every source field.

    Same name first, then the same name in other case, then (if asked for)
    names at a small edit distance; unmatched fields have no target.
    """
    if source_fields is None or target_fields is None:
        raise ValueError("source and target schemas must not be nil")
    source = skip_fields(source_fields).select("collection", F.col("field").alias("source_field")).distinct()
    target = target_fields.select("collection", F.col("field").alias("target_field")).distinct()
    s = source.withColumn("_name", F.lower("source_field"))
    t = target.withColumn("_name", F.lower("target_field"))
    exact = F.col("source_field") == F.col("target_field")
    best = (s.join(t, ["collection", "_name"], "left")
            .groupBy("collection", "source_field")
            .agg(F.min_by("target_field", F.struct(~exact, "target_field")).alias("target_field")))
    kind = (F.when(F.col("target_field").isNull(), "unmatched")
            .when(F.col("source_field") == F.col("target_field"), "exact").otherwise("case"))
    mapping = best.withColumn("match_kind", kind)
    if not fuzzy_distance:
        return mapping
    free = target.join(mapping.select("collection", "target_field").filter(F.col("target_field").isNotNull()),
                       ["collection", "target_field"], "left_anti")
    near = fuzzy_matches(mapping.filter(F.col("match_kind") == "unmatched").select("collection", "source_field"),
                         free, fuzzy_distance)
    joined = mapping.join(near.withColumnRenamed("target_field", "_near"), ["collection", "source_field"], "left")
    return joined.select(
        "collection", "source_field", F.coalesce("target_field", "_near").alias("target_field"),
        F.when(F.col("target_field").isNull() & F.col("_near").isNotNull(), "fuzzy")
        .otherwise(F.col("match_kind")).alias("match_kind"))


def plain_name(name: Column) -> Column:
    """Name for fuzzy comparison: lower case, without ``_`` and ``-``."""
    return F.lower(F.translate(name, "_-", ""))


def _deletions(name: Column, distance: int) -> Column:
    """The name and all forms of it with up to ``distance`` characters left out."""
    forms = F.array(name)
    for _ in range(distance):
        forms = V.let(forms, lambda fs: F.array_distinct(F.concat(fs, F.flatten(F.transform(fs, lambda f: F.when(
            F.length(f) > 0, F.transform(F.sequence(F.lit(1), F.length(f)), lambda i: F.concat(
                F.substring(f, F.lit(1), i - 1), F.substring(f, i + 1, F.length(f)))))
            .otherwise(F.array().cast("array<string>")))))))
    return forms


def fuzzy_matches(source: DataFrame, target: DataFrame, distance: int = 2) -> DataFrame:
    """Best target within an edit distance for each source field.

    Two names within distance ``d`` share a form with at most ``d`` characters
    left out, so an equi-join on such forms finds all candidates without
    comparing every pair of a collection. The edit distance then decides.
    """
    s = source.withColumn("_form", F.explode(_deletions(plain_name(F.col("source_field")), distance)))
    t = target.withColumn("_form", F.explode(_deletions(plain_name(F.col("target_field")), distance)))
    steps = F.levenshtein(plain_name(F.col("source_field")), plain_name(F.col("target_field")), distance)
    candidates = (s.join(t, ["collection", "_form"]).withColumn("distance", steps)
                  .filter(F.col("distance") >= 0))
    return (candidates.groupBy("collection", "source_field")
            .agg(F.min(F.struct("distance", "target_field")).alias("b"))
            .select("collection", "source_field", F.col("b.target_field").alias("target_field"),
                    F.col("b.distance").alias("distance")))


def attach_conversions(mapping: DataFrame, source_type: Column | str, target_type: Column | str) -> DataFrame:
    """Converter of every mapped field by migration path."""
    as_col = lambda c: F.lit(c) if isinstance(c, str) else c
    src, dst = as_col(source_type), as_col(target_type)
    doubles = [p.name for p in PROFILES.values() if p.integers_as_double]
    others = [p.name for p in PROFILES.values() if not p.integers_as_double]
    narrowing = src.isin(*doubles) & dst.isin(*others) & F.col("target_field").isNotNull()
    return (mapping.withColumn("from_type", F.when(narrowing, "float64"))
            .withColumn("to_type", F.when(narrowing, "auto"))
            .withColumn("converter", F.when(narrowing, "auto_number")))


def validate_mapping(mappings: DataFrame) -> DataFrame:
    """Column ``error`` with the first failing rule of each mapping, NULL when valid.

    Input: ``source_type, target_type`` and optionally ``is_null`` for mappings that do not exist.
    """
    src, dst = F.col("source_type"), F.col("target_type")
    missing = F.col("is_null") if "is_null" in mappings.columns else F.lit(False)
    error = (F.when(missing, "mapping cannot be nil")
             .when(_empty(src), "source database type must be specified")
             .when(_empty(dst), "target database type must be specified")
             .when(src == dst, "source and target databases must be different")
             .when(~valid_database_type(src), F.concat(F.lit("invalid source database type: "), src))
             .when(~valid_database_type(dst), F.concat(F.lit("invalid target database type: "), dst)))
    return mappings.withColumn("error", error)


def infer_schema(df: DataFrame, sample_rate: float | None = None, max_depth: int | None = None,
                 keys: tuple[str, ...] = ()) -> DataFrame:
    """Metadata fields found in records: ``path, type, n_values`` (after grouping ``keys``).

    Nested objects are followed to the depth that exists, found out in a pass over their types
    first, or to ``max_depth``. A sample, if asked for, is
    chosen by a hash of the id and so is the same on every run.

    Fields become rows level by level in one pass and are counted per task by
    the whole chain of names and types, of which there are few; the chains are
    taken apart after that.
    """
    if sample_rate is not None:
        from embedlift.operators.validate import sampled
        df = sampled(df, sample_rate)
    max_depth = max_depth or max(1, V.nesting(df))
    rows = df.select(*keys, F.col("metadata").alias("_value0"), V.type_text(F.col("metadata")).alias("_text0"))
    chain = []
    for level in range(1, max_depth + 1):
        parent = F.col(f"_value{level - 1}")
        members = df.sparkSession.tvf.variant_explode_outer(
            F.when(F.startswith(f"_text{level - 1}", F.lit("OBJECT")), parent).outer()).toDF(f"_pos{level}", f"_key{level}", f"_value{level}")
        value, text = F.col(f"_value{level}"), F.col(f"_text{level}")
        rows = rows.lateralJoin(members).withColumn(f"_text{level}", V.type_text(value)).withColumn(
            f"_type{level}", F.when(F.col(f"_key{level}").isNotNull(), V.logical_type(value, text)))
        chain += [f"_key{level}", f"_type{level}"]
    # An object of n members fills n rows; it counts once, with the row of its first member.
    firsts, first = [], F.lit(True)
    for level in range(max_depth, 0, -1):
        firsts.append(F.count_if(first).alias(f"_n{level}"))
        first = first & (F.coalesce(f"_pos{level}", F.lit(0)) == 0)
    counted = rows.groupBy(*keys, *chain).agg(*firsts)
    fields = F.array(*[
        F.struct(F.concat_ws(".", *[f"_key{i}" for i in range(1, level + 1)]).alias("path"),
                 F.col(f"_type{level}").alias("type"), F.col(f"_n{level}").alias("n"))
        for level in range(1, max_depth + 1)])
    found = counted.select(*keys, F.explode(fields).alias("f")).filter("f.type IS NOT NULL AND f.n > 0")
    return (found.groupBy(*keys, "f.path", "f.type").agg(F.sum("f.n").alias("n_values"))
            .select(*keys, "path", "type", "n_values"))


def field_profile(inferred: DataFrame, total: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per field: main type, number of types, null count, fill ratio.

    ``total`` has the record count per ``keys`` (one row when there are none).
    """
    value_rows = F.when(F.col("type") != "null", F.col("n_values"))
    per_field = inferred.groupBy(*keys, "path").agg(
        F.max_by("type", F.struct(F.when(F.col("type") == "null", 0).otherwise(F.col("n_values")), "type")).alias("type"),
        F.count_if(F.col("type") != "null").alias("n_types"),
        F.coalesce(F.sum(value_rows), F.lit(0)).alias("n_filled"),
        F.coalesce(F.sum(F.when(F.col("type") == "null", F.col("n_values"))), F.lit(0)).alias("n_null"))
    joined = (per_field.join(total, list(keys)) if keys
              else per_field.withColumn("n_records", total.select("n_records").scalar()))
    return joined.withColumn("fill_ratio", F.when(F.col("n_records") > 0, F.col("n_filled") / F.col("n_records")))


def target_fields(fields: DataFrame, target: str) -> DataFrame:
    """Type of each field in the target: ``collection, field, type, target_type``."""
    matrix = type_frame(fields.sparkSession).filter(F.col("profile") == target).drop("profile")
    logical = F.when(F.col("type") == "array", "string[]").otherwise(F.col("type"))
    return (fields.withColumn("logical", logical).join(matrix, "logical", "left")
            .withColumn("target_type", F.coalesce("target_type", F.lit(dict(_fallback())[target])))
            .select("collection", "field", "type", "target_type"))


def _fallback():
    from embedlift.model import TYPE_MATRIX
    strings = next(row for row in TYPE_MATRIX if row[0] == "string")
    return list(zip(PROFILES, strings[1:]))


def generate_target_schema(fields: DataFrame, target: str) -> DataFrame:
    """JSON definition per collection. One row per distinct field is gathered, never record rows."""
    typed = target_fields(fields, target).select("collection", "field", "target_type").distinct()
    if target == "weaviate":
        item = F.struct(F.col("field").alias("name"), F.array("target_type").alias("dataType"))
        member, title = "properties", "class"
    else:
        item = F.struct(F.col("field").alias("name"), F.col("target_type").alias("type"))
        member, title = "fields", "collection"
    gathered = typed.groupBy("collection").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return gathered.select("collection", F.to_json(F.struct(
        F.col("collection").alias(title), F.col("items").alias(member))).alias("definition"))


def path_confidence(requests: DataFrame) -> DataFrame:
    """Confidence and warnings of each requested path (``source_type, target_type``)."""
    joined = requests.join(path_frame(requests.sparkSession), ["source_type", "target_type"], "left")
    return joined.select(
        *requests.columns, F.coalesce("confidence", F.lit(OTHER_PATH[0])).alias("overall_confidence"),
        F.coalesce("warnings", F.array(*[F.lit(w) for w in OTHER_PATH[1]])).alias("warnings"))


def path_warnings(requests: DataFrame) -> DataFrame:
    """One row per warning: the request columns, ``position`` from 1, ``warning``."""
    rated = path_confidence(requests)
    return rated.select(*requests.columns, F.posexplode("warnings").alias("position", "warning")).withColumn(
        "position", F.col("position") + 1)


def recommend_error(requests: DataFrame) -> DataFrame:
    src, dst = F.col("source_type"), F.col("target_type")
    return requests.withColumn("error", F.when(_empty(src), "source_type is required")
                               .when(_empty(dst), "target_type is required")
                               .when(src == dst, "source_type and target_type must be different"))


def recommend_schema(requests: DataFrame, fields: DataFrame) -> DataFrame:
    """Recommended mapping rows of each valid request.

    ``requests``: ``request_id, source_type, target_type``; ``fields``:
    ``request_id, field``. The common fields are always recommended, every
    other source field by its own name with less confidence.
    """
    valid = recommend_error(requests).filter(F.col("error").isNull()).select("request_id")
    common = common_field_frame(requests.sparkSession)
    names = F.array(*[F.struct(F.lit(f).alias("source_field"), F.lit(c).alias("confidence"), F.lit(n).alias("notes"))
                      for f, c, n in _common_rows()])
    always = valid.select("request_id", F.explode(names).alias("c")).select("request_id", "c.*")
    own = (fields.select("request_id", F.col("field").alias("source_field")).distinct()
           .join(common.select("source_field"), "source_field", "left_anti")
           .join(valid, "request_id", "left_semi")
           .select("request_id", "source_field", F.lit(OTHER_FIELD[0]).alias("confidence"),
                   F.lit(OTHER_FIELD[1]).alias("notes")))
    return (always.unionByName(own)
            .withColumn("target_field", F.col("source_field"))
            .withColumn("conversion_needed", F.lit(False)))


def _common_rows():
    from embedlift.model import COMMON_FIELDS
    return COMMON_FIELDS


def map_index_config(catalog: DataFrame, target: str) -> DataFrame:
    """Translate index settings of collections to the target.

    ``catalog``: ``collection, profile, concept, name, value``. For a metric the
    value is the vendor's metric name, for a parameter the number is kept.
    Settings without a counterpart have NULL and a warning.
    """
    matrix = index_frame(catalog.sparkSession)
    known = matrix.select("concept", "logical", "profile", F.col("name").alias("_name"))
    wanted = matrix.filter(F.col("profile") == target).select(
        "concept", "logical", F.col("name").alias("target_name"), F.col("default").alias("target_default"))
    is_metric = F.col("concept") == "metric"
    own_name = F.when(is_metric, F.col("value")).otherwise(F.col("name"))
    rows = (catalog.withColumn("_name", own_name).join(known, ["concept", "profile", "_name"], "left")
            .join(F.broadcast(wanted), ["concept", "logical"], "left"))
    value = F.when(is_metric, F.col("target_name")).when(
        F.col("target_name").isNotNull(), F.coalesce(F.col("value"), F.col("target_default").cast("string")))
    warning = F.when(F.col("target_name").isNull(), F.concat(
        F.lit("no counterpart in "), F.lit(target), F.lit(" for "), F.col("concept"), F.lit(" "), own_name))
    squared = F.when((F.lit(target) == "weaviate") & (F.col("logical") == "euclidean"),
                     "distance is squared in the target")
    return rows.select("collection", "concept", "name", F.col("value").alias("source_value"),
                       F.when(is_metric, F.lit("metric")).otherwise(F.col("target_name")).alias("target_name"),
                       value.alias("target_value"), F.coalesce(warning, squared).alias("warning"))
