"""Column builders over VARIANT metadata.

Every rewrite is one expression per record: no explode, no regrouping, no
Python. ``let`` evaluates a sub-expression once where it is used repeatedly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VMAP = "map<string,variant>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable so that it is computed once per row."""
    return F.transform(F.array(value), body)[0]


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters and projections must not compute again.

    A generator of one row stands between: predicates on the column stay above
    it instead of being rewritten in terms of ``value``.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def rows_of(df: DataFrame, found: Column, name: str, keep: list[Column]) -> DataFrame:
    """One row per element of a costly array, which is computed once.

    ``explode`` alone would add a filter on the size of the array and so
    compute it twice.
    """
    return df.select(*keep, F.explode_outer(found).alias(name)).filter(F.col(name).isNotNull())


def field_path(name: str) -> str:
    """Path of a top-level field, whatever characters its name has."""
    quote = "'" if '"' in name else '"'
    if quote in name:
        raise ValueError(f"field name mixes both kinds of quotes: {name!r}")
    return f"$[{quote}{name}{quote}]"


def field(metadata: Column, name: str, as_type: str = "variant") -> Column:
    """Field value; SQL NULL when the field is absent (a JSON null stays a value)."""
    return F.try_variant_get(metadata, field_path(name), as_type)


def empty_map() -> Column:
    return F.create_map().cast(VMAP)


def as_map(metadata: Column) -> Column:
    """Top-level fields as a map; empty for NULL or anything that is no object."""
    return F.coalesce(F.try_variant_get(metadata, "$", VMAP), empty_map())


def to_object(fields: Column) -> Column:
    return F.to_variant_object(fields)


def type_text(value: Column) -> Column:
    """Type of a value in words: ``OBJECT<...>``, ``ARRAY<...>``, ``STRING``, ...; ``VOID`` for null."""
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def kind(value: Column) -> Column:
    """Leading type name of a value: OBJECT, ARRAY, STRING, BIGINT, DOUBLE, DECIMAL, BOOLEAN, VOID."""
    return F.substring_index(F.substring_index(type_text(value), "<", 1), "(", 1)


def is_object(value: Column) -> Column:
    return F.startswith(type_text(value), F.lit("OBJECT"))


def nesting(df: DataFrame, column: str = "metadata", most: int = 64) -> int:
    """Levels of objects in a variant column: 0 without any field, 1 for flat objects.

    Counted on the distinct types of the values; arrays count as a level, so the answer may be
    larger but never smaller. Deeper nesting than ``most`` is an error.
    """
    brackets = F.regexp_replace(F.regexp_replace(type_text(F.col(column)), "`[^`]*`", ""), "[^<>]", "")
    step = lambda a, c: F.struct((a["now"] + F.when(c == "<", 1).otherwise(-1)).alias("now"), F.greatest(a["most"], a["now"] + F.when(c == "<", 1).otherwise(0)).alias("most"))
    forms = df.select(brackets.alias("b")).where("b <> ''").groupBy("b").agg(F.count(F.lit(1)))
    deepest = forms.select(F.aggregate(F.filter(F.split("b", ""), lambda c: c != ""), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda a: a["most"]).alias("d")).agg(F.max("d")).first()[0] or 0
    if deepest > most:
        raise ValueError(f"{column} is nested in {deepest} levels; at most {most} are handled")
    return deepest


def is_array(value: Column) -> Column:
    return F.startswith(type_text(value), F.lit("ARRAY"))


def pair(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def flatten_map(fields: Column, sep: str = ".", depth: int = 1) -> Column:
    """Lift the members of nested objects up by ``depth`` levels.

    Arrays and scalars stay as they are and empty objects vanish. Of entries
    that end up with one key, the one lifted least counts (so a key written out
    literally beats a lifted one), then the last.
    """
    def entry(key: Column, value: Column, lifted: Column) -> Column:
        return F.struct(key.alias("key"), value.alias("value"), lifted.alias("lifted"))

    def members(e: Column) -> Column:
        return F.transform(F.map_entries(as_map(e["value"])), lambda f: entry(
            F.concat(e["key"], F.lit(sep), f["key"]), f["value"], e["lifted"] + 1))

    def pick(es: Column, key: Column) -> Column:
        def least(same: Column) -> Column:
            fewest = F.array_min(F.transform(same, lambda e: e["lifted"]))
            return F.element_at(F.filter(same, lambda e: e["lifted"] == fewest), -1)["value"]
        return let(F.filter(es, lambda e: e["key"] == key), least)

    def pack(es: Column) -> Column:
        keys = F.transform(es, lambda e: e["key"])
        return let(F.array_distinct(keys), lambda distinct: F.map_from_arrays(distinct, F.when(
            F.size(distinct) == F.size(es), F.transform(es, lambda e: e["value"]))
            .otherwise(F.transform(distinct, lambda key: pick(es, key)))))

    def lift(m: Column) -> Column:
        es = F.transform(F.map_entries(m), lambda e: entry(e["key"], e["value"], F.lit(0)))
        for _ in range(depth):
            es = F.flatten(F.transform(es, lambda e: F.when(is_object(e["value"]), members(e)).otherwise(F.array(e))))
        return let(es, pack)

    # Flat metadata, the usual case, passes through untouched.
    return let(fields, lambda m: F.when(F.exists(F.map_values(m), is_object), lift(m)).otherwise(m))


def unflatten_map(fields: Column, sep: str = ".", depth: int = 1) -> Column:
    """Gather ``a.b`` keys below ``a``; inverse of :func:`flatten_map`.

    A prefix that also exists as a key of its own is left alone, so no value is lost.
    """
    def gather(m: Column) -> Column:
        def grouped(entries: Column) -> Column:
            names = F.transform(entries, lambda e: e["key"])

            def head(key: Column) -> Column:
                at = F.instr(key, sep)
                candidate = F.substring(key, F.lit(1), at - 1)
                return F.when((at > 1) & (at + len(sep) - 1 < F.length(key)) & ~F.array_contains(names, candidate),
                              candidate)

            plain = F.filter(entries, lambda e: head(e["key"]).isNull())
            heads = F.array_distinct(F.filter(F.transform(names, head), lambda h: h.isNotNull()))

            def below(h: Column) -> Column:
                members = F.filter(entries, lambda e: head(e["key"]) == h)
                inner = F.map_from_entries(F.transform(members, lambda e: pair(
                    F.substring(e["key"], F.length(h) + len(sep) + 1, F.length(e["key"])), e["value"])))
                if depth > 1:
                    inner = unflatten_map(inner, sep, depth - 1)
                return pair(h, to_object(inner))

            return F.map_from_entries(F.concat(plain, F.transform(heads, below)))
        return let(F.map_entries(m), grouped)

    return gather(fields)


def narrow_number(value: Column) -> Column:
    """Whole floating numbers become integers; everything else is unchanged."""
    as_double = F.try_variant_get(value, "$", "double")
    as_long = F.try_variant_get(value, "$", "bigint")
    return (F.when(kind(value).isin("DOUBLE", "FLOAT", "DECIMAL") & (as_double == F.floor(as_double))
                   & as_long.isNotNull(), as_long.cast("variant"))
            .otherwise(value))


def to_json_text(value: Column) -> Column:
    """A string value holding the JSON text."""
    return F.to_json(value).cast("variant")


def scalar_text(value: Column) -> Column:
    """Text of a scalar without quotes, JSON text of anything else."""
    return F.when(kind(value) == "STRING", F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value))


def arrays_to_json(fields: Column, nested: bool = True) -> Column:
    """Array values as JSON text, for stores without arrays."""
    return F.transform_values(fields, lambda _, v: F.when(is_array(v), to_json_text(v)).otherwise(v))


def derive_uuid(record_id: Column) -> Column:
    """A UUID from the SHA-256 of the id; ids that are UUIDs already stay."""
    digest = F.substring(F.sha2(record_id, 256), 1, 32)
    made = F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(is_uuid(record_id), record_id).otherwise(made)


def is_uuid(record_id: Column) -> Column:
    return record_id.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")


def is_date_text(value: Column) -> Column:
    """A string value that looks like an ISO date or time."""
    return F.try_variant_get(value, "$", "string").rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?$")


def logical_type(value: Column, name: Column | None = None) -> Column:
    """Logical type name of a value: string, int, float, boolean, string[], array, object, date, null.

    ``name`` is the value's :func:`type_text` where that is a column already.
    """
    name = type_text(value) if name is None else name
    return (F.when(name == "STRING", F.when(is_date_text(value), "date").otherwise("string"))
            .when(name == "BIGINT", "int")
            .when(name.isin("DOUBLE", "FLOAT") | F.startswith(name, F.lit("DECIMAL")), "float")
            .when(name == "BOOLEAN", "boolean")
            .when(name == "VOID", "null")
            .when(F.startswith(name, F.lit("OBJECT")), "object")
            .when(name == "ARRAY<STRING>", "string[]")
            .when(F.startswith(name, F.lit("ARRAY")), "array")
            .otherwise("string"))
