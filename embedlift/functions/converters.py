"""Named value converters: VARIANT in, VARIANT out, NULL when it cannot be done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from embedlift.functions import variants as V
from embedlift.functions.text import rfc3339

Converter = Callable[[Column], Column]
_registry: dict[str, Converter] = {}
_changes = 0


def register_converter(name: str, build: Converter) -> None:
    """Make ``build`` usable by name in mappings.

    ``build`` gets the VARIANT value column and returns a VARIANT column; a NULL
    result for a present value marks the record as failed. Built-in functions
    keep the work in the JVM, a pandas UDF works as well.
    """
    global _changes
    _registry[name] = build
    _changes += 1


def registrations() -> int:
    """Grows with every registration; columns built before are out of date."""
    return _changes


def converter(name: str) -> Converter:
    if name not in _registry:
        raise ValueError(f"unknown converter: {name!r}")
    return _registry[name]


def known_converters() -> tuple[str, ...]:
    return tuple(sorted(_registry))


def _keep_null(build: Converter) -> Converter:
    """A JSON null is carried through instead of being a failure."""
    return lambda v: F.when(V.kind(v) == "VOID", v).otherwise(build(v))


def _cast(type_name: str) -> Converter:
    return lambda v: F.try_variant_get(v, "$", type_name).cast("variant")


def _string_list(v: Column) -> Column:
    items = F.try_variant_get(v, "$", "array<variant>")
    return F.to_variant_object(F.transform(F.coalesce(items, F.array(v)), V.scalar_text))


def _iso_date(v: Column) -> Column:
    ts = F.try_to_timestamp(F.try_variant_get(v, "$", "string"))
    return rfc3339(ts).cast("variant")


register_converter("auto_number", V.narrow_number)
register_converter("to_int", _keep_null(_cast("bigint")))
register_converter("to_double", _keep_null(_cast("double")))
register_converter("to_boolean", _keep_null(_cast("boolean")))
register_converter("to_string", _keep_null(lambda v: V.scalar_text(v).cast("variant")))
register_converter("to_string_list", _keep_null(_string_list))
register_converter("to_iso_date", _keep_null(_iso_date))
register_converter("to_json_text", _keep_null(V.to_json_text))
