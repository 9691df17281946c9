"""Slash paths over JSON documents, compiled to variant paths on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_path(path: str | None) -> list[str]:
    """Parts of a slash path; blanks around it and leading or trailing slashes do not count."""
    stripped = (path or "").strip().strip("/")
    return stripped.split("/") if stripped else []


def variant_path(parts: Sequence[str]) -> str:
    """Variant path of ``parts``; every part is quoted, so keys may hold dots and blanks."""
    out = "$"
    for part in parts:
        if '"' not in part:
            out += f'["{part}"]'
        elif "'" not in part:
            out += f"['{part}']"
        else:
            raise ValueError(f"a JSON key with both kinds of quotes cannot be addressed: {part}")
    return out


def variant_at(value: Column, parts: Sequence[str], ddl: str = "variant") -> Column:
    """Read ``parts`` of a variant as ``ddl``; NULL if it is absent or does not convert."""
    return F.try_variant_get(value, variant_path(parts), ddl)


def is_object(value: Column, parts: Sequence[str] = ()) -> Column:
    """True if the variant holds an object at ``parts`` (no field is read)."""
    return variant_at(value, parts, "struct<>").isNotNull()


def as_array(value: Column, parts: Sequence[str] = ()) -> Column:
    """Elements of the array at ``parts``; NULL if there is no array."""
    return variant_at(value, parts, "array<variant>")


def json_path_get(value: Column, path: str | None) -> Column:
    """Walk a slash path as far as it goes.

    Gives ``struct(value, retrieved_path, unretrieved_path)``. The walk stops at the first
    part that is missing (``value`` is NULL) or at a value that is not an object (``value``
    is that value, for instance the array in the middle of the path).
    """
    parts = split_path(path)

    def outcome(found: int, result: Column) -> Column:
        return F.struct(
            result.alias("value"),
            F.lit("/" + "/".join(parts[:found])).alias("retrieved_path"),
            F.lit("/" + "/".join(parts[found:])).alias("unretrieved_path"),
        )

    whole = variant_at(value, parts)
    walk = F.when(whole.isNotNull(), outcome(len(parts), whole))
    for depth in range(len(parts)):
        here = variant_at(value, parts[:depth])
        if depth:
            walk = walk.when(here.isNull(), outcome(depth - 1, F.lit(None).cast("variant")))
        walk = walk.when(~is_object(value, parts[:depth]), outcome(depth, here))
    if parts:
        walk = walk.otherwise(outcome(len(parts) - 1, F.lit(None).cast("variant")))
    return walk


def json_primitive(value: Column, path: str | None) -> Column:
    """Text of the primitive at ``path``; NULL if it is absent, null, an object or an array."""
    parts = split_path(path)
    raw = variant_at(value, parts)
    kind = F.schema_of_variant(raw)
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(raw.isNotNull() & ~F.is_variant_null(raw) & ~nested, variant_at(value, parts, "string"))
