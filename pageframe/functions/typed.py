"""Typed reads that tell a missing value, a null and a value of the wrong type apart.

The tests are SQL text: they are long, and a text is one call to the JVM instead of hundreds.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

from pageframe.functions.paths import variant_path
from pageframe.functions.schemas import as_nullable

WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBERS = (*WHOLE_NUMBERS, T.FloatType, T.DoubleType, T.DecimalType)
NESTED = (T.ArrayType, T.MapType, T.StructType)
# Whole numbers below this size are exact as doubles.
EXACT = 2**53

# How a mapped field turned out.
FINE, WRONG, MISSING, NULL, BLOCKED = 0, 1, 2, 3, 4


def quote(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def at(value: str, parts: list[str], ddl: str = "variant") -> str:
    return f"try_variant_get({value}, {quote(variant_path(parts))}, {quote(ddl)})"


def is_object(value: str, parts: list[str] | None = None) -> str:
    return f"{at(value, parts or [], 'struct<>')} IS NOT NULL"


def read(value: str, parts: list[str], dtype: T.DataType) -> str:
    """First read of a field.

    A whole number is read as a double, which keeps its fraction; reading it as an integer
    would cut the fraction off unseen.
    """
    first = T.DoubleType() if isinstance(dtype, WHOLE_NUMBERS) else dtype
    return at(value, parts, as_nullable(first).simpleString())


def settle(first: str, value: str, parts: list[str], dtype: T.DataType) -> str:
    """The typed value from the first read. A fraction gives NULL; a number too large for an
    exact double is read again as an integer."""
    if not isinstance(dtype, WHOLE_NUMBERS):
        return first
    name = dtype.simpleString()
    exact = f"CASE WHEN {first} = floor({first}) THEN try_cast({first} AS {name}) END"
    return f"CASE WHEN abs({first}) < {EXACT} THEN {exact} ELSE {at(value, parts, name)} END"


def leaf_fits(value: str, parts: list[str], dtype: T.DataType) -> str:
    """True if the value converts to the simple type ``dtype`` without loss."""
    typed = at(value, parts, dtype.simpleString())
    kind = f"schema_of_variant({at(value, parts)})"
    if isinstance(dtype, T.StringType):
        return f"({typed} IS NOT NULL AND {kind} <> 'BOOLEAN' AND NOT startswith({kind}, 'OBJECT') AND NOT startswith({kind}, 'ARRAY'))"
    if isinstance(dtype, T.BooleanType):
        return f"({typed} IS NOT NULL AND {kind} = 'BOOLEAN')"
    if isinstance(dtype, WHOLE_NUMBERS):
        same = f"{at(value, parts, 'double')} = CAST({typed} AS DOUBLE)"
        return f"({typed} IS NOT NULL AND {kind} <> 'BOOLEAN' AND {same})"
    if isinstance(dtype, NUMBERS):
        return f"({typed} IS NOT NULL AND {kind} <> 'BOOLEAN')"
    return f"({typed} IS NOT NULL)"


def fits(value: str, parts: list[str], dtype: T.DataType, nullable: bool, depth: int = 0) -> str:
    """True if the value converts to ``dtype`` without loss, all nested values included."""
    x = f"x{depth}"
    if isinstance(dtype, T.VariantType):
        ok = "true"
    elif isinstance(dtype, T.ArrayType):
        items = at(value, parts, "array<variant>")
        ok = f"coalesce(forall({items}, {x} -> {fits(x, [], dtype.elementType, dtype.containsNull, depth + 1)}), false)"
    elif isinstance(dtype, T.MapType):
        items = f"map_values({at(value, parts, 'map<string,variant>')})"
        ok = f"coalesce(forall({items}, {x} -> {fits(x, [], dtype.valueType, dtype.valueContainsNull, depth + 1)}), false)"
    elif isinstance(dtype, T.StructType):
        tests = [is_object(value, parts)]
        tests += [fits(value, [*parts, f.name], f.dataType, f.nullable, depth) for f in dtype]
        ok = "(" + " AND ".join(tests) + ")"
    else:
        ok = leaf_fits(value, parts, dtype)
    absent = str(nullable).lower()
    raw = at(value, parts)
    return f"CASE WHEN {raw} IS NULL OR is_variant_null({raw}) THEN {absent} ELSE {ok} END"


def plain_kinds(dtype: T.DataType) -> str | None:
    """Pattern of the schemas of nested values whose leaves convert without loss where they are not null.

    The schema of a variant is one for all its elements, so a whole array is judged by one match. None
    if ``dtype`` has types or names that it cannot tell; other fields than those of ``dtype`` may be there
    if they are simple.
    """
    if isinstance(dtype, T.ArrayType):
        inner = plain_kinds(dtype.elementType)
        return inner and f"ARRAY<(?:VOID|{inner})>"
    if isinstance(dtype, T.StructType):
        inner = {f.name: plain_kinds(f.dataType) for f in dtype}
        if not inner or None in inner.values() or not all(re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", n) for n in inner):
            return None
        fields = "".join(f"(?:[^<>`]*, )?{n}: (?:VOID|{inner[n]}), " for n in sorted(inner)).removesuffix(", ")
        return f"OBJECT<{fields}(?:, [^<>`]*)?>"
    if isinstance(dtype, WHOLE_NUMBERS):
        return "BIGINT"
    if isinstance(dtype, NUMBERS):
        return r"(?:BIGINT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\))"
    if isinstance(dtype, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "STRING"
    return "BOOLEAN" if isinstance(dtype, T.BooleanType) else None


def has_all(typed: str, dtype: T.DataType, nullable: bool, depth: int = 0) -> str:
    """True if a typed value has no null where there must be none, or where a value might have been lost."""
    x = f"y{depth}"
    there = f"{typed} IS NOT NULL"
    if isinstance(dtype, T.ArrayType):
        ok = f"{there} AND forall({typed}, {x} -> {has_all(x, dtype.elementType, dtype.containsNull, depth + 1)})"
    elif isinstance(dtype, T.StructType):
        ok = " AND ".join([there, *[has_all(f"{typed}.{f.name}", f.dataType, f.nullable, depth) for f in dtype]])
    else:  # strings, doubles and booleans of the kinds of ``plain_kinds`` are never lost
        return "true" if nullable and isinstance(dtype, (T.StringType, T.FloatType, T.DoubleType, T.BooleanType)) else there
    return f"({ok})"


def is_plainly_fine(item: str, typed: str, parts: list[str], field: T.StructField) -> str:
    """A cheap test that holds for most values. If it fails, the field may still be fine."""
    dtype = field.dataType
    if isinstance(dtype, T.StringType):
        fine = f"NOT (startswith({typed}, '{{') OR startswith({typed}, '[') OR {typed} IN ('true', 'false'))"
    elif isinstance(dtype, T.BooleanType):
        fine = f"schema_of_variant({at(item, parts)}) = 'BOOLEAN'"
    elif isinstance(dtype, NUMBERS):
        # true and false convert to 1 and 0; whole numbers of these values need no further look
        fine = f"({typed} NOT IN (0, 1) OR {typed} IN (0, 1) AND schema_of_variant({at(item, parts)}) = 'BIGINT')"
    elif isinstance(dtype, NESTED):
        fine = f"{fits(item, parts, dtype, field.nullable)} AND {typed} IS NOT NULL"
        if (kinds := plain_kinds(dtype)) is not None:
            seen = f"schema_of_variant({at(item, parts)}) RLIKE {quote(f'^{kinds}$')}"
            fine = f"(coalesce({seen} AND {has_all(typed, dtype, False)}, false) OR {fine})"
    else:
        fine = f"{typed} IS NOT NULL"
    fine = f"coalesce({fine}, false)"
    if field.nullable and len(parts) < 2:
        fine = f"({fine} OR {at(item, parts)} IS NULL)"
    return fine


def field_state(item: str, parts: list[str], field: T.StructField) -> str:
    """State of a mapped field of an element."""
    raw = at(item, parts)
    if isinstance(field.dataType, (*NESTED, T.VariantType)):
        good = fits(item, parts, field.dataType, field.nullable)
    else:
        good = leaf_fits(item, parts, field.dataType)
    missing = str(FINE if field.nullable else MISSING)
    for depth in range(1, len(parts)):
        here = at(item, parts[:depth])
        blocked = f"{here} IS NOT NULL AND NOT is_variant_null({here}) AND NOT ({is_object(item, parts[:depth])})"
        missing = f"CASE WHEN {blocked} THEN {BLOCKED} ELSE {missing} END"
    return (
        f"CASE WHEN {raw} IS NULL THEN {missing} "
        f"WHEN is_variant_null({raw}) THEN {FINE if field.nullable else NULL} "
        f"WHEN {good} THEN {FINE} ELSE {WRONG} END"
    )


def text_as(text: str, field: T.StructField) -> str:
    """A text value as the type of ``field``; NULL if it does not convert.

    An empty text is NULL, but for a text field that must not be null.
    """
    if isinstance(field.dataType, T.StringType):
        return f"nullif({text}, '')" if field.nullable else text
    if isinstance(field.dataType, T.BinaryType):
        return f"CAST(nullif({text}, '') AS BINARY)"
    if isinstance(field.dataType, T.BooleanType):
        return f"CASE lower({text}) WHEN 'true' THEN true WHEN 'false' THEN false END"
    return f"try_cast(nullif({text}, '') AS {field.dataType.simpleString()})"


def text_is_plainly_fine(text: str, typed: str, field: T.StructField) -> str:
    """True if a text value, already read as ``typed``, is no error of its field."""
    if not field.nullable:
        return f"{typed} IS NOT NULL"
    if isinstance(field.dataType, T.StringType):
        return "true"
    return f"({typed} IS NOT NULL OR coalesce({text}, '') = '')"


def aside(value: str, name: str, expression: str) -> str:
    """``expression`` over ``value`` under ``name``, evaluated outside the generated code.

    Meant for large expressions that few rows need: inside a stage they would push its
    methods over the size that the JVM compiles.
    """
    return f"get(transform(array({value}), {name} -> {expression}), 0)"
