"""JSON pages: result path, element mapping, typed-or-error conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageframe.functions.paths import as_array, is_object, split_path, variant_at
from pageframe.functions.typed import (
    BLOCKED,
    MISSING,
    NULL,
    WRONG,
    aside,
    at,
    field_state,
    is_plainly_fine,
    quote,
    read,
    settle,
)
from pageframe.operators.entries import IS_SUCCESS, NOT_ALL_FOUND, PAGE, explode_entries, finish, line_error, page_problem
from pageframe.operators.errors import make_error


def parse_document(text: Column, lenient: bool = False) -> Column:
    """A body as a variant, NULL if it is no JSON. Lenient reading allows bare names and single quotes."""
    if not lenient:
        return F.try_parse_json(text)
    options = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true", "mode": "PERMISSIVE"}
    return F.from_json(text, "variant", options)


def result_items(doc: Column, parts: list[str]) -> Column:
    """Elements the result path leads to; NULL if it leads to neither an array nor an object.

    The path is followed up to the first array; an object at its end counts as one element.
    """
    arrays = [as_array(doc, parts[:depth]) for depth in range(len(parts) + 1)]
    single = F.when(is_object(doc, parts), F.array(variant_at(doc, parts)))
    return F.coalesce(*arrays, single)


def result_depth(doc: Column, parts: list[str]) -> Column:
    """How many parts of the result path lie in front of the array; the rest applies per element."""
    depth = F.lit(len(parts))
    for d in reversed(range(len(parts))):
        depth = F.when(as_array(doc, parts[:d]).isNotNull(), F.lit(d)).otherwise(depth)
    return depth


def json_entries(
    pages: DataFrame,
    schema: T.StructType,
    handling: str,
    result_path: str | None = None,
    mapping: dict[str, str] | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Records of JSON pages. Fields without a mapping are read from ``/<field name>``."""
    mapping = mapping or {}
    parts = split_path(result_path)
    paths = [split_path(mapping.get(f.name, "/" + f.name)) for f in schema]

    doc = F.col("doc")
    docs = pages.select(*PAGE, "status", "text", F.when(F.expr(IS_SUCCESS), parse_document(F.col("text"), lenient)).alias("doc"))
    found = docs.select(
        *PAGE,
        "status",
        "text",
        doc.isNull().alias("no_json"),
        result_items(doc, parts).alias("items"),
        result_depth(doc, parts).alias("depth"),
    )
    problem = page_problem(
        ("no_json", "The page is not valid JSON"),
        ("items IS NULL", f"No object or array found by json path '{result_path or '/'}'"),
    )
    rows = explode_entries(found.selectExpr(*PAGE, "items", "depth", f"{problem} AS page_error"), "depth")

    inner = F.col("entry")
    for d in range(len(parts)):
        inner = F.when(F.col("depth") == d, variant_at(F.col("entry"), parts[d:])).otherwise(inner)
    rows = rows.select(*PAGE, "page_error", "entry_no", is_object(F.col("entry")).alias("is_object"), inner.alias("item"))

    values = [f"v{i}" for i in range(len(schema))]
    fields = list(zip(paths, schema, values, strict=True))
    first = rows.selectExpr("*", *[f"{read('item', p, f.dataType)} AS {v}" for p, f, v in fields])
    typed = first.selectExpr(
        *PAGE,
        "page_error",
        "entry_no",
        "is_object",
        "item",
        *[f"{settle(v, 'item', p, f.dataType)} AS {v}" for p, f, v in fields],
    )
    plain = " AND ".join(["is_object", *[is_plainly_fine("item", v, p, f) for p, f, v in fields]])
    problem = f"CASE WHEN page_error IS NULL AND NOT ({plain}) THEN {element_error(schema, paths)} END"
    return finish(typed, schema, problem, handling, values, keeps_partial=True)


def element_error(schema: T.StructType, paths: list[list[str]]) -> str:
    """SQL for the error of an element, NULL if there is none.

    A field that is null where it must not be, or of another type, gives code 0; required
    fields that were not found give code 1, and the record stays with the error.
    """
    fields = list(zip(paths, schema, strict=True))
    body = ", ".join(f"{quote(f.name)}, {at('e.item', p)}" for p, f in fields)
    states = ", ".join(field_state("e.item", p, f) for p, f in fields)
    names = ", ".join(quote(f.name) for f in schema)
    kinds = ", ".join(quote(f.dataType.simpleString()) for f in schema)
    seen = (
        f"named_struct('is_object', e.is_object, 'states', array({states}), 'body', "
        f"coalesce(to_json(named_struct({body}), map('ignoreNullFields', 'false')), 'null'))"
    )
    first_bad = f"CAST(array_position(transform(s.states, x -> x IN ({WRONG}, {NULL})), true) - 1 AS INT)"
    reason = (
        "CASE WHEN NOT s.is_object THEN 'the element is not an object' "
        f"WHEN exists(s.states, x -> x IN ({WRONG}, {NULL})) THEN concat('field \\'', get(array({names}), {first_bad}), '\\' ', "
        f"CASE WHEN get(s.states, {first_bad}) = {WRONG} THEN concat('is not of type ', get(array({kinds}), {first_bad})) "
        "ELSE 'is null, which its schema does not allow' END) END"
    )
    wrong, partial = line_error("s.body", "r"), make_error(1, quote(NOT_ALL_FOUND), "s.body")
    judged = (
        f"CASE WHEN r IS NOT NULL THEN {wrong} "
        f"WHEN exists(s.states, x -> x IN ({MISSING}, {BLOCKED})) THEN {partial} END"
    )
    return aside("struct(is_object, item)", "e", aside(seen, "s", aside(reason, "r", judged)))
