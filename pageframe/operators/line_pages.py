"""Pages of one record per line (text, CSV, TSV) and blob pages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageframe.functions.text import drop_tail, split_lines
from pageframe.functions.typed import aside, text_as, text_is_plainly_fine
from pageframe.operators.entries import NO_ERROR, PAGE, explode_entries, finish, first_reason, line_error, page_problem

# Fixed value: delimiter per format.
DELIMITERS = {"csv": ",", "tsv": "\t"}

def split_line(line: Column, delimiter: str, quoted: bool) -> Column:
    """Values of a line as an array. With quotes on, a quoted value is kept whole and unquoted.

    The possessive pattern takes runs of characters, so long values cost no stack.
    """
    d = re.escape(delimiter)
    if not quoted:
        return F.split(line, d, -1)
    value = f'{d}((?:"(?:[^"]++|"")*+"|[^"{d}]++)*+)'
    found = F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(value), F.lit(1))

    def unquote(v: Column) -> Column:
        t = F.trim(v)
        inner = F.replace(F.substring(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))
        return F.when(t.startswith('"') & t.endswith('"') & (F.length(t) > 1), inner).otherwise(v)

    return F.transform(found, unquote)


def has_open_quote(line: str) -> str:
    return f"""(length({line}) - length(replace({line}, '"', ''))) % 2 = 1"""


def line_pages(pages: DataFrame, skip_first_row: bool = False) -> DataFrame:
    """One row per line of a good page, one row with a page error for any other page."""
    # the pieces are a column of their own, so that a body is split once
    split = pages.select(*PAGE, split_lines(F.col("text")).alias("pieces"), F.expr(page_problem()).alias("page_error"))
    items = drop_tail(F.col("pieces"))
    if skip_first_row:
        items = F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0)))
    return explode_entries(split.select(*PAGE, "page_error", items.alias("items")))


def text_entries(pages: DataFrame, schema: T.StructType, handling: str) -> DataFrame:
    """Every line is a record with one string field."""
    return finish(line_pages(pages), schema, NO_ERROR, handling, ["entry"])


def delimited_entries(
    pages: DataFrame,
    schema: T.StructType,
    handling: str,
    delimiter: str,
    skip_first_row: bool = False,
    quoted: bool = False,
) -> DataFrame:
    """Records of CSV/TSV pages; columns are bound to the schema by position."""
    n = len(schema)
    raw, values = [f"r{i}" for i in range(n)], [f"v{i}" for i in range(n)]
    fields = list(zip(schema, raw, values, strict=True))
    rows = line_pages(pages, skip_first_row).select("*", split_line(F.col("entry"), delimiter, quoted).alias("pieces"))
    rows = rows.selectExpr("*", *[f"get(pieces, {i}) AS {r}" for i, r in enumerate(raw)])
    rows = rows.selectExpr("*", *[f"{text_as(r, f)} AS {v}" for f, r, v in fields])
    plain = [f"size(pieces) <= {n}", *[text_is_plainly_fine(r, v, f) for f, r, v in fields]]
    if quoted:
        plain.append(f"NOT ({has_open_quote('entry')})")
    error = aside("struct(entry, pieces)", "e", row_error(schema, quoted))
    problem = f"CASE WHEN page_error IS NULL AND NOT ({' AND '.join(plain)}) THEN {error} END"
    return finish(rows, schema, problem, handling, values)


def row_error(schema: T.StructType, quoted: bool) -> str:
    """SQL for the error of a line: the first thing that is wrong with it."""
    n = len(schema)
    reasons = [(has_open_quote("e.entry"), "a quote is not closed")] if quoted else []
    reasons.append((f"size(e.pieces) > {n}", f"more than {n} columns"))
    for i, field in enumerate(schema):
        text = f"get(e.pieces, {i})"
        if not field.nullable:
            reasons.append((f"{text} IS NULL", f"no value for field '{field.name}', which is not nullable"))
        filled = f"{text} IS NOT NULL" if not field.nullable else f"coalesce({text}, '') <> ''"
        reasons.append(
            (f"{filled} AND ({text_as(text, field)}) IS NULL", f"field '{field.name}' is not of type {field.dataType.simpleString()}")
        )
    return line_error("e.entry", first_reason(reasons))


def blob_entries(pages: DataFrame, schema: T.StructType, handling: str) -> DataFrame:
    """The whole body is one record with one bytes field, even if it is empty."""
    rows = pages.selectExpr(*PAGE, "body", "0 AS entry_no", f"{page_problem(body_bytes='body')} AS page_error")
    return finish(rows, schema, NO_ERROR, handling, ["body"])
