"""From responses to entries, whatever the page format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageframe.functions.paths import json_primitive, split_path, variant_at
from pageframe.functions.text import body_text, drop_tail, split_lines
from pageframe.functions.xpath_syntax import absolute_path
from pageframe.functions.xpaths import Node, add_path
from pageframe.operators.errors import SUCCESS, with_strategy
from pageframe.operators.json_pages import json_entries, parse_document, result_items
from pageframe.operators.line_pages import DELIMITERS, blob_entries, delimited_entries, text_entries
from pageframe.operators.responses import KEYS
from pageframe.operators.xml_pages import (
    CORRUPT,
    first_text,
    parse_xml,
    plan_elements,
    plan_paths,
    root_matches,
    xml_entries,
)
from pageframe.options import SourceOptions


def readable_pages(responses: DataFrame, options: SourceOptions) -> DataFrame:
    """Responses with what their status means and the text of their body."""
    marked = with_strategy(responses, options.rules)
    return marked.select(*KEYS, "status", "after_retry", "headers", "body", body_text(F.col("body")).alias("text"))


def parse_pages(responses: DataFrame, options: SourceOptions) -> DataFrame:
    """One row per entry: ``seed, page_no, url, entry_no, record, error, handling``.

    Works on batch and streaming frames alike: every step is a projection or an ``explode``,
    so there is no shuffle and each body is read once.
    """
    options.check()
    pages = readable_pages(responses, options)
    schema, handling, fmt = options.struct, options.entry_handling, options.page_format
    if fmt == "json":
        return json_entries(
            pages, schema, handling, options.result_path, dict(options.fields_mapping), options.lenient_json
        )
    if fmt == "xml":
        return xml_entries(pages, schema, handling, options.result_path, dict(options.fields_mapping))
    if fmt == "text":
        return text_entries(pages, schema, handling)
    if fmt == "blob":
        return blob_entries(pages, schema, handling)
    return delimited_entries(
        pages, schema, handling, DELIMITERS[fmt], options.csv_skip_first_row, options.enable_quoted_values
    )


def locate(pages: DataFrame, options: SourceOptions, link_path: str | None = None) -> DataFrame:
    """Add ``n_entries`` and ``link`` (text at ``link_path`` of the body) to readable pages.

    Elements are found but no field is converted; the body is parsed once for both. A page
    that cannot be read, or whose status was no success, has one entry: its error.
    """
    fmt, text = options.page_format, F.col("text")
    good = F.col("after_retry") == SUCCESS
    link = F.lit(None).cast("string")
    if fmt == "json":
        pages = pages.withColumn("doc", F.when(good, parse_document(text, options.lenient_json)))
        items = result_items(F.col("doc"), split_path(options.result_path))
        n = F.coalesce(F.size(items), F.lit(1))
        n = F.when(items.isNull(), F.lit(1)).otherwise(n)
        if link_path:
            link = json_link(F.col("doc"), link_path)
    elif fmt == "xml":
        plans, root = plan_paths(pages, options.result_path, []), Node()
        links = plan_paths(pages, absolute_path(link_path), []) if link_path else []
        for path, _ in [*plans, *links]:
            add_path(root, path)
        pages = pages.withColumn("doc", F.when(good, parse_xml(text, root)))
        doc = F.col("doc")
        broken = doc.isNull() | doc[CORRUPT].isNotNull()
        size = F.size(plan_elements(text, doc, root, plans, lambda element, plan, e: F.lit(1), "int"))
        n = F.when(broken, F.lit(1)).otherwise(size)
        texts = [F.when(~broken & root_matches(text, p), first_text(doc, root, p)) for p, _ in links]
        link = F.coalesce(*texts) if texts else link
    elif fmt == "blob":
        n = F.lit(1)
    else:
        header = 1 if fmt in DELIMITERS and options.csv_skip_first_row else 0
        n = F.greatest(F.size(drop_tail(split_lines(text))) - header, F.lit(0))
    return pages.select(
        "*", F.when(good, n).otherwise(F.lit(1)).alias("n_entries"), F.nullif(link, F.lit("")).alias("link")
    ).drop("doc")


def json_link(doc: Column, path: str) -> Column:
    """Text at ``path``, NULL if absent or null; an object or array there fails the job."""
    raw = variant_at(doc, split_path(path))
    nested = raw.isNotNull() & ~F.is_variant_null(raw) & json_primitive(doc, path).isNull()
    message = F.lit(f"the value at '{path}' is expected to be a primitive")
    return F.when(nested, F.raise_error(message).cast("string")).otherwise(json_primitive(doc, path))
