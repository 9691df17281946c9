"""Whole reads of captured responses: pagination, status rules, parsing and routing in one call."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pageframe.functions.lineage import stored
from pageframe.operators.errors import Routed, route
from pageframe.operators.infer import infer_schema
from pageframe.operators.line_pages import DELIMITERS
from pageframe.operators.parse import parse_pages
from pageframe.options import INCREMENT_INDEX, NONE, SourceOptions
from pageframe.plans.captures import captured_once, chain_holes, first_holes, hole_entries, index_holes
from pageframe.plans.chains import pages_on_chain, resolve_chains
from pageframe.plans.next_url import page_facts
from pageframe.plans.page_plan import in_plan, single_pages, stop_on_empty


def pages_to_read(responses: DataFrame, options: SourceOptions) -> DataFrame:
    """The captured responses a paged read would fetch, numbered in reading order, each page once."""
    return _pages_and_holes(responses, options)[0]


def _pages_and_holes(responses: DataFrame, options: SourceOptions) -> tuple[DataFrame, DataFrame | None]:
    """The pages to read, and ``seed, page_no, url`` of those that are due but were not captured, if any."""
    responses = captured_once(responses)
    if options.pagination == NONE:
        return single_pages(responses), first_holes(responses)
    if options.pagination == INCREMENT_INDEX:
        planned = in_plan(responses, options)
        facts = stored(page_facts(planned, options).select("seed", "page_no", "n_entries"), "facts")
        return stop_on_empty(planned, facts), index_holes(facts, options)
    facts = stored(page_facts(responses, options), "facts")
    chain = resolve_chains(facts)
    return pages_on_chain(responses, chain), chain_holes(facts, chain, options)


def parse_captured(responses: DataFrame, options: SourceOptions) -> DataFrame:
    """Entries of all pages a paged read would fetch.

    A page that is due but was not captured is an entry without a record: an error of code 0 under
    the handling of bad records. A page captured several times counts once. A CSV or TSV read without a schema infers it from the first page of the source first.
    """
    if options.schema is None and options.page_format in DELIMITERS:
        options = replace(options, schema=infer_schema(responses, options))
    options.check()
    pages, holes = _pages_and_holes(responses, options)
    parsed = parse_pages(pages, options)
    return parsed if holes is None else parsed.unionByName(hole_entries(holes, options))


def read_captured(
    responses: DataFrame, options: SourceOptions, positions: bool = False, observation: Observation | None = None
) -> Routed:
    """Good and error records of a paged read over captured responses."""
    return route(parse_captured(responses, options), positions, observation)


def in_order(records: DataFrame) -> DataFrame:
    """Reading order: page by page and entry by entry. Sorting is by range, not in one task."""
    return records.orderBy(F.col("seed"), F.col("page_no"), F.col("entry_no"))
