"""Paged web-API responses to typed tables and streams, and tables to request messages, on Spark."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

from pageframe.operators.errors import Routed, resolve_attempts, route, with_strategy, write_routed
from pageframe.operators.infer import infer_columns, infer_schema
from pageframe.operators.messages import build_messages
from pageframe.operators.parse import parse_pages
from pageframe.operators.responses import RESPONSE_SCHEMA, as_responses, response_columns
from pageframe.options import Failure, InvalidOptions, SinkOptions, SourceOptions
from pageframe.plans.batch import in_order, pages_to_read, parse_captured, read_captured
from pageframe.plans.chains import missing_links, pages_on_chain, resolve_chains
from pageframe.plans.next_url import page_facts
from pageframe.plans.page_plan import index_plan, missing_pages, replay, stop_on_empty
from pageframe.sources.capture import capture_transport, read_capture, write_capture
from pageframe.sources.fetch import fetch_seeds, fetch_urls, keep
from pageframe.sources.reader import PagesDataSource, fetch_pages, reader_options
from pageframe.sources.writer import MessagesDataSource, send_messages, writer_options

# Functions of this package travel to executors by value, so workers need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "Failure",
    "InvalidOptions",
    "MessagesDataSource",
    "PagesDataSource",
    "RESPONSE_SCHEMA",
    "Routed",
    "SinkOptions",
    "SourceOptions",
    "as_responses",
    "build_messages",
    "capture_transport",
    "fetch_pages",
    "fetch_seeds",
    "fetch_urls",
    "in_order",
    "index_plan",
    "keep",
    "infer_columns",
    "infer_schema",
    "missing_links",
    "missing_pages",
    "page_facts",
    "pages_on_chain",
    "pages_to_read",
    "parse_captured",
    "parse_pages",
    "read_capture",
    "read_captured",
    "reader_options",
    "replay",
    "resolve_attempts",
    "resolve_chains",
    "response_columns",
    "route",
    "send_messages",
    "stop_on_empty",
    "with_strategy",
    "write_capture",
    "write_routed",
    "writer_options",
]
