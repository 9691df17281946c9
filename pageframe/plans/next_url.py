"""The next URL of every captured page, as a column."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageframe.functions.text import first_header
from pageframe.functions.urls import add_parameter, next_in_link_header, resolve_link
from pageframe.operators.parse import locate, readable_pages
from pageframe.options import (
    CUSTOM,
    LINK_IN_BODY,
    LINK_IN_HEADER,
    TOKEN_IN_BODY,
    SourceOptions,
    compile_next_url,
)


class Headers(dict):
    """Response headers for a user's function; names are looked up without regard to case."""

    def __init__(self, values: Mapping[str, str]):
        super().__init__({k.lower(): v for k, v in values.items()})

    def __getitem__(self, name: str) -> str:
        return super().__getitem__(name.lower())

    def __contains__(self, name: object) -> bool:
        return super().__contains__(str(name).lower())

    def get(self, name: str, default: str | None = None) -> str | None:
        return super().get(name.lower(), default)


def custom_next_url(code: str | Callable[..., str | None], url: Column, text: Column, headers: Column) -> Column:
    """Next URL by the user's function ``(url, page, headers)``, in Arrow batches.

    Source text is compiled once per batch, on the executors; an error in it fails the job.
    """
    compile_next_url(code)

    @F.pandas_udf("string")
    def next_url(urls: pd.Series, pages: pd.Series, headers: pd.Series) -> pd.Series:
        call = compile_next_url(code)
        named = (Headers(dict(h)) if h is not None else Headers({}) for h in headers)
        return pd.Series([call(u, p, h) for u, p, h in zip(urls, pages, named, strict=True)], dtype=object)

    last_values = F.transform_values(headers, lambda _, v: F.element_at(v, -1))
    return next_url(url, text, last_values)


def page_facts(responses: DataFrame, options: SourceOptions) -> DataFrame:
    """What planning needs of each page: ``seed, page_no, url, status, n_entries, next_url``.

    This is the only place where planning reads bodies; the result is a narrow table.
    """
    pages = readable_pages(responses, options)
    kind = options.pagination
    path = {LINK_IN_BODY: options.next_page_field_path, TOKEN_IN_BODY: options.next_page_token_path}.get(kind)
    located = locate(pages, options, path)
    seed, url, link = F.col("seed"), F.col("url"), F.col("link")
    if kind == LINK_IN_HEADER:
        following = next_in_link_header(first_header(F.col("headers"), "link"))
    elif kind == LINK_IN_BODY:
        following = resolve_link(link, seed, url)
    elif kind == TOKEN_IN_BODY:
        following = add_parameter(seed, options.next_page_url_parameter, link)
    elif kind == CUSTOM:
        following = custom_next_url(options.custom_next_url, url, F.col("text"), F.col("headers"))
    else:
        following = F.lit(None).cast("string")
    return located.select("seed", "page_no", "url", "status", "n_entries", following.alias("next_url"))
