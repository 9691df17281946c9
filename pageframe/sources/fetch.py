"""Fetching by DataFrame: a plan of URLs, or a table of seeds, to responses.

Tasks fetch what their rows name, so ``repartition(n)`` in front sets how many requests run at
a time. Every evaluation asks the API again: write the result once (:func:`keep`) and go on
from there.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import DataFrame

from pageframe.operators.responses import RESPONSE_SCHEMA
from pageframe.options import SourceOptions
from pageframe.sources.transport import Transport, pack, unpack
from pageframe.sources.walk import Cursor, Response, fetch, walk

RESPONSE_ARROW = pa.schema(
    [
        ("seed", pa.string()),
        ("page_no", pa.int64()),
        ("url", pa.string()),
        ("status", pa.int32()),
        ("headers", pa.map_(pa.string(), pa.list_(pa.string()))),
        ("body", pa.binary()),
    ]
)


def as_batch(page: Response) -> pa.RecordBatch:
    """One response as an Arrow batch, so that a task holds one body at a time."""
    values = [page.seed, page.page_no, page.url, page.status, list(page.headers.items()), page.body]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], f.type) for v, f in zip(values, RESPONSE_ARROW, strict=True)], schema=RESPONSE_ARROW
    )


def fetch_urls(plan: DataFrame, options: SourceOptions, transport: Transport | str = "http") -> DataFrame:
    """Responses of the planned pages ``seed, page_no, url``, each with retries by the status rules."""
    packed = transport if isinstance(transport, str) else pack(transport)
    source = replace(options, schema=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call, first = unpack(packed), True
        for batch in batches:
            for seed, page_no, url in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not first and source.wait_between_pages_ms > 0:
                    time.sleep(source.wait_between_pages_ms / 1000)
                first = False
                answer = fetch(source, call, url)
                yield as_batch(Response(seed, page_no, url, answer.status, answer.headers, answer.body))

    return plan.selectExpr("seed", "CAST(page_no AS BIGINT) AS page_no", "url").mapInArrow(run, RESPONSE_SCHEMA)


def fetch_seeds(seeds: DataFrame, options: SourceOptions, transport: Transport | str = "http") -> DataFrame:
    """All pages of each first URL in ``seed``, walked page by page within a task."""
    packed = transport if isinstance(transport, str) else pack(transport)
    source = replace(options, schema=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = unpack(packed)
        for batch in batches:
            for seed in batch.column(0).to_pylist():
                for page, _ in walk(replace(source, url=seed), call, Cursor()):
                    if page is not None:
                        yield as_batch(page)

    return seeds.select("seed").mapInArrow(run, RESPONSE_SCHEMA)


def keep(responses: DataFrame, path: str) -> DataFrame:
    """Write fetched responses once and give the written ones."""
    responses.write.mode("errorifexists").parquet(path)
    return responses.sparkSession.read.schema(RESPONSE_SCHEMA).parquet(path)
