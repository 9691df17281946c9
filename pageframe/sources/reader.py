"""``format("pages")``: fetched responses as a batch or streaming DataFrame.

Both readers give rows of the response table; parsing is the same DataFrame plan as for
captured responses. All requests are made by executor tasks.
"""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from pageframe.operators.responses import RESPONSE_SCHEMA
from pageframe.options import INCREMENT_INDEX, SourceOptions
from pageframe.plans.page_plan import page_count
from pageframe.sources.fetch import RESPONSE_ARROW, as_batch, keep
from pageframe.sources.transport import Transport, pack, unpack
from pageframe.sources.walk import Cursor, Response, walk


# Bytes of pages that a poll gathers for a row group of its spool.
HELD = 4 << 20


def reader_options(
    options: SourceOptions,
    transport: Transport | str = "http",
    urls: list[str] | None = None,
    partitions: int | None = None,
    spool: str | None = None,
    interval_s: float | None = None,
) -> dict[str, str]:
    """Options for ``spark.read/readStream.format("pages")`` from a :class:`SourceOptions`."""
    plain = replace(options, schema=None)  # responses are not typed yet
    out = {
        "packed": base64.b64encode(cloudpickle.dumps(plain)).decode(),
        "transport": transport if isinstance(transport, str) else pack(transport),
    }
    if urls is not None:
        out["urls"] = "\n".join(urls)
    if partitions is not None:
        out["partitions"] = str(partitions)
    if spool is not None:
        out["spool"] = spool
    if interval_s is not None:
        out["interval_s"] = str(interval_s)
    return out


def _source_options(options: dict[str, str]) -> SourceOptions:
    if "packed" in options:
        return cloudpickle.loads(base64.b64decode(options["packed"]))
    return SourceOptions.from_properties({k: v for k, v in options.items() if k.lower() != "schema"})


def _seeds(options: dict[str, str], source: SourceOptions) -> list[str]:
    return [u for u in options.get("urls", "").split("\n") if u] or [source.url]


@dataclass
class PageRange(InputPartition):
    """Pages ``first`` to ``last`` (None: to the end) of one seed; ``ends``: the first empty page ends it too."""

    url: str
    first: int = 0
    last: int | None = None
    ends: bool = False


class PagesDataSource(DataSource):
    """Paged web API. Options: the flat properties of the source, or those of :func:`reader_options`."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return RESPONSE_SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        filtered = str(self.options.get("push_filters", "")).lower() == "true"
        return (FilteredPagesReader if filtered else PagesReader)(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: ANN001, N802
        return PagesStreamReader(dict(self.options))


class PagesReader(DataSourceReader):
    """Batch reader: index pages are fetched in parallel ranges, any other sequence per seed.

    With a maximum index every page up to it is given out, empty ones too, so the rows depend neither
    on ``partitions`` nor on filters; without one the walk ends in front of the first empty page.
    """

    def __init__(self, options: dict[str, str]):
        self.source = _source_options(options)
        self.seeds = _seeds(options, self.source)
        self.n_partitions = int(options.get("partitions", 8))
        self.transport = options.get("transport")
        self.low, self.high = 0, None

    def partitions(self) -> list[InputPartition]:
        s = self.source
        n_pages = None
        if s.pagination == INCREMENT_INDEX:
            n_pages = page_count(s.start_index, s.index_increment, s.max_index)
        if n_pages is None:  # the end, or the next URL, is known only after a fetch
            return [PageRange(u, 0, self.high, ends=True) for u in self.seeds]
        n_pages = n_pages if self.high is None else min(n_pages, self.high)
        size = max(1, -(-max(0, n_pages - self.low) * len(self.seeds) // self.n_partitions))
        return [
            PageRange(u, first, min(first + size, n_pages))
            for u in self.seeds
            for first in range(self.low, n_pages, size)
        ]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        source = replace(self.source, url=partition.url)
        limit = None if partition.last is None else partition.last - partition.first
        # one of several ranges cannot know of an empty page in another one, so all its pages are given
        # out and the plan over the fetched pages stops at the first empty one
        for page, _ in walk(source, unpack(self.transport), Cursor(partition.first), limit, stop_on_empty=partition.ends):
            if page is not None:
                yield page.as_tuple()


class FilteredPagesReader(PagesReader):
    """The same, with filters on ``page_no`` cutting the pages that are fetched.

    Used with the option ``push_filters``; Spark asks for filters only where
    ``spark.sql.python.filterPushdown.enabled`` is on, and refuses such a reader elsewhere.
    """

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Narrow the page range by filters on ``page_no``; all filters are checked again by Spark."""
        for f in filters:
            if getattr(f, "attribute", None) == ("page_no",) and isinstance(getattr(f, "value", None), int):
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    end = f.value if isinstance(f, LessThan) else f.value + 1
                    self.high = end if self.high is None else min(self.high, end)
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.low = max(self.low, f.value + 1 if isinstance(f, GreaterThan) else f.value)
            yield f


@dataclass
class Poll(InputPartition):
    """One micro-batch of one seed."""

    url: str
    number: int


class Spool:
    """Fetched pages of a stream, kept per seed and micro-batch so that a replay gives the same rows.

    The entry file of a micro-batch names its data file and the cursor behind it, and is
    written last: a micro-batch is either whole or fetched again. Each attempt writes an entry of its
    own; the one that was there first counts (by time, then name), for all attempts and for the next
    micro-batch, so two attempts that ran at once give equal rows.
    """

    def __init__(self, folder: str):
        from pyarrow import fs

        uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
        self.files, self.base = fs.FileSystem.from_uri(uri)

    def _folder(self, url: str) -> str:
        return f"{self.base}/{uuid.uuid5(uuid.NAMESPACE_URL, url).hex}"

    def entry(self, url: str, number: int) -> dict[str, Any] | None:
        found = self._entries(f"{self._folder(url)}/{number:012d}")
        if not found:
            return None
        with self.files.open_input_stream(min(found, key=lambda i: (i.mtime_ns, i.base_name)).path) as f:
            return json.loads(f.read())

    def _entries(self, folder: str) -> list:
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return [i for i in found if i.base_name.endswith(".json")]

    def last_number(self, url: str) -> int:
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(self._folder(url), allow_not_found=True))
        numbers = sorted((int(i.base_name) for i in found if i.type == fs.FileType.Directory), reverse=True)
        return next((n for n in numbers if self._entries(f"{self._folder(url)}/{n:012d}")), 0)

    def write(self, url: str, number: int, pages: Iterator[tuple[Response | None, Cursor]], start: Cursor) -> None:
        """Write the pages as they come (``HELD`` bytes and one page at a time in memory), then the entry file."""
        import pyarrow as pa
        import pyarrow.parquet as pq

        folder, name = f"{self._folder(url)}/{number:012d}", uuid.uuid4().hex
        self.files.create_dir(folder, recursive=True)
        data = f"{folder}/{name}.parquet"
        cursor, writer = start, None
        held, size = [], 0
        for page, after in pages:
            cursor = after
            if page is None:
                continue
            writer = writer or pq.ParquetWriter(data, RESPONSE_ARROW, filesystem=self.files)
            held.append(as_batch(page))
            size += held[-1].nbytes
            if size >= HELD:  # one row group for many pages: a footer entry each would outgrow the pages of a long poll
                writer.write_table(pa.Table.from_batches(held))
                held, size = [], 0
        if writer is not None:
            writer.write_table(pa.Table.from_batches(held, RESPONSE_ARROW))
            writer.close()
        content = {"data": data if writer is not None else None, "cursor": cursor.as_dict()}
        # under its last name only once it is whole
        with self.files.open_output_stream(f"{folder}/{name}.part") as f:
            f.write(json.dumps(content).encode())
        self.files.move(f"{folder}/{name}.part", f"{folder}/{name}.json")

    def pages(self, entry: dict[str, Any]) -> Iterator[tuple]:
        import pyarrow.parquet as pq

        if entry["data"] is None:
            return
        with self.files.open_input_file(entry["data"]) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=16):
                for row in batch.to_pylist():
                    row["headers"] = dict(row["headers"] or [])
                    yield tuple(row.values())


class PagesStreamReader(DataSourceStreamReader):
    """Streaming reader: an offset is a number of polls; each poll reads on where the last ended.

    A poll is a task per seed. It walks on from the cursor that the spool holds for the poll
    before, up to the page and time limits, spools the pages and gives them out. Neither the
    driver nor the checkpoint ever holds a page.
    """

    def __init__(self, options: dict[str, str]):
        self.source = _source_options(options)
        self.seeds = _seeds(options, self.source)
        self.transport = options.get("transport")
        self.interval_s = float(options["interval_s"]) if "interval_s" in options else None
        if "spool" not in options:
            raise ValueError("the streaming reader needs the option 'spool', a folder all executors share")
        self.spool = options["spool"]
        self.last: int | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        return {"polls": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        if self.last is None:
            spool = Spool(self.spool)
            self.last = max(spool.last_number(u) for u in self.seeds)
        return {"polls": self.last + 1}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.last = max(self.last or 0, end["polls"])
        return [Poll(u, n) for n in range(start["polls"] + 1, end["polls"] + 1) for u in self.seeds]

    def commit(self, end: dict) -> None:
        self.last = max(self.last or 0, end["polls"])

    def read(self, partition: Poll) -> Iterator[tuple]:
        spool = Spool(self.spool)
        entry = spool.entry(partition.url, partition.number)
        if entry is None:
            before = spool.entry(partition.url, partition.number - 1)
            start = Cursor(**before["cursor"]) if before else Cursor()
            source = replace(self.source, url=partition.url)
            pages = walk(source, unpack(self.transport), start, source.max_pages_per_fetch, self.interval_s)
            spool.write(partition.url, partition.number, pages, start)
            entry = spool.entry(partition.url, partition.number)
        yield from spool.pages(entry)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagesDataSource)


def fetch_pages(
    spark: SparkSession,
    options: SourceOptions,
    path: str,
    transport: Transport | str = "http",
    urls: list[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Fetch all pages once, write them to ``path``, and give the written responses.

    Planning reads pages more than once; a live API must not be asked again for that.
    """
    options.check()
    register(spark)
    given = reader_options(options, transport, urls, partitions)
    return keep(spark.read.format("pages").options(**given).load(), path)
