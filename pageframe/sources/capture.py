"""Captured responses: written once, read back by Spark or looked up by URL.

A capture is a Parquet folder in buckets of the URL's CRC-32, sorted by URL in small row groups, so
that a lookup of one URL reads one row group of a file or two, by their first and last URLs.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageframe.operators.responses import RESPONSE_SCHEMA
from pageframe.sources.transport import Headers, Transport

# Bytes of a row group, all of which a lookup reads, and rows after which the writer first looks at them.
ROW_GROUP = 256 << 10
ROWS_BETWEEN_CHECKS = 8


def write_capture(responses: DataFrame, path: str, buckets: int = 64, mode: str = "errorifexists") -> None:
    """Write responses in buckets; a URL decides its bucket, so no seed can fill one alone.

    Inside a bucket rows are spread by all they hold, so that many captures of one URL do not
    meet in one task. Take about one bucket per GB, so that a lookup stays small.
    """
    bucket = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(buckets)).cast("int")
    rows = responses.select("seed", "page_no", "url", "status", "headers", "body").withColumn("bucket", bucket)
    spread = F.pmod(F.xxhash64("seed", "page_no", "url", "status", "body"), F.lit(4))
    rows = rows.repartition("bucket", spread).sortWithinPartitions("bucket", "url")
    sizes = {"parquet.block.size": ROW_GROUP, "parquet.page.size": ROW_GROUP, "parquet.page.size.row.check.min": ROWS_BETWEEN_CHECKS}
    rows.write.mode(mode).partitionBy("bucket").options(**sizes).parquet(path)


def read_capture(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSE_SCHEMA + ", bucket INT").parquet(path).drop("bucket")


def capture_transport(path: str, buckets: int = 64) -> Transport:
    """A transport that answers from a capture; an unknown URL gets status 404.

    Opened buckets are kept by the task (their footers, not their rows). A lookup finds the row groups
    that can hold its URL by bisection and reads those alone, whatever the size of the capture.
    """
    opened: dict[int, list[_File]] = {}

    def replayed(method, url, headers, body, timeout_s) -> tuple[int, Headers, bytes]:  # noqa: ANN001
        bucket = zlib.crc32(url.encode()) % buckets
        if bucket not in opened:
            opened[bucket] = _files(path, bucket)
        row = next((r for f in opened[bucket] if (r := f.find(url)) is not None), None)
        if row is None:
            return 404, {}, b""
        return row["status"], dict(row["headers"] or []), row["body"] or b""

    return replayed


def _files(path: str, bucket: int) -> list[_File]:
    from pyarrow import fs

    files, base = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
    found = files.get_file_info(fs.FileSelector(f"{base}/bucket={bucket}", allow_not_found=True))
    names = sorted(i.path for i in found if i.type == fs.FileType.File and not i.base_name.startswith(("_", ".")))
    return [_File(files, name) for name in names]


class _File:
    """The footer of a file whose rows are sorted by URL, with the first and last URL of each row group."""

    def __init__(self, files: object, name: str):
        import pyarrow.parquet as pq

        self.files, self.name = files, name
        with files.open_input_file(name) as f:
            self.footer = pq.ParquetFile(f).metadata
        at = self.footer.schema.to_arrow_schema().names.index("url")  # no nested column is in front of it
        bounds = [self.footer.row_group(g).column(at).statistics for g in range(self.footer.num_row_groups)]
        self.bounded = all(b is not None and b.has_min_max for b in bounds)  # very long URLs have none
        self.first = [b.min for b in bounds] if self.bounded else []
        self.last = [b.max for b in bounds] if self.bounded else []

    def find(self, url: str) -> dict | None:
        """``status``, ``headers`` and ``body`` of the first row of a URL."""
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        groups = range(self.footer.num_row_groups)
        if self.bounded:
            groups = groups[bisect_left(self.last, url) : bisect_right(self.first, url)]
        if not groups:
            return None
        with self.files.open_input_file(self.name) as f:
            file = pq.ParquetFile(f, metadata=self.footer)
            for group in groups:
                at = pc.index(file.read_row_group(group, ["url"], use_threads=False).column(0), url).as_py()
                if at >= 0:
                    rows = file.read_row_group(group, ["status", "headers", "body"], use_threads=False)
                    return rows.slice(at, 1).to_pylist()[0]
        return None
