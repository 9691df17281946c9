"""What a lookup reads and what a poll writes stay small, however many pages there are."""

import os
from glob import glob

import pyarrow.parquet as pq
from fake_api import paged
from pyspark.sql import functions as F

import pageframe as pf
from pageframe.options import SourceOptions
from pageframe.sources.reader import Spool
from pageframe.sources.walk import Cursor, walk


def test_a_lookup_reads_a_small_part_of_a_large_bucket(spark, tmp_path):
    body = F.concat(*[F.sha2(F.concat("id", F.lit(f"-{i}")), 512) for i in range(64)]).cast("binary")
    given = spark.range(600).select(
        F.lit("s").alias("seed"),
        F.col("id").alias("page_no"),
        F.concat(F.lit("http://h/p?"), "id").alias("url"),
        F.lit(200).alias("status"),
        F.create_map(F.lit("n"), F.array(F.col("id").cast("string"))).alias("headers"),
        body.alias("body"),
    )
    path = str(tmp_path / "cap")
    pf.write_capture(given, path, buckets=1)
    footers = [pq.ParquetFile(f).metadata for f in glob(f"{path}/bucket=0/*.parquet")]
    assert max(m.row_group(g).total_byte_size for m in footers for g in range(m.num_row_groups)) < 1 << 20
    look = pf.capture_transport(path, buckets=1)
    want = {r.url: bytes(r.body) for r in given.select("url", "body").collect()}
    for i in range(600):
        assert look("GET", f"http://h/p?{i}", {}, None, 1) == (200, {"n": [str(i)]}, want[f"http://h/p?{i}"])
    for absent in ("http://h/", "http://h/p?10x", "http://h/q"):
        assert look("GET", absent, {}, None, 1)[0] == 404


def test_urls_without_bounds_and_beyond_ascii_are_found(spark, tmp_path, pages):
    urls = ["http://h/" + "x" * 5000 + str(i) for i in range(3)] + ["http://h/￮", "http://h/\U0001f600", "http://h/a"]
    for n, some in enumerate((urls, urls[3:])):
        path = str(tmp_path / f"cap{n}")
        pf.write_capture(pages(*[str(i) for i in range(len(some))], seed="s", urls=some), path, buckets=1)
        look = pf.capture_transport(path, buckets=1)
        assert [look("GET", u, {}, None, 1)[2] for u in some] == [str(i).encode() for i in range(len(some))]


def test_a_long_poll_is_few_row_groups(tmp_path):
    spool = Spool(str(tmp_path))
    o = SourceOptions(schema="v INT NOT NULL", result_path="/items", url="http://h/p", pagination_type="Link in response header")
    spool.write("http://h/p", 1, walk(o, paged(200, link="header"), Cursor()), Cursor())
    entry = spool.entry("http://h/p", 1)
    assert [row[1] for row in spool.pages(entry)] == list(range(200))
    assert pq.ParquetFile(entry["data"]).metadata.num_row_groups == 1
    assert not [f for f in os.listdir(os.path.dirname(entry["data"])) if f.endswith(".part")]
