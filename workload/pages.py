"""Response tables derived from the test tables.

Keys are unique and start at 0, so ``key DIV n`` numbers pages of at most ``n`` rows: the
lists collected per page have a fixed bound.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PER_PAGE = 50
# Rows of one priority on a page of a seed: keys of five priorities are mixed.
SEED_SPAN = 250
HOST = "http://api.example.com"
ORDERS_URL = HOST + "/orders?page={pagination.index}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_of(key: str, per_page: int = PER_PAGE) -> Column:
    return F.floor(F.col(key) / F.lit(per_page)).cast("bigint")


def grouped(df: DataFrame, keys: Sequence[Column], order: str, item: Column) -> DataFrame:
    """Items of each page, in key order, as the array ``items``."""
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("k"), item.alias("v")))).alias("r"))
    return rows.withColumn("items", F.col("r.v")).drop("r")


def responses(
    df: DataFrame, seed: Column, page_no: Column, url: Column, body: Column, status: Column | None = None, link: Column | None = None
) -> DataFrame:
    """A response table of the given columns."""
    headers = F.create_map(F.lit("content-type"), F.array(F.lit("application/json")))
    if link is not None:
        headers = F.when(link.isNotNull(), F.map_concat(headers, F.create_map(F.lit("link"), F.array(link)))).otherwise(headers)
    return df.select(
        seed.alias("seed"),
        page_no.cast("bigint").alias("page_no"),
        url.alias("url"),
        (F.lit(200) if status is None else status).cast("int").alias("status"),
        headers.alias("headers"),
        body.cast("binary").alias("body"),
    )


def order_item() -> Column:
    """An order as an API would show it."""
    return F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("total"),
            F.struct(F.col("o_orderpriority").alias("name")).alias("priority"),
        ).alias("o"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
    )


ORDER_SCHEMA = "id BIGINT NOT NULL, customer BIGINT NOT NULL, status STRING NOT NULL, total DOUBLE NOT NULL, priority STRING, date STRING"
ORDER_MAPPING = {"status": "/o/status", "total": "/o/total", "priority": "/o/priority/name"}


def index_url(template: str, page_no: Column) -> Column:
    return F.replace(F.lit(template), F.lit("{pagination.index}"), page_no.cast("string"))


def order_pages(
    spark: SparkSession, sf_dir: str, item: Column | None = None, wrap: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Orders as index pages ``{"items": [...]}`` of one seed."""
    item = order_item() if item is None else item
    wrap = wrap or (lambda items: F.to_json(F.struct(items.alias("items"))))
    pages = grouped(table(spark, sf_dir, "orders"), [page_of("o_orderkey").alias("page_no")], "o_orderkey", item)
    no = F.col("page_no")
    return responses(pages, F.lit(ORDERS_URL), no, index_url(ORDERS_URL, no), wrap(F.col("items")))


def seed_pages(
    spark: SparkSession,
    sf_dir: str,
    url: Callable[[Column, Column], Column],
    extra: Callable[[Column, Column], Sequence[Column]] = lambda p, n: (),
    link: Callable[[Column, Column], Column] | None = None,
    emptied: dict[str, int] | None = None,
    seed: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Orders as one page sequence per priority. ``url(priority, n)`` is the URL of page ``n``.

    ``extra`` gives more top-level body fields and ``link`` a Link header. The page number
    in ``emptied`` has no items.
    """
    keys = [F.col("o_orderpriority").alias("p"), page_of("o_orderkey", SEED_SPAN).alias("n")]
    pages = grouped(table(spark, sf_dir, "orders"), keys, "o_orderkey", order_item())
    p, n = F.col("p"), F.col("n")
    items = F.col("items")
    for name, page in (emptied or {}).items():
        items = F.when((p == name) & (n == page), F.slice(items, 1, 0)).otherwise(items)
    body = F.to_json(F.struct(items.alias("items"), *extra(p, n)))
    first = seed(p) if seed else url(p, F.lit(0).cast("bigint"))
    return responses(pages, first, n, url(p, n), body, link=link(p, n) if link else None)


def priority_slug(p: Column) -> Column:
    return F.lower(F.replace(p, F.lit(" "), F.lit("-")))


def delimited_pages(
    df: DataFrame, key: str, columns: Sequence[Column], delimiter: str, header: str | None = None, line_end: str = "\n", per_page: int = PER_PAGE
) -> DataFrame:
    """Rows of a table as delimited lines."""
    line = F.concat_ws(delimiter, *columns)
    pages = grouped(df, [page_of(key, per_page).alias("page_no")], key, line)
    text = F.concat(F.array_join("items", line_end), F.lit(line_end))
    if header is not None:
        text = F.concat(F.lit(header + line_end), text)
    url = F.concat(F.lit(f"{HOST}/lines/"), F.col("page_no").cast("string"))
    return responses(pages, F.lit(f"{HOST}/lines/0"), F.col("page_no"), url, text)


def xml_escape(value: Column) -> Column:
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        value = F.replace(value, F.lit(raw), F.lit(escaped))
    return value


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as an Atom-like feed with prefixes, attributes, comments and empty elements."""
    empty_note = F.lit('<d:Note m:null="true"/>')
    note = F.concat(F.lit("<d:Note><![CDATA[<"), F.col("p_name"), F.lit(">]]></d:Note>"))
    entry = F.concat(
        F.lit('<entry cat="'), F.col("p_type"), F.lit('" m:size="'), F.col("p_size").cast("string"), F.lit('"><!-- part -->'),
        F.lit("<id>"), F.col("p_partkey").cast("string"), F.lit("</id><content><m:properties><d:Name>"),
        xml_escape(F.concat(F.col("p_name"), F.lit(" & <co>"))), F.lit("</d:Name><d:Brand>"), F.col("p_brand"),
        F.lit('</d:Brand><d:Price cur="EUR">'), F.col("p_retailprice").cast("string"), F.lit("</d:Price>"),
        F.when(F.col("p_size") % 2 == 0, empty_note).otherwise(note),
        F.lit("<d:Box><b>"), F.col("p_brand"), F.lit("</b></d:Box></m:properties></content></entry>"),
    )
    pages = grouped(table(spark, sf_dir, "part"), [page_of("p_partkey").alias("page_no")], "p_partkey", entry)
    no = F.col("page_no")
    # every third page names no next page
    link = F.when(no % 3 != 2, F.concat(F.lit("<next>/parts?page="), (no + 1).cast("string"), F.lit("</next>"))).otherwise(F.lit("<next/>"))
    body = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?>\n<!-- feed -->\n<feed xmlns="http://www.w3.org/2005/Atom" xmlns:d="urn:d" xmlns:m="urn:m">'),
        link,
        F.array_join("items", "\n"),
        F.lit("</feed>"),
    )
    return responses(pages, F.lit(f"{HOST}/parts?page=0"), no, F.concat(F.lit(f"{HOST}/parts?page="), no.cast("string")), body)
