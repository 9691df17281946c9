"""Registered queries: each runs one or more operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import pageframe as pf
from pageframe.functions.lineage import fresh_path
from pageframe.functions.paths import json_path_get as _path
from pageframe.functions.skew import attach
from pageframe.functions.text import body_text
from pageframe.operators.errors import route, with_strategy
from pageframe.operators.xml_pages import xml_primitive
from pageframe.plans.batch import in_order
from pageframe.streaming.streams import captured_stream, fetched_stream, unseen, write_stream_routed
from workload.pages import (
    HOST,
    ORDER_MAPPING,
    ORDER_SCHEMA,
    ORDERS_URL,
    delimited_pages,
    grouped,
    order_item,
    order_pages,
    page_of,
    part_pages,
    priority_slug,
    responses,
    seed_pages,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


INDEXED = {"url": ORDERS_URL, "pagination_type": "Increment an index", "start_index": 0, "index_increment": 1}


def orders_options(**more: object) -> pf.SourceOptions:
    given = {"schema": ORDER_SCHEMA, "result_path": "/items", "fields_mapping": ORDER_MAPPING, **INDEXED, **more}
    return pf.SourceOptions(**given)


def records(responses_: DataFrame, options: pf.SourceOptions) -> DataFrame:
    """Good records with their position, pages taken as they are."""
    return route(pf.parse_pages(responses_, options), positions=True).records.drop("seed")


# --- scans ------------------------------------------------------------------------------


@query
def scan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch source: pages fetched in parallel index ranges through the data source."""
    path = fresh_path(spark, "capture")
    pf.write_capture(order_pages(spark, sf_dir), path)
    last = table(spark, sf_dir, "orders").agg(F.max(page_of("o_orderkey"))).first()[0]
    options = orders_options(max_index=last)
    spark.dataSource.register(pf.PagesDataSource)
    given = pf.reader_options(options, pf.capture_transport(path), partitions=8)
    return records(spark.read.format("pages").options(**given).load(), options)


@query
def fetch_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned URLs fetched by the tasks that hold them, then parsed."""
    path = fresh_path(spark, "capture")
    pages = order_pages(spark, sf_dir)
    pf.write_capture(pages, path)
    plan = pf.read_capture(spark, path).select("seed", "page_no", "url").repartition(8)
    options = orders_options()
    got = pf.keep(pf.fetch_urls(plan, options, pf.capture_transport(path)), fresh_path(spark, "fetched"))
    return records(got, options)


@query
def ordered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = pf.read_captured(order_pages(spark, sf_dir), orders_options(), positions=True)
    return in_order(read.records)


@query
def response_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    captured = pages.select(
        F.col("url"),
        F.col("page_id").alias("page_no"),
        F.create_map(
            F.lit("Content-Type"), F.array(F.lit("text/html"), F.lit("x")), F.lit("X-Id"), F.array(F.col("page_id").cast("string"))
        ).alias("headers"),
        F.col("html").alias("body"),
    )
    return pf.response_columns(pf.as_responses(captured), "CONTENT-TYPE", "x-id", "absent").drop("page_hash", "seed")


@query
def page_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal bodies have equal hashes and different ones different hashes."""
    docs = table(spark, sf_dir, "documents")
    captured = pf.as_responses(
        docs.select(F.concat(F.lit(f"{HOST}/d/"), F.col("doc_id")).alias("url"), F.col("doc_id").alias("page_no"), F.col("text").alias("body"))
    )
    hashed = pf.response_columns(captured)
    return hashed.groupBy("page_hash").agg(F.min("page_no").alias("first_doc"), F.count("*").alias("n_docs")).drop("page_hash")


@query
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "id BIGINT NOT NULL, customer BIGINT NOT NULL, date STRING NOT NULL"
    return records(order_pages(spark, sf_dir), orders_options(schema=schema, fields_mapping={}))


@query
def json_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(order_pages(spark, sf_dir), orders_options())


@query
def json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "id BIGINT NOT NULL, name STRING NOT NULL"
    return records(order_pages(spark, sf_dir), orders_options(schema=schema, fields_mapping={"name": "o/priority/name/"}))


@query
def json_inner_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result path that runs through the array: its rest applies to every element."""
    schema = "status STRING NOT NULL, total DOUBLE NOT NULL, name STRING"
    options = orders_options(schema=schema, result_path="/items/o", fields_mapping={"name": "/priority/name"})
    return records(order_pages(spark, sf_dir), options)


def customer_item() -> Column:
    return F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.struct(F.col("c_acctbal").alias("balance")).alias("account")
    )


CUSTOMER_SCHEMA = "id BIGINT NOT NULL, name STRING NOT NULL, balance DOUBLE NOT NULL"


@query
def json_root_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = grouped(table(spark, sf_dir, "customer"), [page_of("c_custkey").alias("n")], "c_custkey", customer_item())
    url = F.concat(F.lit(f"{HOST}/customers/"), F.col("n").cast("string"))
    got = responses(pages, url, F.col("n"), url, F.to_json("items"))
    options = pf.SourceOptions(url=f"{HOST}/customers/0", schema=CUSTOMER_SCHEMA, fields_mapping={"balance": "/account/balance"})
    return records(got, options)


@query
def json_single_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    url = F.concat(F.lit(f"{HOST}/customer/"), F.col("c_custkey").cast("string"))
    body = F.to_json(F.struct(F.struct(customer_item().alias("customer")).alias("result")))
    got = responses(rows, url, F.col("c_custkey"), url, body)
    options = pf.SourceOptions(
        url=f"{HOST}/customer/0", schema=CUSTOMER_SCHEMA, result_path="/result/customer/", fields_mapping={"balance": "/account/balance"}
    )
    return records(got, options)


@query
def json_nested_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of records and records stay typed columns; here the lines of every order."""
    line = F.struct(
        F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("qty"), F.struct(F.col("l_returnflag").alias("flag")).alias("state")
    )
    lines_ = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    per_page = lines_.withColumn("o_orderkey", F.col("l_orderkey"))
    item = F.struct(F.col("o_orderkey").alias("id"), F.col("lines"))
    pages = grouped(per_page, [page_of("o_orderkey").alias("n")], "o_orderkey", item)
    url = F.concat(F.lit(f"{HOST}/lines?page="), F.col("n").cast("string"))
    got = responses(pages, F.lit(f"{HOST}/lines"), F.col("n"), url, F.to_json(F.struct(F.col("items").alias("orders"))))
    options = pf.SourceOptions(
        url=f"{HOST}/lines",
        result_path="/orders",
        schema="id BIGINT NOT NULL, lines ARRAY<STRUCT<n INT NOT NULL, qty DOUBLE, state STRUCT<flag STRING>>> NOT NULL",
    )
    read = records(got, options)
    return read.select("id", F.explode("lines").alias("l")).select(
        "id", F.col("l.n").alias("n"), F.col("l.qty").alias("qty"), F.col("l.state.flag").alias("flag")
    )


@query
def json_path_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.try_parse_json("props")
    found, beyond = _path(doc, "/k/"), _path(doc, "/k/deeper")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.try_variant_get(found["value"], "$", "bigint").alias("k"),
        found["unretrieved_path"].alias("left_over"),
        F.try_variant_get(beyond["value"], "$", "bigint").alias("k_again"),
        beyond["retrieved_path"].alias("walked"),
        beyond["unretrieved_path"].alias("not_walked"),
        _path(doc, "absent/x")["unretrieved_path"].alias("absent_left_over"),
    )


def _outcomes(parsed: DataFrame, *fields: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every entry: its record's fields or its error."""
    return parsed.select(
        "page_no", "entry_no", *carry, *[F.when(F.col("error").isNull(), F.col(f"record.{f}")).alias(f) for f in fields],
        F.col("error.code").alias("code"), F.col("error.body").alias("error_body"),
    )


@query
def typed_or_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text where a number is due makes the whole entry an error."""
    total = F.when(F.col("o_orderkey") % 7 == 0, F.lit('"n/a"')).otherwise(F.col("o_totalprice").cast("string"))
    item = F.concat(F.lit('{"id":'), F.col("o_orderkey").cast("string"), F.lit(',"total":'), total, F.lit("}"))
    wrap = lambda items: F.concat(F.lit('{"items":['), F.array_join(items, ","), F.lit("]}"))
    options = orders_options(schema="id BIGINT NOT NULL, total DOUBLE", fields_mapping={}, error_handling="sendToError")
    return _outcomes(pf.parse_pages(order_pages(spark, sf_dir, item, wrap), options), "id", "total")


@query
def json_missing_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A required field that is absent: the record was only partly found."""
    total = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    item = F.struct(F.col("o_orderkey").alias("id"), F.struct(total.alias("total")).alias("o"))
    options = orders_options(schema="id BIGINT NOT NULL, total DOUBLE NOT NULL", fields_mapping={"total": "/o/total"}, error_handling="sendToError")
    parsed = pf.parse_pages(order_pages(spark, sf_dir, item), options)
    return _outcomes(parsed.withColumn("kept_id", F.col("record.id")), "id", "total", carry=("kept_id",))


# --- XML --------------------------------------------------------------------------------

PARTS = {"url": f"{HOST}/parts?page=0", "format": "xml", "result_path": "/feed/entry"}


@query
def xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = pf.SourceOptions(schema="id BIGINT NOT NULL", **PARTS)
    return records(part_pages(spark, sf_dir), options)


@query
def xml_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = pf.SourceOptions(
        schema="id BIGINT NOT NULL, name STRING NOT NULL, cat STRING NOT NULL, size INT, price DOUBLE, cur STRING, note STRING",
        fields_mapping={
            "name": "content/properties/Name",
            "cat": "@cat",
            "size": "@m:size",
            "price": "/content/properties/Price",
            "cur": "content/properties/Price/@cur",
            "note": "content/properties/Note/text()",
        },
        **PARTS,
    )
    return records(part_pages(spark, sf_dir), options)


@query
def xml_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = pf.SourceOptions(
        schema="id BIGINT NOT NULL, brand STRING NOT NULL",
        fields_mapping={"brand": "content/m:properties/d:Brand"},
        **{**PARTS, "result_path": "/feed/entry[@cat='ECONOMY']"},
    )
    return records(part_pages(spark, sf_dir), options)


@query
def xml_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparisons, functions and places in result and field paths, joined by ``and``, ``or`` and ``|``."""
    low = "/feed/entry[@m:size < 10 and not(contains(@cat, 'ECO'))]"
    high = "/feed/entry[@size >= 45 and (starts-with(@cat, 'ST') or content/properties/Price > 1900)][position() <= 3]"
    options = pf.SourceOptions(
        schema="id BIGINT NOT NULL, dear DOUBLE, same STRING, note STRING",
        fields_mapping={
            "dear": "content/properties[Price > 1500]/Price",
            "same": "content/properties[Brand = Box/b or string-length(Name) < 0]/Brand",
            "note": "content/properties/Note[last()]",
        },
        **{**PARTS, "result_path": f"{low} | {high}"},
    )
    return records(part_pages(spark, sf_dir), options).drop("entry_no")


@query
def xml_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sibling elements whose names differ in nothing but their case."""
    pages = part_pages(spark, sf_dir)
    three = F.regexp_replace(F.col("body").cast("string"), "<id>([0-9]+)</id>", "<ID>x$1</ID><id>$1</id><Id>y$1</Id>")
    options = pf.SourceOptions(schema="id BIGINT NOT NULL, capital STRING, brand STRING", fields_mapping={"capital": "Id", "brand": "content/properties/Brand"}, **PARTS)
    return records(pages.withColumn("body", three.cast("binary")), options)


@query
def xml_node_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves give their text, an element with children its inner XML, an empty one NULL."""
    options = pf.SourceOptions(
        schema="id BIGINT NOT NULL, note STRING, box STRING",
        fields_mapping={"note": "content/properties/Note", "box": "content/properties/Box"},
        **PARTS,
    )
    return records(part_pages(spark, sf_dir), options)


@query
def xml_walked_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths outside the native subset: descendants and the last child."""
    options = pf.SourceOptions(
        schema="id BIGINT NOT NULL, price DOUBLE NOT NULL, note STRING",
        fields_mapping={"price": ".//d:Price", "note": ".//Note"},
        **{**PARTS, "result_path": "//entry[content]"},
    )
    return records(part_pages(spark, sf_dir), options)


@query
def xml_next_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = part_pages(spark, sf_dir)
    options = pf.SourceOptions(
        schema="id BIGINT", pagination_type="Link in response body", next_page_field_path="/feed/next", **PARTS
    )
    return pf.page_facts(pages, options).select("page_no", "url", F.col("n_entries").cast("bigint").alias("n_entries"), "next_url")


# --- lines ------------------------------------------------------------------------------


def customer_columns() -> list[Column]:
    return [F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string"), F.col("c_acctbal").cast("string"), F.col("c_mktsegment")]


CUSTOMER_LINE = "custkey BIGINT NOT NULL, name STRING NOT NULL, nationkey INT, acctbal DOUBLE, segment STRING"


def csv_options(**more: object) -> pf.SourceOptions:
    return pf.SourceOptions(**{"url": f"{HOST}/lines/0", "format": "csv", "schema": CUSTOMER_LINE, **more})


@query
def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = delimited_pages(table(spark, sf_dir, "customer"), "c_custkey", customer_columns(), ",", line_end="\r\n")
    schema = "custkey STRING NOT NULL, name STRING NOT NULL, nationkey STRING, acctbal STRING, segment STRING"
    return records(pages, csv_options(schema=schema))


@query
def csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns; an empty value of a nullable column is NULL."""
    columns = customer_columns()
    columns[3] = F.when(F.col("c_custkey") % 5 == 0, F.lit("")).otherwise(columns[3])
    columns[4] = F.when(F.col("c_custkey") % 4 == 0, F.lit("")).otherwise(columns[4])
    return records(delimited_pages(table(spark, sf_dir, "customer"), "c_custkey", columns, ","), csv_options())


@query
def csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = customer_columns()
    columns[1] = F.concat(F.lit(' "'), columns[1], F.lit(', the "'), F.lit('"first"'), F.lit('""'))
    return records(delimited_pages(table(spark, sf_dir, "customer"), "c_custkey", columns, ","), csv_options(enable_quoted_values=True))


@query
def csv_skip_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of every page is left out."""
    pages = delimited_pages(table(spark, sf_dir, "customer"), "c_custkey", customer_columns(), ",", header="custkey,name,nationkey,acctbal,segment")
    return records(pages, csv_options(csv_skip_first_row=True))


def bad_customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line in eleven has a column too many, one in thirteen a word for a number, one in seventeen no name."""
    key = F.col("c_custkey")
    columns = customer_columns()
    columns[3] = F.when(key % 13 == 0, F.lit("much")).otherwise(columns[3])
    columns[4] = F.when(key % 11 == 0, F.concat(columns[4], F.lit(",more"))).otherwise(columns[4])
    line = F.when(key % 17 == 0, key.cast("string")).otherwise(F.concat_ws(",", *columns))
    return delimited_pages(table(spark, sf_dir, "customer"), "c_custkey", [line], ",")


@query
def csv_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = pf.parse_pages(bad_customer_pages(spark, sf_dir), csv_options(error_handling="sendToError"))
    return _outcomes(parsed, "custkey", "name", "acctbal", "segment")


@query
def tsv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = delimited_pages(table(spark, sf_dir, "customer"), "c_custkey", customer_columns(), "\t")
    return records(pages, csv_options(format="tsv"))


@query
def csv_infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One inferred schema per source; every block of 500 customers is a source of its own."""
    columns = customer_columns()
    columns[4] = F.when(F.col("c_custkey") % 9 == 0, F.lit("")).otherwise(columns[4])
    pages = delimited_pages(table(spark, sf_dir, "customer"), "c_custkey", columns, ",", header="custkey,name,nationkey,acctbal,segment", per_page=500)
    sources = pages.withColumn("seed", F.col("url")).withColumn("page_no", F.lit(0).cast("bigint"))
    return pf.infer_columns(sources, csv_options(schema=None, csv_skip_first_row=True, sample_size=100))


@query
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    url = F.concat(F.lit(f"{HOST}/doc/"), F.col("doc_id").cast("string"))
    got = responses(docs, url, F.col("doc_id"), url, F.col("text"))
    return records(got, pf.SourceOptions(url=f"{HOST}/doc/0", format="text", schema="line STRING NOT NULL"))


@query
def blob_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    got = responses(pages, F.col("url"), F.col("page_id"), F.col("url"), F.col("html"))
    read = records(got, pf.SourceOptions(url=f"{HOST}/", format="blob", schema="content BINARY NOT NULL"))
    return read.select("page_no", F.octet_length("content").cast("bigint").alias("n_bytes"), F.md5("content").alias("digest"))


# --- pagination -------------------------------------------------------------------------


@query
def page_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the first page of a source is read, whatever else was captured of it."""
    rows = table(spark, sf_dir, "customer").withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    seed = F.concat(F.lit(f"{HOST}/customer/"), F.col("c_custkey").cast("string"))
    url = F.when(F.col("n") == 0, seed).otherwise(F.concat(seed, F.lit("?page=1")))
    got = responses(rows, seed, F.col("n"), url, F.to_json(customer_item()))
    options = pf.SourceOptions(url=f"{HOST}/customer/0", schema="id BIGINT NOT NULL, name STRING NOT NULL")
    return pf.read_captured(got, options).records


@query
def index_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    seeds = rows.select(F.concat(F.lit(f"{HOST}/c/"), F.col("c_custkey").cast("string"), F.lit("?from={pagination.index}&n=20")).alias("seed"))
    return pf.index_plan(seeds, start=10, increment=20, n_pages=6)


def _seed_url(p: Column, n: Column) -> Column:
    return F.concat(F.lit(f"{HOST}/orders/"), priority_slug(p), F.lit("?page="), n.cast("string"))


EMPTIED = {"1-URGENT": 2, "3-MEDIUM": 4}


@query
def index_stop_on_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = lambda p: F.concat(F.lit(f"{HOST}/orders/"), priority_slug(p), F.lit("?page={pagination.index}"))
    pages = seed_pages(spark, sf_dir, _seed_url, emptied=EMPTIED, seed=template)
    return pf.read_captured(pages, orders_options(), positions=True).records


def _next_header(last: dict[str, int]) -> Callable[[Column, Column], Column]:
    def link(p: Column, n: Column) -> Column:
        here = F.concat(F.lit("<"), _seed_url(p, F.lit(0)), F.lit('>; rel="first"'))
        following = F.concat(here, F.lit(", <"), _seed_url(p, n + 1), F.lit('>; rel="next"'))
        out = following
        for name, page in last.items():
            out = F.when((p == name) & (n == page), here).otherwise(out)
        return out

    return link


# the last pages of these captures name a next one, which was left out on purpose
CHAINED = {"url": f"{HOST}/orders/1-urgent?page=0", "start_index": None, "index_increment": None, "partial_capture": True}


@query
def link_header_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = seed_pages(spark, sf_dir, _seed_url, link=_next_header({"1-URGENT": 3}))
    options = orders_options(**{**CHAINED, "pagination_type": "Link in response header"})
    return pf.read_captured(pages, options, positions=True).records


@query
def chain_stop_on_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = seed_pages(spark, sf_dir, _seed_url, link=_next_header({}), emptied=EMPTIED)
    options = orders_options(**{**CHAINED, "pagination_type": "Link in response header"})
    return pf.read_captured(pages, options, positions=True).records


@query
def link_body_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative links in the body; the one of a page of the second priority is null."""

    def extra(p: Column, n: Column) -> list[Column]:
        path = F.concat(F.lit("/orders/"), priority_slug(p), F.lit("?page="), (n + 1).cast("string"))
        whole = F.when(n % 2 == 0, path).otherwise(F.concat(F.lit(HOST), path))
        return [F.struct(F.when(~((p == "2-HIGH") & (n == 2)), whole).alias("next")).alias("_links")]

    pages = seed_pages(spark, sf_dir, _seed_url, extra=extra)
    options = orders_options(**{**CHAINED, "pagination_type": "Link in response body", "next_page_field_path": "_links/next"})
    return pf.read_captured(pages, options, positions=True).records


@query
def token_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token of a page is a parameter of the first URL."""
    base = lambda p: F.concat(F.lit(f"{HOST}/orders/"), priority_slug(p), F.lit("?n=50"))
    url = lambda p, n: F.when(n == 0, base(p)).otherwise(F.concat(base(p), F.lit("&token=t+"), n.cast("string")))

    def extra(p: Column, n: Column) -> list[Column]:
        token = F.concat(F.lit("t "), (n + 1).cast("string"))
        return [F.when(~((p == "4-NOT SPECIFIED") & (n == 1)), token).alias("nextPageToken")]

    pages = seed_pages(spark, sf_dir, url, extra=extra)
    options = orders_options(
        **{
            **CHAINED,
            "pagination_type": "Token in response body",
            "next_page_token_path": "/nextPageToken",
            "next_page_url_parameter": "token",
        }
    )
    return pf.read_captured(pages, options, positions=True).records


NEXT_PAGE = """
import json

def get_next_page_url(url, page, headers):
    onward = json.loads(page).get("onward")
    return url.partition("?")[0] + "?" + "&".join(onward) if onward else None
"""


@query
def custom_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user's own function names the next page."""
    onward = lambda n: F.array(F.concat(F.lit("page="), (n + 1).cast("string")))
    extra = lambda p, n: [F.when(~((p == "5-LOW") & (n == 3)), onward(n)).alias("onward")]
    pages = seed_pages(spark, sf_dir, _seed_url, extra=extra)
    options = orders_options(**{**CHAINED, "pagination_type": "Custom", "custom_next_url": NEXT_PAGE})
    return pf.read_captured(pages, options, positions=True).records


def _plan_with_holes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages = order_pages(spark, sf_dir)
    last = table(spark, sf_dir, "orders").agg(F.max(page_of("o_orderkey"))).first()[0]
    seeds = pages.select("seed").distinct()
    plan = pf.index_plan(seeds, 0, 1, last + 1)
    return plan, pages.filter(F.col("page_no") % 13 != 5)


@query
def replay_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, captured = _plan_with_holes(spark, sf_dir)
    got = pf.replay(plan, captured)
    facts = pf.page_facts(got, orders_options())
    return facts.select("page_no", "url", "status", F.col("n_entries").cast("bigint").alias("n_entries"))


@query
def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.missing_pages(*_plan_with_holes(spark, sf_dir)).drop("seed")


@query
def read_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole read over a capture that lacks pages: these are errors, the others give their records."""
    _, captured = _plan_with_holes(spark, sf_dir)
    last = table(spark, sf_dir, "orders").agg(F.max(page_of("o_orderkey"))).first()[0]
    read = pf.read_captured(captured, orders_options(max_index=last, error_handling="sendToError"), positions=True)
    return _counted(read, "page_no")


@query
def chain_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains end at pages that were not captured; where more was captured behind, that is an error."""
    pages = seed_pages(spark, sf_dir, _seed_url, link=_next_header({}))
    lost = f"{HOST}/orders/2-high?page=3", f"{HOST}/orders/5-low?page=0"
    options = orders_options(**{**CHAINED, "pagination_type": "Link in response header", "error_handling": "sendToError"})
    return _counted(pf.read_captured(pages.filter(~F.col("url").isin(*lost)), options, positions=True), "seed", "page_no")


@query
def chain_torn_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last page of each chain names one more, which was not captured: an error of its own."""
    pages = seed_pages(spark, sf_dir, _seed_url, link=_next_header({}))
    options = orders_options(**{**CHAINED, "pagination_type": "Link in response header", "error_handling": "sendToError", "partial_capture": False})
    return _counted(pf.read_captured(pages, options, positions=True), "seed", "page_no")


def _counted(read: pf.Routed, *keys: str) -> DataFrame:
    """Records of each page, and its error if it has one."""
    got = read.records.groupBy(*keys).agg(F.count("*").alias("n_records"))
    got = got.select(*keys, "n_records", F.lit(None).cast("int").alias("code"), F.lit(None).cast("string").alias("message"))
    return got.unionByName(read.errors.select(*keys, F.lit(0).cast("bigint").alias("n_records"), "code", "message"))


@query
def read_recaptured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the pages was captured twice, and one of them a hundred times."""
    pages = order_pages(spark, sf_dir)
    times = F.when(F.col("page_no") == 3, 100).when(F.col("page_no") % 3 == 0, 2).otherwise(1)
    again = pages.withColumn("_t", F.explode(F.sequence(F.lit(1), times))).drop("_t")
    return pf.read_captured(again, orders_options(), positions=True).records.drop("seed")


# --- statuses and errors ----------------------------------------------------------------

RULES = [
    ("2..", "Success"),
    ("404", "Skip"),
    ("4..", "Send to error"),
    ("503", "Retry and send to error"),
    ("5..", "Retry and skip"),
    ("6..", "Retry and fail"),
]


def _status_pages(spark: SparkSession, sf_dir: str, statuses: list[int]) -> DataFrame:
    """Order pages whose status goes round the list; bodies of failed pages are plain text."""
    pages = order_pages(spark, sf_dir)
    slot = (F.col("page_no") % len(statuses)).cast("int")
    status = F.element_at(F.array(*[F.lit(s) for s in statuses]), slot + 1)
    text = F.concat(F.lit("busy "), F.col("page_no").cast("string")).cast("binary")
    return pages.withColumn("status", status).withColumn("body", F.when(F.col("status") == 200, F.col("body")).otherwise(text))


@query
def status_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _status_pages(spark, sf_dir, [200, 204, 404, 429, 503, 500, 302, 2000, 600])
    return with_strategy(pages, RULES).select("page_no", "status", "strategy", "should_retry", "after_retry")


@query
def http_error_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed pages that are sent to error; skipped ones give nothing, good ones their records."""
    pages = _status_pages(spark, sf_dir, [200, 404, 429, 503, 500])
    return route(pf.parse_pages(pages, orders_options(http_errors_handling=RULES))).errors.drop("seed", "body_bytes")


@query
def bytes_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed pages of a binary source keep their bytes."""
    pages = table(spark, sf_dir, "pages")
    status = F.when(F.col("page_id") % 3 == 0, F.lit(500)).otherwise(F.lit(200))
    got = responses(pages, F.col("url"), F.col("page_id"), F.col("url"), F.col("html"), status=status)
    options = pf.SourceOptions(
        url=f"{HOST}/", format="blob", schema="content BINARY NOT NULL", pagination_type="Link in response header", http_errors_handling=RULES[:3] + [("5..", "Send to error")]
    )
    sent = route(pf.parse_pages(got, options)).errors
    return sent.select("page_no", "code", F.octet_length("body_bytes").cast("bigint").alias("n_bytes"), F.md5("body_bytes").alias("digest"))


@query
def send_to_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = pf.parse_pages(bad_customer_pages(spark, sf_dir), csv_options(error_handling="sendToError"))
    return route(parsed).errors.drop("seed", "body_bytes")


@query
def skip_on_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = pf.parse_pages(bad_customer_pages(spark, sf_dir), csv_options(error_handling="skipOnError"))
    return route(parsed).records


@query
def stop_on_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading bad lines with ``stopOnError`` fails, even where no column is asked for."""
    pages = bad_customer_pages(spark, sf_dir)
    try:
        route(pf.parse_pages(pages, csv_options())).records.count()
        stopped = False
    except Exception as e:
        if "Cannot convert line" not in str(e):
            raise
        stopped = True
    kept = route(pf.parse_pages(pages, csv_options(error_handling="sendToError")))
    return kept.errors.agg(F.count("*").alias("n_bad")).withColumn("stopped", F.lit(stopped))


@query
def retry_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an attempt log: a URL per user, a status per event type, half a day of retries."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("url"), "event_type")
    first = events.groupBy("url").agg(F.min("ts").alias("first_ts"))
    timed = attach(events, first, ["url"], F.col("event_id"))
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "click", 503).when(F.col("event_type") == "view", 429).otherwise(200)
    log = timed.select(
        "url",
        F.col("event_id").alias("attempt"),
        ((F.unix_micros("ts") - F.unix_micros("first_ts")) / F.lit(1_000_000.0)).alias("elapsed_s"),
        status.alias("status"),
    )
    rules = [("2..", "Success"), ("429", "Retry and skip"), ("5..", "Retry and send to error")]
    return pf.resolve_attempts(log, rules, max_retry_duration_s=43_200)


# --- streams ----------------------------------------------------------------------------


def _write_pages(pages: DataFrame, folder: str, files: int = 6) -> None:
    """Add captured pages to a folder, in several files."""
    pages.repartition(files, "seed", "url").write.mode("append").parquet(folder)


def _run(spark: SparkSession, stream: DataFrame, options: pf.SourceOptions, out: str) -> DataFrame:
    """Run a stream of responses to the end of what is there, and read what it wrote."""
    write_stream_routed(stream, options, out, out + "-checkpoint").awaitTermination()
    written = spark.read.parquet(out)
    return written.filter(F.col("outcome") == "record").select("page_no", "entry_no", "record.*")


@query
def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, out = fresh_path(spark, "pages"), fresh_path(spark, "out")
    _write_pages(order_pages(spark, sf_dir), folder)
    return _run(spark, captured_stream(spark, folder), orders_options(), out)


@query
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream stopped and started again goes on where it ended: no page lost, none twice."""
    folder, out = fresh_path(spark, "pages"), fresh_path(spark, "out")
    pages = order_pages(spark, sf_dir)
    _write_pages(pages.filter(F.col("page_no") % 2 == 0), folder)
    _run(spark, captured_stream(spark, folder), orders_options(), out)
    _write_pages(pages.filter(F.col("page_no") % 2 == 1), folder)
    return _run(spark, captured_stream(spark, folder), orders_options(), out)


@query
def stream_max_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bound on what one micro-batch takes in."""
    folder, out = fresh_path(spark, "pages"), fresh_path(spark, "out")
    _write_pages(order_pages(spark, sf_dir), folder)
    return _run(spark, captured_stream(spark, folder, max_files_per_trigger=2), orders_options(), out)


@query
def stream_skip_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page that was captured again is not given out again."""
    folder, out = fresh_path(spark, "pages"), fresh_path(spark, "out")
    pages = order_pages(spark, sf_dir)
    _write_pages(pages, folder)
    _write_pages(pages.filter(F.col("page_no") % 3 == 0), folder, 2)
    return _run(spark, unseen(captured_stream(spark, folder, max_files_per_trigger=4), forget_after="7 days"), orders_options(), out)


@query
def stream_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming source: every priority is a seed, polled twice along its Link headers."""
    capture, spool, out = fresh_path(spark, "capture"), fresh_path(spark, "spool"), fresh_path(spark, "out")
    pages = seed_pages(spark, sf_dir, _seed_url, link=_next_header({"1-URGENT": 3}))
    last = table(spark, sf_dir, "orders").agg(F.max(page_of("o_orderkey", 250))).first()[0]
    ends = pages.withColumn("headers", F.when(F.col("page_no") == last, F.map_filter("headers", lambda k, _: k != "link")).otherwise(F.col("headers")))
    pf.write_capture(ends, capture)
    urls = [r.seed for r in pages.select("seed").distinct().orderBy("seed").collect()]
    options = orders_options(**{**CHAINED, "pagination_type": "Link in response header"})
    for limit in (2, None):
        limited = orders_options(**{**CHAINED, "pagination_type": "Link in response header", "max_pages_per_fetch": limit})
        stream = fetched_stream(spark, limited, spool, pf.capture_transport(capture), urls)
        write_stream_routed(stream, options, out, out + "-checkpoint").awaitTermination()
    written = spark.read.parquet(out)
    return written.filter(F.col("outcome") == "record").select("seed", "page_no", "entry_no", "record.*")


# --- messages ---------------------------------------------------------------------------

SINK = {"url": f"{HOST}/in", "batch_size": 50}


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer")


def _bodies(messages: DataFrame) -> DataFrame:
    return messages.select("url", "body", "n_records")


@query
def sink_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bodies(pf.build_messages(_customers(spark, sf_dir), pf.SinkOptions(**SINK), "c_custkey"))


@query
def sink_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = pf.SinkOptions(write_json_as_array=True, **SINK)
    return _bodies(pf.build_messages(_customers(spark, sf_dir), options, "c_custkey"))


@query
def sink_json_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = pf.SinkOptions(write_json_as_array=True, json_batch_key="customers", **SINK)
    return _bodies(pf.build_messages(_customers(spark, sf_dir), options, "c_custkey"))


@query
def sink_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = pf.SinkOptions(message_format="Form", delimiter="|", **SINK)
    return _bodies(pf.build_messages(_customers(spark, sf_dir), options, "c_custkey"))


@query
def sink_form_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = pf.SinkOptions(message_format="Form", form_style="pairs", **SINK)
    return _bodies(pf.build_messages(_customers(spark, sf_dir), options, "c_custkey"))


@query
def sink_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = pf.SinkOptions(message_format="Custom", body="#c_name (##c_custkey) has #c_acctbal", delimiter="; ", **SINK)
    return _bodies(pf.build_messages(_customers(spark, sf_dir), options, "c_custkey"))


@query
def sink_url_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PUT batches never mix target URLs."""
    options = pf.SinkOptions(**{**SINK, "method": "PUT", "url": f"{HOST}/nation/#c_nationkey/of/#c_mktsegment"})
    return _bodies(pf.build_messages(_customers(spark, sf_dir), options, "c_custkey"))


@query
def sink_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = pf.SinkOptions(url=f"{HOST}/customer/#c_custkey?name=#c_name", method="DELETE")
    messages = pf.build_messages(_customers(spark, sf_dir), options, "c_custkey")
    return messages.select("method", "url", "body", "n_records", "batch_id")


@query
def sink_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages filled per partition, with their request columns; taken apart again, nothing is lost."""
    options = pf.SinkOptions(headers={"X-App": "a"}, write_json_as_array=True, **SINK)
    messages = pf.build_messages(_customers(spark, sf_dir).repartition(7), options)
    fits = F.col("n_records").between(1, 50) & (F.size(F.from_json("body", "array<string>")) == F.col("n_records"))
    rows = F.from_json("body", "array<struct<c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string>>")
    return messages.select("method", "content_type", F.to_json("headers").alias("headers"), fits.alias("fits"), F.explode(rows).alias("r")).select(
        "method", "content_type", "headers", "fits", "r.*"
    )


def _answering(method, url, headers, body, timeout_s):  # noqa: ANN001, ANN202
    """A receiver that knows no customer whose key ends in 3 and refuses those that end in 7."""
    last = urlsplit(url).path[-1]
    return ({"3": 404, "7": 409}.get(last, 204), {}, b"")


@query
def sink_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every message, by the status rules of the sink."""
    rules = [("2..", "Success"), ("404", "Skip"), ("409", "Send to error")]
    options = pf.SinkOptions(url=f"{HOST}/customer/#c_custkey", method="DELETE", http_errors_handling=rules)
    messages = pf.build_messages(_customers(spark, sf_dir), options, "c_custkey")
    return pf.send_messages(messages, options, _answering)
