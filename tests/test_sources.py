import json

import pyarrow.parquet as pq
import pytest
from fake_api import failing_first, from_folder, paged, recorder, requests, unreadable, with_gap
from pyspark.sql import Row

import pageframe as pf
from pageframe.options import SourceOptions
from pageframe.sources import reader as reader_source
from pageframe.sources.reader import Spool
from pageframe.sources.transport import pack, send, unpack
from pageframe.sources.walk import Cursor, walk
from pageframe.sources.writer import MessagesStreamWriter
from pageframe.streaming.streams import captured_stream, fetched_stream, parse_stream, send_stream, unseen, write_stream_routed

INDEX = {"url": "http://h/p?page={pagination.index}", "pagination_type": "Increment an index", "start_index": 0, "index_increment": 1}
HEADER = {"url": "http://h/p", "pagination_type": "Link in response header"}
JSON = {"schema": "v INT NOT NULL", "result_path": "/items"}


def values(df):
    return sorted(r.v for r in df.collect())


# --- walking one seed --------------------------------------------------------------------


def pages_of(options, transport, start=Cursor(), **limits):
    got = list(walk(options, transport, start, **limits))
    return [p.page_no for p, _ in got if p], (got[-1][1] if got else start)


@pytest.mark.parametrize(
    ("more", "link"),
    [
        (INDEX, None),
        (HEADER, "header"),
        ({"url": "http://h/p", "pagination_type": "Link in response body", "next_page_field_path": "/next"}, "body"),
        (
            {
                "url": "http://h/p",
                "pagination_type": "Custom",
                "custom_next_url": "import json\ndef get_next_page_url(u, p, h):\n    return json.loads(p)['next']",
            },
            "body",
        ),
    ],
)
def test_walk(more, link):
    o = SourceOptions(**JSON, **more)
    assert pages_of(o, paged(4, link=link))[0] == [0, 1, 2, 3]
    assert pages_of(o, paged(4, link=link), max_pages=2)[0] == [0, 1]


def test_walk_none_reads_once():
    o = SourceOptions(**JSON, url="http://h/p")
    got, cursor = pages_of(o, paged(3))
    assert got == [0] and cursor.done
    assert pages_of(o, paged(3), cursor)[0] == []


def test_a_single_page_is_given_out_again_only_if_it_changed():
    for again, want in ((False, []), (True, [0])):
        o = SourceOptions(**JSON, url="http://h/p", reemit_on_change=again)
        first, cursor = pages_of(o, paged(1))
        same, cursor = pages_of(o, paged(1), cursor)
        changed, cursor = pages_of(o, paged(1, per_page=3), cursor)
        assert (first, same, changed) == ([0], [], want)


def test_walk_resumes_without_loss_or_repeat():
    for more, link in ((INDEX, None), (HEADER, "header")):
        o = SourceOptions(**JSON, **more)
        first, cursor = pages_of(o, paged(2, link=link))
        second, cursor = pages_of(o, paged(5, link=link), cursor)
        third, _ = pages_of(o, paged(5, link=link), cursor)
        assert (first, second, third) == ([0, 1], [2, 3, 4], [])


def test_token_walk():
    def api(method, url, headers, body, timeout_s):
        token = {"http://h/p?q=1": "a b", "http://h/p?q=1&t=a+b": "c"}.get(url)
        return 200, {}, json.dumps({"items": [{"v": 1}], "n": token}).encode()

    o = SourceOptions(**JSON, url="http://h/p?q=1", pagination_type="Token in response body", next_page_token_path="n", next_page_url_parameter="t")
    assert [p.url for p, _ in walk(o, api, Cursor()) if p] == ["http://h/p?q=1", "http://h/p?q=1&t=a+b", "http://h/p?q=1&t=c"]


def test_xml_walk():
    def api(method, url, headers, body, timeout_s):
        more = "<next>/q</next>" if url.endswith("/p") else ""
        return 200, {}, f'<a:f xmlns:a="u">{more}<a:e>1</a:e></a:f>'.encode()

    o = SourceOptions(
        url="http://h/p", format="xml", schema="v INT", result_path="/f/e", pagination_type="Link in response body", next_page_field_path="/f/next"
    )
    assert [p.url for p, _ in walk(o, api, Cursor()) if p] == ["http://h/p", "http://h/q"]


def test_a_stop_status_fails():
    o = SourceOptions(**JSON, url="http://h/p")
    with pytest.raises(RuntimeError, match="answered 403: no"):
        list(walk(o, lambda *a: (403, {}, b"no"), Cursor()))


# --- retries -----------------------------------------------------------------------------


def run_send(statuses, policy="exponential", interval=None, budget=100.0):
    """Send against a list of statuses with a clock that only sleeping moves."""
    now, waits, left = [0.0], [], list(statuses)

    def sleep(s):
        waits.append(s)
        now[0] += s

    def transport(*_):
        status = left.pop(0) if len(left) > 1 else left[0]
        if status == 0:
            raise ConnectionResetError("reset")
        return status, {}, b""

    answer = send(
        transport, "GET", "u", {}, None, 1, lambda s: "Success" if s == 200 else "Retry and skip", lambda s: s != "Success",
        policy, interval, budget, sleep, lambda: now[0],
    )
    return answer.status, answer.attempts, waits


def test_retry_policies():
    assert run_send([200]) == (200, 1, [])
    assert run_send([503, 503, 200]) == (200, 3, [0.5, 1.0])
    assert run_send([503, 200], "linear", 30) == (200, 2, [30.0])
    assert run_send([503], "linear", 30) == (503, 4, [30.0] * 3)
    assert run_send([0, 0, 200]) == (200, 3, [0.5, 1.0])
    with pytest.raises(ConnectionError, match="Failed to load the page u"):
        run_send([0], budget=2.0)


def test_transport_names():
    assert unpack(None).__name__ == "http"
    assert unpack("fake_api:requests").__name__ == "requests"
    assert unpack(pack(lambda *a: (1, {}, b"")))()[0] == 1


# --- batch reader --------------------------------------------------------------------------


def load(spark, options, transport, **kw):
    reader_source.register(spark)
    return spark.read.format("pages").options(**pf.reader_options(options, transport, **kw)).load()


def test_index_pages_are_read_in_parallel(spark):
    o = SourceOptions(**JSON, **INDEX, max_index=9)
    df = load(spark, o, paged(100), partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert values(pf.route(pf.parse_pages(df, o)).records) == list(range(20))


def test_many_seeds(spark):
    o = SourceOptions(**JSON, **HEADER)
    df = load(spark, o, paged(3, link="header"), urls=["http://a/p", "http://b/p"])
    assert df.rdd.getNumPartitions() == 2
    assert sorted((r.seed, r.page_no) for r in df.collect()) == [(s, i) for s in ("http://a/p", "http://b/p") for i in range(3)]


def test_flat_properties(spark):
    reader_source.register(spark)
    df = (
        spark.read.format("pages")
        .option("url", "http://h/p?page={pagination.index}")
        .option("httpMethod", "post")
        .option("paginationType", "Increment an index")
        .option("startIndex", "1")
        .option("indexIncrement", "2")
        .option("maxIndex", "5")
        .option("format", "json")
        .option("resultPath", "/items")
        .option("transport", pack(paged(100)))
        .load()
    )
    rows = df.orderBy("page_no").collect()
    assert [r.url[-1] for r in rows] == ["1", "3", "5"] and b'"m": "POST"' in rows[0].body


def test_filters_cut_the_pages_fetched(spark, tmp_path):
    (tmp_path / "n_pages").write_text("100")
    o = SourceOptions(**JSON, **INDEX, max_index=99)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        reader_source.register(spark)
        given = {**pf.reader_options(o, from_folder(str(tmp_path))), "push_filters": "true"}
        df = spark.read.format("pages").options(**given).load().filter("page_no >= 3 and page_no < 6")
        assert sorted(r.page_no for r in df.collect()) == [3, 4, 5]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert len(list((tmp_path / "log").iterdir())) == 3


@pytest.mark.parametrize("bound", ["page_no < 10", "page_no <= 1", "page_no >= 1", "page_no = 2"])
def test_filters_on_an_open_index_keep_its_end(spark, tmp_path, bound):
    """Pages behind the first empty one are not given out, whatever filter was pushed."""
    (tmp_path / "n_pages").write_text("3")
    o = SourceOptions(**JSON, **INDEX)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        reader_source.register(spark)
        given = {**pf.reader_options(o, from_folder(str(tmp_path))), "push_filters": "true"}
        rows = spark.read.format("pages").options(**given).load()
        kept = [n for n in range(3) if eval(bound.replace(" = ", " == "), {"page_no": n})]
        assert sorted(r.page_no for r in rows.filter(bound).collect()) == kept
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_fetch_retries_inside_the_task(spark, tmp_path):
    o = SourceOptions(
        **JSON, **INDEX, max_index=2, retry_policy="linear", linear_retry_interval_s=0, http_errors_handling=[("2..", "Success"), ("5..", "Retry and fail")]
    )
    got = pf.fetch_pages(spark, o, str(tmp_path / "out"), failing_first(str(tmp_path / "seen"), 2))
    assert values(pf.read_captured(got, o).records) == list(range(6))
    refused = pf.fetch_pages(spark, o, str(tmp_path / "out2"), failing_first(str(tmp_path / "seen2"), 2, status=0))
    assert refused.count() == 3


def test_open_index_stops_at_the_empty_page(spark, tmp_path):
    (tmp_path / "n_pages").write_text("4")
    o = SourceOptions(**JSON, **INDEX)
    got = pf.fetch_pages(spark, o, str(tmp_path / "out"), from_folder(str(tmp_path)))
    assert got.count() == 4 and len(list((tmp_path / "log").iterdir())) == 5


def test_fetch_by_dataframe(spark, tmp_path):
    o = SourceOptions(**JSON, **INDEX, max_index=5)
    seeds = spark.createDataFrame([("http://a/p?page={pagination.index}",), ("http://b/p?page={pagination.index}",)], "seed string")
    plan = pf.index_plan(seeds, 0, 1, 6).repartition(3)
    got = pf.keep(pf.fetch_urls(plan, o, paged(100)), str(tmp_path / "a"))
    assert sorted((r.seed[7], r.page_no, r.url[-1]) for r in got.collect()) == [(s, i, str(i)) for s in "ab" for i in range(6)]
    chains = pf.fetch_seeds(spark.createDataFrame([("http://a/p",), ("http://b/p",)], "seed string"), SourceOptions(**JSON, **HEADER), paged(3, link="header"))
    assert sorted((r.seed, r.page_no) for r in chains.collect()) == [(s, i) for s in ("http://a/p", "http://b/p") for i in range(3)]
    refused = pf.fetch_urls(plan, o, lambda *a: (404, {}, b"gone"))
    with pytest.raises(Exception, match="answered 404: gone"):
        refused.count()


def test_capture_round_trip(spark, tmp_path, pages):
    given = pages("a", "b", "c", seed="http://h/x", headers=[{"Link": ["l"]}, None, None], status=[200, 500, 200])
    path = str(tmp_path / "cap")
    pf.write_capture(given, path, buckets=4)
    key = lambda r: r.url
    assert sorted(pf.read_capture(spark, path).collect(), key=key) == sorted(given.collect(), key=key)
    look = pf.capture_transport(path, buckets=4)
    assert look("GET", "http://h/x", {}, None, 1) == (200, {"link": ["l"]}, b"a")
    assert look("GET", "http://h/x?1", {}, None, 1)[0] == 500 and look("GET", "http://h/none", {}, None, 1)[0] == 404


# --- streams -------------------------------------------------------------------------------


def test_stream_resumes_where_it_ended(spark, tmp_path):
    """Polls, a restart and new pages in between: every page once, and no fetch is repeated in a replay."""
    api = tmp_path / "api"
    api.mkdir()
    o = SourceOptions(**JSON, **HEADER, max_pages_per_fetch=2)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    seen = []
    for n in (1, 5, 5, 6):
        (api / "n_pages").write_text(str(n))
        stream = fetched_stream(spark, o, str(tmp_path / "spool"), from_folder(str(api)))
        write_stream_routed(stream, o, out, checkpoint).awaitTermination()
        seen.append(spark.read.parquet(out).select("page_no").distinct().count())
    assert seen == [1, 3, 5, 6]
    assert values(spark.read.parquet(out).select("record.v")) == list(range(12))


def test_open_index_stream_waits_for_new_pages(spark, tmp_path):
    api = tmp_path / "api"
    api.mkdir()
    o = SourceOptions(**JSON, **INDEX)
    for n, want in ((2, 4), (2, 4), (3, 6)):
        (api / "n_pages").write_text(str(n))
        stream = fetched_stream(spark, o, str(tmp_path / "spool"), from_folder(str(api)))
        write_stream_routed(stream, o, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert values(spark.read.parquet(str(tmp_path / "out")).select("record.v")) == list(range(want))


def test_spool_replays_a_poll(tmp_path):
    spool = Spool(str(tmp_path))
    o = SourceOptions(**JSON, **HEADER)
    spool.write("http://h/p", 1, walk(o, paged(3, link="header"), Cursor(), 2), Cursor())
    entry = spool.entry("http://h/p", 1)
    assert [row[1] for row in spool.pages(entry)] == [0, 1] == [row[1] for row in spool.pages(entry)]
    assert entry["cursor"] == {"page_no": 2, "url": "http://h/p?page=2", "done": False, "digest": None}
    assert spool.last_number("http://h/p") == 1 and spool.last_number("http://other") == 0 and spool.entry("http://h/p", 2) is None
    headers = next(iter(spool.pages(entry)))[4]
    assert headers["link"] == ['<http://h/p?page=1>; rel="next"']


def test_unseen_on_change(spark, tmp_path, pages):
    folder = str(tmp_path / "cap")
    pages('{"v":1}', seed="u").write.mode("append").parquet(folder)
    pages('{"v":1}', seed="u").write.mode("append").parquet(folder)
    pages('{"v":2}', seed="u").write.mode("append").parquet(folder)
    o = SourceOptions(url="http://h/p", schema="v INT")
    for name, on_change, want in (("once", False, 1), ("changes", True, 2)):
        records = parse_stream(unseen(captured_stream(spark, folder, 1), on_change), o).records
        q = records.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(name).count() == want


# --- sink ----------------------------------------------------------------------------------


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(i, f"n{i}") for i in range(10)], "id int, name string").repartition(2)


def test_writer_sends_every_message(people, spark, tmp_path):
    spark.dataSource.register(pf.MessagesDataSource)
    o = pf.SinkOptions(url="http://h/in", method="PUT", batch_size=3, message_format="Custom", body="#id=#name", delimiter=",", headers={"A": "b"})
    messages = pf.build_messages(people, o)
    messages.write.format("page_messages").options(**pf.writer_options(o, recorder(str(tmp_path)))).mode("append").save()
    got = requests(str(tmp_path))
    assert sorted(p for r in got for p in r["body"].split(",")) == sorted(f"{i}=n{i}" for i in range(10))
    assert {r["method"] for r in got} == {"PUT"} and all(r["headers"]["A"] == "b" and r["headers"]["Batch-Id"] for r in got)
    assert len({r["headers"]["Batch-Id"] for r in got}) == len(got)


def test_refused_messages_go_to_the_error_folder(spark, tmp_path):
    spark.dataSource.register(pf.MessagesDataSource)
    df = spark.createDataFrame([(1, "ok"), (2, "refuse")], "id int, name string").coalesce(1)
    o = pf.SinkOptions(url="http://h/in", http_errors_handling=[("2..", "Success"), ("409", "Send to error")])
    given = pf.writer_options(o, recorder(str(tmp_path / "sent")), error_path=str(tmp_path / "errors"))
    pf.build_messages(df, o).write.format("page_messages").options(**given).mode("append").save()
    assert len(requests(str(tmp_path / "sent"))) == 2
    assert [(r.status, json.loads(r.body)["id"]) for r in spark.read.parquet(str(tmp_path / "errors")).collect()] == [(409, 2)]


def test_two_attempts_of_a_poll_give_the_rows_of_the_first(tmp_path):
    spool = Spool(str(tmp_path))
    o = SourceOptions(**JSON, **HEADER)
    late = Spool(str(tmp_path))
    slow = walk(o, paged(4, link="header"), Cursor(), 3)
    begun = next(slow)  # this attempt started first and ends last
    spool.write("http://h/p", 1, walk(o, paged(3, link="header"), Cursor(), 2), Cursor())
    first = spool.entry("http://h/p", 1)
    late.write("http://h/p", 1, iter([begun, *slow]), Cursor())
    assert late.entry("http://h/p", 1) == spool.entry("http://h/p", 1) == first
    assert [row[1] for row in late.pages(first)] == [0, 1] and spool.last_number("http://h/p") == 1
    assert spool.entry("http://h/p", 1)["cursor"] == first["cursor"]


def test_refused_messages_of_repeated_tasks_count_once(tmp_path):
    """Only the attempts that a commit names are published; a micro-batch run again replaces what it left."""
    o = pf.SinkOptions(url="http://h/in", http_errors_handling=[("2..", "Success"), ("409", "Send to error")])
    given = pf.writer_options(o, recorder(str(tmp_path / "sent")), error_path=str(tmp_path / "errors"))
    rows = [Row(url="http://h/in", method="POST", headers={}, body=b, batch_id=b, n_records=1) for b in ('{"name":"refuse","id":1}', '{"name":"ok","id":2}')]
    writer = MessagesStreamWriter(given)
    lost, kept = writer.write(iter(rows)), writer.write(iter(rows))
    assert lost.file != kept.file and not list((tmp_path / "errors").glob("*.parquet"))
    writer.commit([kept], 7)
    writer.commit([writer.write(iter(rows)), None], 7)
    found = list((tmp_path / "errors").glob("*.parquet"))
    assert [f.name for f in found] == ["batch-000000000007-00000.parquet"] and pq.read_table(found[0])["batch_id"].to_pylist() == [rows[0].batch_id]
    counts = json.loads((tmp_path / "errors" / "_outcomes" / "batch-000000000007.json").read_text())
    assert counts == {"messages": 2, "records": 2, "skipped": 0, "to_error": 1}
    given_up = writer.write(iter(rows))
    writer.abort([given_up, None], 8)
    assert not (tmp_path / "errors" / "_staged" / given_up.file).exists() and len(list((tmp_path / "errors").glob("*.parquet"))) == 1


def test_a_failing_status_fails_the_write(people, spark, tmp_path):
    spark.dataSource.register(pf.MessagesDataSource)
    o = pf.SinkOptions(url="http://h/in", batch_size=100)
    with pytest.raises(Exception, match="returned status code '500'"):
        given = pf.writer_options(o, recorder(str(tmp_path), status=500))
        pf.build_messages(people, o).write.format("page_messages").options(**given).mode("append").save()


def test_sink_retries(people, tmp_path):
    o = pf.SinkOptions(
        url="http://h/#id", method="DELETE", retry_policy="linear", linear_retry_interval_s=0, http_errors_handling=[("2..", "Success"), ("5..", "Retry and fail")]
    )
    sent = pf.send_messages(pf.build_messages(people, o), o, failing_first(str(tmp_path), 2, then=lambda *a: (204, {}, b"")))
    assert [(r.status, r.attempts, r.handling) for r in sent.collect()] == [(204, 3, "success")] * 10


def test_stream_sink(spark, tmp_path, pages):
    folder = str(tmp_path / "cap")
    pages('[{"v":1},{"v":2}]', '[{"v":3}]').write.parquet(folder)
    source = SourceOptions(url="http://h/p", schema="v INT")
    records = parse_stream(captured_stream(spark, folder), source).records
    sink = pf.SinkOptions(url="http://h/in", batch_size=2)
    send_stream(records, sink, str(tmp_path / "cp"), recorder(str(tmp_path / "sent"))).awaitTermination()
    bodies = [line for r in requests(str(tmp_path / "sent")) for line in r["body"].split("\n")]
    assert sorted(bodies) == ['{"v":1}', '{"v":2}', '{"v":3}']


def test_stream_writer(spark, tmp_path, pages):
    """Messages of a stream through ``writeStream`` itself."""
    spark.dataSource.register(pf.MessagesDataSource)
    folder = str(tmp_path / "cap")
    pages('[{"v":1},{"v":2}]').write.parquet(folder)
    records = parse_stream(captured_stream(spark, folder), SourceOptions(url="http://h/p", schema="v INT")).records
    o = pf.SinkOptions(url="http://h/in", batch_size=10)
    given = pf.writer_options(o, recorder(str(tmp_path / "sent")))
    q = (
        pf.build_messages(records, o).writeStream.format("page_messages").options(**given)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    assert [r["body"] for r in requests(str(tmp_path / "sent"))] == ['{"v":1}\n{"v":2}']


# --- reads that don't depend on how they are cut up ----------------------------------------


@pytest.mark.parametrize("partitions", [1, 4, 8])
def test_ranges_with_an_empty_page(spark, partitions):
    o = SourceOptions(**JSON, **INDEX, max_index=39)
    df = load(spark, o, with_gap(5), partitions=partitions)
    assert sorted(r.page_no for r in df.collect()) == list(range(40))
    assert values(pf.read_captured(df, o).records) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("handling", ["stopOnError", "skipOnError", "sendToError"])
def test_an_open_index_of_unreadable_pages_ends(handling):
    o = SourceOptions(**JSON, **INDEX, error_handling=handling)
    if handling == "stopOnError":
        with pytest.raises(RuntimeError, match="cannot be read"):
            pages_of(o, unreadable)
    else:
        assert pages_of(o, unreadable)[0] == [0]


def test_batch_ids_never_repeat_for_other_content(spark):
    rows = spark.createDataFrame([(i, f"t{i % 3}") for i in range(40)], "id long, t string").repartition(4)
    for sink in (
        pf.SinkOptions(url="http://h/in", batch_size=3),
        pf.SinkOptions(url="http://h/in"),
        pf.SinkOptions(url="http://h/in/#t", method="DELETE"),
    ):
        ids = [r.batch_id for part in (rows, rows) for r in pf.build_messages(part, sink).collect()]
        assert len(ids) == len(set(ids))
        same = [sorted(r.batch_id for r in pf.build_messages(rows, sink, run="x").collect()) for _ in range(2)]
        assert same[0] == same[1] and not set(same[0]) & set(ids)


def test_a_delimited_read_without_a_schema(spark, pages):
    body = "id,name,price\n1,a,2.5\n2,,3"
    o = SourceOptions(url="http://h/p", format="csv", csv_skip_first_row=True)
    read = pf.read_captured(pages(body, seed="http://h/p"), o).records.orderBy("id")
    assert read.dtypes == [("id", "int"), ("name", "string"), ("price", "double")]
    assert [tuple(r) for r in read.collect()] == [(1, "a", 2.5), (2, None, 3.0)]
