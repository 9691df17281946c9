"""Streams that skip pages they have given out: what is kept, and for how long."""

import time

from pageframe.operators.responses import RESPONSE_SCHEMA
from pageframe.streaming.streams import captured_stream, unseen


def write(pages, folder, urls, bodies=None):
    pages(*(bodies or ["{}"] * len(urls)), seed="http://h/p", urls=urls).select(*[f.split()[0] for f in RESPONSE_SCHEMA.split(", ")][:6]).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, out, **kw):
    stream = unseen(captured_stream(spark, folder), **kw)
    query = (
        stream.select("url", "body").writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    state = [op for p in query.recentProgress for op in p["stateOperators"]]
    return sorted(r.url for r in spark.read.parquet(out).collect()), [op["numRowsTotal"] for op in state]


def test_seen_pages_are_skipped_and_state_has_a_row_for_each(spark, pages, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(pages, folder, ["a", "b", "a", "a"])
    got, rows = run(spark, folder, out, forget_after="1 hour")
    assert got == ["a", "b"] and rows[-1] == 2
    write(pages, folder, ["b", "c"])
    got, rows = run(spark, folder, out, forget_after="1 hour")
    assert got == ["a", "b", "c"] and rows[-1] == 3


def test_changed_content_is_new(spark, pages, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(pages, folder, ["a", "a", "a"], ["1", "2", "1"])
    got, rows = run(spark, folder, out, on_change=True, forget_after="1 hour")
    assert got == ["a", "a"] and rows[-1] == 2
    assert run(spark, folder, str(tmp_path / "ever"), on_change=True)[0] == ["a", "a"]


def test_state_is_dropped_in_time(spark, pages, tmp_path):
    """Keys live as long as asked for; a page that comes back later is given out again."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(pages, folder, [f"u{i}" for i in range(50)])
    run(spark, folder, out, forget_after="1 second")
    for n in range(3):
        time.sleep(2)
        write(pages, folder, [f"v{n}"])
        got, rows = run(spark, folder, out, forget_after="1 second")
    assert rows[-1] <= 2
    write(pages, folder, ["u7"])
    got, _ = run(spark, folder, out, forget_after="1 second")
    assert got.count("u7") == 2 and got.count("u8") == 1
