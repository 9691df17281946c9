import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import pageframe as pf
from pageframe.operators.errors import STRATEGIES, with_strategy

RULES = [("2..", "Success"), ("401", "Retry and fail"), ("4..", "Fail"), ("5..", "Retry and send to error"), (".*", "Fail")]


@pytest.mark.parametrize(
    ("status", "strategy", "retry", "after"),
    [
        (200, "Success", False, "success"),
        (401, "Retry and fail", True, "stopOnError"),
        (404, "Fail", False, "stopOnError"),
        (503, "Retry and send to error", True, "sendToError"),
        (302, "Fail", False, "stopOnError"),
        (2000, "Fail", False, "stopOnError"),
    ],
)
def test_first_matching_rule_wins(spark, status, strategy, retry, after):
    row = with_strategy(spark.createDataFrame([(status,)], "status int"), RULES).first()
    assert (row.strategy, row.should_retry, row.after_retry) == (strategy, retry, after)


def test_no_rule_is_a_failure(spark):
    assert with_strategy(spark.createDataFrame([(200,)], "status int"), []).first().after_retry == "stopOnError"


def options(handling, **more):
    return pf.SourceOptions(url="http://h/p", format="csv", schema="a INT NOT NULL", error_handling=handling, **more)


def test_three_ways(pages):
    got = pages("1\nx\n3\n")
    sent = pf.route(pf.parse_pages(got, options("sendToError")))
    assert sorted(r.a for r in sent.records.collect()) == [1, 3]
    assert [(e.code, e.body, e.entry_no) for e in sent.errors.collect()] == [(0, "x", 1)]
    skipped = pf.route(pf.parse_pages(got, options("skipOnError")))
    assert skipped.records.count() == 2 and skipped.errors.count() == 0


@pytest.mark.parametrize("action", ["count", "collect", "errors"])
def test_stop_fails_whatever_is_asked_for(pages, action):
    routed = pf.route(pf.parse_pages(pages("1\nx\n"), options("stopOnError")))
    with pytest.raises(Exception, match="Cannot convert line 'x'"):
        routed.errors.count() if action == "errors" else getattr(routed.records, action)()


def test_failed_page_stops_the_job(pages):
    got = pages("1\n", "denied", status=[200, 403])
    routed = pf.route(pf.parse_pages(got, options("skipOnError")))
    with pytest.raises(Exception, match="Request failed with '403' http status code. Body is 'denied'"):
        routed.records.count()


def test_observed_counts(pages):
    seen = Observation("routed")
    routed = pf.route(pf.parse_pages(pages("1\nx\ny\n3\n"), options("skipOnError")), observation=seen)
    assert routed.records.count() == 2
    assert seen.get == {"n_records": 2, "n_sent": 0, "n_skipped": 2}


def test_both_outputs_in_one_pass(spark, pages, tmp_path):
    path = str(tmp_path / "out")
    pf.write_routed(pf.parse_pages(pages("1\nx\n3\n"), options("sendToError")), path)
    written = spark.read.parquet(path)
    assert sorted(r.a for r in written.filter("outcome = 'record'").select("record.a").collect()) == [1, 3]
    assert [r.body for r in written.filter("outcome = 'error'").select("error.body").collect()] == ["x"]


def test_attempts_against_brute_force(spark):
    rnd = random.Random(3)
    rules = [("2..", "Success"), ("404", "Skip"), ("4..", "Retry and fail"), ("5..", "Retry and send to error")]
    log, want = [], {}
    for u in range(60):
        t, result = rnd.choice([0.0, 5.0]), None
        for attempt in range(1, rnd.randint(2, 12)):
            status = rnd.choice([200, 404, 429, 500, 503, 503])
            log.append((f"u{u}", attempt, t, status))
            if result is None or not result[3]:
                if attempt == 1 or t <= 20:
                    strategy = "Success" if status == 200 else "Skip" if status == 404 else "Retry and fail" if status == 429 else "Retry and send to error"
                    result = (attempt, status, strategy, not STRATEGIES[strategy][0])
            t += rnd.choice([1.0, 7.0])
        want[f"u{u}"] = result
    df = spark.createDataFrame(log, "url string, attempt int, elapsed_s double, status int").repartition(5)
    for r in pf.resolve_attempts(df, rules, 20).collect():
        attempt, status, strategy, final = want[r.url]
        assert (r.attempt, r.status, r.strategy, r.timed_out) == (attempt, status, strategy, not final)
        assert r.after_retry == STRATEGIES[strategy][1]


def test_headers_are_folded(spark):
    df = spark.createDataFrame([("u", {"Link": ["a"], "X": ["1", "2"], "x": ["3"]}, "b")], "url string, headers map<string,array<string>>, body string")
    row = pf.as_responses(df).first()
    assert row.headers["link"] == ["a"] and sorted(row.headers["x"]) == ["1", "2", "3"]
    assert (row.seed, row.page_no, row.status, bytes(row.body)) == ("u", 0, 200, b"b")
    bare = pf.as_responses(spark.createDataFrame([("u", None)], "url string, body string"))
    got = pf.response_columns(bare, "Link").first()
    assert (got.n_bytes, got.text, got.header_link) == (0, "", None)
    assert F is not None
