import json
import random

import pytest
from pyspark.sql import functions as F

import pageframe as pf
from pageframe.functions.skew import attach, lookup
from pageframe.functions.urls import add_parameter, next_in_link_header, resolve_link
from pageframe.plans.chains import resolve_chains
from pageframe.plans.page_plan import in_plan, page_count

URL = "http://h.com/p"
FACTS = "seed string, page_no long, url string, status int, n_entries int, next_url string"


def options(kind="None", **more):
    given = {"url": URL, "schema": "v INT NOT NULL", "result_path": "/items", "pagination_type": kind, **more}
    return pf.SourceOptions(**given)


def page(*values, **extra):
    return json.dumps({"items": [{"v": v} for v in values], **extra})


def read(responses, o):
    rows = pf.read_captured(responses, o, positions=True).records.orderBy("page_no", "entry_no").collect()
    return [(r.page_no, r.v) for r in rows]


def test_none_reads_the_first_page_only(pages):
    got = pages(page(1, 2), page(3), seed=URL, urls=[URL, URL + "?2"])
    assert read(got, options()) == [(0, 1), (0, 2)]


def test_index(pages):
    template = "http://h.com/p?from={pagination.index}"
    o = options("Increment an index", url=template, start_index=10, index_increment=5, max_index=20)
    plan = pf.index_plan(pages("x", seed=template), 10, 5, page_count(10, 5, 20)).orderBy("page_no").collect()
    assert [(r.page_no, r.page_index, r.url) for r in plan] == [(i, 10 + 5 * i, f"http://h.com/p?from={10 + 5 * i}") for i in range(3)]
    got = pages(page(1), page(2), page(3), page(4), seed=template, urls=[r.url for r in plan] + ["http://h.com/p?from=25"])
    assert read(got, o) == [(0, 1), (1, 2), (2, 3)]
    assert in_plan(got, o).count() == 3


@pytest.mark.parametrize(
    ("start", "increment", "maximum", "n"), [(0, 20, 100, 6), (0, 20, 99, 5), (5, 1, 5, 1), (6, 1, 5, 0), (6, -1, 5, 0), (3, -1, 5, None), (0, 1, None, None)]
)
def test_page_count(start, increment, maximum, n):
    assert page_count(start, increment, maximum) == n


def test_long_plan_in_blocks(spark):
    seeds = spark.createDataFrame([("http://a/{pagination.index}",), ("http://b/{pagination.index}",)], "seed string")
    plan = pf.index_plan(seeds, 100, -3, 25_001)
    assert plan.count() == 50_002 and plan.select("seed", "page_no").distinct().count() == 50_002
    assert plan.agg(F.min("page_index"), F.max("page_index")).first() == (100 - 3 * 25_000, 100)


def test_open_index_stops_at_the_first_empty_page(pages):
    template = "http://h.com/p?{pagination.index}"
    o = options("Increment an index", url=template, start_index=0, index_increment=1)
    got = pages(page(1), page(2), page(), page(4), seed=template, urls=[f"http://h.com/p?{i}" for i in range(4)])
    assert read(got, o) == [(0, 1), (1, 2)]


@pytest.mark.parametrize(
    ("link", "url"),
    [
        ('<http://a?p=2>; rel="next", <http://a?p=9>; rel="last"', "http://a?p=2"),
        ('<http://a?p=1>; rel="prev", <http://a?p=3,4;5>; title="x"; rel="next"', "http://a?p=3,4;5"),
        ("<http://a?p=2>; rel=next", "http://a?p=2"),
        ('<http://a?p=2>; rel="last"', None),
        ("", None),
        (None, None),
        ('<http://a?p=2>; rel="nextish"', None),
    ],
)
def test_next_link_in_header(spark, link, url):
    assert spark.createDataFrame([(link,)], "l string").select(next_in_link_header(F.col("l"))).first()[0] == url


@pytest.mark.parametrize(
    ("link", "url"),
    [
        ("https://x.org/a", "https://x.org/a"),
        ("/rest/q?start=2", "http://u@h.com:81/rest/q?start=2"),
        ("?start=2", "http://u@h.com:81/a/b?start=2"),
        ("c?x=1", "http://u@h.com:81/a/c?x=1"),
        ("//other.org/z", "http://other.org/z"),
        ("", None),
        (None, None),
    ],
)
def test_link_resolution(spark, link, url):
    df = spark.createDataFrame([(link,)], "l string")
    got = df.select(resolve_link(F.col("l"), F.lit("http://u@h.com:81/first"), F.lit("http://u@h.com:81/a/b?start=1#f"))).first()[0]
    assert got == url


@pytest.mark.parametrize(
    ("url", "token", "want"),
    [
        ("http://a/b", "t 1&", "http://a/b?token=t+1%26"),
        ("http://a/b?x=1", "t", "http://a/b?x=1&token=t"),
        ("http://a/b?x=1#f", "t", "http://a/b?x=1&token=t#f"),
        ("http://a/b?", "t", "http://a/b?token=t"),
        ("http://a/b", None, None),
    ],
)
def test_token_parameter(spark, url, token, want):
    df = spark.createDataFrame([(url, token)], "u string, t string")
    assert df.select(add_parameter(F.col("u"), "token", F.col("t"))).first()[0] == want


def test_link_in_header_with_skipped_page(pages):
    urls = [f"http://h.com/p{i}" for i in range(4)]
    headers = [{"Link": [f'<{urls[i + 1]}>; rel="next"']} if i < 3 else None for i in range(4)]
    o = options("Link in response header", url=urls[0], http_errors_handling=[("2..", "Success"), ("500", "Skip"), ("404", "Send to error")])
    got = pages(page(1), "oops", "gone", page(4), seed=urls[0], urls=urls, headers=headers, status=[200, 500, 404, 200])
    assert read(got, o) == [(0, 1), (3, 4)]
    errors = pf.read_captured(got, o).errors.collect()
    assert [(e.page_no, e.code, e.body) for e in errors] == [(2, 404, "gone")]


def test_link_in_body(pages):
    urls = [URL, "http://h.com/q?2", "http://h.com/q?3"]
    got = pages(page(1, links={"next": "/q?2"}), page(2, links={"next": urls[2]}), page(3, links={"next": None}), seed=URL, urls=urls)
    o = options("Link in response body", next_page_field_path="/links/next")
    assert read(got, o) == [(0, 1), (1, 2), (2, 3)]


def test_object_where_a_link_is_due_fails(pages):
    o = options("Link in response body", next_page_field_path="/links")
    with pytest.raises(Exception, match="expected to be a primitive"):
        pf.page_facts(pages(page(1, links={"a": 1})), o).collect()


def test_token_and_stop_on_empty(pages):
    urls = [URL, URL + "?t=a", URL + "?t=b", URL + "?t=c"]
    got = pages(page(1, n="a"), page(2, n="b"), page(n="c"), page(4), seed=URL, urls=urls)
    o = options("Token in response body", next_page_token_path="n", next_page_url_parameter="t")
    assert read(got, o) == [(0, 1), (1, 2)]


def test_xml_next_link(pages):
    urls = ["http://h.com/x", "http://h.com/y"]
    bodies = ["<f><next>/y</next><e><v>1</v></e></f>", "<f><next/><e><v>2</v></e></f>"]
    o = options("Link in response body", url=urls[0], format="xml", result_path="/f/e", next_page_field_path="/f/next")
    assert read(pages(*bodies, seed=urls[0], urls=urls), o) == [(0, 1), (1, 2)]


CODE = """
def get_next_page_url(url, page, headers):
    import json
    n = json.loads(page)["then"]
    return None if n > 3 else "http://h.com/p?%d" % n
"""


def test_custom(pages):
    urls = [URL] + [f"{URL}?{i}" for i in (1, 2, 3, 4)]
    got = pages(*[page(i, then=i + 1) for i in range(5)], seed=URL, urls=urls)
    assert [v for _, v in read(got, options("Custom", custom_next_url=CODE))] == [0, 1, 2, 3]
    by_header = options("Custom", custom_next_url=lambda url, body, headers: headers.get("X-Next"))
    tagged = pages(page(1), page(2), seed=URL, urls=urls[:2], headers=[{"x-NEXT": [urls[1]]}, None])
    assert [v for _, v in read(tagged, by_header)] == [1, 2]


def test_custom_function_that_raises_fails_the_job(pages):
    o = options("Custom", custom_next_url="def get_next_page_url(url, page, headers):\n    raise ValueError('no page')")
    with pytest.raises(Exception, match="no page"):
        pf.read_captured(pages(page(1), seed=URL), o)


def walk(facts):
    """Brute force: follow the links of each seed."""
    by = {}
    for seed, no, url, _, n, following in sorted(facts, key=lambda f: f[1], reverse=True):
        by[seed, url] = (no, n, following)
    out = set()
    for seed in {f[0] for f in facts}:
        url, i, seen = seed, 0, set()
        while (seed, url) in by and url not in seen:
            seen.add(url)
            no, n, following = by[seed, url]
            out.add((seed, url, i, no))
            if n == 0 or following is None:
                break
            url, i = following, i + 1
    return out


@pytest.mark.parametrize("numbering", ["in order", "shuffled", "none"])
@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_chains_against_a_walk(spark, hot_rows, numbering, monkeypatch):
    """Long, short, broken, looping and empty chains, with many pages that name one hot page."""
    monkeypatch.setattr("pageframe.plans.chains.BLOCK", 16)
    rnd = random.Random(7)
    facts = []
    for s, length in enumerate([1, 2, 37, 64, 65, 100]):
        urls = [f"s{s}"] + [f"s{s}/{i}" for i in range(1, length)]
        for i, u in enumerate(urls):
            following = urls[i + 1] if i + 1 < length else None
            facts.append([f"s{s}", i, u, 200, 3, following])
        for i in range(60):  # unreachable pages that all name the middle of the chain
            facts.append([f"s{s}", 1000 + i, f"s{s}/x{i}", 200, 1, urls[length // 2]])
    facts += [["loop", i, "loop" if i == 0 else f"l{i}", 200, 1, f"l{i + 1}" if i < 9 else "l4"] for i in range(10)]
    facts += [["self", 0, "self", 200, 1, "self"], ["gap", 0, "gap", 200, 1, "nowhere"], ["late", 0, "elsewhere", 200, 1, None]]
    facts += [["empty", 0, "empty", 200, 1, "e1"], ["empty", 1, "e1", 200, 0, "e2"], ["empty", 2, "e2", 200, 1, None]]
    facts += [["twice", 5, "twice", 200, 1, "t1"], ["twice", 3, "twice", 200, 1, "t1"], ["twice", 4, "t1", 200, 1, None]]
    if numbering == "shuffled":
        for s in {f[0] for f in facts} - {"twice"}:
            mine = [f for f in facts if f[0] == s]
            numbers = [f[1] for f in mine]
            rnd.shuffle(numbers)
            for f, no in zip(mine, numbers, strict=True):
                f[1] = no
    if numbering == "none":
        facts = [[f[0], 0, *f[2:]] for f in facts]
    rnd.shuffle(facts)
    df = spark.createDataFrame([tuple(f) for f in facts], FACTS)
    chain = resolve_chains(df, hot_rows=hot_rows)
    assert {(r.seed, r.url, r.page_no, r.captured_no) for r in chain.collect()} == walk(facts)
    missing = pf.missing_links(df, chain).collect()
    assert [(r.seed, r.page_no, r.url) for r in missing] == [("gap", 1, "nowhere")]


def test_missing_pages(pages, spark):
    plan = spark.createDataFrame([("s", i, f"u{i}") for i in range(4)], "seed string, page_no long, url string")
    got = pages("a", "b", seed="s", urls=["u0", "u2"])
    assert sorted((r.page_no, r.url, r.code) for r in pf.missing_pages(plan, got).collect()) == [(1, "u1", 0), (3, "u3", 0)]
    assert sorted((r.page_no, r.url) for r in pf.replay(plan, got).collect()) == [(0, "u0"), (2, "u2")]


def test_skewed_joins_give_the_plain_join(spark):
    left = spark.range(2000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 7).alias("w"))
    want = sorted(map(tuple, left.join(right, "k").select("k", "id", "w").collect()))
    for hot in (1, 100, 10_000):
        assert sorted(map(tuple, lookup(left, right, "k", F.col("id"), hot_rows=hot, salts=8).select("k", "id", "w").collect())) == want
    outer = sorted(left.join(right, "k", "left").select("k", "id", "w").collect(), key=lambda r: r.id)
    for limit in (0, 1000):
        got = attach(left, right, ["k"], F.col("id"), limit=limit, salts=8).select("k", "id", "w").collect()
        assert sorted(got, key=lambda r: r.id) == outer


def test_small_stops_are_broadcast_and_bodies_stay(pages):
    template = "http://h.com/p?{pagination.index}"
    o = options("Increment an index", url=template, start_index=0, index_increment=1)
    got = pages(page(1), page(), seed=template)
    plan = pf.pages_to_read(got, o)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def outcome(responses, o):
    """(page, value) of the records and (page, code, url) of the errors."""
    both = pf.read_captured(responses, o, positions=True)
    records = [(r.page_no, r.v) for r in both.records.orderBy("page_no", "entry_no").collect()]
    return records, [(e.page_no, e.code, e.url) for e in both.errors.orderBy("page_no").collect()]


def test_missing_index_pages_are_errors(pages, monkeypatch):
    monkeypatch.setattr("pageframe.plans.captures.BLOCK", 2)
    template = "http://h.com/p?{pagination.index}"
    url = "http://h.com/p?{}".format
    more = {"url": template, "start_index": 0, "index_increment": 10, "error_handling": "sendToError"}
    numbers = [0, 1, 3, 4, 7]
    got = pages(*[page(n) for n in numbers], seed=template, urls=[url(10 * n) for n in numbers], page_nos=numbers)
    records = [(n, n) for n in numbers]
    o = options("Increment an index", **more)
    assert outcome(got, o) == (records, [(n, 0, url(10 * n)) for n in (2, 5, 6)])
    o = options("Increment an index", max_index=90, **more)
    assert outcome(got, o) == (records, [(n, 0, url(10 * n)) for n in (2, 5, 6, 8, 9)])
    empty = pages(*[page(n) if n != 4 else page() for n in numbers], seed=template, urls=[url(10 * n) for n in numbers], page_nos=numbers)
    assert outcome(empty, o) == (records[:3], [(2, 0, url(20))])
    with pytest.raises(Exception, match="Failed to load the page"):
        read(got, options("Increment an index", **{**more, "error_handling": "stopOnError"}))
    assert read(got, options("Increment an index", **{**more, "error_handling": "skipOnError"})) == records


def test_missing_pages_of_chains_are_errors(pages):
    urls = [URL] + [f"{URL}?t={i}" for i in range(1, 5)]
    more = {"next_page_token_path": "n", "next_page_url_parameter": "t", "error_handling": "sendToError"}
    o = options("Token in response body", **more)
    bodies = [page(i, n=str(i + 1)) for i in range(5)]
    partial = options("Token in response body", partial_capture=True, **more)
    whole = pages(*bodies, seed=URL, urls=urls)
    assert outcome(whole, partial) == ([(i, i) for i in range(5)], [])  # the capture ends there
    # a next page that is known and cannot be had is missing, as it is for a fetch
    assert outcome(whole, o) == ([(i, i) for i in range(5)], [(5, 0, f"{URL}?t=5")])
    assert outcome(whole, options("Token in response body", max_pages_per_fetch=5, **more))[1] == []
    with pytest.raises(Exception, match="Failed to load the page .*t=5"):
        read(whole, options("Token in response body", **{**more, "error_handling": "stopOnError"}))
    at = [0, 1, 3, 4]
    got = pages(*[bodies[i] for i in at], seed=URL, urls=[urls[i] for i in at], page_nos=at)
    assert outcome(got, o) == ([(0, 0), (1, 1)], [(2, 0, urls[2])])
    with pytest.raises(Exception, match="Failed to load the page"):
        read(got, options("Token in response body", **{**more, "error_handling": "stopOnError"}))
    headless = pages(*bodies[1:], seed=URL, urls=urls[1:], page_nos=[1, 2, 3, 4])
    assert outcome(headless, o) == ([], [(0, 0, URL)])


@pytest.mark.parametrize("kind", ["None", "Increment an index", "Token in response body"])
def test_a_page_captured_several_times_counts_once(pages, kind):
    more = {"None": {}, "Increment an index": {"start_index": 0, "index_increment": 1}}.get(
        kind, {"next_page_token_path": "n", "next_page_url_parameter": "t"}
    )
    seed = f"{URL}?t={{pagination.index}}" if kind == "Increment an index" else URL
    urls = [f"{URL}?t={i}" if i or kind == "Increment an index" else URL for i in range(3)]
    bodies = [page(i, n=str(i + 1) if i < 2 else None) for i in range(3)]
    twice = [(0, bodies[0]), (1, bodies[1]), (1, bodies[1]), (1, page(1, n="2", again=True)), (2, bodies[2]), (0, bodies[0])]
    got = pages(*[b for _, b in twice], seed=seed, urls=[urls[i] for i, _ in twice], page_nos=[i for i, _ in twice])
    want = [(i, i) for i in range(1 if kind == "None" else 3)]
    assert read(got, options(kind, **{"url": seed, **more})) == want


def test_the_page_that_is_missing_is_named(pages):
    """Under stopOnError the read fails with the page that is absent, not with one that is there."""
    urls = [f"{URL}?n={i}" for i in (0, 1, 3)]
    got = pages(*[page(i) for i in (0, 1, 3)], seed=URL + "?n={pagination.index}", urls=urls, page_nos=[0, 1, 3])
    o = options("Increment an index", url=URL + "?n={pagination.index}", start_index=0, index_increment=1)
    with pytest.raises(Exception, match=r"Failed to load the page http://h.com/p\?n=2"):
        read(got, o)


def test_empty_capture_has_no_pages_and_no_holes(pages, spark):
    none = pages("x").limit(0)
    for kind, more in (("None", {}), ("Increment an index", {"start_index": 0, "index_increment": 1, "url": URL + "{pagination.index}"})):
        assert outcome(none, options(kind, error_handling="sendToError", **more)) == ([], [])
