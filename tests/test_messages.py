import pytest

import pageframe as pf

PEOPLE = [(1, "John", "USA"), (2, "Jane", "Canada"), (3, "Jack", "USA"), (4, "Jill", "Canada"), (5, "Joe", "USA")]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, "id int, name string, country string").repartition(3)


def sink(**more):
    return pf.SinkOptions(**{"url": "http://h/in", "batch_size": 5, **more})


def body(df, options, n=1):
    rows = pf.build_messages(df, options, "id").orderBy("body").collect()
    assert len(rows) == n
    return rows[0].body if n == 1 else [r.body for r in rows]


def text(i):
    return '{"id":%d,"name":"%s","country":"%s"}' % PEOPLE[i]


# numbers 1 to 5 with batches of 10 are one message
ONE = {"batch_size": 10}


def test_json_lines(people):
    assert body(people, sink(**ONE)) == "\n".join(text(i) for i in range(5))
    assert body(people, sink(delimiter="|", **ONE)) == "|".join(text(i) for i in range(5))


def test_json_array(people):
    assert body(people, sink(write_json_as_array=True, **ONE)) == "[" + ",".join(text(i) for i in range(5)) + "]"


def test_json_wrapped(people):
    assert body(people, sink(write_json_as_array=True, json_batch_key="data", **ONE)) == '{"data":[' + ",".join(text(i) for i in range(5)) + "]}"
    lines = body(people, sink(json_batch_key="data", **ONE))
    assert lines == "\n".join(text(i) for i in range(5))


def test_nulls_stay_in_json(spark):
    df = spark.createDataFrame([(1, None)], "id int, name string")
    assert body(df, sink(**ONE)) == '{"id":1,"name":null}'


def test_form(spark):
    df = spark.createDataFrame([(1, "a b&c", None)], "id int, name string, x string")
    assert body(df, sink(message_format="Form", **ONE)) == "id%3D1%26name%3Da+b%26c%26x%3Dnull"
    assert body(df, sink(message_format="form", form_style="pairs", **ONE)) == "id=1&name=a+b%26c&x=null"


def test_custom(people, spark):
    o = sink(message_format="Custom", body="#id:#name (#country)", delimiter="; ", **ONE)
    assert body(people, o) == "; ".join("%d:%s (%s)" % p for p in PEOPLE)
    prefixed = spark.createDataFrame([(1, "x")], "id int, id2 string")
    assert body(prefixed, sink(message_format="Custom", body="#id2-#id-# #", **ONE)) == "x-1-# #"
    assert body(people, sink(message_format="Custom", body="fixed text", delimiter=",", batch_size=10)) == "fixed text," * 4 + "fixed text"


def test_custom_without_a_value_fails(spark):
    df = spark.createDataFrame([(1, None)], "id int, name string")
    messages = pf.build_messages(df, sink(message_format="Custom", body="#name"), "id")
    with pytest.raises(Exception, match="Field name of the message template has no value"):
        messages.count()


def test_batches_by_number(people):
    bodies = body(people, sink(batch_size=2), n=3)
    assert bodies == [text(0), text(1) + "\n" + text(2), text(3) + "\n" + text(4)]


@pytest.mark.parametrize("size", [1, 2, 3, 50])
def test_batches_per_partition(spark, size):
    df = spark.range(1000).selectExpr("cast(id as int) id", "concat('n', id) name").repartition(7)
    rows = pf.build_messages(df, sink(batch_size=size)).collect()
    assert all(1 <= r.n_records <= size for r in rows)
    assert len({r.batch_id for r in rows}) == len(rows)
    lines = [line for r in rows for line in r.body.split("\n")]
    assert sorted(lines) == sorted('{"id":%d,"name":"n%d"}' % (i, i) for i in range(1000))
    assert len(rows) <= -(-1000 // size) + 7


def test_put_never_mixes_urls(spark):
    # one target holds a third of all rows
    df = spark.range(900).selectExpr("cast(id as int) id", "if(id % 3 = 0, 0, id % 20) target").repartition(5)
    o = sink(method="PUT", url="http://h/t/#target/x", batch_size=10)
    plan = pf.build_messages(df, o)
    assert plan._jdf.queryExecution().toString().count("Exchange") == df._jdf.queryExecution().toString().count("Exchange")
    total = 0
    for r in plan.collect():
        target = int(r.url.split("/")[4])
        ids = [int(line.split('"id":')[1].split(",")[0]) for line in r.body.split("\n")]
        assert all((0 if i % 3 == 0 else i % 20) == target for i in ids) and len(ids) == r.n_records <= 10
        total += len(ids)
    assert total == 900


def test_url_template(spark):
    df = spark.createDataFrame([(1, "a b/c", None)], "id int, id2 string, gone string")
    o = sink(method="PUT", url="http://h/#id2/#id/#gone?x=#id", batch_size=1)
    assert pf.build_messages(df, o).first().url == "http://h/a+b%2Fc/1/#gone?x=1"
    assert pf.build_messages(df, sink(url="http://h/#id")).first().url == "http://h/#id"


def test_delete(people):
    rows = pf.build_messages(people, sink(method="delete", url="http://h/#id")).orderBy("url").collect()
    assert [(r.method, r.url, r.body, r.n_records) for r in rows] == [("DELETE", f"http://h/{i}", None, 1) for i in range(1, 6)]
    assert rows[0].content_type is None and "Content-Type" not in rows[0].headers


@pytest.mark.parametrize(("form", "kind"), [("JSON", "application/json"), ("Form", "application/x-www-form-urlencoded"), ("Custom", "text/plain")])
def test_headers(people, form, kind):
    row = pf.build_messages(people, sink(message_format=form, body="x", headers={"A": "b"}, follow_redirects=False)).first()
    assert row.content_type == kind
    assert row.headers == {"A": "b", "Request-Method": "POST", "Instance-Follow-Redirects": "false", "charset": "UTF-8", "Content-Type": kind}
    own = pf.build_messages(people, sink(headers={"Content-Type": "x/y"})).first()
    assert own.content_type == "x/y" == own.headers["Content-Type"]


def test_no_shuffle_by_default(people):
    plan = pf.build_messages(people, sink(batch_size=50))._jdf.queryExecution().toString()
    assert plan.count("Exchange") == people._jdf.queryExecution().toString().count("Exchange")
