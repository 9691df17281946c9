"""The one match that judges a nested value as a whole says yes to usual values, and to no value that the full check refuses."""

import json

from pageframe.functions.schemas import to_struct
from pageframe.functions.typed import fits, has_all, plain_kinds, quote, read

LINES = "v ARRAY<STRUCT<n INT NOT NULL, qty DOUBLE, state STRUCT<flag STRING, on BOOLEAN NOT NULL>>> NOT NULL"
LINE = {"n": 1, "qty": 2.5, "state": {"flag": "N", "on": True}}


def judged(spark, ddl, values):
    """(quick, full) for each value."""
    field = to_struct(ddl)[0]
    rows = spark.createDataFrame([(i, json.dumps({"v": v})) for i, v in enumerate(values)], "i int, t string")
    rows = rows.selectExpr("i", "parse_json(t) AS item").selectExpr("*", f"{read('item', ['v'], field.dataType)} AS typed")
    seen = f"schema_of_variant(try_variant_get(item, '$.v', 'variant')) RLIKE {quote(f'^{plain_kinds(field.dataType)}$')}"
    quick = f"coalesce({seen} AND {has_all('typed', field.dataType, False)}, false) AS quick"
    full = f"coalesce({fits('item', ['v'], field.dataType, field.nullable)} AND typed IS NOT NULL, false) AS full"
    return [(r.quick, r.full) for r in rows.selectExpr("i", quick, full).orderBy("i").collect()]


def test_usual_values_take_the_quick_check(spark):
    usual = [
        [LINE],
        [LINE, {**LINE, "n": 2, "qty": 7}, {**LINE, "qty": None}],
        [],
        [{**LINE, "more": "x", "a": 1, "z": 1.5}],
    ]
    assert judged(spark, LINES, usual) == [(True, True)] * len(usual)
    assert plain_kinds(to_struct("v MAP<STRING, INT>")[0].dataType) is None
    assert plain_kinds(to_struct("v STRUCT<`a b`: INT>")[0].dataType) is None


def test_no_bad_value_passes_the_quick_check(spark):
    def line(**more):
        return {**LINE, **more}

    bad = [
        [line(n=1.5)], [line(n=True)], [line(n=None)], [LINE, line(n=2**40)], [line(n="x")], [line(qty=False)], [line(qty="x")],
        [line(state={"flag": True, "on": True})], [line(state={"flag": ["x"], "on": True})], [line(state={"flag": {"a": 1}, "on": True})],
        [LINE, line(state={"flag": "N"})], [line(state={"flag": "N", "on": 1})], [line(state=3)], [LINE, 4], {"n": 1}, "x", None,
        [{k: v for k, v in LINE.items() if k != "n"}], [LINE, line(qty=True)], [line(**{"x, n: BIGINT": 1, "n": 1.5})],
    ]
    assert judged(spark, LINES, bad) == [(False, False)] * len(bad)
    # odd, but good: left to the full check or not, never refused
    odd = [[line(n="7")], [LINE, None], [line(state=None)], [line(more={"a": [1]})], [{"n": 1}], [line(qty="2.5")]]
    assert [full for _, full in judged(spark, LINES, odd)] == [True] * len(odd)
    whole = "v STRUCT<a: DECIMAL(4,1), d: DATE, b: BIGINT>"
    got = judged(spark, whole, [{"a": 99999.5, "d": "2020-01-01", "b": 1}, {"a": 1.5, "d": "x", "b": 1}, {"a": 1.5, "d": "2020-01-01", "b": 2**53 + 1}])
    assert got == [(False, False), (False, False), (True, True)]
