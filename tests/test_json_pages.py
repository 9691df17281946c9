import json

import pytest
from pyspark.sql import functions as F

import pageframe as pf
from pageframe.functions.paths import json_path_get, split_path, variant_path

URL = "http://h/p"


def options(schema, result_path=None, **more):
    return pf.SourceOptions(url=URL, schema=schema, result_path=result_path, **{"error_handling": "sendToError", **more})


HARVEST = json.dumps(
    {
        "farm": {
            "warnings": [],
            "crates": [
                {"label": "q7", "weight": {"grams": 1250, "scale": "old"}, "fruit": "plum"},
                {"label": "q8", "weight": {"grams": 980, "scale": "new"}, "fruit": "pear"},
            ],
        },
        "notes": [],
    }
)


def test_result_path(parsed):
    got = parsed(options("label STRING NOT NULL, fruit STRING NOT NULL", "/farm/crates"), HARVEST)
    assert [r for r, *_ in got] == [("q7", "plum"), ("q8", "pear")]


def test_result_path_through_the_array(parsed):
    got = parsed(options("grams INT NOT NULL, scale STRING", "/farm/crates/weight"), HARVEST)
    assert [r for r, *_ in got] == [(1250, "old"), (980, "new")]


def test_result_path_to_one_object(parsed):
    got = parsed(options("notes ARRAY<STRING>", "/"), HARVEST)
    assert [r for r, *_ in got] == [([],)]


def test_root_array(parsed):
    got = parsed(options("n BIGINT NOT NULL", "/a/b"), '[{"a":{"b":{"n":1}}},{"a":{"b":{"n":2}}}]')
    assert [r for r, *_ in got] == [((1),), ((2),)]


FLIGHTS = json.dumps(
    {
        "board": [
            {"no": "K 14", "leg": {"stops": [{"port": "OUL", "gate": "4", "open": True}], "plane": {"maker": {"town": "Linz"}}, "night": False, "hint": "late"}},
            {"no": "K 13", "leg": {"plane": {"maker": {"town": "Gent"}}, "stops": [], "night": True}, "crew": 5},
        ],
        "hour": 6,
    }
)


def test_mapping_with_nested_types(parsed):
    got = parsed(
        options(
            "no STRING NOT NULL, town STRING NOT NULL, night BOOLEAN NOT NULL, hint STRING, "
            "stops ARRAY<STRUCT<gate: STRING NOT NULL, port: STRING, open: BOOLEAN>> NOT NULL",
            "/board",
            fields_mapping={"town": "/leg/plane/maker/town", "night": "/leg/night", "hint": "/leg/hint", "stops": "/leg/stops"},
        ),
        FLIGHTS,
    )
    assert got[0][0] == ("K 14", "Linz", False, "late", [("4", "OUL", True)])
    assert got[1][0] == ("K 13", "Gent", True, None, [])


def test_record_schema_text(parsed):
    schema = json.dumps(
        {
            "type": "record",
            "name": "out",
            "fields": [
                {"name": "key", "type": "string"},
                {"name": "n", "type": ["int", "null"]},
                {"name": "tags", "type": {"type": "map", "keys": "string", "values": "long"}},
                {"name": "any", "type": ["string", "int", "null"]},
            ],
        }
    )
    got = parsed(options(schema), '{"key":"k","tags":{"a":1},"any":[1]}')
    assert got[0][0][:3] == ("k", None, {"a": 1}) and got[0][1] is None


CASES = [
    ("BIGINT", "1", True),
    ("BIGINT", '"12"', True),
    ("BIGINT", "1.0", True),
    ("BIGINT", "1.5", False),
    ("BIGINT", "true", False),
    ("BIGINT", "9007199254740993", True),
    ("BIGINT", "99999999999999999999", False),
    ("INT", "3000000000", False),
    ("INT", "0", True),
    ("DOUBLE", "1e3", True),
    ("DOUBLE", "0", True),
    ("DOUBLE", "true", False),
    ("DOUBLE", '"x"', False),
    ("BOOLEAN", "true", True),
    ("BOOLEAN", '"true"', False),
    ("BOOLEAN", "1", False),
    ("STRING", '"{x"', True),
    ("STRING", '"true"', True),
    ("STRING", "7", True),
    ("STRING", "true", False),
    ("STRING", '{"a":1}', False),
    ("STRING", "[1]", False),
    ("ARRAY<INT>", "[1,2]", True),
    ("ARRAY<INT>", '[1,"x"]', False),
    ("ARRAY<INT>", "[]", True),
    ("ARRAY<INT>", "5", False),
    ("STRUCT<a INT NOT NULL>", '{"a":1,"b":2}', True),
    ("STRUCT<a INT NOT NULL>", '{"b":2}', False),
    ("STRUCT<a INT>", '{"b":2}', True),
    ("STRUCT<a STRUCT<b BOOLEAN>>", '{"a":{"b":0}}', False),
    ("MAP<STRING, INT>", '{"x":1}', True),
    ("MAP<STRING, INT>", '{"x":"y"}', False),
]


def test_typed_or_error(parsed):
    """One field and one page per case: a page sets its own field only."""
    schema = ", ".join(f"f{i} {kind}" for i, (kind, _, _) in enumerate(CASES))
    got = parsed(options(schema), *[f'{{"f{i}":{value}}}' for i, (_, value, _) in enumerate(CASES)])
    for i, ((record, code, message), (kind, value, good)) in enumerate(zip(got, CASES, strict=True)):
        assert (code is None) == good, (kind, value)
        if good:
            assert record[i] is not None, (kind, value)
        else:
            assert record is None and code == 0 and f"field 'f{i}' is not of type" in message


def test_large_whole_number_is_exact(parsed):
    assert parsed(options("f BIGINT"), '{"f":9007199254740993}')[0][0] == (9007199254740993,)


def test_missing_null_and_blocked(parsed):
    o = options("a STRING NOT NULL, b STRING", fields_mapping={"b": "/x/y"})
    got = parsed(o, '[{"a":"1"},{"b":"2"},{"a":null},{"a":"1","x":[5]},{"a":"1","x":null},{"a":"1","x":{"y":null}},3]')
    assert [(r, c) for r, c, _ in got] == [
        (("1", None), None),
        ((None, None), 1),
        (None, 0),
        (("1", None), 1),
        (("1", None), None),
        (("1", None), None),
        (None, 0),
    ]
    assert "Couldn't find all required fields" in got[1][2]
    assert "does not allow" in got[2][2]


def test_pages_that_cannot_be_read(parsed):
    got = parsed(options("a STRING", "/items"), "no json", "", '{"other":1}', '{"items":5}', '{"items":[]}')
    assert [c for _, c, _ in got] == [0, 0, 0, 0]


def test_lenient(parsed):
    body = "{items:[{'a':'x'}]}"
    assert parsed(options("a STRING", "/items"), body)[0][1] == 0
    assert parsed(options("a STRING", "/items", lenient_json=True), body)[0][0] == ("x",)


def test_invalid_utf8_is_replaced(parsed):
    assert parsed(options("a STRING"), b'{"a":"x\xff"}')[0][0] == ("x�",)


def test_keys_with_dots_blanks_and_quotes(parsed):
    o = options("v INT", fields_mapping={"v": "/a.b/c d/e'f"})
    assert parsed(o, '{"a.b":{"c d":{"e\'f":4}}}')[0][0] == (4,)


def test_path_parts():
    assert split_path(" /a/b/ ") == ["a", "b"] and split_path(None) == [] and split_path("/") == []
    assert variant_path(["a b", 'c"d']) == "$[\"a b\"]['c\"d']"
    with pytest.raises(ValueError, match="cannot be addressed"):
        variant_path(["a\"'"])


DOCUMENT = json.dumps({"pageInfo": {"total": 208}, "items": [{"kind": "v", "id": {"x": "1"}}], "none": None})


@pytest.mark.parametrize(
    ("path", "value", "walked", "left"),
    [
        ("/pageInfo/total", "208", "/pageInfo/total", "/"),
        ("pageInfo/total/", "208", "/pageInfo/total", "/"),
        ("/pageInfo", '{"total":208}', "/pageInfo", "/"),
        ("/items/id/x", '[{"id":{"x":"1"},"kind":"v"}]', "/items", "/id/x"),
        ("/pageInfo/other/deep", None, "/pageInfo", "/other/deep"),
        ("/absent", None, "/", "/absent"),
        ("/pageInfo/total/deep", "208", "/pageInfo/total", "/deep"),
        ("/none", "null", "/none", "/"),
        ("/", None, "/", "/"),
    ],
)
def test_json_path_get(spark, path, value, walked, left):
    df = spark.createDataFrame([(DOCUMENT,)], "t string").select(json_path_get(F.parse_json("t"), path).alias("r"))
    row = df.select(F.to_json("r.value").alias("v"), "r.retrieved_path", "r.unretrieved_path").first()
    if path != "/":
        assert row.v == value
    assert (row.retrieved_path, row.unretrieved_path) == (walked, left)


def test_parse_plan_has_no_shuffle_and_prunes_columns(spark, tmp_path, pages):
    path = str(tmp_path / "cap")
    pages(HARVEST).write.parquet(path)
    read = spark.read.parquet(path)
    plan = pf.route(pf.parse_pages(read.filter("seed = 'x'"), options("label STRING", "/farm/crates"))).records
    text = plan._jdf.queryExecution().toString()
    assert "Exchange" not in text and "Python" not in text
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "EqualTo(seed,x)" in scan and "headers" not in scan.split("ReadSchema")[1]
