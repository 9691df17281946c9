import pytest

import pageframe as pf


def options(schema, fmt="csv", **more):
    return pf.SourceOptions(url="http://h/p", format=fmt, schema=schema, **{"error_handling": "sendToError", **more})


def test_plain_lines(parsed):
    got = parsed(options("a INT NOT NULL, b STRING, c DOUBLE"), "1,x,2.5\r\n2,,\r3\n")
    assert [r for r, *_ in got] == [(1, "x", 2.5), (2, None, None), (3, None, None)]


def test_header_is_data_unless_skipped(parsed):
    body = "a,b\n1,x\n2,\n"
    assert [r for r, *_ in parsed(options("a STRING, b STRING"), body)] == [("a", "b"), ("1", "x"), ("2", None)]
    assert [r for r, *_ in parsed(options("a INT, b STRING", csv_skip_first_row=True), body, body)] == [(1, "x"), (2, None)] * 2


def test_page_with_only_a_header_is_empty(parsed):
    assert parsed(options("a INT", csv_skip_first_row=True), "a\n", "a", "") == []


def test_quoted_values(parsed):
    o = options("id STRING NOT NULL, address STRING, more STRING", enable_quoted_values=True)
    got = parsed(o, '1,"12 Main St, Town, CA",x\n1, "a, b, c",""\n2,"say ""hi""",\n3,x\n4,"open\n5,a,b,\n6,a,b,c,d\n')
    assert [(r, c) for r, c, _ in got] == [
        (("1", "12 Main St, Town, CA", "x"), None),
        (("1", "a, b, c", None), None),
        (("2", 'say "hi"', None), None),
        (("3", "x", None), None),
        (None, 0),
        (None, 0),
        (None, 0),
    ]
    assert "not closed" in got[4][2] and "more than 3" in got[5][2] and "more than 3" in got[6][2]


def test_quotes_are_plain_text_unless_enabled(parsed):
    got = parsed(options("a STRING, b STRING, c STRING"), '1,"x, y"')
    assert got[0][0] == ("1", '"x', ' y"')


@pytest.mark.parametrize(
    ("schema", "line", "reason"),
    [
        ("a INT", "x", "not of type int"),
        ("a INT", "1.0", "not of type int"),
        ("a INT", "1,2", "more than 1"),
        ("a INT NOT NULL, b STRING NOT NULL", "1", "no value for field 'b'"),
        ("a INT NOT NULL, b STRING", ",x", "not of type int"),
        ("a BOOLEAN", "yes", "not of type boolean"),
        ("a BIGINT", "99999999999999999999", "not of type bigint"),
    ],
)
def test_bad_lines(parsed, schema, line, reason):
    ((record, code, message),) = parsed(options(schema), line)
    assert record is None and code == 0 and reason in message and f"'{line}'" in message


@pytest.mark.parametrize(
    ("schema", "line", "record"),
    [("a BOOLEAN", "TRUE", (True,)), ("a STRING NOT NULL", "", ("",)), ("a STRING", "", (None,)), ("a FLOAT", "1e2", (100.0,)), ("a BIGINT, b INT", "5", (5, None))],
)
def test_good_lines(parsed, schema, line, record):
    body = line + "\n"
    assert parsed(options(schema), body)[0][0] == record


def test_tabs(parsed):
    assert parsed(options("a STRING, b INT", "tsv"), "x y,z\t1")[0][0] == ("x y,z", 1)
    assert parsed(options("a STRING, b INT", "tsv", enable_quoted_values=True), '"x\ty"\t1')[0][0] == ("x\ty", 1)


def test_text_lines(parsed):
    o = options("body STRING NOT NULL", "text")
    assert [r for r, *_ in parsed(o, "one\n\ntwo\r\n", "x", "", "\n")] == [("one",), ("",), ("two",), ("x",), ("",)]


def test_blob(parsed):
    o = options("body BINARY NOT NULL", "blob")
    assert [bytes(r[0]) for r, *_ in parsed(o, b"\x00\xff\n", b"", None)] == [b"\x00\xff\n", b"", b""]


def test_wide_quoted_lines(parsed):
    names = ", ".join(f"c{i} INT" for i in range(60))
    line = ",".join(f'"{i}"' for i in range(60))
    assert parsed(options(names, enable_quoted_values=True), line)[0][0] == tuple(range(60))


LINES = "raj,29,true,india\nrahul,30,false,\n"


@pytest.mark.parametrize("fmt", ["csv", "tsv"])
@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("quoted", [True, False])
def test_infer_schema(pages, fmt, header, quoted):
    body = ("name,age,isIndian,country\n" if header else "") + LINES
    if fmt == "tsv":
        body = body.replace(",", "\t")
    o = options(None, fmt, csv_skip_first_row=header, enable_quoted_values=quoted)
    schema = pf.infer_schema(pages(body), o)
    names = ["name", "age", "isIndian", "country"] if header else [f"body_{i}" for i in range(4)]
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == list(
        zip(names, ["string", "int", "boolean", "string"], [False, False, False, True], strict=True)
    )


def test_infer_widens_and_counts_short_lines(pages):
    body = "1,3000000000,1.5,x\n2,5,7,\n3\n"
    schema = pf.infer_schema(pages(body), options(None))
    assert [(f.dataType.simpleString(), f.nullable) for f in schema] == [("int", False), ("bigint", True), ("double", True), ("string", True)]


def test_infer_sees_only_the_sample(pages):
    body = "1\n2\nx\n"
    assert pf.infer_schema(pages(body), options(None, sample_size=2))[0].dataType.simpleString() == "int"
    assert pf.infer_schema(pages(body), options(None, sample_size=3))[0].dataType.simpleString() == "string"
    assert pf.infer_schema(pages(body), options(None, sample_size=None))[0].dataType.simpleString() == "string"


def test_infer_respects_quotes(pages):
    body = '1,"a, b"\n2,"c"\n'
    schema = pf.infer_schema(pages(body), options(None, enable_quoted_values=True))
    assert [f.dataType.simpleString() for f in schema] == ["int", "string"]
