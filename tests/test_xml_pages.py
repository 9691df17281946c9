from dataclasses import replace
from functools import partial

import pytest
from pyspark.sql import functions as F

import pageframe as pf
from pageframe.functions.xpath_syntax import Step
from pageframe.functions.xpaths import Node, add_path, parse_xpath, select_text
from pageframe.operators.xml_pages import absolute_nodes, parse_xml, xml_primitive
from pageframe.sources.xml_document import texts_at

HARBOURS = """<?xml version="1.0" encoding="UTF-8"?>
<register>
  <notice>Winter timetable</notice>
  <harbour code="N"><berths>2</berths>
    <ship kind="ferry"><crew>Aino</crew><name script="latin">Aava</name><built>1987</built><hull><metres>61.5</metres><ice>strong</ice></hull></ship>
    <ship kind="tug"><crew>Brita</crew><crew>Carl</crew><name script="latin">Brim</name><built>2011</built>
      <hull><metres>18.25</metres><ice>none</ice></hull></ship>
  </harbour>
  <harbour code="S"><ship kind="tug"><name script="cyrillic">Kivi</name><built>unknown</built></ship></harbour>
</register>"""


def options(schema, result_path, **more):
    return pf.SourceOptions(url="http://h/p", format="xml", schema=schema, result_path=result_path, **{"error_handling": "sendToError", **more})


def test_all_ships(parsed):
    o = options(
        "name STRING NOT NULL, script STRING, crew STRING, metres DOUBLE",
        "/register/harbour/ship",
        fields_mapping={"script": "name/@script", "crew": "crew", "metres": "hull/metres"},
    )
    assert [r for r, *_ in parsed(o, HARBOURS)] == [
        ("Aava", "latin", "Aino", 61.5),
        ("Brim", "latin", "Brita", 18.25),
        ("Kivi", "cyrillic", None, None),
    ]


@pytest.mark.parametrize(
    ("path", "names"),
    [
        ("/register/harbour/ship[@kind='tug']", ["Brim", "Kivi"]),
        ("/register/harbour[@code='N']/ship", ["Aava", "Brim"]),
        ("/register/harbour[@code='N']/ship[@kind=\"tug\"]", ["Brim"]),
        ("/register/harbour[2]/ship", ["Kivi"]),
        ("/register/harbour/ship[name='Kivi']", ["Kivi"]),
        ("/register/harbour/ship[crew='Carl']", ["Brim"]),
        ("/register/harbour/ship[@kind='none']", []),
        ("/other/harbour/ship", []),
    ],
)
def test_predicates(parsed, path, names):
    assert [r[0] for r, *_ in parsed(options("name STRING", path), HARBOURS)] == names


def test_bad_value_and_required_field(parsed):
    o = options("built INT NOT NULL, crew STRING NOT NULL", "/register/harbour/ship")
    got = parsed(o, HARBOURS)
    assert [c for _, c, _ in got] == [None, None, 0]
    assert "'built' is not of type int" in got[2][2]


def test_prefixes_comments_cdata_and_empty_elements(parsed):
    body = """<!-- top --><a:feed xmlns:a="u" xmlns:m="v"><a:entry><m:props><d:Fax m:null="true"/><d:Name>x &amp; <!-- c -->y</d:Name>
      <d:Raw><![CDATA[<b:c>]]></d:Raw></m:props></a:entry></a:feed>"""
    o = options(
        "name STRING, fax STRING, raw STRING, props STRING",
        "/feed/entry",
        fields_mapping={"name": "props/Name", "fax": "props/Fax/text()", "raw": "m:props/d:Raw"},
    )
    ((record, code, _),) = parsed(pf.SourceOptions(**{**o.__dict__, "schema": "name STRING, fax STRING, raw STRING"}), body)
    assert code is None and record == ("x & y", None, "<b:c>")


def test_prefixed_attributes(parsed):
    body = """<?xml version='1.0'?><!-- menu --><k:menu xmlns:k="urn:k"><k:course title="Soups"><k:bowls>
      <k:bowl label="pea" spice="k:mint"/><k:bowl label="beet"/></k:bowls></k:course>
      <k:course title="Cakes"><k:bowls><k:bowl label="plum"/></k:bowls></k:course></k:menu>"""
    o = options("label STRING NOT NULL, spice STRING", "/menu/course[@title='Soups']/bowls/bowl", fields_mapping={"label": "@label", "spice": "@spice"})
    assert [r for r, *_ in parsed(o, body)] == [("pea", "k:mint"), ("beet", None)]


def test_long_prologs(parsed):
    """What stands before the root element may be of any length."""
    o = options("a STRING", "/x/y")
    for prolog in ("\n" * 100_000, "<!--" + " " * 100_000 + "-->", "<!-- c -->\n" * 20_000):
        assert [r for r, *_ in parsed(o, prolog + "<x><y><a>1</a></y></x>")] == [("1",)]


def test_broken_document(parsed):
    got = parsed(options("a STRING", "/x/y"), "<x><y></x>", "", "<x/>")
    assert [c for _, c, _ in got] == [0, 0]


@pytest.mark.parametrize(
    ("path", "value"),
    [("/r/next", "n1"), ("/r/links/link[@rel='next']/@href", "n2"), ("/r/none", None), ("/q/next", None), ("/r/empty", None), ("r/next", "n1")],
)
def test_primitive(spark, path, value):
    text = '<r><next>n1</next><empty/><links><link rel="prev" href="n0"/><link rel="next" href="n2"/></links></r>'
    assert spark.range(1).select(xml_primitive(F.lit(text), path)).first()[0] == value


@pytest.mark.parametrize("path", ["//a", "/a/*", "/a/parent::b", "/a|/b", "/a[//b]"])
def test_paths_that_need_more_than_one_path_of_names(path):
    with pytest.raises(ValueError, match="unsupported"):
        parse_xpath(path)


@pytest.mark.parametrize(
    "path", ["/a/parent::b", "/a[", "/a/..", "/a[b=]", "/a[/b]", "/a[nosuch(b)]", "/a[contains(b)]", "1+1", "/a[b='x]", "/a//@b", "/a b", "a|1", "/a[]"]
)
def test_paths_that_are_refused(spark, path):
    assert [f.option for f in options("a STRING", path).validate()] == ["result_path"]


CONDITIONS = [
    "built>1990", "built >= 1987 and built<=2011", "built!='1987'", "built != 1987", "not(crew)", "not(crew='Carl')", "crew or built='unknown'",
    "contains(name,'i')", "starts-with(name, 'B')", "position()<2", "position()=last()", "last()=2", "last()", "2", "0", "@kind!='tug'",
    "name/@script='latin' and hull/metres>20", "hull/metres div 2 > 30", "built mod 2 = 1", "built*2 = 4022", "-hull/metres < -20",
    "count(crew)=2", "count(crew) > count(hull/none)", "string-length(name)=4", "normalize-space(hull/ice)='none'", "hull", "hull/metres=61.5",
    "crew|name='Kivi'", "(crew='Aino') = true()", "crew = name", "sum(crew)=0", "concat(name,'-',@kind)='Brim-tug'", "substring(name,2,2)='iv'",
    "substring-after(name,'r')='im'", "substring-before(name,'v')='Aa'", "translate(name,'ABK','xyz')='yrim'", "round(hull/metres)=62",
    "floor(hull/metres)=61 or ceiling(hull/metres)=19", "number(built)=2011", "string(built)='2011'", "boolean(crew)", "name/text()", "crew[2]='Carl'",
    "crew[last()]='Carl'", "name[@script='latin']='Brim'", "name[.='Kivi']", "hull[ice='strong']/metres<62", "built='1987' or built='2011'", "name<1",
    "built>'1990'", "'a'='b'", "true()", "@kind='tug'][1", "@kind='tug'][position()=last()",
]


def test_conditions_select_what_the_built_in_xpath_does(spark, pages):
    body = HARBOURS.replace("</register>", '<harbour code="W"><ship kind="raft"><name/><built> 1990 </built><hull/></ship></harbour></register>')
    one = spark.createDataFrame([(body,)], "text string")
    paths = [f"/register/harbour/ship[{c}]" for c in CONDITIONS]
    want = one.select(*[F.expr(f'xpath(text, "{p}/built/text()")').alias(f"c{i}") for i, p in enumerate(paths)]).first()
    columns = []
    for i, p in enumerate(paths):
        path, root = parse_xpath(p), Node()
        built = add_path(root, replace(path, steps=(*path.steps, Step("built"))))
        assert built.is_text
        doc = parse_xml(F.col("text"), root)
        nodes, ship = absolute_nodes(doc, root, path)
        columns.append(F.transform(nodes, partial(lambda ship, e: select_text(e, ship, parse_xpath("built")), ship)).alias(f"c{i}"))
    got = one.select(*columns).first()
    assert {p: got[i] for i, p in enumerate(paths)} == {p: want[i] for i, p in enumerate(paths)}
    walked = {p: texts_at(body, p + "/built") for p in paths}
    assert walked == {p: want[i] for i, p in enumerate(paths)}


def test_conditions_in_a_read(parsed):
    o = options(
        "name STRING, mate STRING, tall BOOLEAN",
        "/register/harbour[@code!='S']/ship[built>1980 and not(hull/ice='none')] | /register/harbour[last()]/ship[contains(name, 'iv')]",
        fields_mapping={"mate": "crew[last()]", "tall": "hull[metres > 99]/ice"},
    )
    assert [r for r, *_ in parsed(o, HARBOURS)] == [("Aava", "Aino", None), ("Kivi", None, None)]


def test_names_that_differ_in_case_only(parsed):
    body = """<r><!-- <Id>9</Id> --><Item><Id>7</Id><id>8</id><ID n="x">9</ID><Note><![CDATA[<ID>&</ID>]]></Note><note>low</note></Item>
      <item><Id>1</Id><id/></item><k:Item xmlns:k="u"><k:ID>5</k:ID></k:Item></r>"""
    o = options("Upper STRING, lower STRING, note STRING", "/r/Item", fields_mapping={"Upper": "Id", "lower": "id", "note": "Note"})
    assert [r for r, *_ in parsed(o, body)] == [("7", "8", "<ID>&</ID>"), (None, None, None)]
    o = options("a STRING, b STRING", "/r/*[id or ID]", fields_mapping={"a": "ID", "b": "id"})
    assert sorted((r for r, *_ in parsed(o, body)), key=str) == [("5", None), ("9", "8"), (None, None)]
    o = options("a STRING, b STRING", "/r/Item[ID]", fields_mapping={"a": "ID/@n", "b": "ID"})
    assert [r for r, *_ in parsed(o, body)] == [("x", "9"), (None, "5")]
    assert [r for r, *_ in parsed(options("a STRING", "/R/Item", fields_mapping={"a": "Id"}), body)] == []


def test_open_steps(parsed):
    """Descendants and any name: what the documents have decides."""
    body = "<t><a k='1'><n>1</n><a k='2'><n>2</n><b><a k='3'><n>3</n></a></b></a></a><c><a k='4'/></c><!-- <z><a k='9'/></z> --></t>"
    got = [r for r, *_ in parsed(options("k INT, n INT, deep INT", "//a", fields_mapping={"k": "@k", "deep": ".//a/@k"}), body)]
    assert sorted(got, key=str) == [(1, 1, 2), (2, 2, 3), (3, 3, None), (4, None, None)]
    assert [r[0] for r, *_ in parsed(options("k INT", "/t/*/a", fields_mapping={"k": "@k"}), body)] == [2, 4]
    assert [r[0] for r, *_ in parsed(options("k INT", "//a[.//n=3 and @k>1]", fields_mapping={"k": "@k"}), body)] == [2, 3]
    assert parsed(options("k INT", "//none"), body) == []
    assert [c for _, c, _ in parsed(options("k INT", "//none"), body, "<t")] == [0]


@pytest.mark.parametrize(
    ("path", "names"),
    [
        ("//ship", ["Aava", "Brim", "Kivi"]),
        ("/register//ship[@kind='tug']", ["Brim", "Kivi"]),
        ("/register/*/ship[last()]", ["Brim", "Kivi"]),
        ("/register/harbour/ship[crew]", ["Aava", "Brim"]),
        ("/other//ship", []),
    ],
)
def test_walked_paths(parsed, path, names):
    o = options("name STRING NOT NULL, script STRING, metres DOUBLE", path, fields_mapping={"script": "name/@script", "metres": ".//metres"})
    got = parsed(o, HARBOURS)
    assert [r[0] for r, *_ in got] == names
    if names[:1] == ["Aava"]:
        assert got[0][0] == ("Aava", "latin", 61.5)


def test_walked_links_and_counts(pages):
    body = '<a:r xmlns:a="u"><links><link rel="x" href="n2"/></links><e/><k><e/></k></a:r>'
    o = options("v STRING", "//e", pagination_type="Link in response body", next_page_field_path="//link/@href")
    row = pf.page_facts(pages(body, seed="http://h/p"), o).first()
    assert (row.n_entries, row.next_url) == (2, "http://h/n2")
