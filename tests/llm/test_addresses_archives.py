"""Addresses in other forms, archives as other readers take them, single tokens out of files, and a plain FTRL."""

import math
import random
import re
import struct
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_edge_cases import docs, plain

from pageframe.functions.lineage import fresh_path
from pageframe.llm import token_files, toxicity, url_rules, warc
from pageframe.llm.oracles import ORACLES

LINK = '<link rel="canonical" href="{}">'


def judged(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return df, {r["page_id"]: (r["verdict"], r["by"]) for r in plain(url_rules.judge(df))}


def test_dot_segments_ports_and_comments(spark):
    bad = LINK.format("http://q.net/es/1")
    pages = [
        (1, "http://a.org/p/q", LINK.format("../x")), (2, "http://a.org/x", bad),
        (3, "http://b.org:80/y", None), (4, "https://user:key@B.org:443/./z/../y", bad),
        (5, "http://c.org:443/y", None), (6, "http://c.org/y", bad),
        (7, "http://d.org/", "<!-- " + bad + " -->"), (8, "http://e.org/", "<!-- open " + bad), (9, "http://f.org/", f"<!--> {bad}"),
        (10, "http://g.org/", f"<script>var x = '{bad}';</SCRIPT>"), (11, "http://h.org/", f"<style>a</style>{bad}<!-- b -->"),
        (12, "http://i.org", None), (13, "http://i.org/", bad), (14, "http://j.net:80/es/2", None), (15, "http://k.net/x/%2e%2E/fr/", None),
        (16, "http://l.org/", LINK.format("mailto:a@q.net/es/")), (17, "http://m.org/", None), (18, "http://m.org:/#f", bad),
    ]
    _, got = judged(spark, pages)
    block = {1, 2, 3, 4, 6, 9, 11, 12, 13, 14, 15, 17, 18}
    assert {i for i, (v, _) in got.items() if v == "block"} == block
    assert {by for i, (_, by) in got.items() if i in block} == {"alias"}


def test_paths_without_dots(spark):
    rng = random.Random(3)
    paths = ["/" + "/".join(rng.choice(["a", "b", "..", ".", "", "...", "..c"]) for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    paths += ["/..", "/.", "/a/..", "/a/../", "/" + "a/" * 700 + "../" * 699, "/" + "b/../" * 2000 + "c", "/" + "x/./" * 3000 + "..", ""]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i long, p string")
    got = {r.i: r.n for r in df.select("i", url_rules.node_of(F.concat(F.lit("http://h"), "p")).alias("n")).collect()}

    def removed(path):
        out, parts = [], path.split("/")[1:]
        for part in parts:
            if part == "..":
                out = out[:-1]
            elif part != ".":
                out.append(part)
        if parts and parts[-1] in (".", ".."):
            out.append("")
        return "/" + "/".join(out)

    assert got == {i: "h" + removed(p) for i, p in enumerate(paths)}


def test_long_urls(spark):
    pages = [(1, "http://a.org/" + "a/../" * 40000 + "x", None), (2, "http://a.org/x", LINK.format("http://q.net/fr/" + "y" * 500000)), (3, "http://b.net/" + "z/./" * 40000 + "../" * 39999 + "../fr/", None)]
    assert {i: v for i, (v, _) in judged(spark, pages)[1].items()} == {1: "block", 2: "block", 3: "block"}


def test_links_with_sql(spark):
    rng = random.Random(8)
    hosts = ["a.org", "b.net", "b.net", "www.example.com", "c.de", "d.org"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', 'q'])}/{rng.randrange(40)}" for _ in range(150)]
    pages = [(i, rng.choice(urls) + rng.choice(["", "#f"]), LINK.format(rng.choice(urls)) if rng.random() < 0.2 else "x") for i in range(200)]
    df, _ = judged(spark, pages)
    con = duckdb.connect()
    con.register("given", df.toArrow())
    con.execute("CREATE VIEW pages AS SELECT * FROM given")
    want = con.execute(ORACLES["op3_url_filter"]).fetchall()
    got = [tuple(r) for r in url_rules.judge(df).select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert any(r[3] is None and r[4] == "block" for r in got)


def records_of(data):
    """A plain reader of WARC files: heads by their fields, blocks by their length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        assert first == "WARC/1.1"
        head = dict(x.split(": ", 1) for x in lines)
        n = int(head["Content-Length"])
        block = data[end + 4 : end + 4 + n]
        assert data[end + 4 + n : end + 8 + n] == b"\r\n\r\n"
        at = end + 8 + n
        yield head, block


def test_archives_are_whole_warc(spark):
    rows = [(1, "http://h/1", "y" * 100), (2, "http://h/2", "y" * 100), (2, "http://h/2", "y" * 100), (3, "http://h/3", "short é"), (3, "http://h/3", "short é"), (None, None, None)]
    folder = fresh_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), folder)
    files = [p for p in Path(folder.removeprefix("file:")).iterdir() if p.name.startswith("part-") and p.stat().st_size]
    read = [r for p in files for r in records_of(p.read_bytes())]
    assert len(read) == 6 and len({h["WARC-Record-ID"] for h, _ in read}) == 6
    for head, block in read:
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", head["WARC-Record-ID"])
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", head["WARC-Date"])
        assert head["Content-Type"] == "application/http; msgtype=response"
        if head["WARC-Type"] == "revisit":
            assert head["WARC-Profile"].endswith("/revisit/identical-payload-digest") and block == b""
            assert (head["WARC-Refers-To-Target-URI"], head["WARC-Refers-To-Date"]) == ("http://h/1", head["WARC-Date"])
        else:
            message, payload = block.split(b"\r\n\r\n", 1)
            status, *fields = message.decode().split("\r\n")
            assert status == "HTTP/1.1 200 OK" and f"Content-Length: {len(payload)}" in fields
    assert sorted(h["WARC-Type"] for h, _ in read) == ["response"] * 4 + ["revisit"] * 2
    assert sorted(b.split(b"\r\n\r\n", 1)[1] for h, b in read if b) == sorted([b"y" * 100, "short é".encode(), "short é".encode(), b""])


@pytest.mark.parametrize("named", [0, 1000])
def test_single_tokens(spark, monkeypatch, named):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 500)
    monkeypatch.setattr(token_files, "NAMED_SEGMENTS", named)
    rng = random.Random(1)
    given = [(i, " ".join(rng.choice(["alpha", "Beta", "the", "日本", "9" * 30]) for _ in range(rng.randrange(200)))) for i in range(120)]
    given += [(None, "no id"), (7, None), (7, "x " * 3000)]
    folder = fresh_path(spark, "tokens")
    token_files.write_token_files(docs(spark, [(i, t, "en", "s") for i, t in given]), folder)
    whole = sorted(plain(token_files.read_token_files(spark, folder, with_ids=True)), key=lambda r: r["start"])
    ids = [i for r in whole for i in struct.unpack(f"<{r['n_tokens']}I", r["ids"])]
    asked = [0, len(ids) - 1, len(ids), -1, None, 3, 3, *(rng.randrange(len(ids)) for _ in range(300))]
    df = spark.createDataFrame([(p, "x") for p in asked], "position long, id string")
    got = sorted((r["position"], r["id"]) for r in plain(token_files.token_at(df, folder)))
    assert got == sorted((p, ids[p]) for p in asked if p is not None and 0 <= p < len(ids))
    assert token_files.token_at(df.limit(0), folder).count() == 0


def test_segments_lie_open_in_the_files(spark):
    """Every segment lies in its file byte by byte, so no look-up has to unpack one."""
    import pyarrow.parquet as pq

    folder = fresh_path(spark, "tokens")
    given = [(i, f"word{i} " * 30000, "en", "s") for i in range(12)]
    token_files.write_token_files(docs(spark, given), folder)
    seen = 0
    for path in Path(folder.removeprefix("file:")).glob("part-*.parquet"):
        data, file = path.read_bytes(), pq.ParquetFile(path)
        cells = file.read(["segment"]).column("segment").to_pylist()
        seen += len(cells)
        assert all(cell in data for cell in cells)
        for g in range(file.metadata.num_row_groups):
            group = file.metadata.row_group(g)
            assert {group.column(i).compression for i in range(group.num_columns)} == {"UNCOMPRESSED"}
    assert seen >= 6


def test_ftrl_against_a_plain_one():
    """Weights, gradients and L1 of the vectorised model equal those of dictionaries and single numbers."""
    rng = random.Random(4)
    rows = [(sorted(rng.sample(range(60), rng.randrange(1, 12))) + [64], rng.random() < 0.3) for _ in range(400)]
    model = toxicity.Ftrl(6)
    z, n = dict.fromkeys(range(65), 0.0), dict.fromkeys(range(65), 0.0)

    def weight(i):
        if abs(z[i]) <= model.l1:
            return 0.0
        return -(z[i] - math.copysign(model.l1, z[i])) / ((model.beta + math.sqrt(n[i])) / model.alpha + model.l2)

    for at, label in rows:
        model.learn(np.array(at), int(label))
        before = {i: weight(i) for i in at}
        g = 1 / (1 + math.exp(-sum(before.values()))) - label
        for i in at:
            rate = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / model.alpha
            z[i] += g - rate * before[i]
            n[i] += g * g
    assert np.allclose(model.weights(), [weight(i) for i in range(65)], atol=1e-12)
    assert 0 < sum(w == 0 for w in map(weight, range(60))) < 60
