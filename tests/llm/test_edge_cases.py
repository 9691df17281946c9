"""Nulls, empty and odd texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_ops_against_brute_force import check_pieces, check_pii, quality, url_parts

import corpus_pipeline
from pageframe.llm import curriculum, line_quality, packing, pii, simhash, token_files, topk, toxicity, url_rules, warc
from pageframe.llm.components import components
from pageframe.llm.oracles import ORACLES
from pageframe.llm.queries import QUERIES
from pageframe.llm.tokens import default_path, encoder

SF = "/root/testdata/sf0.001"
LONG = "The quick brown fox jumps over the lazy dog and runs home again . " * 3000
TEXTS = [
    None, "", " \n\t", "one", "One", "two words", "a b c d", "A B C D", "a b c d", "x" * 70000, LONG, LONG + "end", "mail me@x.org now",
    "é ü 漢字 <|endoftext|> it's  two\n\nlines\r\n", "own line one here\nshared line of words\n" + "word " * 30,
]
#: Columns named as helper columns are.
DOCS = "doc_id long, text string, source string, key string, row string, h long, size int, pii string, fp long, node long"


def docs(spark, texts=TEXTS):
    rows = [(i, t, None if i % 4 == 0 else f"s{i % 3}", "k", "r", 1, 2, "p", 3, 4) for i, t in enumerate(texts)]
    if texts:
        rows += [rows[4], rows[4], (None, "no id", None, "k", "r", 1, 2, "p", 3, 4), (None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def plain(df):
    return [r.asDict() for r in df.collect()]


def test_simhash_edges(spark):
    d = docs(spark)
    got = plain(simhash.near_duplicates(d))
    assert len(got) == d.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[0]["fp"] == by_id[1]["fp"] == by_id[2]["fp"] == 0 and by_id[2]["component_id"] == 0
    assert by_id[4]["component_id"] == 3 and by_id[8]["component_id"] == by_id[7]["component_id"] == 6
    kept = simhash.kept_documents(d)
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in plain(kept) if r["doc_id"] is not None) == sorted(
        {r["component_id"] for r in got if r["component_id"] is not None}
    )
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("blocks", [1, 3, 64])
def test_gray_index_finds_the_groups_of_all_pairs(spark, blocks):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = [b ^ np.uint64((1 << int(i)) | (1 << int(j))) for b in base[:60] for i, j in rng.integers(0, 64, (6, 2))]
    dense = [np.uint64(7) ^ np.uint64(i) for i in range(200)]
    codes = np.unique(np.concatenate([base, near, dense, [np.uint64(0), np.uint64((1 << 64) - 1)]]).astype(np.uint64))
    want = {int(c): int(c) for c in codes.view(np.int64)}

    def root(x):
        while want[x] != x:
            x = want[x]
        return x

    for i, a in enumerate(codes):
        for b in codes[i + 1 :][np.bitwise_count(codes[i + 1 :] ^ a) <= 2]:
            x, y = sorted((root(int(a.view(np.int64))), root(int(b.view(np.int64)))))
            want[y] = x
    table = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long").repartition(5)
    roots = {r["node"]: r["root"] for r in plain(components(simhash.near_links(table, blocks=blocks), "a", "b"))}
    assert {int(c): roots.get(int(c), int(c)) for c in codes.view(np.int64)} == {c: root(c) for c in want}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(5, 5), (None, 7), (300, 200), (200, 300)]
    got = {r["node"]: r["root"] for r in plain(components(spark.createDataFrame(edges, "a long, b long"), "a", "b"))}
    assert got == {i: 0 for i in range(41)} | {j: 100 for j in range(100, 160)} | {200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_toxicity_edges(spark):
    d = docs(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(3, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    got = plain(toxicity.rated(d, labels))
    assert len(got) == d.count() and all(0 <= r["score"] <= 1 for r in got)
    empty = toxicity.rated(d, labels.limit(0))
    assert {r["score"] for r in plain(empty)} == {0.5}
    assert toxicity.rated(docs(spark, []), labels).count() == 0


def test_labels_of_held_out_rows_are_not_read(spark):
    d = spark.createDataFrame([(i, f"word{i % 7} common text") for i in range(200)], "doc_id long, text string")
    labels = [(i, i % 7 == 3) for i in range(200)]
    turned = [(i, y != (zlib.crc32(str(i).encode()) % 5 == 0)) for i, y in labels]
    scores = [
        sorted((r["doc_id"], r["score"]) for r in plain(toxicity.rated(d, spark.createDataFrame([(i, int(y)) for i, y in t], "doc_id long, toxic int"))))
        for t in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_url_aliases(spark):
    link, meta = '<link rel="{}" href="{}">', "<meta http-equiv='refresh' content='0; url={}'>"
    pages = [
        (1, "http://a.org/x", link.format("canonical", "https://m.shop.net/es/1"), "block"),
        (2, "http://b.org/y#f", link.format("nofollow CANONICAL", "http://a.org/x"), "block"),
        (3, "https://b.org/y", None, "block"),
        (4, "http://c.org/d/e", "<META content=\"5;URL=../z\" http-equiv=refresh>" + meta.format("/up?q=1&amp;r=2"), "allow"),
        (5, "http://c.org/up?q=1&r=2", link.format("canonical", "//d.net/fr/"), "block"),
        (6, "http://e.org/", link.format("canonical", "http://x.com/"), "allow"),
        (7, "http://f.org/", link.format("canonical", "http://e.org/") + meta.format("http://q.net/es/"), "allow"),
        (8, "http://g.org/", link.format("stylesheet", "http://q.net/es/") + "canonical", "allow"),
        (9, "http://x.example.com/en/p", link.format("canonical", "http://x.com/"), "block"),
        (10, None, link.format("canonical", "http://q.net/es/"), "allow"),
        (11, "no scheme", None, "allow"),
        (11, "no scheme", None, "allow"),
        (12, "HTTP://WWW.Example.COM?x", None, "allow"),
        (13, "http://h.org/", link.format("canonical", "http://h.org/"), "allow"),
    ]
    # 4 refreshes to 5, which is an alias of a blocked address
    pages = [(i, u, h, "block" if i == 4 else v) for i, u, h, v in pages]
    df = spark.createDataFrame([(i, u, h, 1, "x", "y") for i, u, h, _ in pages], "page_id long, url string, html string, node long, r string, root string")
    got = plain(url_rules.judge(df.repartition(4)))
    assert sorted((r["page_id"], r["verdict"]) for r in got) == sorted((i, v) for i, _, _, v in pages)
    for r in got:
        assert (r["host"], r["path"]) == url_parts(dict((i, u) for i, u, _, _ in pages)[r["page_id"]])
    assert {r["page_id"]: r["by"] for r in got}[5] == "alias"
    assert url_rules.judge(df.limit(0)).count() == 0


MAGIC = "WARC/1.1\r\n"


def test_warc_payloads_with_magic(spark, tmp_path):
    fake = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    bodies = [
        None, "", "x" * 99, "y" * 100, "y" * 100, "y" * 100, MAGIC, MAGIC * 40, fake, "a\r\n\r\n" + fake * 3 + "tail", fake + MAGIC[:-2], "\r\n\r\n",
        "z\r", "z\r\n\r\n" + MAGIC, "é" * 60, "é" * 60, "W" * 500 + "WARC/1.1\r", fake.replace("5", "999999"), LONG, LONG + fake, "\x00\x01 ﻿",
    ]
    rows = [(i, f"http://h/{i}\r\nX: y", b, "t") for i, b in enumerate(bodies)] + [(3, "u", "y" * 100, "t"), (None, None, "y" * 100, "t"), (None, None, "n" * 200, None)]
    first, want = {}, Counter()
    for i, _, b, _ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (b or "").encode()
        d = hashlib.sha256(data).hexdigest()
        again = len(data) >= 100 and first.setdefault(d, i) is not None and first[d] != i
        want[i, len(data), d, "revisit" if again else "response", first[d] if again else None] += 1
    df = spark.createDataFrame(rows, "page_id long, url string, html string, value string")
    for parts, split in ((1, "128m"), (3, "128m"), (2, "1000b"), (1, "20000b")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            got = warc.archived(df.repartition(parts)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert Counter(tuple(r) for r in got) == want, (parts, split)
    assert warc.archived(df.limit(0)).count() == 0


def ids_of(text, end):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(default_path()).encode(text or "", add_special_tokens=False).ids, end]


def test_encoder_equals_the_library():
    odd = ["", " ", "a  b", " a b ", "a\n\nb", "a \nb", "a\n b", "\ta b", "x <|endoftext|> y", "a b c", "it's they'll 12 34.", "\r\nq", "a\x1cb c\x85d", "de-fg h!!", "漢字 é"]
    for text, ids in zip(odd + TEXTS, encoder(default_path()).encode([t or "" for t in odd + TEXTS]), strict=True):
        assert ids == np.array(ids_of(text, 0)[:-1], "<u4").tobytes(), text


def test_token_file_edges(spark, tmp_path):
    d = docs(spark)
    order = sorted(plain(d), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    folder = str(tmp_path / "f")
    token_files.write_token_files(d, folder)
    got = sorted(plain(token_files.read_token_files(spark, folder, with_ids=True)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in order]
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:k]) for k in range(len(got))]
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["n_tokens"]
        if r["doc_id"] is not None:
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids_of(TEXTS[r["doc_id"]], 0)
    assert token_files.token_files(docs(spark, [])).count() == 0


def test_random_access():
    rng = np.random.default_rng(1)
    for top in (1, 256, 50257, 1 << 24, (1 << 32) - 1):
        ids = rng.integers(0, top, 3000, dtype=np.uint64).astype(np.uint32)
        segment = token_files.Segment(token_files.encode_segment([4, None, -9], [1000, 1500, 500], ids))
        assert segment.doc_ids == [4, None, -9] and segment.counts.tolist() == [1000, 1500, 500]
        assert segment.ids().tolist() == ids.tolist() and [segment[i] for i in range(0, 3000, 7)] == ids[::7].tolist()
    assert token_files.Segment(token_files.encode_segment([], [], np.zeros(0, np.uint32))).ids().tolist() == []


def test_mixing_edges(spark):
    d = docs(spark)
    got = plain(curriculum.schedule(d))
    assert len(got) == d.count()
    for r in got:
        assert r["copies"] == len(r["positions"]) <= 3 and all(0 <= p <= 1 for p in r["positions"]) and r["positions"] == sorted(r["positions"])
        assert r["size"] == quality(r["row"]["text"] or "")[0]
    mixed = curriculum.mix(d)
    assert mixed.columns == d.columns and mixed.count() == sum(r["copies"] for r in got)
    assert curriculum.mix(docs(spark, [])).count() == 0


@pytest.mark.parametrize("knots", curriculum.SCHEDULES)
def test_inverse_of_the_schedule(spark, knots):
    times, weights = zip(*knots, strict=True)
    grid = np.linspace(0, 1, 20001)
    area = np.concatenate([[0], np.cumsum((np.interp(grid[1:], times, weights) + np.interp(grid[:-1], times, weights)) / 2)])
    shares = [0.0, 0.1, 0.37, 0.5, 0.99, 1.0]
    got = spark.createDataFrame([(s,) for s in shares], "s double").select(curriculum.inverse(F.col("s"), knots).alias("t")).collect()
    assert [r["t"] for r in got] == pytest.approx(np.interp(shares, area / area[-1], grid).tolist(), abs=1e-4)


def test_pii_edges(spark):
    d = docs(spark)
    got = plain(pii.report(d))
    assert len(got) == d.count()
    check_pii([{"doc_id": i, "text": t} for i, t in enumerate(TEXTS)], {r["doc_id"]: r for r in got if r["doc_id"] is not None})
    clean = {r["doc_id"]: r for r in plain(pii.masked(d)) if r["doc_id"] is not None}
    assert clean[12]["text"] == "mail <email> now" and clean[0]["text"] is None and clean[10]["text"] == LONG and clean[12]["pii"] == "p"
    assert pii.masked(d).columns == d.columns and pii.report(docs(spark, [])).count() == 0


def test_quality_edges(spark):
    d = docs(spark)
    got = plain(line_quality.verdicts(d))
    assert len(got) == d.count()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for r in got:
        if r["doc_id"] is not None:
            assert tuple(r[n] for n in names) == quality(TEXTS[r["doc_id"]] or "")
    kept = line_quality.kept_documents(d)
    assert kept.columns == d.columns and kept.count() == sum(r["kept"] for r in got)
    assert line_quality.verdicts(docs(spark, [])).count() == 0


def test_common_lines_deplete_documents_but_copies_do_not(spark):
    line = " ".join(f"menu{i}" for i in range(30))
    own = " ".join(f"text{i}" for i in range(40))
    rows = [(i, f"{line}\nunlike{i} " + f"u{i} v{i}", "h") for i in range(30)]
    rows += [(100 + i, f"{line}\n" + " ".join(f"w{i}x{k}" for k in range(25)), "h") for i in range(100)]
    rows += [(200 + i, own + (f" changed{i}" if i % 10 == 0 else ""), "h") for i in range(60)]
    rows += [(300, f"{line}\nelsewhere one two", "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in plain(line_quality.verdicts(df, limit=20))}
    assert not any(kept[i] for i in range(30)) and all(kept[100 + i] for i in range(100))
    assert all(kept[200 + i] for i in range(60)) and kept[300]


def test_top_k_edges(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(150)] + [(200 + i, [0.5] * 8) for i in range(60)]
    rows += [(400, None), (420, [1.0, None] * 4), (440, [float("nan")] * 8), (460, [float("inf")] * 8), (480, [1.0, 2.0]), (481, [3.0, 1.0]), (500, []), (None, [0.1] * 8), (20, [0.3] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, score string, rank int")
    rows.append((60, rows[60][1]))
    good = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for q, v in {(i, tuple(v.tolist())) for i, v in good}:
        v = np.array(v, int)
        if q % 20 == 0:  # 60 is repeated and asks once, 20 occurs with two vectors, which ask each
            best = sorted((-int(v @ c), i) for i, c in good if i != q and len(c) == len(v))[:20]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    for block in (16, 64, 4096):
        got = [tuple(r) for r in topk.top_k(df.unionByName(df.filter("vec_id = 60")).repartition(4), block=block).collect()]
        assert sorted(got) == sorted(want)
    assert topk.top_k(df.limit(0)).count() == 0


def test_packing_edges(spark):
    d = docs(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_pieces(plain(packing.pack_documents(d)), {i: ids_of(t, 1) for i, t in enumerate(TEXTS)})
    every = docs(spark)
    assert sum(r["length"] for r in plain(packing.pack_documents(every))) == sum(len(ids_of(r["text"], 1)) for r in plain(every))
    assert packing.pack_documents(docs(spark, [])).count() == 0


def test_least_slack():
    rng = np.random.default_rng(3)
    for _ in range(60):
        counts = {int(k): int(n) for k, n in zip(rng.integers(1, 60, 6), rng.integers(1, 4, 6), strict=True)}
        room = int(rng.integers(1, 120))
        sums = {0}
        for k, n in counts.items():
            sums |= {s + k * j for s in sums for j in range(n + 1)}
        chosen = packing.least_slack(counts, room)
        assert all(n <= counts[k] for k, n in chosen.items())
        assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= room)


def test_stages_keep_columns_on_odd_tables(spark):
    for d in (docs(spark), docs(spark, [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, d, SF)
            assert out.columns == d.columns
            out.count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = Counter(cursor.fetchall())
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == want
