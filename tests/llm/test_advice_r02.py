"""What the second advice found missing."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from test_ops_against_brute_force import BLANKS, quality

import corpus_pipeline
from pageframe.llm import curriculum, line_quality, pii, queries, simhash


def grams(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similar(sets, alike=0.8):
    """All pairs of places whose sets have that similarity, counted over common members."""
    holders, common = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for held in holders.values():
        common.update(combinations(held, 2))
    return [p for p, n in common.items() if n >= alike * (len(sets[p[0]]) + len(sets[p[1]]) - n)]


def test_near_duplicates_stage_against_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("size(split(text, ' ')) >= 20")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    first = {}
    for i in sorted(rows):
        first.setdefault(rows[i], i)
    ids = sorted(first.values())
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = similar([grams(rows[i]) for i in ids])
    for a, b in pairs:
        x, y = sorted((top(ids[a]), top(ids[b])))
        root[y] = x
    want = {top(i) for i in ids}
    assert len(ids) - len(want) >= 4
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert {r["doc_id"] for r in stage(spark, docs, sf).collect()} == want


def test_a_large_group_of_near_copies_is_one(spark):
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*base[: i % 290], f"new{i}", *base[i % 290 + 1 :]])) for i in range(400)]
    rows += [(1000 + i, " ".join([f"o{i}x{k}" for k in range(200)] + base)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert all(got[i] == 0 for i in range(400)) and all(got[1000 + i] == 1000 + i for i in range(30))


def test_a_shared_line_counts_every_unlike_document(spark):
    menu = " ".join(f"menu{i}" for i in range(80))
    rows = [(i, f"{menu}\n" + " ".join(f"own{i}x{k}" for k in range(20)), "h") for i in range(260)]
    rows += [(1000 + i, "\n".join(f"copied line {k} of one text" for k in range(6)), "h") for i in range(260)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = {r["doc_id"]: r for r in line_quality.verdicts(docs).collect()}
    assert all(got[i]["removed_words"] == 80 and not got[i]["kept"] for i in range(260))
    assert all(got[1000 + i]["removed_words"] == 0 for i in range(260))


def test_kept_documents_lose_their_common_lines(spark):
    own = [" ".join(f"own{i}x{k}" for k in range(30)) for i in range(260)]
    rows = [(i, f"Menu  Home About\n\n{o}\nmenu home ABOUT\tImprint", "h", i) for i, o in enumerate(own)]
    rows += [(i, f"MENU home about\r\n{o}", "h", i) for i, o in enumerate(own[:5], 500)] + [(600, f"Menu  Home About\n{own[0]}", "other", 1)]
    docs = spark.createDataFrame([*rows, rows[3], rows[3]], "doc_id long, text string, source string, n_chars int").repartition(4)
    stage = dict(corpus_pipeline.STAGES)["quality"]
    got = stage(spark, docs, "")
    assert got.columns == docs.columns
    want = [(i, f"\n{o}", "h", i) for i, o in enumerate(own)] + [(i, o, "h", i) for i, o in enumerate(own[:5], 500)] + [rows[-1]]
    assert Counter(tuple(r) for r in got.collect()) == Counter([*want, want[3], want[3]])


def test_kept_against_a_count_of_lines(spark):
    """The limit follows the host: 50 documents each here, so lines of over 5 documents are common."""
    sf = "/root/testdata/sf0.01"
    rows = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts, holders = defaultdict(set), defaultdict(set)

    def lines(text):
        return [(" ".join(w).lower(), len(w)) for x in text.split("\n") if (w := re.findall(BLANKS, x))]

    for r in rows:
        texts[r["source"]].add(r["text"] or "")
        for line, _ in lines(r["text"] or ""):
            holders[r["source"], line].add(r["text"] or "")
    common = {k for k, held in holders.items() if len(held) > min(200, max(5, len(texts[k[0]]) / 10))}
    want = {}
    for r in rows:
        n, *_, failed = quality(r["text"] or "")
        gone = sum(k for line, k in lines(r["text"] or "") if (r["source"], line) in common)
        want[r["doc_id"]] = (gone, not failed and 100 * (n - gone) >= 30 * n)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert {r["doc_id"]: (r["removed_words"], r["kept"]) for r in line_quality.verdicts(docs).collect()} == want
    assert common and any(gone for gone, _ in want.values())


def test_a_line_of_all_documents_of_a_small_host_is_common(spark):
    menu = " ".join(f"menu{i}" for i in range(80))
    rows = [(i, f"{menu}\n" + " ".join(f"own{i}x{k}" for k in range(20)), "small" if i < 30 else "tiny") for i in range(34)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r["doc_id"]: r["kept"] for r in line_quality.verdicts(docs).collect()} == {i: i >= 30 for i in range(34)}


def test_ibans_before_other_words(spark):
    texts = {
        "DE89 3704 0044 0532 0130 00 Thanks": "iban:0:27",
        "GB29 NWBK 6016 1331 9268 19 BIC: X": "iban:0:27",
        "DE89370400440532013000 EUR 500": "iban:0:22",
        "GB29NWBK60161331926819 2024": "iban:0:22",
        "DE89 3704 0044 0532 0130 00 GB29 NWBK 6016 1331 9268 19 NOW": "iban:0:27,iban:28:55",
        "ZZ12 3456 DE89 3704 0044 0532 0130 00 END": "iban:10:37",
        "NO12 DE89 3704 0044 0532 0130 00": "iban:5:32",
        "MT84MALT011000012345MTLCAST001S, FR14 2004 1010 0505 0001 3M02 606": "iban:0:31,iban:33:66",
        "DE89 3704 0044 0532 0130 01 Thanks": "",
        "DE893704004405320130002 X": "",
        "xDE89370400440532013000 X": "",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
    ibans = {t: ",".join(s for s in found[i].split(",") if s.startswith("iban")) for i, t in enumerate(texts)}
    assert ibans == texts
    clean = {r["doc_id"]: r["text"] for r in pii.masked(docs).collect()}
    assert clean[0] == "<iban> Thanks" and clean[3] == "<iban> 2024"


def billionths(row):
    return [int(p) for p in row["positions"].split(",") if p]


def test_mixing_gives_the_training_positions(spark):
    sf = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in queries.op6_mixing(spark, sf).collect()]
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    kind = {s: i % 3 for i, s in enumerate(sorted(set(source.values())))}
    grid, shares = np.linspace(0, 1, 20001), []
    for knots in curriculum.SCHEDULES:
        weight = np.interp(grid, *zip(*knots, strict=True))
        area = np.concatenate([[0], np.cumsum((weight[1:] + weight[:-1]) / 2)])
        shares.append(area / area[-1])
    used = defaultdict(int)
    for r in sorted(rows, key=lambda r: hashlib.md5(str(r["doc_id"]).encode()).hexdigest()):
        s = source[r["doc_id"]]
        copies = [used[s] + e * r["source_size"] for e in range(3) if used[s] + r["size"] / 2 + e * r["source_size"] < r["target"]]
        used[s] += r["size"]
        want = np.interp([c / r["target"] for c in copies], shares[kind[s]], grid)
        assert billionths(r) == pytest.approx((want * 1e9).tolist(), abs=1e6)
    first = [billionths(r)[0] if r["positions"] else 2e9 for r in rows]
    assert first == sorted(first) and 0 < sum(len(billionths(r)) for r in rows)
