"""Faults that were found in the third round."""

import random
from pathlib import Path

import numpy as np
import pytest
from test_advice_r03 import exact_groups, near_groups, words
from test_ops_against_brute_force import find_root

from pageframe.functions import lineage
from pageframe.llm import near_copies
from pageframe.llm.components import components


@pytest.fixture
def written(spark, monkeypatch):
    """Number of files of each frame that is stored while 64 shuffle partitions are never coalesced."""
    names = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, files = {k: spark.conf.get(k) for k in names}, {}
    plain = lineage.stored

    def stored(df, name="rows", path=None, most=None):
        path = path or lineage.fresh_path(df.sparkSession, name)
        out = plain(df, name, path, most)
        files[path] = len(list(Path(path.removeprefix("file:")).glob("part-*")))
        return out

    for module in ("pageframe.functions.lineage", "pageframe.llm.components", "pageframe.llm.near_copies"):
        monkeypatch.setattr(f"{module}.stored", stored)
    for k, v in names.items():
        spark.conf.set(k, v)
    yield files
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rounds_of_components_write_few_files(spark, written):
    rng, n = random.Random(3), 3000
    edges = [(i, i + 1) for i in range(0, 400)] + [(rng.randrange(500, n), rng.randrange(500, n)) for _ in range(1500)]
    parent = {i: i for e in edges for i in e}
    for a, b in edges:
        x, y = sorted((find_root(parent, a), find_root(parent, b)))
        parent[y] = x
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["root"] for r in found} == {i: find_root(parent, i) for e in edges if e[0] != e[1] for i in e}
    rounds = list(written.values())[1:]
    assert rounds and max(rounds) <= lineage.FEWEST_FILES


def test_near_copies_write_few_files(spark, written):
    """Groups of copies under a shared template: frames whose size is bounded beforehand are not written in a file for each partition."""
    rng, texts = random.Random(8), []
    base = words(rng, 200)
    for _ in range(6):
        head = words(rng, 30)
        for _ in range(12):
            t = base + head
            t[rng.randrange(len(t))] = "x"
            texts.append(" ".join(t))
    texts += [" ".join(base + words(rng, 35)) for _ in range(20)]
    assert near_groups(spark, texts) == exact_groups(texts)
    names = {k.rsplit("/", 1)[1].split("-")[0] for k, n in written.items() if n > 8}  # unshuffled sides: a writer for each thread
    assert not names & {"star", "links", "side"}
    assert sum(written.values()) < 64 * 12


def test_no_link_is_lost_when_crowded_bands_add_none(spark):
    rng = random.Random(9)
    one = words(rng, 120)
    texts = [" ".join(one + [f"end{i}"]) for i in range(12)] + [" ".join(words(rng, 90)) for _ in range(5)]
    assert near_groups(spark, texts) == exact_groups(texts)
    d = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    linked = {i for r in near_copies.near_links(d).collect() for i in (r["a"], r["b"])}
    assert linked == set(range(12))


def test_fingerprints_of_near_copies_are_majorities():
    rng = np.random.default_rng(4)
    width, tables = near_copies.layout(1000)
    for n in (1, 20, 255, 256, 700):
        hashes = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        bits = near_copies._stirred(hashes[:, None] ^ near_copies._SEEDS[: -(-width * tables // 64)])
        counts = [sum(int(w) >> i & 1 for w in column) for column in bits.T for i in range(64)]
        codes = near_copies.simhash(hashes, width, tables)
        for t, code in enumerate(codes.tolist()):
            want = sum(1 << i for i, c in enumerate(counts[t * width : (t + 1) * width]) if 2 * c > n)
            assert code == want | t * 0x010101 << 40


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_candidates_are_the_pairs_within_two_bits(spark, monkeypatch, block):
    """Candidates of near copies come from codes of fingerprints in Gray order: every close pair is there, or both are crowded."""
    monkeypatch.setattr(near_copies, "BLOCK_CODES", block)
    rng, tables, fps = random.Random(2), 3, []
    base = [rng.randrange(1 << 32) for _ in range(60)] + [7] * 6 + [11, 11, 19, 19]
    base += [b ^ 1 << rng.randrange(32) ^ 1 << rng.randrange(32) for b in base[:40]]
    dense = rng.randrange(1 << 32)
    base += [dense ^ 1 << i for i in range(20)]
    rows = [(node, t * 0x010101 << 40 | (code if t < 2 else rng.randrange(1 << 32))) for node, code in enumerate(base) for t in range(tables)]
    got = near_copies.candidates(spark.createDataFrame(rows, "node long, fp long").repartition(4), len(base), tables).collect()
    pairs = {(r["a"], r["b"]) for r in got if r["b"] is not None}
    heavy = {r["fp"] for r in got if r["fp"] is not None}
    assert heavy == {7, 0x010101 << 40 | 7}
    crowded = {r["a"] for r in got if r["b"] is None and r["fp"] is None} | {n for n, fp in rows if fp in heavy}
    close = {(a, b) for a, x in rows for b, y in rows if a < b and (x ^ y).bit_count() <= 2}
    assert len(close) > 200 and all(p in pairs or crowded.issuperset(p) for p in close)
    assert {n for n, _ in rows} - crowded and len(pairs - close) <= len(crowded)
