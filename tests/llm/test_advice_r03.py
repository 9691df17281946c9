"""Faults that were found in the second round."""

import random
import time

import pytest
from test_edge_cases import docs, plain
from test_ops_against_brute_force import find_root

from pageframe.llm import near_copies, pii


def exact_groups(texts, alike=0.8):
    sets = [set(near_copies.shingles(t.encode()).tolist()) for t in texts]
    parent = {i: i for i in range(len(texts))}
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if min(len(a), len(b)) >= alike * max(len(a), len(b)) and (n := len(a & b)) >= alike * (len(a) + len(b) - n) - 1e-9:
                x, y = sorted((find_root(parent, i), find_root(parent, j)))
                parent[y] = x
    return {i: find_root(parent, i) for i in parent}


def near_groups(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "node long, text string").repartition(4)
    got = {r["node"]: r["root"] for r in plain(near_copies.groups(d))}
    return {i: got.get(i, i) for i in range(len(texts))}


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


@pytest.mark.parametrize("own,edits", [(60, 2), (90, 6)])
def test_pairs_under_a_shared_template(spark, own, edits):
    """All texts share most bands; each has one near copy, and the others are below the similarity."""
    rng, texts = random.Random(5), []
    template = words(rng, 300)
    for _ in range(400):
        a = template + words(rng, own)
        b = list(a)
        for at in rng.sample(range(len(a)), edits):
            b[at] = "edited"
        texts += [" ".join(a), " ".join(b)]
    want, got = exact_groups(texts), near_groups(spark, texts)
    pairs = [k for k in range(0, len(texts), 2) if want[k] == want[k + 1]]
    assert len(pairs) > 350
    assert sum(got[k] == got[k + 1] for k in pairs) >= 0.99 * len(pairs)
    assert len(set(got.values())) >= len(set(want.values()))  # nothing is linked that is not alike


def test_groups_beside_each_other_in_crowded_bands(spark):
    """Large groups of near copies of texts that are just not alike, strangers among them, copies that drift."""
    rng, texts = random.Random(6), []
    base = words(rng, 200)
    for _ in range(6):
        head = words(rng, 30)
        for _ in range(40):
            t = base + head
            t[rng.randrange(len(t))] = "x"
            texts.append(" ".join(t))
    t = base + words(rng, 40)
    for _ in range(30):
        t = list(t)
        t[rng.randrange(len(t))] = f"y{rng.random()}"
        texts.append(" ".join(t))
    texts += [" ".join(base + words(rng, 35)) for _ in range(40)]
    want, got = exact_groups(texts), near_groups(spark, texts)
    assert got == want


@pytest.mark.parametrize("one", ["+1 555 {:07d};", "user{}@mail{}.example.org "])
def test_pii_of_long_texts(spark, one):
    text, n, spans = "", 0, []
    rng, at, parts = random.Random(1), 0, []
    while at < 1_000_000:
        part = one.format(*(rng.randrange(10**7) for _ in range(2)))
        spans.append((at, at + len(part) - 1))
        parts.append(part)
        at += len(part)
    text = "".join(parts)
    d = spark.createDataFrame([(1, text), (2, "call +1 555 0000001 now")], "doc_id long, text string")
    began = time.time()
    kind = "phone" if "+" in one else "email"
    r = pii.report(d).filter("doc_id = 1").first()
    assert r["spans"].split(",") == [f"{kind}:{s}:{e}" for s, e in spans]
    masked = pii.masked(d).filter("doc_id = 1").first()["text"]
    assert masked == "".join(f"<{kind}>{text[e]}" for _, e in spans)
    assert time.time() - began < 60  # some seconds alone; it was hours


def test_pii_parts_at_their_edges(spark):
    """Context and gaps across the parts into which a text is cut."""
    rows = []
    for n in (0, 1, 215, 216, 250, 255, 256, 257, 511, 512, 513, 1000):
        rows.append((n, "é" * n + " mail me@x.org " + "漢" * n + " ssn 123-45-6789" + "." * n))
    got = {r["doc_id"]: r for r in plain(pii.report(spark.createDataFrame(rows, "doc_id long, text string")))}
    clean = {r["doc_id"]: r["text"] for r in plain(pii.masked(spark.createDataFrame(rows, "doc_id long, text string")))}
    for n, text in rows:
        a, b = text.index("me@"), text.index("123-")
        assert got[n]["spans"] == f"email:{a}:{a + 8},ssn:{b}:{b + 11}"
        assert clean[n] == text.replace("me@x.org", "<email>").replace("123-45-6789", "<ssn>")
    assert plain(pii.report(docs(spark, []))) == []
