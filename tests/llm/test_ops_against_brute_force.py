"""Each registered query against a plain computation over the same rows."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict
from functools import reduce

import duckdb
import numpy as np
import pytest
import xxhash

from pageframe.llm import queries
from pageframe.llm.tokens import default_path

SF = "/root/testdata/sf0.001"
BLANKS = "[^\x20\x09-\x0d]+"


def table(name):
    rows = duckdb.sql(f"SELECT * FROM '{SF}/{name}.parquet'")
    return [dict(zip(rows.columns, r, strict=True)) for r in rows.fetchall()]


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def find_root(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_simhash(spark):
    docs, prints = table("documents"), {}
    for d in docs:
        words = re.findall(BLANKS, ascii_lower(d["text"] or ""))
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        bits = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g, seed=42) >> b & 1)
        prints[d["doc_id"]] = sum(1 << b for b, n in bits.items() if 2 * n > len(grams))
    ids = sorted(prints)
    parent = {i: i for i in ids}
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find_root(parent, a), find_root(parent, b)))
                parent[y] = x
    want = {i: (f"{prints[i]:016x}", find_root(parent, i)) for i in ids}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows_of(queries.op1_simhash(spark, SF))}
    assert got == want


def test_toxicity(spark):
    """Held-out accuracy on the larger table, where there are enough labels."""
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in rows_of(queries.op2_toxicity(spark, sf))}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet' WHERE toxic IS NOT NULL").fetchall()
    assert len(got) == duckdb.sql(f"SELECT count(*) FROM '{sf}/documents.parquet'").fetchall()[0][0]
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    out = [(got[i]["score"], t) for i, t in labels if i in got and got[i]["held_out"]]
    bad, good = [s for s, t in out if t], [s for s, t in out if not t]
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert auc > 0.9
    assert np.mean([(s >= 0.5) == t for s, t in out]) > 0.93


def url_parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return ascii_lower(host), path


def test_url_filter(spark):
    from pageframe.llm.url_rules import RULES

    got = {r["page_id"]: r for r in rows_of(queries.op3_url_filter(spark, SF))}
    for p in table("pages"):
        host, path = url_parts(p["url"])
        fits = []
        for verdict, rule in RULES:
            h, _, rest = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + rest):
                fits.append((len(rule), rule, verdict))
        best = max(fits, default=(0, None, None))
        r = got[p["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, best[1])
        assert best[2] in (None, r["verdict"])


def test_warc(spark):
    first, want = {}, []
    pages = sorted(table("pages"), key=lambda p: p["page_id"])
    for p in pages:
        data = (p["html"] or "").encode()
        key = hashlib.sha256(data).hexdigest()
        shared = len(data) >= 100 and key in first
        want.append((p["page_id"], len(data), key, "revisit" if shared else "response", first[key] if shared else None))
        first.setdefault(key, p["page_id"])
    got = sorted(tuple(r) for r in queries.op4_warc(spark, SF).collect())
    assert got == want


def encoded(end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path())
    docs = sorted(table("documents"), key=lambda d: d["doc_id"])
    return {d["doc_id"]: [*t.encode(d["text"] or "", add_special_tokens=False).ids, end] for d in docs}


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_token_files(spark):
    want, start = [], 0
    for i, ids in encoded(0).items():
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(tuple(r) for r in queries.op5_token_files(spark, SF).collect()) == want


def test_mixing(spark):
    docs = table("documents")
    size = {d["doc_id"]: len(re.findall(BLANKS, d["text"] or "")) for d in docs}
    source = {d["doc_id"]: d["source"] for d in docs}
    sums = defaultdict(int)
    for i, n in size.items():
        sums[source[i]] += n
    names = sorted(sums)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, open_, target = sum(sums.values()), set(names), {}
    while True:
        share = {s: (total - sum(target.values())) * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sums[s]}
        if not above:
            target |= share
            break
        target |= {s: 3 * sums[s] for s in above}
        open_ -= above
    got = rows_of(queries.op6_mixing(spark, SF))
    assert len(got) == len(docs)
    taken = defaultdict(int)
    for r in got:
        i = r["doc_id"]
        assert (r["size"], r["source_size"]) == (size[i], sums[source[i]])
        assert r["target"] == pytest.approx(target[source[i]])
        assert r["taken"] % max(1, size[i]) == 0 and r["taken"] <= 3 * size[i]
        taken[source[i]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= max(size[i] for i in size if source[i] == s)
    again = rows_of(queries.op6_mixing(spark, SF))
    assert sorted(map(str, got)) == sorted(map(str, again))


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def base_spans(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": "[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][" + "\x20" + r"().0-9-]+[0-9]",
    }
    out = []
    for k, (kind, pattern) in enumerate(kinds.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, kind, m.end()))
    return sorted(out)


def check_pii(docs, got):
    for d in docs:
        base, r = base_spans(d["text"] or ""), got[d["doc_id"]]
        listed = [f"{kind}:{a}:{b}" for a, _, kind, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest(), d["doc_id"]
        for kind in ("email", "ip", "card", "phone"):
            assert r[f"n_{kind}"] == sum(s[2] == kind for s in base)
        found = r["spans"].split(",") if r["spans"] else []
        assert [s for s in found if s.split(":")[0] in ("email", "ip", "card", "phone")] == listed
        assert [int(s.split(":")[1]) for s in found] == sorted(int(s.split(":")[1]) for s in found)


def test_pii(spark):
    check_pii(table("documents"), {r["doc_id"]: r for r in rows_of(queries.op7_pii(spark, SF))})


def test_pii_on_hard_texts(spark):
    from pageframe.llm import pii

    texts = [
        None, "", "a@b.c_d@e.f", "x@y", "äö a.b+c@d-e.fg.h, +1 (212) 555-0100 x", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.255 1.2.3.999",
        "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111" * 3, "+1", "+12 3", "+1((((((((((1 23456789", "1 2 3 4 5 6 7 8 9 0 1 2 3",
        "é" * 500 + "12.13.14.15" + "." * 500, "a" * 60000 + "@" + "b." * 3000 + "c", "1" * 60000, "1." * 30000, "@" * 1000, "+1" * 5000,
        "a@b.c" * 300, "x@1.2.3.4 +49 (0)30 1234567", "IBAN DE89 3704 0044 0532 0130 00 end", "DE89370400440532013001", "ssn 123-45-6789", "123-45-6789",
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in rows_of(pii.report(spark.createDataFrame(rows, "doc_id long, text string")))}
    check_pii([{"doc_id": i, "text": t} for i, t in rows], got)
    spans = [got[i]["spans"] for i in range(len(rows) - 4, len(rows))]
    assert ["iban" in s for s in spans] == [True, False, False, False]
    assert ["ssn" in s for s in spans] == [False, False, True, False]


def quality(text):
    words = re.findall(BLANKS, text)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if grams[tuple(words[i : i + 8])] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(BLANKS, x)]
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_quality(spark):
    got = {r["doc_id"]: r for r in rows_of(queries.op8_quality(spark, SF))}
    kept = 0
    for d in table("documents"):
        r = got[d["doc_id"]]
        want = quality(d["text"] or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
        assert not (r["base_failed"] and r["kept"])
        kept += r["kept"]
    assert kept > 0.7 * len(got)


def test_top_k(spark):
    rows = table("embeddings")
    vectors = {r["vec_id"]: np.floor(64 * np.array(r["embedding"], np.float64)).astype(int) for r in rows}
    ids = sorted(vectors)
    matrix = np.array([vectors[i] for i in ids])
    want = []
    for q in ids:
        if q % 20 == 0:
            scores = matrix @ vectors[q]
            best = sorted((-int(s), i) for s, i in zip(scores, ids, strict=True) if i != q)[:20]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in queries.op9_top_k(spark, SF).collect()) == want


def check_pieces(pieces, ids, capacity=2048):
    by_doc, by_row = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_row[p["sequence_id"]].append(p)
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert (len(part), crc(part), p["doc_tokens"]) == (p["length"], p["ids_crc32"], len(ids[p["doc_id"]]))
    assert set(by_doc) == set(ids)
    for i, parts in by_doc.items():
        parts.sort(key=lambda p: p["start"])
        assert [p["start"] for p in parts] == [sum(q["length"] for q in parts[:k]) for k in range(len(parts))]
        assert sum(p["length"] for p in parts) == len(ids[i])
    for row in by_row.values():
        row.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in row] == [sum(q["length"] for q in row[:k]) for k in range(len(row))]
        used = sum(p["length"] for p in row)
        assert used <= capacity and used.bit_count() == 1


def test_packing(spark):
    check_pieces(rows_of(queries.op10_packing(spark, SF)), encoded(1))


def test_pipeline(spark):
    import corpus_pipeline
    from pageframe.functions.lineage import stored

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {r["doc_id"]: r for r in rows_of(docs)}
    good = {r["doc_id"] for r in rows_of(queries.op8_quality(spark, SF)) if r["kept"]}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]
    kept = stored(stages["quality"](spark, docs, SF))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == good and kept.count() == len(good)
    one = stored(stages["near_duplicates"](spark, kept, SF))
    from pageframe.llm import simhash

    groups = {r["component_id"] for r in rows_of(simhash.near_duplicates(kept))}
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one.collect()) == sorted(groups)
    clean = stored(stages["personal_data"](spark, one, SF))
    for r in rows_of(clean):
        text = whole[r["doc_id"]]["text"]
        spans = base_spans(text)
        if not spans:
            assert r["text"] == text or "<" in r["text"]
        else:
            assert r["text"] != text
        assert {k: v for k, v in r.items() if k != "text"} == {k: v for k, v in whole[r["doc_id"]].items() if k != "text"}
    mixed = stored(stages["mixing"](spark, clean, SF))
    counts = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == docs.columns and set(counts) <= groups and max(counts.values()) <= 3
    pieces = rows_of(stages["packing"](spark, mixed, SF))
    texts = {r["doc_id"]: r["text"] for r in rows_of(clean)}
    tokens = defaultdict(int)
    for p in pieces:
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
        tokens[p["doc_id"]] += p["length"]
    one_pass = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert all(tokens[i] == counts[i] * one_pass[i] for i in counts) and set(tokens) == set(counts) and texts
    run = queries.pipeline(spark, SF)
    assert reduce(lambda a, b: a + b, (r["length"] for r in run.select("length").collect())) == sum(tokens.values())
