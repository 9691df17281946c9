"""Token counts, periodic runs and lexical search against plain computations, and on odd tables."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from test_edge_cases import SF, TEXTS, docs, plain
from test_ops_against_brute_force import BLANKS, ascii_lower, table

from pageframe.llm import lexical, runs, token_counts
from pageframe.llm.queries import QUERIES
from pageframe.llm.tokens import Encoder, default_path, encoder

ALPHABET = ["a", "b", " ", "  ", "\n", "\t", "'s", "'re", "'r", "é", "漢", " ", "　", "\x1c", "1", "23", "!!", "<|endoftext|>", "<|endof", "\r\n", "😀", "ß", "᠎", "\x85", " the", " and,"]


def odd_texts(n, longest, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(longest))) for _ in range(n)]


def library_counts(texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(default_path())
    return [len(g.ids) for g in own.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_on_odd_texts(monkeypatch):
    texts = [*odd_texts(4000, 30), "", "x" * 70000, " " * 3000, "word, word. word's <|endoftext|>"]
    monkeypatch.setattr("pageframe.llm.tokens.MOST_WORDS", 500)  # forgets and learns again
    own = Encoder(default_path())
    for low in range(0, len(texts), 500):
        some = texts[low : low + 500]
        want = own.tokenizer.encode_batch(some, add_special_tokens=False)
        assert own.encode(some) == [np.array(w.ids, "<u4").tobytes() for w in want]
    assert own.words < 3000


def test_token_counts(spark):
    rows = table("documents")
    got = {r["doc_id"]: r for r in plain(QUERIES["op11_token_counts"](spark, SF))}
    assert len(got) == len(rows)
    for d, n in zip(rows, library_counts([d["text"] for d in rows]), strict=True):
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((d["text"] or "").encode()), n > 512)


def test_chunks_are_spliced_as_the_whole_text(spark):
    texts = [*odd_texts(250, 400), *TEXTS, "a" * 40000 + " b", "ab " * 3000 + "<|endoftext|>" * 300 + " " * 900, "x'" * 5000, "漢" * 9000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in plain(token_counts.count_tokens(d, chunk=256, overlap=16))}
    assert {i: got[i]["n_tokens"] for i in got} == dict(enumerate(library_counts(texts)))
    assert sum(r["n_seams"] > 1 for r in got.values()) > 100


def test_no_splice_without_proof(spark):
    own = encoder(default_path())
    assert token_counts.provable(own) and token_counts.unsure(own) == 17
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    texts = ["Some Words here", "", None, "x" * 5000, "é ü 漢字"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    other = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: r["n_tokens"] for r in plain(token_counts.count_tokens(d, public_tokenizers.path("word_bpe_49k.json"), chunk=64))}
    assert got == {i: len(other.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r["n_tokens"] for r in plain(token_counts.count_tokens(d, public_tokenizers.path("piece_bpe_32k.model"), chunk=64))}
    assert got == {i: len(pieces.encode(t or "")) for i, t in enumerate(texts)}


def plain_runs(w):
    n, out = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_random_sequences():
    rng = random.Random(1)
    for _ in range(700):
        k, w = rng.choice([1, 2, 2, 3, 5, 50]), []
        for _ in range(rng.randrange(12)):
            unit = [rng.randrange(k) for _ in range(rng.randrange(1, 30))]
            w += unit * rng.randrange(1, 9) + unit[: rng.randrange(len(unit))] if rng.random() < 0.6 else unit
        assert runs.periodic_runs(np.array(w, np.int64)) == plain_runs(w)


def test_grammar_gives_the_sequence_back():
    rng = random.Random(2)
    for _ in range(200):
        w = [rng.randrange(rng.choice([1, 2, 6])) for _ in range(rng.randrange(200))]
        rules, rest = runs.re_pair(w)
        pairs = [p for p in zip(rest, rest[1:], strict=False) if p[0] != p[1]]
        assert len(pairs) == len(set(pairs))

        def words(x, rules=rules):
            return [x] if x not in rules else [*words(rules[x][0]), *words(rules[x][1])]

        assert [v for x in rest for v in words(x)] == w


def run_row(doc_id, text):
    words = re.findall(BLANKS, text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
    figures = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *figures, *(hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept)))


def test_runs_query(spark):
    rows = [d for d in table("documents") if len(d["text"] or "") < 40000]
    got = {r["doc_id"]: tuple(r.values()) for r in plain(QUERIES["op12_runs"](spark, SF))}
    assert sum(r[1] > 0 for r in got.values()) > 10
    assert [got[d["doc_id"]] for d in rows] == [run_row(d["doc_id"], d["text"]) for d in rows]


def test_runs_edges(spark):
    d = docs(spark)
    got = plain(runs.runs_of(d))
    assert len(got) == d.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[10]["runs"] == [(0, 42000, 14)] and by_id[10]["collapsed"] == TEXTS[10][: len(TEXTS[10]) // 3000].strip()
    assert by_id[0]["n_runs"] == by_id[1]["n_runs"] == by_id[9]["n_runs"] == 0 and by_id[0]["collapsed"] == "" and by_id[0]["start"] is None
    assert runs.runs_of(docs(spark, [])).count() == 0 and runs.run_digests(docs(spark, [])).count() == 0


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_search(documents, items, top=20):
    import math

    counted = [(i, [t for t in TERM.findall(ascii_lower(text or ""))]) for i, text in documents]
    n, total = sum(bool(t) for _, t in counted), sum(len(t) for _, t in counted)
    df = {}
    for _, terms in counted:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    out = []
    for item_id, text in items:
        found = []
        for i, terms in counted:
            score, m = 0, 75 + (25 * len(terms) * n // total if total else 0)
            for t in TERM.findall(ascii_lower(text or "")):
                if tf := terms.count(t):
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                found.append((-score, i is not None, i or 0))
        out += [(item_id, r + 1, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("top,pass_terms,block", [(20, 1 << 18, 4096), (3, 5, 7), (1, 1, 2)])
def test_search_edges(spark, monkeypatch, top, pass_terms, block):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    rng = random.Random(4)
    words = ["the", "The", "a", "b-c", "é", "É", "rare", "Rare2", "x_y", "漢字"]
    texts = [*TEXTS[:10], *(" ".join(rng.choices(words, [9, 9, 9, 3, 2, 1, 1, 1, 1, 1], k=rng.randrange(40))) for _ in range(90))]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(3, texts[3], "k"), (None, "rare the", "k"), (None, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    items = [(0, "the rare rare"), (1, None), (2, "nothing here at all zzz"), (3, "É é 漢字 x"), (3, "b c"), (None, "THE a")]
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    got = sorted((tuple(r) for r in lexical.search(d, asked, top, pass_terms).collect()), key=str)
    assert got == plain_search([(i, t) for i, t, _ in rows], items, top)


def test_search_of_empty_tables(spark):
    d, items = docs(spark), spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert lexical.search(docs(spark, []), items).count() == 0
    assert lexical.search(d, items.limit(0)).count() == 0
    assert lexical.search(d, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_search_keeps_all_terms_of_a_large_vocabulary(spark, monkeypatch):
    d, items = docs(spark), spark.createDataFrame([(1, "one two quick fox"), (2, "shared line")], "item_id long, text string")
    want = sorted(map(tuple, lexical.search(d, items).collect()))
    monkeypatch.setattr(lexical, "broadcast_if_small", lambda df: (df, False))
    assert sorted(map(tuple, lexical.search(d, items).collect())) == want


def test_accumulators_stop(monkeypatch):
    """Documents of the common term get no accumulator once the rare term's ones are out of reach."""
    n = 400
    rows = [{"item": 0, "term": t, "times": 1, "df": f, "weight": w} for t, f, w in ((b"rare", 30, 5000), (b"common", n, 10))]
    s = lexical.Search(rows, n, n)
    block = {
        "ids": np.arange(n), "known": np.ones(n, np.int64), "sizes": np.ones(n, np.int64), "terms": [b"common", b"rare"],
        "ends": np.array([n, n + 30]), "docs": np.concatenate([np.arange(n), np.arange(100, 130)]), "tfs": np.ones(n + 30, np.int64),
    }
    seen, kept = [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, k: seen.append((a > 0).sum()) or kept(a, k))
    best = [np.zeros((3, 0), np.int64)]
    s.block(block, best)
    assert best[0].shape[1] == 20 and set(best[0][2]) <= set(range(100, 130)) and max(seen) == 30
