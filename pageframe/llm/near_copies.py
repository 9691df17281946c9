"""Near copies: documents whose sets of word shingles are alike, found by SimHash and checked exactly."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageframe.functions.lineage import counted, stored
from pageframe.functions.skew import broadcast_if_small, small_or_not
from pageframe.llm.components import components
from pageframe.llm.gray_index import GrayIndex, dealt, even_bounds, gray_rank, gray_ranks, merge
from pageframe.llm.rows import WORD, text_of

SHINGLE, ALIKE = 5, 0.8
#: Neighbours of a code up to which it is compared with each; bits of the bound on how much two sets have in common.
FEW = 4
PARITIES = 1024
#: A fingerprint is cut into codes. Texts are candidates if ``DIFFERENCES`` or fewer bits of one of them differ.
DIFFERENCES = 2
#: Share of the bits that differ at a similarity of 0.8: 15.15 % by the angle, up to 15.8 % for sets of ``SMALL`` shingles.
DIFFER, RECALL, SMALL = 0.155, 0.998, 20
#: Codes have enough bits that a code has fewer neighbours by chance than this.
BY_CHANCE, WIDTHS = 1 / 16, (32, 40)
#: Codes of a table up to which it is one block; codes on whose bits a pair must not differ by far more than ``DIFFER``.
BLOCK_CODES, PROBE = 1 << 20, 8
_PLACES = np.random.default_rng(7).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Each of the 8 bits of a byte in a byte of its own; a table's mark above its codes, 3 or more bits from any other's.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
_MARKS = np.arange(256, dtype=np.uint64) * np.uint64(0x010101 << 40)


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of all runs of ``width`` words, A-Z lower-cased; of the whole text if it is shorter."""
    words = text.lower().split()
    ids: dict[bytes, int] = {}
    place = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    codes = np.fromiter((xxhash.xxh64_intdigest(w) for w in ids), np.uint64, len(ids))[place]
    n = max(1, len(words) - width + 1)
    out = np.full(n, min(len(words), width), np.uint64)
    for i in range(min(width, len(words))):
        out = _stirred(out + codes[i : i + n] * _PLACES[i])
    return np.unique(out)


def layout(n: int) -> tuple[int, int]:
    """Bits of a code and number of codes for ``n`` texts, so that a pair at 0.8 has a close code with a chance of ``RECALL``."""

    def near(width: int) -> int:
        return sum(math.comb(width, i) for i in range(DIFFERENCES + 1))

    width = next((w for w in range(*WIDTHS) if n * near(w) <= BY_CHANCE * 2**w), WIDTHS[1])
    met = sum(math.comb(width, i) * DIFFER**i * (1 - DIFFER) ** (width - i) for i in range(DIFFERENCES + 1))
    return width, math.ceil(math.log(1 - RECALL) / math.log(1 - met))


def simhash(hashes: np.ndarray, width: int, tables: int) -> np.ndarray:
    """The fingerprint of a set: bits that over half of its hashes have, ``width`` of them in each of the ``tables`` codes.

    A hash gives 64 bits for each seed. A code lies below its table's mark.
    """
    words = -(-width * tables // 64)
    counts = np.zeros(64 * words, np.int64)
    for low in range(0, len(hashes), 255):
        bits = _stirred(hashes[low : low + 255, None] ^ _SEEDS[:words])
        counts += _SPREAD[bits.view(np.uint8)].sum(0, dtype=np.uint64).view(np.uint8)
    fields = np.zeros((tables, 64), bool)
    fields[:, :width] = (2 * counts > len(hashes))[: tables * width].reshape(tables, width)
    return np.packbits(fields, axis=1, bitorder="little").view(np.uint64).ravel() | _MARKS[:tables]


def parities(hashes: np.ndarray) -> np.ndarray:
    """``PARITIES`` bits, each telling whether an odd number of the hashes falls on it, as longs.

    Two sets differ in at least as many hashes as their bits differ, so the bits can rule a pair out.
    """
    return np.packbits(np.bincount((hashes % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1).view(np.int64)


def _of_texts(texts: DataFrame, **of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(node, ...) of ``texts`` (node, text): for each name of ``of`` an array of longs made of a text's shingles."""
    kind = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 512):
                batch = whole.slice(low, 512)
                found = [shingles(t.as_py()) for t in batch.column("_text")]
                columns = [pa.array([f(h).view(np.int64) for h in found], kind) for f in of.values()]
                yield pa.RecordBatch.from_arrays([batch.column("node"), *columns], names=["node", *of])

    schema = ", ".join(["node long", *[f"{c} array<long>" for c in of]])
    return texts.select("node", text_of().alias("_text")).mapInArrow(run, schema)


def text_node(text: Column) -> Column:
    """A hash that names a text; 0 if it has no words."""
    return F.when(text.rlike(WORD), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))


def _alike(pairs: DataFrame, sets: DataFrame, alike: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose ``sets`` (node, hashes, bits) have a Jaccard similarity of ``alike`` or more.

    Sets meet only if neither their sizes nor their parities rule the pair out; both bounds are exact.
    """
    one, two = (sets.select(F.col("node").alias(n), F.col("hashes").alias(f"of_{n}")) for n in ("a", "b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    close = both >= F.lit(alike) * (F.size("of_a") + F.size("of_b") - both)
    small, _ = broadcast_if_small(sets.select("node", F.size("hashes").alias("n"), "bits"))
    a, b = (small.select(F.col("node").alias(n), F.col("n").alias(f"n_{n}"), F.col("bits").alias(f"bits_{n}")) for n in ("a", "b"))
    sizes = F.least("n_a", "n_b") >= F.lit(alike) * F.greatest("n_a", "n_b")
    differ = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    fit = pairs.join(a, "a").join(b, "b").filter(sizes & (differ <= F.lit((1 - alike) / (1 + alike)) * (F.col("n_a") + F.col("n_b")) + 1e-6))
    return fit.select("a", "b").join(one, "a").join(two, "b").filter(close).select("a", "b")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def rare_first(sets: DataFrame, alike: float) -> DataFrame:
    """(hash, node, n, i): of each set the hashes that others hold too, i of its n hashes being rarer, as far as a pair can first meet.

    All sets are ordered alike, by the number of sets that hold a hash. Two sets of ``alike`` or more
    have their first common hash where enough of both lies behind it, so the rest is left out.
    """
    each = sets.select("node", F.size("hashes").alias("n"), F.explode("hashes").alias("hash"))
    held = each.groupBy("hash").agg(F.count("*").alias("df")).filter("df > 1")
    # what only one set holds comes first and meets nothing
    listed = F.array_sort(F.collect_list(F.struct("df", "hash")))
    shared = each.join(held, "hash").groupBy("node", "n").agg(listed.alias("shared"))
    alone = (F.col("n") - F.size("shared")).alias("alone")
    most = F.col("n") - F.ceil(F.lit(alike) * F.col("n")) + 1 - F.col("alone")
    placed = shared.select("node", "n", "shared", alone).select("node", "n", "alone", F.posexplode(F.slice("shared", F.lit(1), F.greatest(most, F.lit(0)).cast("int"))))
    return placed.select(F.col("col.hash").alias("hash"), "node", "n", (F.col("alone") + F.col("pos")).alias("i"))


def missing_pairs(sets: DataFrame, roots: DataFrame, alike: float) -> DataFrame:
    """All pairs (a, b) of ``sets`` (node, hashes) that may be alike and are not yet in one component of ``roots`` (node, root).

    Pairs meet at a hash of ``rare_first`` whose place still allows the similarity: what many unlike
    texts share stands too far behind for that. Of the sets at a hash, those of the component that
    has most of them are compared with the others only, so a group that is linked already costs nothing.
    """
    at = rare_first(sets, alike).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    at = stored(at, "meeting")
    counts = at.groupBy("hash", "root").agg(F.count("*").alias("k"))
    major = counts.groupBy("hash").agg(F.max_by("root", F.struct("k", "root")).alias("major"), F.count("*").alias("roots"))
    others = at.join(major.filter("roots > 1").select("hash", "major"), "hash").filter("root != major").drop("major")
    x, y = others.alias("x"), at.alias("y")
    need = F.lit(alike / (1 + alike)) * (F.col("x.n") + F.col("y.n")) - 1e-6
    enough = F.least(F.col("x.n") - F.col("x.i"), F.col("y.n") - F.col("y.i")) >= need
    met = x.join(y, (F.col("x.hash") == F.col("y.hash")) & (F.col("x.root") != F.col("y.root")) & enough)
    return met.select(*_ordered(F.col("x.node"), F.col("y.node"))).distinct()


def close_pairs(fp: np.ndarray, node: np.ndarray, heavy: np.ndarray, member: np.ndarray, among_members: bool = True) -> tuple[np.ndarray, ...]:
    """(a, b, crowded): of all pairs of a member and another code within ``DIFFERENCES`` bits those that have to be checked, as nodes.

    A code of up to ``FEW`` neighbours, none ``heavy``, gives all of its pairs. The others are
    ``crowded``: of theirs only enough are found to hang each on the smallest node of its group.
    Every pair is thus among (a, b), or both of its nodes are crowded.
    """
    order = np.lexsort((node, gray_ranks(fp)))
    fp, node, heavy, member = fp[order], node[order], heavy[order], member[order]
    index = GrayIndex(fp, fp, 2)
    degree, pairs = np.where(heavy, FEW, 0), []
    own, few = index.above(member), index.above(degree <= FEW)

    def wanted(depth: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (own[depth][a] | own[depth][b]) & (few[depth][a] | few[depth][b])

    def found(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal degree, few
        sides = member[a] | member[b] if among_members else member[a] ^ member[b]
        use = (a != b) & sides & ((degree[a] <= FEW) | (degree[b] <= FEW))
        a, b = a[use], b[use]
        pairs.append((a, b))
        full = np.count_nonzero(degree > FEW)
        degree = degree + np.bincount(np.concatenate([a, b]), minlength=len(fp))
        degree[np.concatenate([a[heavy[b]], b[heavy[a]]])] += FEW + 1
        if np.count_nonzero(degree > FEW) > full:
            few = index.above(degree <= FEW)

    index.meet(DIFFERENCES, wanted, found)
    a, b = (np.concatenate([p[i] for p in pairs]) if pairs else np.zeros(0, np.int32) for i in (0, 1))
    by_node = np.argsort(node, kind="stable")
    rank = np.empty(len(node), np.int64)
    rank[by_node] = np.arange(len(node))
    root = by_node[merge(np.arange(len(node)), rank[a], rank[b])][rank]
    crowded = np.flatnonzero(degree > FEW)
    both = (degree[a] > FEW) & (degree[b] > FEW)
    a, b = np.concatenate([a[~both], crowded]), np.concatenate([b[~both], root[crowded]])
    return node[a], node[b], np.unique(node[crowded])


def candidates(signed: DataFrame, n: int, tables: int) -> DataFrame:
    """(a, b, fp) for ``signed`` (node, fp), the codes of ``n`` texts, where b or fp is null: pairs (a, b), nodes a of crowded codes, heavy codes fp with their smallest node a.

    Every pair of nodes that differ in ``DIFFERENCES`` or fewer bits of a code is there, or each of
    both has a crowded or heavy code. A code is heavy if more than two nodes have it, and only the
    smallest and the largest stand for them. A table is a block of the index, or several of about equal size.
    """
    codes = signed.groupBy("fp").agg(F.count("*").alias("k"), F.min("node").alias("low"), F.max("node").alias("high"))
    ends = F.explode(F.array_distinct(F.array("low", "high"))).alias("node")
    codes = codes.select("fp", ends, (F.col("k") > 2).alias("heavy"), (F.col("node") == F.col("low")).alias("first"))
    marks = gray_ranks(_MARKS[:tables])
    bounds = np.sort((marks >> np.uint64(40) << np.uint64(40) ^ np.uint64(1 << 63)).view(np.int64))
    if n > BLOCK_CODES:
        codes = stored(codes, "ends")
        bounds = np.union1d(bounds, even_bounds(codes, tables * -(-n // BLOCK_CODES)))
        rows = dealt(codes, bounds, DIFFERENCES, home=False)
    else:  # tables are too far apart to visit each other
        rows = codes.select("*", F.shiftrightunsigned(gray_rank(F.col("fp")), 40).alias("block"), F.lit(0).cast("long").alias("salt"), F.lit(True).alias("member"))

    def pairs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        fp, node, heavy, first, member = (table.column(c).to_numpy() for c in ("fp", "node", "heavy", "first", "member"))
        a, b, crowded = close_pairs(fp.view(np.uint64), node, heavy, member, key[1].as_py() == 0)
        one = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b], axis=0)
        named = heavy & first & member
        out = [[*one.T, None], [crowded, None, None], [node[named], None, fp[named]]]
        columns = [[pa.nulls(len(o[0]), pa.int64()) if c is None else pa.array(c, pa.int64()) for c in o] for o in out]
        return pa.table({name: pa.chunked_array(list(c)) for name, c in zip(("a", "b", "fp"), zip(*columns, strict=True), strict=True)})

    return rows.groupBy("block", "salt").applyInArrow(pairs, "a long, b long, fp long")


def _near_prints(pairs: DataFrame, signed: DataFrame, width: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose fingerprints differ no more than texts at 0.8 could, by seven standard deviations."""
    bits = width * PROBE
    most = math.ceil(bits * DIFFER + 7 * math.sqrt(bits * DIFFER * (1 - DIFFER)))
    probe = F.slice("codes", 1, PROBE)
    a, b = (signed.select(F.col("node").alias(n), probe.alias(f"of_{n}")) for n in ("a", "b"))
    differ = F.aggregate(F.zip_with("of_a", "of_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return pairs.join(a, "a").join(b, "b").filter(differ <= most).select("a", "b")


def near_links(texts: DataFrame, alike: float = ALIKE) -> DataFrame:
    """Links (a, b) that join all ``texts`` (node, text) whose shingle sets have a Jaccard similarity of ``alike`` or more.

    Texts are candidates if a code of their fingerprints is close: all pairs of a code with up to
    ``FEW`` neighbours. A more crowded one is first compared with the smallest node of its group
    only, which joins a group of copies of any size. What that leaves apart is found among all texts
    of crowded codes, and of fewer than ``SMALL`` shingles, by ``missing_pairs``, whose candidates
    lack none. All candidates are checked on their whole sets. Pairs that other links join already
    have no link of their own.
    """
    links, _, more, _ = _links(texts, alike)
    return links if more is None else links.unionByName(more)


def _links(texts: DataFrame, alike: float) -> tuple[DataFrame, DataFrame, DataFrame | None, int]:
    """The links of candidates, (node, root) by them, what crowded codes add (or None), and the rows of the latter two at most."""
    n = texts.count()
    width, tables = layout(n)
    signed = _of_texts(texts, codes=lambda h: simhash(h, width, tables), size=lambda h: np.array([len(h)]))
    signed = stored(signed.dropDuplicates(["node"]), "signed")
    each = signed.select("node", F.explode("codes").alias("fp"))
    found, n = counted(candidates(each, n, tables), pairs="b is not null", heavy="fp is not null")
    n_close, n_crowded = n["pairs"], n["rows"] - n["pairs"]
    heavy, _ = broadcast_if_small(found.filter("fp is not null").select("fp", F.col("a").alias("low")).distinct(), most=n["heavy"])
    met, n = counted(each.join(heavy, "fp").select("node", "low").distinct())
    n_met = n["rows"]
    # a pair is found once a block, and a text of a heavy code meets its smallest
    pairs = found.filter("b is not null").select("a", "b").unionByName(met.filter("node != low").select(*_ordered(F.col("node"), F.col("low"))))
    pairs, n = counted(_near_prints(pairs.distinct(), signed, width), most=n_close + n_met)
    n_pairs = n["rows"]
    small = signed.filter(F.col("size")[0] < SMALL).select("node")
    crowded = found.filter("b is null and fp is null").select(F.col("a").alias("node")).unionByName(met.select("node")).unionByName(small)
    dense, _, crowd = small_or_not(crowded.distinct(), most=n_crowded + n_met + signed.filter(F.col("size")[0] < SMALL).count())
    asked, _ = broadcast_if_small(pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(dense).distinct(), most=2 * n_pairs + crowd)
    once = texts.join(asked, "node", "left_semi").dropDuplicates(["node"])
    sets = stored(_of_texts(once, hashes=lambda h: h, bits=parities), "sets")
    links = stored(_alike(pairs, sets, alike), "links", most=n_pairs)
    roots = components(links, "a", "b", n_pairs)
    if not crowd:
        return links, roots, None, 0
    among = sets.join(dense, "node", "left_semi")
    pairs, n = counted(missing_pairs(among, roots, alike))
    if not n["rows"]:
        return links, roots, None, 0
    more, n = counted(_alike(pairs, among, alike), most=n["rows"])
    return links, roots, more if n["rows"] else None, 2 * n_pairs + n["rows"]


def groups(texts: DataFrame, alike: float = ALIKE) -> DataFrame:
    """(node, root) of the texts that are linked, directly or through others."""
    _, roots, more, n = _links(texts, alike)
    if more is None:
        return roots
    # a node hangs on its root already: the few links that are new need few rounds
    return components(more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))), "a", "b", n)
