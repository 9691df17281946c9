"""The hierarchical index of codes in Gray order that the searches by Hamming distance share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageframe.functions.lineage import stored

FAN = 16
#: Pairs of nodes that a join of codes goes down with at once.
PAIRS = 1 << 15


def gray_rank(code: Column) -> Column:
    """The place of a code in Gray order, as a signed long of that order."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def gray_ranks(codes: np.ndarray) -> np.ndarray:
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Levels of nodes over codes in Gray order, leaves first.

    A node holds the bits that all codes below share (``mask``) and their values (``bits``), without
    those that a node above has factored out already. A search adds up the differences on its way
    down and leaves a node with all that is below once they are too many.
    """

    def __init__(self, both: np.ndarray, either: np.ndarray, fan: int = FAN):
        """``both``, ``either``: conjunction and disjunction of the codes below each leaf."""
        levels = [(both, either)]
        while len(levels[-1][0]) > 1:
            starts = np.arange(0, len(levels[-1][0]), fan)
            levels.append((np.bitwise_and.reduceat(levels[-1][0], starts), np.bitwise_or.reduceat(levels[-1][1], starts)))
        self.fan, self.levels, self.whole, above = fan, [], [], None
        for both, either in reversed(levels):
            mask = ~(both ^ either)
            self.whole.append((mask, both & mask))
            own = mask if above is None else mask & ~np.repeat(above, fan)[: len(mask)]
            self.levels.append((own, both & own))
            above = mask

    def search(self, codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``codes``, leaf) of leaves that may hold a code within ``most`` differences."""
        query, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        found = np.zeros(len(codes), np.int64)
        for depth, (mask, bits) in enumerate(self.levels):
            if depth:
                children = node[:, None] * self.fan + np.arange(self.fan)
                inside = children < len(mask)
                query, found, node = (np.repeat(x, self.fan)[inside.ravel()] for x in (query, found, node))
                node = children.ravel()[inside.ravel()]
            found = found + np.bitwise_count((codes[query] ^ bits[node]) & mask[node])
            stay = found <= most
            query, found, node = query[stay], found[stay], node[stay]
        return query, node

    def meet(self, most: int, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray], found: Callable[[np.ndarray, np.ndarray], None]) -> None:
        """Hands to ``found`` the pairs a <= b of leaves that may hold codes within ``most`` differences of each other.

        The index goes down beside itself, deepest pairs first: the bits that all codes below both of
        two nodes share bound their differences from below. ``wanted`` tells at a depth, root 0, which pairs are of use.
        """
        one, two = (x.astype(np.int32) for x in np.divmod(np.arange(self.fan**2), self.fan))
        stack = [(0, np.zeros(1, np.int32), np.zeros(1, np.int32))]
        while stack:
            depth, a, b = stack.pop()
            if depth == len(self.whole) - 1:
                found(a, b)
                continue
            if len(a) > PAIRS:
                stack.append((depth, a[PAIRS:], b[PAIRS:]))
                a, b = a[:PAIRS], b[:PAIRS]
            stay = wanted(depth, a, b)
            a, b = ((x[stay][:, None] * np.int32(self.fan) + y).ravel() for x, y in ((a, one), (b, two)))
            mask, bits = self.whole[depth + 1]
            inside = (a <= b) & (b < len(mask))
            a, b = a[inside], b[inside]
            near = np.bitwise_count((bits[a] ^ bits[b]) & mask[a] & mask[b]) <= most
            stack.append((depth + 1, a[near], b[near]))

    def above(self, flags: np.ndarray) -> list[np.ndarray]:
        """For each depth, root first, whether a leaf below a node has its flag."""
        out = [flags]
        while len(out[-1]) > 1:
            out.append(np.logical_or.reduceat(out[-1], np.arange(0, len(out[-1]), self.fan)))
        return out[::-1]


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after uniting the groups of ``a`` and ``b``; a label is the smallest place of its group."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[differ], np.minimum(x, y)[differ])
        while not np.array_equal(up := label[label], label):
            label = up


def dealt(codes: DataFrame, bounds: np.ndarray, most: int, home: bool) -> DataFrame | None:
    """(block, salt, member, the columns of ``codes``): the codes ``fp`` in blocks of the Gray order, cut at ``bounds``; None without codes.

    A code is a member of its own block and a visitor of the later blocks, with ``home`` of its own
    too, that the upper nodes of the index, the bits that all codes of a block share, cannot rule out
    within ``most`` differences. Visitors of a much visited block are dealt to several salts, each with
    a copy of the block's members, so no task holds more than a few times a block. Nothing is capped.
    """
    spark, names = codes.sparkSession, codes.columns
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in codes.schema) + ", block int"

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.searchsorted(bounds, batch.column("rank").to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(block.astype(np.int32))], names=[*names, "block"])

    own = stored(codes.withColumn("rank", gray_rank(F.col("fp"))).mapInArrow(blocked, kinds), "codes")
    nodes = own.groupBy("block").agg(F.bit_and("fp").alias("both"), F.bit_or("fp").alias("either"), F.count("*").alias("n"))
    nodes = sorted(nodes.collect())  # one row a block
    if not nodes:
        return None
    ids = np.array([r["block"] for r in nodes], np.int32)
    upper = GrayIndex(*(np.array([r[c] for r in nodes], np.int64).view(np.uint64) for c in ("both", "either")))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                query, leaf = upper.search(part.column("fp").to_numpy().view(np.uint64), most)
                to, at = ids[leaf], part.column("block").to_numpy()[query]
                later = to >= at if home else to > at
                row = part.take(pa.array(query[later]))
                yield pa.RecordBatch.from_arrays([*[row.column(c) for c in names], pa.array(to[later])], names=[*names, "block"])

    visits = stored(own.mapInArrow(routed, kinds), "visits")
    sizes = {r["block"]: r["n"] for r in nodes}
    seen = {r["block"]: r["count"] for r in visits.groupBy("block").count().collect()}  # one row a block
    spread = [(int(k), 1 + seen.get(k, 0) // (1 << 16 | 4 * sizes[k])) for k in sizes]
    spread = F.broadcast(spark.createDataFrame(spread, "block int, tasks int"))
    salt = F.pmod(F.xxhash64("fp"), F.col("tasks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - F.lit(1).cast("long")))
    members = own.join(spread, "block").select("block", every.alias("salt"), *names, F.lit(True).alias("member"))
    return members.unionByName(visits.join(spread, "block").select("block", salt.alias("salt"), *names, F.lit(False).alias("member")))


def even_bounds(codes: DataFrame, blocks: int) -> np.ndarray:
    """Ranks that cut the codes ``fp`` into about ``blocks`` equal parts of the Gray order."""
    cuts = [i / blocks for i in range(1, blocks)]
    found = codes.select(gray_rank(F.col("fp")).alias("rank")).agg(F.percentile_approx("rank", cuts, 10 * blocks).alias("b")).first()["b"] if cuts else []
    return np.array(sorted(set(found or [])), np.int64)
