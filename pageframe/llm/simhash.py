"""Near duplicates by SimHash, found through a hierarchical index in Gray order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageframe.functions.lineage import stored
from pageframe.llm import gray_index, near_copies
from pageframe.llm.components import components
from pageframe.llm.gray_index import FAN, GrayIndex, gray_ranks, merge
from pageframe.llm.rows import packed, row_key, text_of

SEED = 42
DIFFERENCES = 2
SHINGLE = 3
#: Blocks of the Gray order. Their upper nodes, 24 bytes each, go to every task.
BLOCKS, MOST_BLOCKS, BLOCK_CODES = 256, 1 << 16, 1 << 20
QUERIES = 128


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """64 bits, each set if over half of the shingles' hashes have it; 0 without words."""
    words = text.lower().split()  # on bytes: A-Z and the ASCII blanks only
    if not words:
        return 0
    counts, n = np.zeros(64, np.int64), max(1, len(words) - width + 1)
    for low in range(0, n, 1 << 14):
        part = words[low : low + (1 << 14) + width - 1]
        shingles = zip(*[part[i:] for i in range(width)], strict=False) if len(words) >= width else [words]
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in shingles], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, carry: list[Column]) -> DataFrame:
    """The columns of ``carry`` and ``fp``, the fingerprint of ``text`` as a signed long.

    A null text counts as empty. Whole texts are hashed, in pieces of bounded size.
    """
    narrow = docs.select(*carry, text_of().alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            fp = np.fromiter((fingerprint(t.as_py()) for t in batch.column(at)), np.uint64, batch.num_rows)
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [f.name for i, f in enumerate(batch.schema) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fp.view(np.int64))], names=[*names, "fp"])

    return narrow.mapInArrow(run, narrow.drop("_text").withColumn("fp", F.lit(0).cast("long")).schema)


def block_links(members: np.ndarray, visitors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same groups as all pairs of a visitor and a member within ``most`` differences."""
    members = members[np.argsort(gray_ranks(members), kind="stable")]
    starts = np.arange(0, len(members), FAN)
    index = GrayIndex(np.bitwise_and.reduceat(members, starts), np.bitwise_or.reduceat(members, starts))
    label, left, right = np.arange(len(members)), [], []
    for low in range(0, len(visitors), QUERIES):
        codes = visitors[low : low + QUERIES]
        query, leaf = index.search(codes, most)
        place = leaf[:, None] * FAN + np.arange(FAN)
        inside = (place < len(members)).ravel()
        query, place = np.repeat(query, FAN)[inside], place.ravel()[inside]
        near = np.bitwise_count(codes[query] ^ members[place]) <= most
        query, place = query[near], place[near]
        same = query[1:] == query[:-1]
        label = merge(label, place[1:][same], place[:-1][same])
        first = np.concatenate([[True], ~same])[: len(query)]
        left.append(codes[query[first]])
        right.append(members[place[first]])
    left.append(members)
    right.append(members[label])
    a, b = np.concatenate(left), np.concatenate(right)
    return a[a != b], b[a != b]


def near_links(codes: DataFrame, most: int = DIFFERENCES, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between distinct codes ``fp`` that connect the same groups as all pairs within ``most`` bits.

    The codes are cut into blocks of about equal size along the Gray order. The upper nodes of the
    index, the bits that all codes of a block share, are at most ``MOST_BLOCKS`` rows and go to every
    task; a code travels to the later blocks that they cannot rule out, and each block searches its
    own lower levels. Visitors of a much visited block are dealt to several tasks, each with a copy
    of the block's codes, so no task holds more than a few times a block. Nothing is capped.
    """
    n = codes.count()
    blocks = blocks or min(MOST_BLOCKS, max(BLOCKS, -(-n // BLOCK_CODES)))
    dealt = gray_index.dealt(codes.select("fp"), gray_index.even_bounds(codes, blocks), most, home=True)
    if dealt is None:
        return codes.sparkSession.createDataFrame([], "a long, b long")

    def links(table: pa.Table) -> pa.Table:
        fp, member = table.column("fp").to_numpy().view(np.uint64), table.column("member").to_numpy()
        a, b = block_links(fp[member], fp[~member], most)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("block", "salt").applyInArrow(links, "a long, b long")


def fingerprint_groups(docs: DataFrame) -> DataFrame:
    """(fp, doc_id, key, root, component_id) for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id among the rows that are linked, directly or through others,
    by fingerprints of 2 or fewer differing bits; null if none of them has an id. Rows with a null id
    are linked like any other; repeated rows give a row each; null and empty texts have fingerprint
    0. ``root`` names the group, ``key`` is equal for rows with equal id and text. Columns other than
    these two are ignored.
    """
    prints = stored(fingerprints(docs, [F.col("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("key")]), "prints")
    codes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "codes")
    return _with_components(prints, codes, components(near_links(codes), "a", "b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(fp, doc_id, key, root, component_id) as ``fingerprint_groups``, for near copies on word shingles.

    Texts are linked if their sets of 5-word shingles have a Jaccard similarity of 0.8 or more: there
    64 bits differ in about 10, so ``near_copies`` takes longer fingerprints and searches them code by
    code, at 2 bits each, in the Gray index. ``fp`` names the text, 0 without words.
    """
    node = near_copies.text_node(F.col("text")).alias("fp")
    nodes = stored(docs.select(node, F.col("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("key")), "nodes")
    roots = near_copies.groups(docs.select(node.alias("node"), "text"))
    codes = nodes.groupBy("fp").agg(F.min("doc_id").alias("least"))
    return _with_components(nodes, codes, roots)


def _with_components(rows: DataFrame, codes: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the root of their code and the smallest id below it."""
    grouped = codes.join(roots, codes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(grouped.select("fp", "root").join(least, "root"), "fp")


def kept_documents(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id, then the smallest text hash.

    All columns of ``docs`` are kept. Rows without an id stay only where no row of their group has one.
    """
    chosen = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("f")
    first = near_duplicates(docs).groupBy("root").agg(chosen).select(F.col("f.key").alias("key"))
    whole = docs.select(packed(docs), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    return whole.join(first, "key").dropDuplicates(["key"]).select("row.*")
