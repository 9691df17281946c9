"""Token ids in files of directly addressable codes."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from pageframe.functions.lineage import fresh_path, stored
from pageframe.llm.tokens import default_path, encoder, slices

MAGIC = b"DAC1"
CHUNK_BITS = 8
#: Bits of a continuation bitmap that one entry of its rank directory covers.
RANK_BITS = 512
#: Ids after which a segment is closed; a document is never split between segments.
SEGMENT_IDS = 1 << 16
END = 0
#: Bytes after which a page of a file is closed: less than a segment takes, so each has a page of its own.
PAGE_BYTES = 1 << 12
#: Segments that a look-up names to the scan, which then reads their pages alone; for more it reads all.
NAMED_SEGMENTS = 1000
SEGMENTS = "part int, seq int, n_docs long, n_tokens long, segment binary"


def encode_segment(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """One segment.

    Level k holds the k-th 8 bits of every id that has them, without gaps. A bitmap of each level
    tells which of its ids go on in the next level, and a directory counts the bits that are set
    before every 512th: the place of an id in the next level is a look-up and a count in one block.
    """
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >= 1 << CHUNK_BITS
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(more) // RANK_BITS) * RANK_BITS, np.uint32)
        padded[: len(more)] = more
        ranks = np.concatenate([[0], padded.reshape(-1, RANK_BITS).sum(1)]).cumsum()[:-1].astype("<u4")
        chunks = (rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        levels.append(struct.pack("<II", len(chunks), len(ranks)) + ranks.tobytes() + bits.tobytes() + chunks.tobytes())
        if not more.any():
            break
        rest = rest[more] >> CHUNK_BITS
    known = np.packbits(np.array([d is not None for d in doc_ids], bool), bitorder="little").tobytes()
    index = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + known + np.array(counts, "<u4").tobytes()
    return MAGIC + struct.pack("<IIB", len(doc_ids), len(ids), len(levels)) + index + b"".join(levels)


class Segment:
    """Reads a segment: whole, or any single id without the others."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        n_docs, self.n_tokens, n_levels = struct.unpack_from("<IIB", data, 4)
        at = 13

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        ids, known = take("<i8", n_docs), np.unpackbits(take("u1", -(-n_docs // 8)), bitorder="little")
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known, strict=False)]
        self.counts = take("<u4", n_docs)
        self.levels = []
        for _ in range(n_levels):
            n, n_ranks = (int(x) for x in take("<u4", 2))
            self.levels.append((take("<u4", n_ranks), take("u1", -(-n // 8)), take("u1", n)))

    def __getitem__(self, i: int) -> int:
        value, shift = 0, 0
        for ranks, bits, chunks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            before = bits[block * RANK_BITS // 8 : i >> 3]
            part = int(bits[i >> 3]) & ((1 << (i & 7)) - 1)
            i = int(ranks[block]) + int(np.bitwise_count(before).sum()) + part.bit_count()
            shift += CHUNK_BITS
        return value

    def ids(self) -> np.ndarray:
        out, places = np.zeros(self.n_tokens, "<u4"), np.arange(self.n_tokens)
        for level, (_, bits, chunks) in enumerate(self.levels):
            out[places] |= chunks.astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            places = places[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end: int = END) -> None:
    """Encode all texts of ``docs`` (doc_id, text) and write them in ascending doc_id order.

    Documents are dealt to as many ranges of doc_id as the session has shuffle partitions, equal ids
    by a hash of the text, and a task writes segments as it goes: it never holds more than one.
    Segments are binary cells of Parquet files, so that Spark commits them in any store it can
    write; each cell is a page of its own and not compressed, so its codes can be addressed as they
    lie in the file. Null ids come first; a null text counts as empty and has its end id only.
    """
    path = path or default_path()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce("text", F.lit(""))
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).repartitionByRange(n, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, last = TaskContext.get().partitionId(), 0, end.to_bytes(4, "little")
        own = encoder(path)
        doc_ids: list[int | None] = []
        found: list[bytes] = []
        held = 0

        def out() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(found), "<u4")
            row = [part, seq, len(doc_ids), len(ids), encode_segment(doc_ids, [len(f) // 4 for f in found], ids)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = [f.split()[0] for f in SEGMENTS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for low, high in slices(batch.column("text")):
                for doc_id, got in zip(ids[low:high], own.encode(batch.column("text").slice(low, high - low)), strict=True):
                    doc_ids.append(doc_id)
                    found.append(got + last)
                    held += len(got) // 4 + 1
                    if held >= SEGMENT_IDS:
                        yield out()
                        seq, held, doc_ids, found = seq + 1, 0, [], []
        if doc_ids:
            yield out()

    segments = ranged.sortWithinPartitions(*order).mapInArrow(run, SEGMENTS)
    plain = {"compression": "none", "parquet.page.size": PAGE_BYTES, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}
    segments.write.options(**plain).parquet(folder)


def earlier(window: WindowSpec) -> WindowSpec:
    """All rows before this one."""
    return window.rowsBetween(W.unboundedPreceding, -1)


def _bases(segments: DataFrame) -> DataFrame:
    """(part, seq, base) with the number of ids before each segment."""
    sums = segments.select("part", "seq", "n_tokens")
    parts = sums.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier(W.orderBy("part"))), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n_tokens").over(earlier(W.partitionBy("part").orderBy("seq"))), F.lit(0))
    return sums.withColumn("inside", inside).join(parts, "part").select("part", "seq", (F.col("base") + F.col("inside")).alias("base"))


def token_at(positions: DataFrame, folder: str) -> DataFrame:
    """(position, id) for each row of ``positions`` (position, a long counted over all documents from 0).

    A position is located by the segments' lengths, which are columns of their own; its segment is
    then addressed in place, chunk by chunk over the rank directories: no code but its own is decoded. If
    the positions meet at most ``NAMED_SEGMENTS`` segments, the scan is told which and reads the pages of
    these alone; otherwise the segments are joined. Positions that are null or outside the files give
    no row; repeated ones give a row each.
    """
    spark = positions.sparkSession
    segments = spark.read.schema(SEGMENTS).parquet(folder)
    spans = segments.select("part", "seq", "n_tokens").join(_bases(segments), ["part", "seq"])
    # segments are at least as long as a block of positions but for the last of a part: few blocks each
    block = F.sequence(F.floor(F.col("base") / SEGMENT_IDS), F.floor((F.col("base") + F.col("n_tokens") - 1) / SEGMENT_IDS))
    spans = spans.filter("n_tokens > 0").withColumn("block", F.explode(block))
    wanted = positions.select(F.col("position").cast("long").alias("position")).withColumn("block", F.floor(F.col("position") / SEGMENT_IDS))
    within = (F.col("position") >= F.col("base")) & (F.col("position") < F.col("base") + F.col("n_tokens"))
    found = wanted.join(spans, "block").filter(within)
    found = stored(found.select("part", "seq", "position", (F.col("position") - F.col("base")).alias("local")), "located")
    named = found.select("part", "seq").distinct().limit(NAMED_SEGMENTS + 1).collect()
    if len(named) <= NAMED_SEGMENTS:
        segments = segments.filter(F.col("part").isin(sorted({r.part for r in named})) & F.col("seq").isin(sorted({r.seq for r in named})))
    # distinct positions of a segment: at most as many as it has ids
    places = found.groupBy("part", "seq").agg(F.collect_set(F.struct("position", "local")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row["segment"])
                columns = [[p["position"] for p in row["at"]], [segment[p["local"]] for p in row["at"]]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["position", "id"])

    ids = places.join(segments.select("part", "seq", "segment"), ["part", "seq"]).select("segment", "at").mapInArrow(run, "position long, id long")
    return wanted.select("position").join(ids, "position")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, and its ``ids`` as bytes if asked for.

    ``start`` counts the ids of all documents before it: segments are summed up within the part that
    wrote them, and parts, of which there are as many as write tasks, among each other.
    """
    segments = spark.read.schema(SEGMENTS).parquet(folder)
    bases = _bases(segments)
    schema = "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row["segment"])
                ids, counts = segment.ids().tobytes(), segment.counts.astype(np.int64)
                starts, n = counts.cumsum() - counts, len(counts)
                cells = [ids[4 * s : 4 * (s + c)] for s, c in zip(starts, counts, strict=True)]
                columns = [
                    pa.array(np.full(n, row["part"], np.int32)),
                    pa.array(np.full(n, row["seq"], np.int32)),
                    pa.array(segment.doc_ids, pa.int64()),
                    pa.array(starts),
                    pa.array(counts),
                    pa.array([zlib.crc32(c) for c in cells], pa.int64()),
                    pa.array(cells if with_ids else [None] * n, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    found = segments.select("part", "seq", "segment").mapInArrow(run, schema).join(bases, ["part", "seq"])
    columns = ["doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"]
    return found.select(*columns, *["ids"] * with_ids)


def token_files(docs: DataFrame, path: str | None = None, folder: str | None = None) -> DataFrame:
    """``docs`` written to token files and what the files hold; see ``write_token_files``.

    Repeated rows and rows with a null doc_id are documents of their own; no rows give no rows;
    columns other than doc_id and text are ignored.
    """
    folder = folder or fresh_path(docs.sparkSession, "token-files")
    write_token_files(docs, folder, path)
    return read_token_files(docs.sparkSession, folder)
