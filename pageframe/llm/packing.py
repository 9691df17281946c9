"""Packing token ids into sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageframe.llm.tokens import default_path, encoder, slices

CAPACITY = 2048
END = 1
#: Remainders that are packed together; a task holds no more than these and one batch of rows.
WINDOW = 1024
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def least_slack(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many items of each length fill ``room`` with the least slack.

    Subset sums are a bitset: bit s is set if some choice adds up to s. The counts of a length join
    in powers of two, each step keeps the bitset before it, and walking the steps backwards from
    the highest sum gives the choice. It stops at the first step that fills the room exactly.
    """
    sums, full, steps = 1, (2 << room) - 1, []
    for length in sorted(counts, reverse=True):
        left, times = min(counts[length], room // length), 1
        while left:
            take = min(times, left)
            steps.append((length, take, sums))
            sums |= (sums << length * take) & full
            left, times = left - take, 2 * times
        if sums >> room:
            break
    best, chosen = sums.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            chosen[length] = chosen.get(length, 0) + take
            best -= length * take
    return chosen


class Packer:
    """Gathers the remainders of documents and lays windows of them into sequences.

    An item is (doc_id, start, ids, doc_tokens). The longest remainder opens a sequence and the
    choice of least slack fills it; the same choice is used again while the counts allow. If no
    choice is exact, the next remainder is cut so that the sequence is full. What is left in the
    end goes into sequences of a power of two.
    """

    def __init__(self, first_id: int, capacity: int = CAPACITY, window: int = WINDOW):
        self.next_id, self.capacity, self.window = first_id, capacity, window
        self.items: dict[int, list[tuple]] = defaultdict(list)
        self.held = 0
        self.pieces: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n, size = len(ids) // 4, self.capacity
        for start in range(0, n - size + 1, size):
            self._lay([(doc_id, start, ids[4 * start : 4 * (start + size)], n)])
        if n % size:
            self._keep((doc_id, n - n % size, ids[4 * (n - n % size) :], n))
        if self.held >= self.window:
            self._pack()

    def end(self) -> None:
        self._pack()
        rest = [i for length in sorted(self.items, reverse=True) for i in self.items[length]]
        self.items.clear()
        while rest:
            room = 1 << (sum(len(i[2]) // 4 for i in rest).bit_length() - 1)
            row = []
            while room:
                item = rest.pop(0)
                head, tail = _cut(item, room)
                row.append(head)
                room -= len(head[2]) // 4
                if tail:
                    rest.insert(0, tail)
            self._lay(row)

    def _keep(self, item: tuple) -> None:
        self.items[len(item[2]) // 4].append(item)
        self.held += 1

    def _take(self, length: int) -> tuple:
        item = self.items[length].pop()
        if not self.items[length]:
            del self.items[length]
        self.held -= 1
        return item

    def _pack(self) -> None:
        total = sum(length * len(items) for length, items in self.items.items())
        while total >= self.capacity:
            counts = {length: len(items) for length, items in self.items.items()}
            first = max(counts)
            counts[first] -= 1
            chosen = least_slack({k: n for k, n in counts.items() if n and k <= self.capacity - first}, self.capacity - first)
            chosen[first] = chosen.get(first, 0) + 1
            slack = self.capacity - sum(k * n for k, n in chosen.items())
            times = 1 if slack else min(len(self.items[k]) // n for k, n in chosen.items())
            for _ in range(times):
                row = [self._take(k) for k, n in chosen.items() for _ in range(n)]
                if slack:  # every other remainder is longer than the slack
                    head, tail = _cut(self._take(min(self.items)), slack)
                    row.append(head)
                    if tail:
                        self._keep(tail)
                self._lay(row)
                total -= self.capacity

    def _lay(self, row: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, n in row:
            self.pieces.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), n, self.next_id, offset, ids))
            offset += len(ids) // 4
        self.next_id += 1


def _cut(item: tuple, length: int) -> tuple[tuple, tuple | None]:
    doc_id, start, ids, n = item
    rest = (doc_id, start + length, ids[4 * length :], n) if len(ids) > 4 * length else None
    return (doc_id, start, ids[: 4 * length], n), rest


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The pieces of all documents (doc_id, text), each with its ids as little-endian 32-bit bytes.

    Every text is encoded whole, ``end`` is appended, and each id lies in exactly one piece. Whole
    sequences are cut from a document as it comes; remainders are packed within the task that read
    them, a window at a time, so nothing is shuffled and memory is bounded by a window and the
    longest text. No sequence needs padding: all are full but the last few of a task, which are
    powers of two. Sequence ids are unique; a task that runs again on the same rows gives the same
    ones. A null text counts as empty and still has its end id; rows with equal or null doc_id are
    packed each; no rows give no pieces; other columns are ignored.
    """
    path = path or default_path()
    schema = [f.split()[0] for f in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 40, capacity)
        own, last = encoder(path), end.to_bytes(4, "little")

        def out() -> pa.RecordBatch:
            rows, packer.pieces = packer.pieces, []
            kinds = [pa.binary() if c == "ids" else pa.int64() for c in schema]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=schema)

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text")
            for low, high in slices(texts):
                for doc_id, ids in zip(doc_ids[low:high], own.encode(texts.slice(low, high - low)), strict=True):
                    packer.add(doc_id, ids + last)
                if len(packer.pieces) > 512:
                    yield out()
        packer.end()
        yield out()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, PIECES)
