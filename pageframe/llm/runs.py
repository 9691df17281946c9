"""Periodic runs of words, found on a grammar of each text."""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageframe.llm.rows import text_of

#: Words that a run has at least, and times its period that it is long at least.
SHORTEST, TIMES = 24, 3
#: Words that stand again one period on, around any place of a run; half of the fewest equal ones it has.
ANCHOR = (SHORTEST - SHORTEST // TIMES) // 2


def names(ids: np.ndarray, longest: int) -> list[np.ndarray]:
    """Names of all stretches of 1, 2, 4, ... up to ``longest`` words: equal names, equal stretches. No hashing."""
    levels = [np.unique(ids, return_inverse=True)[1].astype(np.int64)]
    while 2 << (len(levels) - 1) <= min(longest, len(ids)):
        last, half = levels[-1], 1 << (len(levels) - 1)
        pair = last[:-half] * np.int64(len(ids) + 1) + last[half:]
        levels.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
    return levels


def repeated_stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) outside of which no run can lie.

    Every stretch of ``ANCHOR`` words inside a run occurs a second time in it, one period before or
    behind, so a run is covered by stretches that occur at least twice in the text.
    """
    if len(ids) < SHORTEST:
        return []
    name = names(ids, ANCHOR)[-1]
    twice = np.concatenate([[False], np.bincount(name)[name] > 1, [False]])
    edges = np.flatnonzero(np.diff(twice.astype(np.int8)))
    found = zip(edges[::2].tolist(), (edges[1::2] + ANCHOR - 1).tolist(), strict=True)
    return [(a, b) for a, b in found if b - a >= SHORTEST]


def re_pair(ids: list[int]) -> tuple[dict[int, tuple[int, int]], list[int]]:
    """Rules (symbol: two symbols) and the sequence that is left when no pair of neighbours occurs twice any more.

    The most frequent pair is replaced by a new symbol again and again, of equally frequent ones that
    which was met first, so that the rules of a repeated stretch halve it. Neighbours are linked;
    where a pair occurs is kept in a list and checked when its turn comes. Each replacement shortens
    the sequence by one, and work and memory are in proportion to its length.
    """
    n = len(ids)
    symbol, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    where: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i in range(n - 1):
        where[symbol[i], symbol[i + 1]].append(i)
    queues: dict[int, deque] = defaultdict(deque)
    for pair, places in where.items():
        if len(places) > 1:
            queues[len(places)].append(pair)
    rules: dict[int, tuple[int, int]] = {}
    new, most = max(ids, default=0) + 1, max(queues, default=0)
    while most > 1:
        if not queues[most]:
            del queues[most]
            most -= 1
            continue
        pair = a, b = queues[most].popleft()
        places, free = [], -1
        for i in where[pair]:
            j = after[i]
            if symbol[i] == a and j < n and symbol[j] == b and i != free:  # of overlapping ones, every other
                places.append(i)
                free = j
        if len(places) < most:  # some are gone: its turn comes later
            where[pair] = places
            if len(places) > 1:
                queues[len(places)].append(pair)
            continue
        del where[pair]
        rules[new] = pair
        touched = {}
        for i in places:
            j = after[i]
            left, right = before[i], after[j]
            symbol[i], symbol[j], after[i] = new, -1, right
            if right < n:
                before[right] = i
                touched[new, symbol[right]] = None
                where[new, symbol[right]].append(i)
            if left >= 0:
                touched[symbol[left], new] = None
                where[symbol[left], new].append(left)
        for p in touched:
            k = len(where[p])
            if k > 1:
                queues[min(k, most)].append(p)
        new += 1
    i, rest = 0, []
    while i < n:
        rest.append(symbol[i])
        i = after[i]
    return rules, rest


class Grammar:
    """Rules for a sequence and for what Re-Pair leaves of it, which is halved into further symbols.

    ``size`` is the number of words that a symbol stands for, ``places`` where it is derived; both
    hold only symbols of ``SHORTEST`` words or more, as no shorter one can hold a run.
    """

    def __init__(self, ids: list[int]):
        self.rules, rest = re_pair(ids)
        self.size: dict[int, int] = {}
        for x, (y, z) in self.rules.items():  # parts come before the whole
            self.size[x] = self.size.get(y, 1) + self.size.get(z, 1)
        new = max(self.rules, default=max(ids, default=0)) + 1
        while len(rest) > 1:
            halved = []
            for y, z in zip(rest[::2], rest[1::2], strict=False):
                self.rules[new], self.size[new] = (y, z), self.size.get(y, 1) + self.size.get(z, 1)
                halved.append(new)
                new += 1
            rest = halved + rest[len(rest) - len(rest) % 2 :]
        self.places: dict[int, list[int]] = defaultdict(list)
        todo = [(x, 0) for x in rest]
        while todo:
            x, at = todo.pop()
            if self.size.get(x, 1) >= SHORTEST:
                self.places[x].append(at)
                y, z = self.rules[x]
                todo += [(y, at), (z, at + self.size.get(y, 1))]


def _equal(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many words are equal from ``i`` and ``j`` on, at most ``most``; in front of them for ``step`` -1."""
    done = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        span, last = 1 << k, len(levels[k]) - 1
        while True:
            a, b = (i + done, j + done) if step > 0 else (i - done - span, j - done - span)
            same = (done + span <= most) & (levels[k][np.clip(a, 0, last)] == levels[k][np.clip(b, 0, last)])
            if not same.any():
                break
            done += span * same
    return done


def crossing(levels: list[np.ndarray], grammar: Grammar) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, end, period) of each symbol that cross the boundary of its rule, each symbol looked at once.

    A run that crosses a boundary has its period to one side of it, and ``ANCHOR`` equal words one
    period apart that begin or end at the boundary, or a period before it. So the places where the
    words on either side of the boundary occur again tell the periods to try; how far one holds is
    read from the names of stretches.
    """
    anchors = levels[ANCHOR.bit_length() - 1]
    owner, base, low, high, period = ([] for _ in range(5))
    for x, places in grammar.places.items():
        start, size = places[0], grammar.size[x]
        mid, end, most = start + grammar.size.get(grammar.rules[x][0], 1), start + size, size // TIMES
        tried = set()
        for at in (mid, mid - ANCHOR):
            if at < start or at + ANCHOR > end:
                continue
            first = max(start, at - most)
            again = np.flatnonzero(anchors[first : min(at + most, end - ANCHOR) + 1] == anchors[at]) + (first - at)
            tried.update(np.abs(again[again != 0]).tolist())
        for q in tried:
            for at in (mid, mid - q):
                if at >= start and at + q <= end:
                    owner.append(x)
                    base.append(at)
                    low.append(start)
                    high.append(end)
                    period.append(q)
    if not owner:
        return {}
    base, low, high, period = (np.array(v, np.int64) for v in (base, low, high, period))
    right = _equal(levels, base, base + period, high - base - period, 1)
    left = _equal(levels, base, base + period, base - low, -1)
    start, end = base - left, base + period + right
    long = end - start >= np.maximum(SHORTEST, TIMES * period)
    least: dict[tuple[int, int, int], int] = {}
    for k in np.flatnonzero(long).tolist():  # a multiple of a period holds over the same words
        run = owner[k], int(start[k] - low[k]), int(end[k] - low[k])
        least[run] = min(int(period[k]), least.get(run, int(period[k])))
    out: dict[int, list] = defaultdict(list)
    for (x, s, e), q in least.items():
        out[x].append((s, e, q))
    return out


def merged(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) whose parts are joined where they share a period's words; the least period of each, by start."""
    whole: list[tuple[int, int, int]] = []
    for q, start, end in sorted({(q, s, e) for s, e, q in found}):
        if whole and whole[-1][2] == q and start + q <= whole[-1][1]:
            whole[-1] = (whole[-1][0], max(end, whole[-1][1]), q)
        else:
            whole.append((start, end, q))
    least: dict[tuple[int, int], int] = {}
    for start, end, q in whole:
        least[start, end] = min(q, least.get((start, end), q))
    return sorted((s, e, q) for (s, e), q in least.items())


def periodic_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of a sequence, by start and then period.

    A run is a stretch with least period q, of ``SHORTEST`` words and ``TIMES`` periods at least,
    that neither neighbour extends. Re-Pair is run on each stretch that may hold one; the runs at
    the boundary of each symbol are found once and laid to all places where the symbol is derived.
    """
    found: list[tuple[int, int, int]] = []
    for low, high in repeated_stretches(ids):
        part = ids[low:high]
        levels = names(part, len(part) // 2)
        grammar = Grammar(levels[0].tolist())
        own: list[tuple[int, int, int]] = []
        for x, runs in crossing(levels, grammar).items():
            own += [(at + s, at + e, q) for at in grammar.places[x] for s, e, q in runs]
        found += [(low + s, low + e, q) for s, e, q in merged(own)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length over period; of equal ones the first, then that of the least period."""
    return min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, without those behind the first period of a run."""
    if not runs:
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, [s + q for s, _, q in runs], 1)
    np.add.at(cover, [e for _, e, _ in runs], -1)
    keep = cover.cumsum()[:-1] == 0
    return b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """``words``, of one in ten documents with the repeats that its id asks for; a document without an id has none."""
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def runs_of(docs: DataFrame, plant: bool = False) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs, collapsed) of every document (doc_id, text).

    The four figures are of ``best_run``, null without runs. ``runs`` is an array of (start, length,
    period), ``collapsed`` the text with all but the first period of each run dropped and its words
    joined by single blanks. ``plant`` puts repeats into one in ten documents first, see ``planted``.
    Null and empty texts have no words and no runs; texts are taken whole, each in the task that
    reads it, with some hundred bytes of memory for a repeated word; rows with equal or null doc_id
    are taken each; no rows give no rows; other columns are ignored.
    """
    schema = (
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
        " runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    run_kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    columns = [f.split()[0] for f in schema.split(", ")[:6]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows, runs, texts = [], [], []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    words = text.as_py().split()
                    words = planted(words, doc_id) if plant else words
                    ids: dict[bytes, int] = {}
                    found = periodic_runs(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words)))
                    best = best_run(found)
                    figures = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
                    rows.append((doc_id, len(found), *figures))
                    runs.append([{"start": s, "length": e - s, "period": q} for s, e, q in found])
                    texts.append(collapsed(words, found))
                out = [pa.array([r[i] for r in rows], pa.int64()) for i in range(6)]
                out += [pa.array(runs, run_kind), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(out, names=[*columns, "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, schema)


def run_digests(docs: DataFrame, plant: bool = True) -> DataFrame:
    """``runs_of`` with the runs and the collapsed text as SHA-256 digests."""
    found = runs_of(docs, plant)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digests = [F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")]
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", *digests)
