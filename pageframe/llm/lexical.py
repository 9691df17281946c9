"""Ranked lexical search: term-at-a-time over blocks of an inverted index, with a limited set of accumulators."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pageframe.functions.lineage import stored
from pageframe.functions.skew import broadcast_if_small
from pageframe.llm.rows import text_of

#: Items come back with this many documents.
TOP = 20
#: Documents of an index block; bytes of text after which one is closed earlier.
BLOCK_DOCS, BLOCK_BYTES = 4096, 16 << 20
#: Terms of the items that one pass over the index answers; an item is never split.
PASS_TERMS = 1 << 18
#: Bytes that end a term, A-Z lower-cased: all of ASCII but digits and letters.
_TABLE = bytes(c | 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_BLOCK = "part int, seq int, ids array<long>, sizes array<long>, terms array<binary>, ends array<int>, docs array<int>, tfs array<long>"
_HIT = "item int, doc_id long, score long"


def terms_of(text: bytes) -> Counter[bytes]:
    """The terms of a UTF-8 text and how often each occurs."""
    return Counter(text.translate(_TABLE).split())


def item_terms(items: DataFrame) -> DataFrame:
    """(key, item_id, term, times) of ``items`` (item_id, text); each row is an item of its own, named by ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, texts = (batch.column(c).to_pylist() for c in ("key", "item_id", "text"))
            rows = [(k, i, t, n) for k, i, text in zip(keys, ids, texts, strict=True) for t, n in terms_of(text).items()]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "item_id", "term", "times"])

    rows = items.select(F.monotonically_increasing_id().alias("key"), F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    return stored(rows.mapInArrow(run, "key long, item_id long, term binary, times long"), "item-terms")


def indexed(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """An inverted index of ``docs`` (doc_id, text) in blocks, over the terms of ``vocabulary`` (term).

    A block has the ids and sizes (terms with repeats) of its documents, its terms, and for each term
    the documents that hold it, by their place in the block, with its occurrences; ``ends`` says
    where a term's list ends. Tasks write blocks as they read, so nothing is shuffled. The
    vocabulary travels to the tasks if it was counted and found small; else all terms are kept.
    """
    vocabulary, small = broadcast_if_small(vocabulary.select("term"))
    wanted = frozenset(bytes(r["term"]) for r in vocabulary.collect()) if small else None
    names = [f.split()[0] for f in _BLOCK.split(", ")]
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    kinds = [pa.int32(), pa.int32(), longs, longs, pa.list_(pa.binary()), ints, ints, longs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        sizes: list[int] = []
        lists: dict[bytes, tuple[list[int], list[int]]] = {}

        def out() -> pa.RecordBatch:
            terms = sorted(lists)
            ends = np.array([len(lists[t][0]) for t in terms], np.int32).cumsum()
            postings = ([x for t in terms for x in lists[t][side]] for side in (0, 1))
            row = [part, seq, ids, sizes, terms, ends, *postings]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = terms_of(data := text.as_py())
                at = len(ids)
                for term in found if wanted is None else wanted.intersection(found):
                    got = lists.get(term)
                    if got is None:
                        got = lists[term] = ([], [])
                    got[0].append(at)
                    got[1].append(found[term])
                ids.append(doc_id)
                sizes.append(found.total())
                held += len(data)
                if len(ids) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                    yield out()
                    seq, held = seq + 1, 0
                    ids, sizes, lists = [], [], {}
        if ids:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return stored(rows.mapInArrow(run, _BLOCK), "index")


def weighed(index: DataFrame, items: DataFrame) -> tuple[DataFrame, int, int]:
    """``items`` (key, item_id, term, times) with df and weight of each term; documents that have terms; all their terms.

    A term that no document holds is left out: it adds nothing to any score.
    """
    total = index.select(F.explode("sizes").alias("n")).agg(F.sum((F.col("n") > 0).cast("long")).alias("docs"), F.sum("n").alias("terms")).first()
    n = total["docs"] or 0
    lists = F.arrays_zip("terms", "ends", F.concat(F.array(F.lit(0)), F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0)))).alias("starts"))
    each = index.select(F.explode(lists).alias("l")).select(F.col("l.terms").alias("term"), (F.col("l.ends") - F.col("l.starts")).cast("long").alias("df"))
    df, _ = broadcast_if_small(each.join(broadcast_if_small(items.select("term").distinct())[0], "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(F.lit(1000.0) * F.ln(F.lit(2.0 * n + 2) / (F.col("df") * 2.0 + 1))).cast("long")
    return items.join(df, "term").withColumn("weight", weight), n, total["terms"] or 0


class Search:
    """Items laid out for a pass: for each its terms from the rarest on, with times * weight."""

    def __init__(self, rows: list, n_docs: int, n_terms: int, top: int = TOP):
        self.n_docs, self.n_terms, self.top = n_docs, n_terms, top
        self.terms: dict[bytes, int] = {}
        order = sorted(rows, key=lambda r: (r["item"], r["df"], bytes(r["term"])))
        self.items: list[list[tuple[int, int]]] = [[] for _ in range(1 + max((r["item"] for r in rows), default=-1))]
        for r in order:
            term = self.terms.setdefault(bytes(r["term"]), len(self.terms))
            if r["weight"] > 0:
                self.items[r["item"]].append((term, r["times"] * r["weight"]))

    def block(self, row: dict, best: list[np.ndarray]) -> None:
        """The best documents of each item, (score, null id, doc_id) as columns, brought up to date with a block of the index.

        Accumulators are made for the documents of the rarest terms first. Once what all further terms
        can add to a document without an accumulator is below the score of the ``top``-th one, a
        partial score here or a final one of earlier blocks, no more are made: such a document
        cannot even tie. The documents that have one get all their terms, so scores are exact.
        """
        sizes = row["sizes"]
        m = 75 + (25 * sizes * self.n_docs) // max(1, self.n_terms)
        lists: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        starts = np.concatenate([[0], row["ends"]])[:-1]
        for term, low, high in zip(row["terms"], starts.tolist(), row["ends"].tolist(), strict=True):
            if (number := self.terms.get(term)) is not None:
                docs, tf = row["docs"][low:high], row["tfs"][low:high]
                impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[docs])
                lists[number] = docs, impact, int(impact.max())
        score, held = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), bool)
        for item, terms in enumerate(self.items):
            own = [(*lists[t], w) for t, w in terms if t in lists]
            if not own:
                continue
            rest = sum(most * w for _, _, most, w in own)
            score[:], held[:] = 0, False
            final = int(best[item][0, -1]) if best[item].shape[1] >= self.top else 0
            opening, n_held, highest = True, 0, 0
            for docs, impact, most, w in own:
                if opening and rest <= max(final, highest):
                    kth = final
                    if n_held >= self.top <= len(score):
                        kth = max(kth, int(np.partition(score, len(score) - self.top)[len(score) - self.top]))
                    opening = rest >= kth
                if opening:
                    score[docs] += impact * w
                    held[docs] = True
                    n_held, highest = n_held + len(docs), highest + most * w
                elif not n_held:
                    break
                else:
                    live = held[docs]
                    score[docs[live]] += impact[live] * w
                rest -= most * w
            if not n_held:
                continue
            at = np.flatnonzero(score)
            if len(at) > self.top:  # equal scores stay until they are ordered by id
                at = at[score[at] >= np.partition(score[at], len(at) - self.top)[len(at) - self.top]]
            new = np.stack([score[at], row["known"][at], row["ids"][at]])
            both = np.concatenate([best[item], new], axis=1)
            best[item] = both[:, np.lexsort((both[2], both[1], -both[0]))[: self.top]]


def _best_of(index: DataFrame, search: Search) -> DataFrame:
    """(item, doc_id, score): for each item the best documents of each task's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros((3, 0), np.int64) for _ in search.items]
        for batch in batches:
            for i in range(batch.num_rows):
                arrays = {c: batch.column(c)[i].values for c in ("ids", "sizes", "ends", "docs", "tfs")}
                row = {c: a.fill_null(0).to_numpy(zero_copy_only=False) for c, a in arrays.items()}
                row["known"] = arrays["ids"].is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
                search.block(row | {"terms": batch.column("terms")[i].as_py()}, best)
        counts = np.array([b.shape[1] for b in best], np.int64)
        found = np.concatenate(best, axis=1) if best else np.zeros((3, 0), np.int64)
        columns = [
            pa.array(np.repeat(np.arange(len(best)), counts), pa.int32()),
            pa.array(found[2], pa.int64(), mask=found[1] == 0),
            pa.array(found[0], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return index.drop("part", "seq").mapInArrow(run, _HIT)


def _passes(items: DataFrame, most: int) -> DataFrame:
    """``items`` with ``pass``, numbers from 0 in order of key: items of about ``most`` terms share one."""
    sizes = items.groupBy("key").agg(F.count("*").alias("n"))
    # sums in blocks of keys first, so that no task sees all items
    block = F.expr("key div 4096").alias("block")
    blocks = sizes.groupBy(block).agg(F.sum("n").alias("b"))
    earlier = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("base"))
    inside = W.partitionBy("block").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    placed = sizes.withColumn("block", block).join(blocks, "block")
    before = F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    numbered = placed.select("key", before.alias("before")).withColumn("pass", F.floor(F.col("before") / most))
    return items.join(numbered.select("key", "pass"), "key")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, pass_terms: int = PASS_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the ``top`` documents with the highest scores above 0, equal ones by doc_id.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.
    A document's score is the sum over the item's terms, repeats included, of an integer weight
    times a saturated frequency (``Search.block``). The index is built once, in blocks; items are
    answered in passes of about ``pass_terms`` terms, the only thing that is sent to all tasks, and
    a task keeps ``top`` documents of each item for all its blocks. Their union is cut to the best
    in two steps, so no task sees what all tasks found for an item.

    Null and empty texts have no terms and are never found; an item without terms that occur gives no
    rows; repeated documents and items count each, a null doc_id comes before others of its score;
    empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    asked = item_terms(items)
    index = indexed(docs, asked.select("term").distinct())
    weights, n_docs, n_terms = weighed(index, asked)
    weights = stored(_passes(weights, pass_terms), "weights")
    found = None
    for (number,) in weights.select("pass").distinct().orderBy("pass").toLocalIterator():
        own = weights.filter(F.col("pass") == number)
        rows = own.withColumn("item", F.dense_rank().over(W.orderBy("key")) - 1)
        rows = rows.select("item", "key", "item_id", "term", "times", "df", "weight").collect()
        of = {r["item"]: (r["key"], r["item_id"]) for r in rows}
        hits = _best_of(index, Search(rows, n_docs, n_terms, top))
        names = spark.createDataFrame([(i, k, d) for i, (k, d) in of.items()], "item int, key long, item_id long")
        got = hits.join(F.broadcast(names), "item").select("key", "item_id", "doc_id", "score")
        found = got if found is None else found.unionByName(got)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    spread = F.pmod(F.xxhash64("doc_id", "score"), F.lit(64))
    for keys in (["key", "spread"], ["key"]):
        ranked = found.withColumn("spread", spread).withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        found = ranked.filter(F.col("rank") <= top)
    return found.select("item_id", "rank", "doc_id", "score")
