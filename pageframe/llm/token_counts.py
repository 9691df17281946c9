"""Token counts of whole texts; huge ones are encoded in overlapping chunks that are spliced where they agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageframe.functions.lineage import counted, stored
from pageframe.llm.tokens import Encoder, default_path, encoder, slices

#: Characters of a chunk and of the overlap with the chunk before; a longer text is a huge one.
CHUNK, OVERLAP = 32_768, 256
#: What chunk and overlap are multiplied by for the texts in which two chunks found no common boundary.
WIDER = 8
LIMIT = 512
_SEAMS = "array<struct<at: long, before: long>>"
_CHUNK = "key long, i long, last boolean, low long, overlap long, chunk string"
_FOUND = f"key long, i long, last boolean, n long, head {_SEAMS}, tail {_SEAMS}"
_SEAM = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))


def provable(own: Encoder) -> bool:
    """Whether a common boundary proves that two chunks are encoded alike from there on.

    Byte-level BPE joins inside the words of its pre-tokenizer only, and that reads from left to
    right: behind the end of a word, what it does depends on the text behind it alone. For files of
    another kind nothing of that sort is known, and texts are encoded whole.
    """
    return own.by_word


def unsure(own: Encoder) -> int:
    """Characters at the end of a chunk in which a word's end may still move when more text follows.

    The pre-tokenizer looks at two characters behind a word at most, or at the white space behind
    it; a special token that starts in the chunk may end behind it, and what stands in front of
    one is split as at the end of a text.
    """
    return max((len(s) for s in own.special), default=0) + 4


def boundaries(own: Encoder, text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """The tokens of a text by the library; where its words begin, in characters, and the tokens before each."""
    got = own.tokenizer.encode(text, add_special_tokens=False)
    words = np.array([-1 if w is None else w for w in got.word_ids], np.int64)
    first = np.flatnonzero(np.diff(words, prepend=-2) != 0)
    offsets = got.offsets
    return len(got), np.array([offsets[t][0] for t in first], np.int64), first


def chunked(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, i, last, low, overlap, chunk) of ``texts`` (key, text): parts of ``chunk`` characters, each with ``overlap`` more in front."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _CHUNK.split(", ")]
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                n = -(-len(text) // chunk)
                for low in range(0, n, 64):
                    at = range(low, min(n, low + 64))
                    starts = [max(0, i * chunk - overlap) for i in at]
                    parts = [text[s : (i + 1) * chunk] for s, i in zip(starts, at, strict=True)]
                    columns = [[key] * len(at), list(at), [i == n - 1 for i in at], starts, [overlap] * len(at), parts]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return texts.select("key", "text").mapInArrow(run, _CHUNK)


def encoded(chunks: DataFrame, path: str) -> DataFrame:
    """(key, i, last, n, head, tail) of ``chunks``: tokens, and the sure word beginnings in both overlaps with the tokens before each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(c) for c in ("key", "i", "last", "low", "overlap", "chunk")), strict=True):
                key, i, last, low, overlap, text = (v.as_py() for v in row)
                n, at, before = boundaries(own, text)
                end = low + len(text)
                at = at + low
                # the next chunk starts ``overlap`` before the end of this one
                tail = (at >= end - overlap) & (at <= end - unsure(own)) if not last else np.zeros(len(at), bool)
                head = at <= low + overlap if i else np.zeros(len(at), bool)
                seams = [[{"at": a, "before": b} for a, b in zip(at[m].tolist(), before[m].tolist(), strict=True)] for m in (head, tail)]
                out.append((key, i, last, n, *seams))
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), _SEAM, _SEAM]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "i", "last", "n", "head", "tail"])

    return chunks.repartition("key", "i").mapInArrow(run, _FOUND)


def spliced(found: DataFrame) -> DataFrame:
    """(key, n_tokens, seams, failed) of encoded chunks: each pair of neighbours is cut at the last boundary that both have.

    A chunk is right from its first common boundary on, as the one before is right up to there; so
    its tokens between its two common boundaries are those of the whole text. ``failed`` counts
    the pairs without a common boundary.
    """
    before = found.filter("not last").select("key", (F.col("i") + 1).alias("i"), "tail")
    after = found.filter("i > 0").select("key", "i", "head")

    def places(seams: str) -> F.Column:
        return F.transform(seams, lambda s: s["at"])

    def tokens(seams: str) -> F.Column:
        return F.get(F.filter(seams, lambda s: s["at"] == F.col("cut")), F.lit(0))["before"]

    seams = before.join(after, ["key", "i"]).withColumn("cut", F.array_max(F.array_intersect(places("tail"), places("head"))))
    seams = seams.select("key", (tokens("tail") - tokens("head")).alias("n"), F.lit(1).alias("seam"), F.col("cut").isNull().cast("int").alias("fail"))
    ends = found.filter("last").select("key", "n", F.lit(0).alias("seam"), F.lit(0).alias("fail"))
    parts = ends.unionByName(seams).groupBy("key")
    return parts.agg(F.sum("n").alias("n_tokens"), F.sum("seam").alias("seams"), F.sum("fail").alias("failed"))


def huge_counts(texts: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, n_tokens, seams) of ``texts`` (key, text), a written frame.

    Chunks are dealt to tasks by text and number, so a text of any length is worked on by many. Where
    two chunks have no common boundary, as inside a word longer than the overlap, the text is
    cut again with a wider overlap and longer chunks, until all agree or it is a single chunk; both
    end in proportion to its longest word.
    """
    overlap = max(overlap, 4 * unsure(encoder(path)))
    chunk, done, todo = max(chunk, 4 * overlap), None, texts
    while True:
        got, n = counted(spliced(stored(encoded(chunked(todo, chunk, overlap), path), "chunks")), failed="failed > 0")
        fine = got.filter("failed = 0").select("key", "n_tokens", "seams")
        done = fine if done is None else done.unionByName(fine)
        if not n["failed"]:
            return done
        todo = texts.join(got.filter("failed > 0").select("key"), "key", "left_semi")
        chunk, overlap = WIDER * chunk, WIDER * overlap


def count_tokens(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, n_seams) of every document.

    ``path`` is a file of the ``tokenizers`` library, or of ``sentencepiece`` if it ends in
    ``.model``. Texts of up to ``chunk`` characters, and all texts where a splice could not be
    proven (``provable``), are encoded whole in the task that reads them; ``n_seams`` is 0 for them.
    A null text counts as empty and has no tokens; rows with equal or null doc_id are counted each;
    no rows give no rows; other columns are ignored.
    """
    path = path or default_path()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    schema = "doc_id long, n_bytes long, n_tokens long, n_seams long"
    pieces = path.endswith(".model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _sentencepiece(path) if pieces else encoder(path).count_array
        for batch in batches:
            texts = batch.column("text")
            got = [count(texts.slice(low, high - low)) for low, high in slices(texts)]
            n = np.concatenate([np.zeros(0, np.int64), *got])
            columns = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64()), pa.array(np.zeros_like(n))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "n_seams"])

    over = (F.col("n_tokens") > limit).alias("over_limit")
    columns = ["doc_id", "n_bytes", "n_tokens", over, "n_seams"]
    if pieces or not provable(encoder(path)):
        return rows.mapInArrow(run, schema).select(*columns)
    huge = F.length("text") > chunk
    short = rows.filter(~huge).select("doc_id", "n_bytes", "text").mapInArrow(run, schema)
    long = stored(rows.filter(huge).withColumn("key", F.monotonically_increasing_id()), "huge")
    counts = huge_counts(long.select("key", "text"), path, chunk, overlap)
    long = long.select("key", "doc_id", "n_bytes").join(counts.withColumnRenamed("seams", "n_seams"), "key")
    return short.unionByName(long.drop("key")).select(*columns)


def _sentencepiece(path: str):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: np.array([len(own.encode(t)) for t in texts.to_pylist()], np.int64)
