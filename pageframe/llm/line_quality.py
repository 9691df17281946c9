"""Quality rules over documents and over the lines that documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageframe.functions.lineage import stored
from pageframe.functions.skew import broadcast_if_small
from pageframe.llm.rows import packed, row_key, text_of

WINDOW, FEWEST_WORDS, MOST_REPEATED = 8, 20, 30
#: Documents of a host, copies counted once, that may share a line: this share of them in per cent, but
#: never fewer than the floor nor more than the limit.
LINE_SHARE, LINE_FLOOR, LINE_LIMIT = 10, 5, 200
#: Share of its words that a document must keep when lines above the limit are removed, in per cent.
LEAST_KEPT = 30
SYMBOLS = b"#*$%&|<>"
_FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, copy long"
_LINES = "lines array<struct<line: long, words: int>>"


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    if len(words) <= width:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    n = len(words) - width + 1
    rank = codes
    span = 1
    while span < width:  # rank of each run of 2, 4, 8 words: exact, by pairs of ranks
        step = min(span, width - span)
        pair = rank[: len(rank) - step] * np.int64(len(words) + 1) + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1]
        span += step
    many = np.bincount(rank)[rank] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(many[:n])
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + width, -1)
    return int((cover.cumsum()[:-1] > 0).sum())


def _line(words: list[bytes]) -> int:
    """What lines are compared by: blanks joined, A-Z lower-cased."""
    return xxhash.xxh64_intdigest(b" ".join(words).lower()) - (1 << 63)


def without(text: bytes, lines: set[int]) -> bytes:
    """A text without the lines of these hashes; lines that have no word stay."""
    return b"\n".join(x for x in text.split(b"\n") if not (own := x.split()) or _line(own) not in lines)


def measure(text: bytes) -> tuple[tuple[int, ...], list[tuple[int, int]]]:
    """The base figures and the hash of a text, and (hash, words) of each line that has a word."""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[bytes] = set()
    repeats, lines = 0, []
    for line in text.split(b"\n"):
        own = line.split()
        if own:
            repeats += line in seen
            seen.add(line)
            lines.append((_line(own), len(own)))
    copy = xxhash.xxh64_intdigest(text) - (1 << 63)
    return (len(words), chars, symbols, repeats, repeated_words(words), copy), lines


def measured(docs: DataFrame, carry: list[Column], with_lines: bool = True) -> DataFrame:
    """The columns of ``carry`` with the figures of ``measure``."""
    narrow = docs.select(*carry, text_of().alias("_text"))
    names = [f.split()[0] for f in _FEATURES.split(", ")]
    kind = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 512):
                batch = whole.slice(low, 512)
                at = batch.schema.get_field_index("_text")
                got = [measure(t.as_py()) for t in batch.column(at)]
                columns = [c for i, c in enumerate(batch.columns) if i != at]
                kept = [f.name for i, f in enumerate(batch.schema) if i != at]
                figures = [pa.array([g[0][i] for g in got], pa.int64()) for i in range(len(names))]
                lines = pa.array([[{"line": h, "words": n} for h, n in g[1]] for g in got], kind)
                yield pa.RecordBatch.from_arrays([*columns, *figures, lines], names=[*kept, *names, "lines"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.drop("_text").schema)
    out = narrow.mapInArrow(run, f"{schema}, {_FEATURES}, {_LINES}")
    return out if with_lines else out.drop("lines")


def common_lines(lines: DataFrame, hosts: DataFrame, limit: int = LINE_LIMIT) -> DataFrame:
    """(host, line) of the lines that too many distinct documents of a host have.

    Too many are more than ``LINE_SHARE`` per cent of its distinct documents, ``docs`` of ``hosts``
    (host, docs), and more than ``LINE_FLOOR``; or more than ``limit`` on a host of any size.

    Documents count as one if their whole texts are equal (``copy``, a hash of the text): copies of
    a text don't make its own lines common, any other two documents count as two, near copies as
    well. Repeats within a document count once. The distinct texts of a line are counted in two
    combining steps, so a line of any frequency is spread out.
    """
    distinct = lines.groupBy("host", "line", "copy").count()
    counts = distinct.groupBy("host", "line").count().filter(F.col("count") > min(LINE_FLOOR, limit))
    hosts, _ = broadcast_if_small(hosts)
    most = F.least(F.lit(limit), F.greatest(F.lit(LINE_FLOOR), F.col("docs") * LINE_SHARE / 100))
    return counts.join(hosts, "host").filter(F.col("count") > most).select("host", "line")


def kept_documents(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that ``verdicts`` keeps, ``text`` without its common lines, all other columns as they are."""
    judged = _judged(docs, **kw).filter("not kept or common is not null")
    changed, _ = broadcast_if_small(judged.select("key", "kept", "common").dropDuplicates(["key"]))
    whole = docs.select(packed(docs), _key().alias("key"))
    whole = whole.join(changed, "key", "left").filter(F.coalesce("kept", F.lit(True)))

    @F.arrow_udf("string")
    def cleaned(text: pa.Array, common: pa.Array) -> pa.Array:
        pairs = zip(text, common, strict=True)
        return pa.array([without(t.as_py().encode(), set(c.as_py())).decode() if t.is_valid else None for t, c in pairs], pa.string())

    # other texts don't travel to Python
    own = F.when(F.col("common").isNotNull(), F.col("row.text"))
    whole = whole.withColumn("_clean", cleaned(own, F.col("common")))
    text = F.when(F.col("common").isNotNull(), F.col("_clean")).otherwise(F.col("row.text")).alias("text")
    return whole.select(*[text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def _key() -> Column:
    return row_key(F.col("doc_id"), F.concat_ws("\0", "source", "text"))


def verdicts(docs: DataFrame, **kw) -> DataFrame:
    """(key, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words, base_failed, kept).

    A document fails the base rules with under 20 words or over 30 % of them in repeated windows of
    8. Of the others, lines that are common on their host (``source``; null is a host of its own) are
    removed; a document that is left with under ``least`` % of its words is depleted and not kept. Lines are compared with blanks joined and A-Z lower-cased.

    Null and empty texts have no words and fail. Rows with a null doc_id count as documents;
    repeated rows give a row each with the same verdict; no rows give none; other columns are ignored.
    """
    return _judged(docs, **kw).drop("common")


def _judged(docs: DataFrame, limit: int = LINE_LIMIT, least: int = LEAST_KEPT) -> DataFrame:
    """``verdicts`` with ``common``, the lines that are removed from the document; null if there are none."""
    table = stored(measured(docs, [_key().alias("key"), F.col("doc_id"), F.col("source").alias("host")]), "measured")
    host = F.coalesce(F.concat(F.lit("="), F.col("host")), F.lit("-")).alias("host")
    lines = table.select("key", host, "copy", F.explode("lines").alias("l")).select("key", "host", "copy", "l.line", "l.words")
    hosts = table.select(host, "copy").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    common, _ = broadcast_if_small(common_lines(lines, hosts, limit))
    removed = lines.join(common, ["host", "line"]).groupBy("key").agg(F.sum("words").alias("w"), F.collect_set("line").alias("common"))
    copies = table.groupBy("key").agg(F.count("*").alias("copies"))
    removed = removed.join(copies, "key").select("key", (F.col("w") / F.col("copies")).cast("long").alias("removed_words"), "common")
    rows = table.drop("lines", "host", "copy").join(removed, "key", "left").fillna(0, ["removed_words"])
    left = F.col("n_words") - F.col("removed_words")
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    kept = ~failed & (100 * left >= least * F.col("n_words"))
    return rows.withColumns({"base_failed": failed, "kept": kept})
