"""WARC archives: writing records, and reading back only those that a chain of lengths reaches."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pageframe.functions.lineage import fresh_path, remove, stored
from pageframe.functions.skew import broadcast_if_small

MAGIC = "WARC/1.1\r\n"
#: Payloads from this size on are stored once; later ones of the same content refer to the first.
LEAST_SHARED = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CANDIDATES = (
    "file string, block long, rel long, succ long, leave long, record_type string, page_id long, refers_to long, "
    "payload_bytes long, payload_digest string, whole boolean, skip long"
)


def _named(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_archives(pages: DataFrame, folder: str) -> None:
    """A record per row of ``pages`` (page_id, url, html), in as many archives as ``pages`` has partitions.

    Of the rows with equal payloads of at least ``LEAST_SHARED`` bytes, those with the smallest
    page_id are responses (all of them, should that id repeat; a null id only if no row has one) and
    the others are revisits, which name it and have no payload of their own. Records are text that
    Spark writes and commits, each closed by two line ends. Digests and ids alone are shuffled;
    the payloads stay where they are read unless there are more revisits than a checked broadcast
    takes. A null html is an empty payload, control characters in a url are replaced.

    A response's block is an HTTP message, a revisit's is empty. Record ids are random UUIDs, so rows
    with equal ids have records of their own; ``Page-Id`` has the row's id (absent for null). A revisit names its
    first by target, date and ``Refers-To-Page-Id``. The date is that of writing: ``pages`` has none.
    """
    date = F.lit(datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"))
    payload = F.coalesce("html", F.lit(""))
    size = F.octet_length(payload).cast("long")
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    shared = pages.select("page_id", target.alias("url"), F.sha2(payload, 256).alias("d"), size.alias("n")).filter(F.col("n") >= LEAST_SHARED)
    by_id = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    first = shared.groupBy("d").agg(F.min(by_id).alias("first"), F.count("*").alias("rows")).filter("rows > 1 and first is not null")
    again = shared.join(first, "d").filter("page_id is null or page_id != first.page_id")
    again = again.select("page_id", "d", F.col("first.page_id").alias("first"), F.col("first.url").alias("first_url")).distinct()
    again, small = broadcast_if_small(again)
    again = again.withColumnsRenamed({"page_id": "_id", "d": "_d"})
    rows = pages.select("page_id", target.alias("url"), payload.alias("payload"), size.alias("n"), F.sha2(payload, 256).alias("d"))
    rows = rows.join(again, rows["page_id"].eqNullSafe(again["_id"]) & (rows["d"] == again["_d"]), "left")
    revisit, none = F.col("first").isNotNull(), F.lit("")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    rows = rows.withColumn("http", http)
    refers = F.concat(
        _named("WARC-Profile", F.lit(PROFILE)),
        _named("WARC-Refers-To-Target-URI", F.col("first_url")),
        _named("WARC-Refers-To-Date", date),
        _named("Refers-To-Page-Id", F.col("first").cast("string")),
    )
    length = F.when(revisit, F.lit(0)).otherwise(F.octet_length("http") + F.col("n"))
    head = F.concat(
        F.lit(MAGIC),
        _named("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _named("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))),
        _named("WARC-Date", date),
        _named("WARC-Target-URI", F.col("url")),
        F.coalesce(_named("Page-Id", F.col("page_id").cast("string")), none),
        F.when(revisit, refers).otherwise(none),
        _named("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("d"))),
        _named("WARC-Payload-Length", F.col("n").cast("string")),
        _named("Content-Type", F.lit("application/http; msgtype=response")),
        _named("Content-Length", length.cast("string")),
    )
    record = F.concat(head, F.lit("\r\n"), F.when(revisit, none).otherwise(F.concat("http", "payload")))
    rows.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").text(folder)


def _field(head: bytes, name: bytes) -> bytes | None:
    found = re.search(rb"(?:^|\r\n)" + name + rb":[ \t]*([^\r\n]*)", head, re.IGNORECASE)
    return found[1] if found else None


def _page(value: bytes | None) -> int | None:
    return int(value) if re.fullmatch(rb"-?[0-9]{1,19}", value or b"") else None


def _candidate(piece: bytes, rel: int) -> dict | None:
    """What the bytes behind a magic say if they are a record's head; offsets from the start of the block."""
    end = piece.find(b"\r\n\r\n")
    length = _field(piece[: max(end, 0)], b"Content-Length")
    if end < 0 or not length or not length.isdigit() or len(length) > 18:
        return None
    n, skip = int(length), end + 4
    whole, succ = len(piece) >= skip + n, rel + len(MAGIC) + skip + n + 4
    if (_field(piece[:end], b"Content-Type") or b"").startswith(b"application/http"):
        # the payload is what follows the message's own head
        body = piece.find(b"\r\n\r\n", skip, skip + n)
        n, skip = (n, skip) if body < 0 else (n - (body + 4 - skip), body + 4)
    payload = piece[skip : skip + n]
    kind = (_field(piece[:end], b"WARC-Type") or b"").decode("latin-1")
    digest, size = hashlib.sha256(payload).hexdigest() if whole else None, n
    if kind == "revisit":
        digest = (_field(piece[:end], b"WARC-Payload-Digest") or b"").decode("latin-1").removeprefix("sha256:")
        named = _field(piece[:end], b"WARC-Payload-Length") or b""
        size = int(named) if named.isdigit() and len(named) < 19 else None
    return {
        "rel": rel,
        "succ": succ,
        "record_type": kind,
        "page_id": _page(_field(piece[:end], b"Page-Id")),
        "refers_to": _page(_field(piece[:end], b"Refers-To-Page-Id")),
        "payload_bytes": size,
        "payload_digest": digest,
        "whole": whole,
        "skip": skip,
    }


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The archives' bytes cut at every magic, with the file and the block each piece starts in."""
    read = spark.read.option("lineSep", MAGIC).text(folder)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return read.select(*place, F.col("value").cast("binary").alias("value"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, block, offset in the block, piece): a reader takes a block's pieces in order, and all that start in it."""
    at, rel = None, 0
    for batch in batches:
        for file, block, value in zip(*[batch.column(c).to_pylist() for c in ("file", "block", "value")], strict=True):
            if at != (file, block):
                at, rel = (file, block), 0
            yield file, block, rel, value
            rel += len(value) + len(MAGIC)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate records, each with the first offset outside of its block that its chain leads to.

    The end of a block is a row of its own, without a successor; ``rel`` is then the block's length.
    """
    names = [f.split()[0] for f in _CANDIDATES.split(", ")]
    schema = pa.schema([(f.split()[0], {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[f.split()[1]]) for f in _CANDIDATES.split(", ")])

    def out(at: tuple[str, int], rows: list[dict], length: int) -> pa.RecordBatch:
        leave: dict[int, int | None] = {}
        for row in reversed(rows):
            # the next block's first candidate is the magic that ends this one
            row["leave"] = row["succ"] if row["succ"] >= length - len(MAGIC) else leave.get(row["succ"])
            leave[row["rel"]] = row["leave"]
        rows.append({"rel": length})
        return pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} | {"file": at[0], "block": at[1]} for r in rows], schema)

    at, rows, length = None, [], 0
    for file, block, rel, value in _blocks(batches):
        if at != (file, block):
            if at:
                yield out(at, rows, length)
            at, rows = (file, block), []
        length = rel + len(value) + len(MAGIC)
        # a piece stands behind a magic, but for what precedes the first one of a file
        if (block or rel) and (found := _candidate(value, rel - len(MAGIC))):
            rows.append(found)
    if at:
        yield out(at, rows, length)


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, start) that chains enter a block at, beginning with offset 0 of each file, by pointer jumping.

    ``candidates`` has file, start and leave: the start of a record and where its chain leaves its
    block. Only starts that some chain leads to take part; each round doubles the jumps.
    """
    spark = candidates.sparkSession
    entries = candidates.select("file", F.col("leave").alias("start")).unionByName(candidates.select("file", F.lit(0).cast("long").alias("start")))
    jumps = candidates.join(entries.distinct(), ["file", "start"]).select("file", "start", "leave")
    paths = [fresh_path(spark, "jumps"), fresh_path(spark, "reached")]
    jumps = stored(jumps, path=paths[0])
    reached = stored(jumps.filter("start = 0").select("file", "start"), path=paths[1])
    n = reached.count()
    while True:
        far = reached.join(jumps, ["file", "start"]).filter("leave is not null").select("file", F.col("leave").alias("start"))
        old, paths = paths, [fresh_path(spark, "jumps"), fresh_path(spark, "reached")]
        grown = stored(reached.unionByName(far).distinct(), path=paths[1])
        more = grown.count()
        if more == n:
            return grown
        then = jumps.select("file", F.col("start").alias("leave"), F.col("leave").alias("next"))
        jumps = stored(jumps.join(then, ["file", "leave"]).select("file", "start", F.col("next").alias("leave")), path=paths[0])
        for path in old:
            remove(spark, path)
        reached, n = grown, more


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(file, start, page_id, record_type, refers_to, payload_bytes, payload_digest) of every record.

    Tasks read blocks of the archives, cut at every magic, and give each candidate with the offset
    of its successor. A candidate is a record only if the chain of successors from its file's start
    reaches it, so a magic or a whole record inside a payload is none. Payloads that were cut at a
    magic of their own are put together again from their pieces. Archives without a record at offset
    0, or whose chain breaks, end there.
    """
    found = stored(_pieces(spark, folder).mapInArrow(_candidates, _CANDIDATES), "candidates")
    ends = found.filter("succ is null").select("file", "block", F.col("rel").alias("length"))
    order = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    bases = stored(ends.select("file", "block", F.coalesce(F.sum("length").over(order), F.lit(0)).alias("base")), "bases")
    placed = found.filter("succ is not null").join(bases, ["file", "block"])
    placed = stored(
        placed.withColumns({"start": F.col("base") + F.col("rel"), "leave": F.col("base") + F.col("leave"), "succ": F.col("base") + F.col("succ")}).drop("rel", "base"),
        "placed",
    )
    entries = reachable(placed).withColumn("entry", F.lit(True))
    marked = placed.join(entries, ["file", "start"], "left")
    fields = ["start", "succ", "record_type", "page_id", "refers_to", "payload_bytes", "payload_digest", "whole", "skip"]
    kinds = "start long, succ long, record_type string, page_id long, refers_to long, payload_bytes long, payload_digest string, whole boolean, skip long"

    def walk(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("start")
        starts, succ, entry = (table.column(c).to_pylist() for c in ("start", "succ", "entry"))
        due, keep = set(), []
        for s, t, e in zip(starts, succ, entry, strict=True):
            keep.append(bool(e) or s in due)
            if keep[-1]:
                due.add(t)
        table = table.filter(pa.array(keep, pa.bool_())).select(fields)
        return table.add_column(0, "file", pa.array([key[0].as_py()] * len(table), pa.string()))

    true = stored(marked.groupBy("file", "block").applyInArrow(walk, f"file string, {kinds}"), "records")
    cut = true.filter("not whole and record_type != 'revisit'")
    records = true.filter("whole or record_type = 'revisit'")
    columns = ["file", "start", "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    if cut.isEmpty():
        return records.select(*columns)
    return records.select(*columns).unionByName(_joined(spark, folder, cut, bases).select(*columns))


def _joined(spark: SparkSession, folder: str, cut: DataFrame, bases: DataFrame) -> DataFrame:
    """Records whose payload holds a magic, from all pieces between their start and their successor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, rel, value in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block]), pa.array([rel - len(MAGIC)]), pa.array([value])], names=["file", "block", "rel", "value"])

    spans = cut.select("file", "start", "succ")
    places = _pieces(spark, folder).mapInArrow(run, "file string, block long, rel long, value binary").join(bases, ["file", "block"])
    places = places.select("file", (F.col("base") + F.col("rel")).alias("at"), F.col("value"))
    narrow = places.select("file", "at").unionByName(spans.select("file", F.col("start").alias("at"))).distinct()
    last = W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    owner = narrow.join(spans.withColumn("at", F.col("start")), ["file", "at"], "left")
    owner = owner.select("file", "at", F.last("start", True).over(last).alias("start"), F.last("succ", True).over(last).alias("succ"))
    owner, _ = broadcast_if_small(owner.filter("at >= start and at < succ").select("file", "at", "start"))
    text = places.join(owner, ["file", "at"]).groupBy("file", "start").agg(F.sort_array(F.collect_list(F.struct("at", F.col("value").cast("string").alias("v")))).alias("p"))
    whole = F.array_join(F.transform("p", lambda x: x["v"]), MAGIC).cast("binary")
    rows = text.select("file", "start", whole.alias("bytes")).join(cut.drop("payload_digest"), ["file", "start"])
    payload = F.substring(F.col("bytes"), F.col("skip").cast("int") + 1, F.col("payload_bytes").cast("int"))
    return rows.withColumn("payload_digest", F.sha2(payload, 256))


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """``pages`` written to archives and what is read back: see ``write_archives`` and ``read_archives``.

    One row for each row of ``pages``, repeated ones too; no rows give none; columns other than
    page_id, url and html are ignored.
    """
    folder = folder or fresh_path(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
