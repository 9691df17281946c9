"""Streams of captured or fetched responses."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pageframe.operators.errors import Routed, route, with_outcome
from pageframe.operators.messages import build_messages
from pageframe.operators.parse import parse_pages
from pageframe.operators.responses import RESPONSE_SCHEMA
from pageframe.options import SinkOptions, SourceOptions
from pageframe.sources import reader as reader_source
from pageframe.sources import writer as writer_source
from pageframe.sources.transport import Transport


def captured_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Responses as they are captured into a Parquet folder; the checkpoint knows the files seen."""
    reader = spark.readStream.schema(RESPONSE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def fetched_stream(
    spark: SparkSession,
    options: SourceOptions,
    spool: str,
    transport: Transport | str = "http",
    urls: list[str] | None = None,
    interval_s: float | None = None,
) -> DataFrame:
    """Responses polled from a paged API. ``spool`` is a folder that all executors share."""
    options.check()
    reader_source.register(spark)
    given = reader_source.reader_options(options, transport, urls, spool=spool, interval_s=interval_s)
    return spark.readStream.format("pages").options(**given).load()


def unseen(responses: DataFrame, on_change: bool = False, forget_after: str | None = None) -> DataFrame:
    """Pages whose URL was not given out before, or, with ``on_change``, whose content is new.

    State is keyed by a 16-byte hash of seed and URL (and content), so one busy seed is spread over
    all state partitions. With ``forget_after``, an interval such as ``7 days``, a key is dropped so
    long after its page was given out first; a page that comes again later is given out again. Time
    is that of the micro-batches. Without it keys are kept for ever. Copies of a page within an
    Arrow batch are thinned before the shuffle, so that a page captured very often does not crowd a
    state partition; nothing is remembered between batches outside the state.
    """
    key = [F.col("seed"), F.col("url")]
    if on_change:
        key.append(F.sha2("body", 256))
    keyed = responses.withColumn("_page", F.unhex(F.md5(F.concat_ws("\n", *key).cast("binary"))))
    thinned = keyed.mapInArrow(_first_copies, keyed.schema)
    if forget_after is None:
        return thinned.dropDuplicates(["_page"]).drop("_page")
    timed = thinned.withColumn("_given", F.current_timestamp()).withWatermark("_given", forget_after)
    return timed.dropDuplicatesWithinWatermark(["_page"]).drop("_page", "_given")


def _first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each ``_page`` of an Arrow batch."""
    for batch in batches:
        codes = batch.column("_page").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        first = np.sort(np.unique(codes, return_index=True)[1])
        yield batch if len(first) == batch.num_rows else batch.take(pa.array(first))


def parse_stream(responses: DataFrame, options: SourceOptions) -> Routed:
    """Good and error records of a stream of responses, routed as in batch."""
    return route(parse_pages(responses, options))


def write_stream_routed(
    responses: DataFrame,
    options: SourceOptions,
    path: str,
    checkpoint: str,
    configure: Callable[..., object] | None = None,
) -> StreamingQuery:
    """Both outputs of a stream in one query: Parquet partitions ``outcome=record|error``.

    The file sink commits a micro-batch as a whole, so rows are written exactly once.
    """
    writer = (
        with_outcome(parse_pages(responses, options))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("outcome")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    writer = configure(writer) if configure else writer.trigger(availableNow=True)
    return writer.start()


def send_stream(
    records: DataFrame,
    options: SinkOptions,
    checkpoint: str,
    transport: Transport | str = "http",
    error_path: str | None = None,
    configure: Callable[[DataStreamWriter], DataStreamWriter] | None = None,
) -> StreamingQuery:
    """Build and send the messages of a stream of records, micro-batch by micro-batch.

    Ids of messages hold the checkpoint's path and the number of the micro-batch, so they stay the
    same when it is run again. ``configure`` sets the trigger; by default all there is is sent once.
    """
    options.check(records.schema)
    given = writer_source.writer_options(options, transport, error_path)

    def one_batch(df: DataFrame, batch_id: int) -> None:
        writer_source.register(df.sparkSession)
        build_messages(df, options, run=f"{checkpoint}#{batch_id}").write.format("page_messages").options(**given).mode("append").save()

    writer = records.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    writer = configure(writer) if configure else writer.trigger(availableNow=True)
    return writer.start()
