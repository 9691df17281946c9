"""``format("page_messages")``: sending built messages, in batch and from streams.

Requests are made by the tasks that hold the messages. Delivery is at least once: a task
that is run again sends its messages again, so every message carries its ``batch_id`` as a
header by which a receiver can drop repeats.
"""

from __future__ import annotations

import base64
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from pageframe.operators.errors import SEND, SKIP, STOP, STRATEGIES
from pageframe.operators.messages import MESSAGE_SCHEMA
from pageframe.options import SinkOptions
from pageframe.sources.transport import Answer, Transport, pack, send, unpack
from pageframe.sources.walk import strategy_for

BATCH_HEADER = "Batch-Id"


def writer_options(
    options: SinkOptions, transport: Transport | str = "http", error_path: str | None = None
) -> dict[str, str]:
    """Options for ``df.write.format("page_messages")`` from a :class:`SinkOptions`."""
    out = {
        "packed": base64.b64encode(cloudpickle.dumps(options)).decode(),
        "transport": transport if isinstance(transport, str) else pack(transport),
    }
    if error_path is not None:
        out["error_path"] = error_path
    return out


def deliver(options: SinkOptions, transport: Transport, message: dict) -> Answer:
    """Send one message with retries; a status whose handling is to stop fails the job."""
    if options.wait_between_pages_ms > 0:
        time.sleep(options.wait_between_pages_ms / 1000)
    rules = options.rules
    headers = {**message["headers"], BATCH_HEADER: message["batch_id"]}
    body = message["body"].encode() if message["body"] is not None else None
    answer = send(
        transport,
        message["method"],
        message["url"],
        headers,
        body,
        max(options.connect_timeout_s, options.read_timeout_s),
        lambda status: strategy_for(status, rules),
        lambda strategy: STRATEGIES[strategy][0],
        options.retry_policy.lower(),
        options.linear_retry_interval_s,
        options.max_retry_duration_s,
    )
    if STRATEGIES[answer.strategy][1] == STOP:
        raise RuntimeError(f"Sending to url '{message['url']}' returned status code '{answer.status}'")
    return answer


def send_messages(messages: DataFrame, options: SinkOptions, transport: Transport | str = "http") -> DataFrame:
    """Send messages and give what became of each. Every evaluation sends again: write the result once."""
    packed = transport if isinstance(transport, str) else pack(transport)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = unpack(packed)
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                row["headers"] = dict(row["headers"])
            answers = [deliver(options, call, row) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["url"] for r in rows], pa.string()),
                    pa.array([r["batch_id"] for r in rows], pa.string()),
                    pa.array([r["n_records"] for r in rows], pa.int64()),
                    pa.array([a.status for a in answers], pa.int32()),
                    pa.array([a.attempts for a in answers], pa.int32()),
                    pa.array([STRATEGIES[a.strategy][1] for a in answers], pa.string()),
                ],
                names=["url", "batch_id", "n_records", "status", "attempts", "handling"],
            )

    return messages.mapInArrow(
        run, "url STRING, batch_id STRING, n_records BIGINT, status INT, attempts INT, handling STRING"
    )


#: Refused messages as they are kept.
REFUSED = pa.schema([("url", pa.string()), ("status", pa.int32()), ("batch_id", pa.string()), ("body", pa.string())])


@dataclass
class Sent(WriterCommitMessage):
    """Counts of one task and its file of refused messages; this is all that reaches the driver."""

    messages: int
    records: int
    skipped: int
    to_error: int
    file: str | None = None


class _TaskWriter:
    def __init__(self, options: dict[str, str]):
        self.sink = (
            cloudpickle.loads(base64.b64decode(options["packed"]))
            if "packed" in options
            else SinkOptions.from_properties(options)
        )
        self.transport = options.get("transport")
        self.error_path = options.get("error_path")

    def write(self, rows: Iterator[Row]) -> Sent:
        call, failed = unpack(self.transport), None
        sent = Sent(0, 0, 0, 0)
        for row in rows:
            message = row.asDict()
            answer = deliver(self.sink, call, message)
            handling = STRATEGIES[answer.strategy][1]
            sent.messages += 1
            sent.records += message["n_records"]
            sent.skipped += handling == SKIP
            if handling == SEND:
                sent.to_error += 1
                failed = failed or self._open(sent)
                self._keep(failed, message, answer.status)
        if failed is not None:
            failed.close()
        return sent

    def _folder(self):  # noqa: ANN202
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.error_path if ":" in self.error_path else f"file://{self.error_path}")

    def _open(self, sent: Sent):  # noqa: ANN202
        """This attempt's file of refused messages, in a folder that readers of the error folder pass over."""
        import pyarrow.parquet as pq

        if self.error_path is None:
            raise RuntimeError("'Send to error' needs the option 'error_path'")
        files, base = self._folder()
        files.create_dir(f"{base}/_staged", recursive=True)
        sent.file = f"{uuid.uuid4().hex}.parquet"
        return pq.ParquetWriter(f"{base}/_staged/{sent.file}", REFUSED, filesystem=files)

    def _keep(self, writer, message: dict, status: int) -> None:  # noqa: ANN001
        row = {"url": message["url"], "status": status, "batch_id": message["batch_id"], "body": message["body"]}
        writer.write_table(pa.Table.from_pylist([row], schema=REFUSED))

    def publish(self, messages: list[Sent | None], name: str) -> None:
        """Bring the files of the attempts that count into the error folder, and note what became of the messages.

        Files of attempts that failed or were too late are never named here and stay out of sight. A
        micro-batch that is run again has the same names and so replaces what it left.
        """
        done = [m for m in messages if m is not None]
        if self.error_path is None:
            return
        files, base = self._folder()
        files.create_dir(f"{base}/_outcomes", recursive=True)
        for i, m in enumerate(sorted((m for m in done if m.file), key=lambda m: m.file)):
            files.move(f"{base}/_staged/{m.file}", f"{base}/{name}-{i:05d}.parquet")
        counts = {k: sum(getattr(m, k) for m in done) for k in ("messages", "records", "skipped", "to_error")}
        with files.open_output_stream(f"{base}/_outcomes/{name}.json") as f:
            f.write(json.dumps(counts).encode())

    def drop(self, messages: list[Sent | None]) -> None:
        """Delete the files of a write that is given up."""
        for m in messages:
            if m is not None and m.file:
                files, base = self._folder()
                files.delete_file(f"{base}/_staged/{m.file}")


class MessagesWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.task, self.name = _TaskWriter(options), f"run-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Sent:
        return self.task.write(iterator)

    def commit(self, messages: list[Sent | None]) -> None:
        self.task.publish(messages, self.name)

    def abort(self, messages: list[Sent | None]) -> None:
        self.task.drop(messages)


class MessagesStreamWriter(DataSourceStreamWriter):
    def __init__(self, options: dict[str, str]):
        self.task = _TaskWriter(options)

    def write(self, iterator: Iterator[Row]) -> Sent:
        return self.task.write(iterator)

    def commit(self, messages: list[Sent | None], batchId: int) -> None:  # noqa: N803
        self.task.publish(messages, f"batch-{batchId:012d}")

    def abort(self, messages: list[Sent | None], batchId: int) -> None:  # noqa: N803
        self.task.drop(messages)


class MessagesDataSource(DataSource):
    """Message sink. Options: the flat properties of the sink, or those of :func:`writer_options`."""

    @classmethod
    def name(cls) -> str:
        return "page_messages"

    def schema(self) -> str:
        return MESSAGE_SCHEMA

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:  # noqa: ANN001
        return MessagesWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:  # noqa: ANN001, N802
        return MessagesStreamWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MessagesDataSource)
