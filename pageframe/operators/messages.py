"""From records to request messages: text per record, batches, headers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageframe.functions.templates import fill_template, template_fields
from pageframe.options import MESSAGE_FORMATS, SinkOptions, pick

# Content type per message format.
CONTENT_TYPES = {
    "JSON": "application/json",
    "Form": "application/x-www-form-urlencoded",
    "Custom": "text/plain",
}
MESSAGE_SCHEMA = (
    "method STRING, url STRING, headers MAP<STRING,STRING>, content_type STRING, "
    "body STRING, n_records BIGINT, batch_id STRING"
)


def json_text(df: DataFrame) -> Column:
    """A record as a JSON object; null fields are kept."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def _as_text(df: DataFrame, name: str) -> Column:
    nested = isinstance(df.schema[name].dataType, (T.StructType, T.ArrayType, T.MapType))
    column = F.col(f"`{name}`")
    return F.to_json(column) if nested else column.cast("string")


def form_text(df: DataFrame, style: str = "whole") -> Column:
    """A record as form text ``a=1&b=2``; a null is the word ``null``.

    ``whole`` encodes the finished text, so ``=`` and ``&`` are escaped as well; ``pairs``
    encodes names and values only, as forms usually do.
    """
    whole = style == "whole"
    pairs = []
    for name in df.columns:
        value = F.coalesce(_as_text(df, name), F.lit("null"))
        pairs.append(
            F.concat(F.lit(f"{name}="), value) if whole else F.concat(F.url_encode(F.lit(name)), F.lit("="), F.url_encode(value))
        )
    text = F.concat_ws("&", *pairs)
    return F.url_encode(text) if whole else text


def custom_text(df: DataFrame, template: str) -> Column:
    return fill_template(template, lambda name: _as_text(df, name))


def url_text(df: DataFrame, options: SinkOptions) -> Column:
    """Target URL of a record. PUT and DELETE fill ``#field``; a null leaves the placeholder."""
    if options.verb not in ("PUT", "DELETE"):
        return F.lit(options.url)
    return fill_template(
        options.url, lambda name: F.coalesce(F.url_encode(_as_text(df, name)), F.lit(f"#{name}"))
    )


def require_template_values(df: DataFrame, template: str) -> DataFrame:
    """Fail the job on a record with no value for a field of the template (kept in a filter)."""
    for name in template_fields(template):
        if df.schema[name].nullable:
            message = F.lit(f"Field {name} of the message template has no value.")
            df = df.filter(F.when(F.col(f"`{name}`").isNull(), F.raise_error(message).cast("boolean")).otherwise(True))
    return df


def record_texts(df: DataFrame, options: SinkOptions, *carry: Column) -> DataFrame:
    """``url, text`` per record; text is NULL for DELETE, whose requests have no body."""
    form = pick(MESSAGE_FORMATS, options.message_format)
    if options.verb == "DELETE":
        return df.select(*carry, url_text(df, options).alias("url"), F.lit(None).cast("string").alias("text"))
    if form == "JSON":
        text = json_text(df)
    elif form == "Form":
        text = form_text(df, options.form_style)
    else:
        df = require_template_values(df, options.body)
        text = custom_text(df, options.body)
    return df.select(*carry, url_text(df, options).alias("url"), text.alias("text"))


def joints(options: SinkOptions) -> tuple[str, str, str]:
    """What stands before, between and after the records of one message."""
    if pick(MESSAGE_FORMATS, options.message_format) != "JSON" or not options.write_json_as_array:
        return "", options.delimiter, ""
    if not options.json_batch_key:
        return "[", ",", "]"
    key = options.json_batch_key.replace("\\", "\\\\").replace('"', '\\"')
    return '{"' + key + '":[', ",", "]}"


def request_headers(options: SinkOptions) -> dict[str, str]:
    headers = dict(options.headers)
    headers["Request-Method"] = options.verb
    headers["Instance-Follow-Redirects"] = str(options.follow_redirects).lower()
    headers["charset"] = options.charset
    if options.verb in ("POST", "PUT"):
        headers.setdefault("Content-Type", CONTENT_TYPES[pick(MESSAGE_FORMATS, options.message_format)])
    return headers


def _with_request_columns(batches: DataFrame, options: SinkOptions) -> DataFrame:
    headers = request_headers(options)
    pairs = [F.lit(x) for item in sorted(headers.items()) for x in item]
    return batches.select(
        F.lit(options.verb).alias("method"),
        "url",
        F.create_map(*pairs).alias("headers"),
        F.lit(headers.get("Content-Type")).cast("string").alias("content_type"),
        "body",
        F.col("n_records").cast("bigint").alias("n_records"),
        "batch_id",
    )


def _message_id(*parts: Column) -> Column:
    """An id that two messages share only if all parts are equal, the content among them."""
    return F.sha1(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _chunks(options: SinkOptions):
    """Arrow function that joins consecutive records of one URL into messages of a partition."""
    size = options.batch_size
    before, between, after = joints(options)

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, open_url, open_texts = 0, None, []

        def message(url: str | None, texts: list[str]) -> tuple[str | None, str, int, str]:
            nonlocal number
            number += 1
            return url, before + between.join(texts) + after, len(texts), f"{part}-{number - 1}"

        for batch in batches:
            done = []
            for url, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if open_texts and url != open_url:
                    done.append(message(open_url, open_texts))
                    open_texts = []
                open_url = url
                open_texts.append(text)
                if len(open_texts) == size:
                    done.append(message(open_url, open_texts))
                    open_texts = []
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*done, strict=True), _CHUNK_TYPES, strict=True)], names=_CHUNK_NAMES
                )
        if open_texts:
            last = message(open_url, open_texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], t) for c, t in zip(last, _CHUNK_TYPES, strict=True)], names=_CHUNK_NAMES
            )

    return chunk


_CHUNK_NAMES = ["url", "body", "n_records", "batch_id"]
_CHUNK_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string()]


def build_messages(df: DataFrame, options: SinkOptions, sequence: str | None = None, run: str | None = None) -> DataFrame:
    """Request messages of at most ``batch_size`` records each.

    By default every partition fills its own messages, with no shuffle; the record texts are
    built by Spark expressions and only joined in Arrow batches. Where the URL depends on
    the record, partitions are sorted by URL (in place, no shuffle) and a message never mixes
    URLs.

    ``sequence`` names a unique integer column that numbers the records. Then the records
    numbered ``k * batch_size`` up to the next multiple form one message (per URL), whatever
    the partitioning is; a group has no more than ``batch_size`` records by construction.

    ``batch_id`` is a hash of the run, the place in it, the URL and the content. Two messages of a run
    never share it; messages of different content never share it, whatever run or attempt they are
    from. ``run`` names the run, a new name for each call by default, so that a later job or
    micro-batch never repeats an id. With ``sequence`` the number is the place and needs no run.
    """
    options.check(df.schema)
    run = run or uuid.uuid4().hex
    if options.verb == "DELETE":
        place = [F.lit(run), F.monotonically_increasing_id(), F.col("url")]
        number = _message_id(*place) if sequence is None else F.col("_n")
        carry = [] if sequence is None else [F.col(sequence).cast("bigint").alias("_n")]
        rows = record_texts(df, options, *carry)
        batches = rows.select("url", F.col("text").alias("body"), F.lit(1).alias("n_records"), number.cast("string").alias("batch_id"))
        return _with_request_columns(batches, options)

    if sequence is None:
        rows = record_texts(df, options)
        if options.batch_size > 1 and options.verb == "PUT" and template_fields(options.url):
            rows = rows.sortWithinPartitions("url")
        if options.batch_size == 1:
            before, _, after = joints(options)
            batches = rows.select(
                "url",
                F.concat(F.lit(before), F.col("text"), F.lit(after)).alias("body"),
                F.lit(1).alias("n_records"),
                _message_id(F.lit(run), F.monotonically_increasing_id(), F.col("url"), F.col("text")).alias("batch_id"),
            )
        else:
            batches = rows.mapInArrow(_chunks(options), "url STRING, body STRING, n_records BIGINT, batch_id STRING")
            batches = batches.withColumn("batch_id", _message_id(F.lit(run), F.col("batch_id"), F.col("url"), F.col("body")))
        return _with_request_columns(batches, options)

    before, between, after = joints(options)
    rows = record_texts(df, options, F.col(sequence).cast("bigint").alias("_n"))
    if options.batch_size == 1:
        batches = rows.select(
            "url",
            F.concat(F.lit(before), F.col("text"), F.lit(after)).alias("body"),
            F.lit(1).alias("n_records"),
            _message_id(F.col("url"), F.col("_n"), F.col("text")).alias("batch_id"),
        )
        return _with_request_columns(batches, options)
    number = (F.col("_n") - F.pmod(F.col("_n"), F.lit(options.batch_size))).alias("_batch")
    grouped = rows.groupBy("url", number).agg(F.sort_array(F.collect_list(F.struct("_n", "text"))).alias("_rows"))
    message = F.lit(f"the numbers in {sequence} are not unique")
    too_many = F.size("_rows") > options.batch_size
    grouped = grouped.filter(F.when(too_many, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    text = F.concat(F.lit(before), F.array_join(F.col("_rows.text"), between), F.lit(after))
    batches = grouped.select(
        "url",
        text.alias("body"),
        F.size("_rows").alias("n_records"),
        _message_id(F.col("url"), F.col("_batch"), text).alias("batch_id"),
    )
    return _with_request_columns(batches, options)
