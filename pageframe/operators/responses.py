"""The response table: one row per response, whatever its format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageframe.functions.text import body_text, first_header

RESPONSE_SCHEMA = (
    "seed STRING, page_no BIGINT, url STRING, status INT, "
    "headers MAP<STRING,ARRAY<STRING>>, body BINARY"
)
KEYS = ("seed", "page_no", "url")


def as_responses(df: DataFrame) -> DataFrame:
    """Bring captured responses into the response table's shape.

    Needs ``url`` and ``body`` (text or bytes). ``seed`` (the first URL, or the URL with the
    index placeholder) is the page's own URL if absent, ``page_no`` 0, ``status`` 200.
    Header names are folded to lower case; an absent body becomes an empty one.
    """
    have = set(df.columns)
    headers = F.col("headers") if "headers" in have else F.lit(None).cast("map<string,array<string>>")
    entries = F.transform(
        F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    # names that differ only in case are one header; its values stay in order
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    folded = F.map_from_arrays(
        names,
        F.transform(
            names, lambda n: F.flatten(F.transform(F.filter(entries, lambda e: e["key"] == n), lambda e: e["value"]))
        ),
    )
    return df.select(
        (F.col("seed") if "seed" in have else F.col("url")).cast("string").alias("seed"),
        (F.col("page_no") if "page_no" in have else F.lit(0)).cast("bigint").alias("page_no"),
        F.col("url").cast("string").alias("url"),
        (F.col("status") if "status" in have else F.lit(200)).cast("int").alias("status"),
        F.coalesce(folded, F.create_map().cast("map<string,array<string>>")).alias("headers"),
        F.coalesce(F.col("body").cast("binary"), F.lit(b"")).alias("body"),
    )


def response_columns(responses: DataFrame, *header_names: str) -> DataFrame:
    """Status, length, text, hash and the first value of the named headers of each response."""
    return responses.select(
        *KEYS,
        "status",
        F.octet_length("body").cast("bigint").alias("n_bytes"),
        body_text(F.col("body")).alias("text"),
        F.xxhash64("body").alias("page_hash"),
        *[first_header(F.col("headers"), n).alias(f"header_{n.lower().replace('-', '_')}") for n in header_names],
    )
