"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageframe.functions.lineage import counted, fresh_path, size_of

# A frame is broadcast only after it was written and found to be no larger than this, in rows and in files.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
# Rows of one key above which its rows are spread over several tasks.
HOT_ROWS = 1_000_000
SALTS = 64


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS, most: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` written to the shared folder; hinted only within ``limit`` rows and ``BROADCAST_BYTES``. ``most``: as for ``stored``."""
    written, small, _ = small_or_not(df, limit, most)
    return written, small


def small_or_not(df: DataFrame, limit: int = BROADCAST_ROWS, most: int | None = None) -> tuple[DataFrame, bool, int]:
    """``broadcast_if_small`` and the number of rows, all from one job."""
    path = fresh_path(df.sparkSession, "side")
    written, n = counted(df, path, most)
    small = n["rows"] <= limit and size_of(df.sparkSession, path) <= BROADCAST_BYTES
    return (F.broadcast(written) if small else written), small, n["rows"]


def attach(
    df: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    spread_by: Column,
    limit: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Left join of ``df`` to ``groups`` (one row per key) that survives hot keys in ``df``.

    ``groups`` is broadcast if it was counted to be small, so ``df`` does not move at all.
    Otherwise each key is spread over ``salts`` join keys and its row is copied once per salt.
    """
    groups, small = broadcast_if_small(groups, limit)
    if small:
        return df.join(groups, list(keys), "left")
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    copies = groups.withColumn("_salt", F.explode(every_salt))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    return salted.join(copies, [*keys, "_salt"], "left").drop("_salt")


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Column,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Inner join of ``left`` to ``right`` (unique on ``key``) where ``left`` may have hot keys.

    Keys with more than ``hot_rows`` rows are found by a map-side combined count; there are at
    most ``rows / hot_rows`` of them. Their rows are salted and only their matches on the
    right are copied; all other keys join as usual. ``left`` is read more than once, so it
    should be a written frame.
    """
    hot = left.groupBy(key).count().filter(F.col("count") > hot_rows).select(key)
    marks, _, n_hot = small_or_not(hot.withColumn("_hot", F.lit(True)))
    if not n_hot:
        return left.join(right, key)
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(salts))).otherwise(F.lit(0).cast("bigint"))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(
        F.array(F.lit(0).cast("bigint"))
    )
    salted = left.join(marks, key, "left").withColumn("_salt", salt).drop("_hot")
    copied = right.join(marks, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted.join(copied, [key, "_salt"]).drop("_salt")
