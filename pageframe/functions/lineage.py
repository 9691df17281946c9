"""Cutting lineage through the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows of a file and fewest files of a frame whose greatest number of rows is known before it is written.
FILE_ROWS, FEWEST_FILES = 100_000, 2


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Where nothing is named, as in tests, it is a folder of the warehouse, which the executors
    share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_between"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder; later plans start from the written rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "rows", path: str | None = None, most: int | None = None) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    ``most`` is a number of rows that ``df`` cannot exceed. All tasks work as before; if fewer files hold
    so many rows, their results are dealt evenly to that many writers. A file costs more than its rows
    then: where Hadoop has no native library, each one starts several processes on its executor.
    """
    spark = df.sparkSession
    path = path or fresh_path(spark, name)
    files = max(FEWEST_FILES, -(-(most or 0) // FILE_ROWS))
    few = most is not None and files < int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(files) if few else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, path: str | None = None, most: int | None = None, **counts: str) -> tuple[DataFrame, dict[str, int]]:
    """``stored`` with the number of rows as ``rows``, and of those where each expression of ``counts`` holds.

    The write counts as it goes, so there is no second job.
    """
    path, seen = path or fresh_path(df.sparkSession, "counted"), Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.expr(e)).alias(n) for n, e in counts.items()]]
    return stored(df.observe(seen, *metrics), path=path, most=most), {n: v or 0 for n, v in seen.get.items()}


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files at ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was written to ``path``, a path of ``fresh_path`` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
