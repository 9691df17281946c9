"""One query per operator, over the whole of its table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageframe.llm import curriculum, lexical, line_quality, packing, pii, runs, simhash, token_counts, token_files, topk, toxicity, url_rules, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.fingerprint_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archived(_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = curriculum.schedule(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    taken = (F.col("size") * F.col("copies")).alias("taken")
    ordered = curriculum.in_order(plan.select("row.doc_id", "size", "source_size", "target", taken, "positions"))
    # positions in billionths of the training, so that they compare as text
    billionths = F.transform("positions", lambda p: F.round(p * 1e9).cast("long").cast("string"))
    return ordered.withColumn("positions", F.array_join(billionths, ","))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents")).drop("scores")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.verdicts(_table(spark, sf_dir, "documents")).drop("key", "removed_words")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents")).drop("ids")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(_table(spark, sf_dir, "documents"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_toxicity, op3_url_filter, op4_warc, op5_token_files, op6_mixing, op7_pii, op8_quality, op9_top_k,
        op10_packing, op11_token_counts, op12_runs, op13_search, pipeline,
    )
}
