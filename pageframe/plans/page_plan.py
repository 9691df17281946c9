"""Pages that are known before any fetch: index pagination and single pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageframe.functions.skew import attach
from pageframe.functions.urls import fill_index
from pageframe.options import SourceOptions

# Pages listed by one row before the list is spread over the cluster.
BLOCK = 10_000


def page_count(start: int, increment: int, maximum: int | None) -> int | None:
    """Pages of an index plan; None if it is open-ended.

    The maximum is an upper bound, also for a negative increment: a start above it gives no
    page, and counting down never reaches it.
    """
    if maximum is None:
        return None
    if start > maximum:
        return 0
    return (maximum - start) // increment + 1 if increment > 0 else None


def index_plan(seeds: DataFrame, start: int, increment: int, n_pages: int) -> DataFrame:
    """URLs of the first ``n_pages`` index pages of each seed: ``seed, page_no, page_index, url``.

    All of them are known up front, so they can be fetched in parallel. Long plans are
    listed in blocks, so that no row holds more than ``BLOCK`` pages.
    """
    blocks = max(0, -(-n_pages // BLOCK))
    rows = seeds.select("seed")
    if blocks > 1:
        rows = rows.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition("seed", "_b")
    else:
        rows = rows.withColumn("_b", F.lit(0))
    first = F.col("_b").cast("bigint") * BLOCK
    last = F.least(first + (BLOCK - 1), F.lit(n_pages - 1).cast("bigint"))
    listed = F.explode(F.when(F.lit(n_pages > 0), F.sequence(first, last)))
    pages = rows.select("seed", listed.alias("page_no"))
    index = F.lit(start).cast("bigint") + F.col("page_no") * F.lit(increment)
    return pages.withColumn("page_index", index).withColumn("url", fill_index(F.col("seed"), F.col("page_index")))


def single_pages(responses: DataFrame) -> DataFrame:
    """No pagination: the page at the seed's own URL and nothing else."""
    return responses.filter(F.col("url") == F.col("seed"))


def stop_on_empty(pages: DataFrame, facts: DataFrame) -> DataFrame:
    """Pages in front of the first page without entries of their seed.

    ``facts`` has ``seed, page_no, n_entries``. The first empty page is a min aggregate, one
    row per seed that has one; it is joined back without moving the bodies if it is small.
    """
    stops = facts.filter(F.col("n_entries") == 0).groupBy("seed").agg(F.min("page_no").alias("stop_at"))
    marked = attach(pages, stops, ["seed"], F.col("url"))
    return marked.filter(F.col("stop_at").isNull() | (F.col("page_no") < F.col("stop_at"))).drop("stop_at")


def replay(plan: DataFrame, responses: DataFrame) -> DataFrame:
    """Responses of planned URLs. Seed and URL together are the join key, so a hot seed spreads."""
    return plan.select("seed", "page_no", "url").join(responses.drop("page_no"), ["seed", "url"])


def missing_pages(plan: DataFrame, responses: DataFrame) -> DataFrame:
    """Planned URLs without any response, as error rows: a page that failed to load."""
    lost = plan.select("seed", "page_no", "url").join(responses.select("seed", "url"), ["seed", "url"], "left_anti")
    return lost.select(
        "seed",
        "page_no",
        "url",
        F.lit(0).alias("code"),
        F.concat(F.lit("Failed to load the page "), F.col("url")).alias("message"),
    )


def in_plan(responses: DataFrame, options: SourceOptions) -> DataFrame:
    """Captured index pages within the maximum; a plain filter that reaches the scan."""
    n_pages = page_count(options.start_index, options.index_increment, options.max_index)
    return responses if n_pages is None else responses.filter(F.col("page_no") < n_pages)
