"""What a paged read makes of a capture: repeated pages count once, pages that are due but absent are entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageframe.functions.lineage import stored
from pageframe.functions.skew import broadcast_if_small, small_or_not
from pageframe.functions.urls import fill_index
from pageframe.operators.entries import missing_error
from pageframe.operators.responses import KEYS
from pageframe.options import SourceOptions
from pageframe.plans.page_plan import BLOCK, page_count


def page_id(seed: Column, url: Column) -> Column:
    """A 16-byte key of a page, much shorter than its seed and URL."""
    return F.unhex(F.md5(F.concat_ws("\n", seed, url).cast("binary")))


def captured_once(responses: DataFrame) -> DataFrame:
    """Every URL of a seed once: the capture with the smallest page number, then the smallest hash of its body.

    Only the keys are read to find repeats. Without any, ``responses`` comes back as it is; else
    only repeated pages are shuffled, each combined to one row before that, however often it is there.
    """
    me = page_id(F.col("seed"), F.col("url"))
    again = responses.select(me.alias("_page")).groupBy("_page").count().filter(F.col("count") > 1)
    again, _, n_again = small_or_not(again.select("_page", F.lit(True).alias("_again")))
    if not n_again:
        return responses
    marked = responses.withColumn("_page", me).join(again, "_page", "left")
    order = F.struct("page_no", F.xxhash64("body"), "status", F.to_json("headers"))
    first = F.min_by(F.struct(*responses.columns), order).alias("r")
    chosen = marked.filter(F.col("_again")).groupBy("_page").agg(first).select("r.*")
    return marked.filter(F.col("_again").isNull()).select(*responses.columns).unionByName(chosen)


def index_holes(facts: DataFrame, options: SourceOptions) -> DataFrame | None:
    """Index pages that are due but were not captured: ``seed, page_no, url``; None if there are none.

    Due are the pages in front of the first one without entries; without such a page, those of the
    plan if it has a maximum, else those in front of the last one captured. Seeds without a hole
    drop out by their counts; the pages of the others are listed in blocks.
    """
    planned = page_count(options.start_index, options.index_increment, options.max_index)
    pages = facts.groupBy("seed", "page_no").agg(F.min("n_entries").alias("n_entries")).filter(F.col("page_no") >= 0)
    seeds = pages.groupBy("seed").agg(
        F.count("*").alias("n"),
        (F.max("page_no") + 1).alias("last"),
        F.min(F.when(F.col("n_entries") == 0, F.col("page_no"))).alias("stop"),
    )
    due = F.coalesce("stop", F.lit(planned).cast("bigint"), "last")
    due = seeds.select("seed", "n", "last", due.alias("due")).filter(F.col("due") > 0)
    open_, _, n_open = small_or_not(due.filter((F.col("n") < F.col("last")) | (F.col("last") < F.col("due"))))
    if not n_open:
        return None
    last_block = F.floor((F.col("due") - 1) / F.lit(BLOCK)).cast("bigint")
    blocks = open_.select("seed", "due", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("b")).repartition("seed", "b")
    listed = F.sequence(F.col("b") * BLOCK, F.least(F.col("b") * BLOCK + (BLOCK - 1), F.col("due") - 1))
    wanted = blocks.select("seed", F.explode(listed).alias("page_no"))
    index = F.lit(options.start_index).cast("bigint") + F.col("page_no") * F.lit(options.index_increment)
    absent = wanted.join(pages.select("seed", "page_no"), ["seed", "page_no"], "left_anti")
    # written, so that no error is raised for a page before it is known to be absent
    return stored(absent.select("seed", "page_no", fill_index(F.col("seed"), index).alias("url")), "holes")


def first_holes(pages: DataFrame) -> DataFrame | None:
    """Seeds whose own page was not captured, as page 0: ``seed, page_no, url``; None if there are none."""
    seeds = pages.groupBy("seed").agg(F.max(F.col("url") == F.col("seed")).alias("there"))
    lost, _, n_lost = small_or_not(seeds.filter(~F.col("there")).select("seed"))
    return lost.select("seed", F.lit(0).cast("bigint").alias("page_no"), F.col("seed").alias("url")) if n_lost else None


def chain_holes(facts: DataFrame, chain: DataFrame, options: SourceOptions) -> DataFrame | None:
    """Pages that a chain leads to and that were not captured: ``seed, page_no, url``.

    None if there are none. A chain has one end, so there is at most one such page for a seed; a seed
    whose own page is missing has that one. A next page that is known and cannot be had is missing,
    as it is for a fetch, unless the walk was to end there (``max_pages_per_fetch``). A
    ``partial_capture`` may end anywhere: there a page is missing only if later ones of its seed were captured.
    """
    ends = chain.groupBy("seed").agg(F.max_by(F.struct("url", "captured_no", "page_no", "goes_on"), "page_no").alias("e"))
    seeds = facts.groupBy("seed").agg(F.max("page_no").alias("last"), F.max(F.col("url") == F.col("seed")).alias("there"))
    torn = F.col("e.goes_on")
    if options.max_pages_per_fetch is not None:
        torn = torn & (F.col("e.page_no") + 1 < options.max_pages_per_fetch)
    if options.partial_capture:
        torn = torn & (F.col("last") > F.col("e.captured_no"))
    ends = seeds.join(ends, "seed", "left").filter(~F.col("there") | torn)
    ends, _, n_ends = small_or_not(ends.select("seed", "there", "e.url", (F.col("e.page_no") + 1).alias("following")))
    if not n_ends:
        return None
    first = ends.filter(~F.col("there")).select("seed", F.lit(0).cast("bigint").alias("page_no"), F.col("seed").alias("url"))
    links = facts.join(ends.filter("there"), ["seed", "url"]).select("seed", F.col("following").alias("page_no"), F.col("next_url").alias("url"))
    links, _ = broadcast_if_small(links)
    there = facts.select("seed", "url").join(links, ["seed", "url"], "left_semi").distinct()
    return stored(links.join(there, ["seed", "url"], "left_anti").unionByName(first), "holes")


def hole_entries(holes: DataFrame, options: SourceOptions) -> DataFrame:
    """Missing pages as entries of code 0 under the handling of bad records."""
    record = f"CAST(NULL AS {options.struct.simpleString()}) AS record"
    return holes.selectExpr(
        *KEYS, "CAST(0 AS BIGINT) AS entry_no", record, f"{missing_error('url')} AS error", f"'{options.entry_handling}' AS handling"
    )
