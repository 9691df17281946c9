"""Chains of captured pages: which pages a walk along the next links reaches, and in which order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageframe.functions.lineage import counted, fresh_path, remove, stored
from pageframe.functions.skew import HOT_ROWS, broadcast_if_small, lookup, small_or_not
from pageframe.plans.captures import page_id

# Page numbers of a seed that one window looks at, and the most pages it may hold.
BLOCK = 4096


def resolve_chains(facts: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Pages reached from each seed's first URL: ``seed, url, captured_no, page_no, n_entries, goes_on``.

    A walk goes on from a page that has entries and a next URL; it ends at a page without
    entries, at a link to a page that was not captured, and where it comes back to a page
    already reached. ``page_no`` counts the steps from the first page.

    Stretches captured in order are contracted to their heads first. The walk over the heads
    is done by pointer doubling: each round joins along the pointers once, which takes all
    reached heads on to what they point at and doubles the pointers. A chain of ``n`` heads
    takes about log2(n) rounds over 16-byte keys instead of ``n`` dependent steps. Each round
    is written to the shared folder, counted on the way, and the one before is deleted.
    """
    me, following = page_id(F.col("seed"), F.col("url")), page_id(F.col("seed"), F.col("next_url"))
    goes_on = (F.col("n_entries") > 0) & F.col("next_url").isNotNull()
    rows = facts.select(
        me.alias("id"),
        F.struct(
            F.col("page_no").alias("captured_no"),
            (F.col("url") == F.col("seed")).alias("is_first"),
            F.when(goes_on, following).alias("next"),
            "n_entries",
            "seed",
            "url",
        ).alias("page"),
    )
    # a URL captured several times counts once; min combines before the shuffle
    pages = stored(rows.groupBy("id").agg(F.min("page").alias("page")).select("id", "page.*"), "pages")
    members = stored(_stretches(pages), "members")
    state = members.groupBy(F.col("head").alias("id")).agg(
        F.max(F.when(F.col("is_first"), F.lit(0).cast("bigint"))).alias("pos"),
        F.max_by("next", "offset").alias("next"),
        (F.max("offset") + 1).alias("span"),
    )
    spark, reached = facts.sparkSession, {"reached": "pos IS NOT NULL"}
    path = fresh_path(spark, "state")
    state, n = counted(state, path, **reached)
    step, n_heads = 1, n["rows"]
    while step < n_heads:
        before, left_behind, path = n, path, fresh_path(spark, "state")
        state, n = counted(_advance(state, hot_rows if n_heads > hot_rows else None), path, **reached)
        remove(spark, left_behind)
        if n["reached"] == before["reached"]:
            break
        step *= 2
    heads = state.filter(F.col("pos").isNotNull()).select(F.col("id").alias("head"), "pos")
    reached = members.join(heads, "head").select("id", (F.col("pos") + F.col("offset")).alias("page_no"))
    return pages.join(reached, "id").select("seed", "url", "captured_no", "page_no", "n_entries", F.col("next").isNotNull().alias("goes_on"))


def _stretches(pages: DataFrame) -> DataFrame:
    """Contract pages that were captured in link order: ``id, head, offset, is_first, next``.

    A stretch is a run of pages of one seed and one block of page numbers, each naming the
    one behind it. A first page, and a page that several pages name, always begins one, so
    that every pointer leads to the head of a stretch. Pages of a block with more of them than
    numbers, as their numbers repeat, are a stretch each, so that no window exceeds a block.
    """
    pages = pages.withColumn("block", F.floor(F.coalesce("captured_no", F.lit(-1)) / F.lit(BLOCK)))
    wide, _, n_wide = small_or_not(pages.groupBy("seed", "block").count().filter(F.col("count") > BLOCK).select("seed", "block"))
    inside, single = pages, []
    if n_wide:
        alone = pages.join(wide, ["seed", "block"], "left_semi")
        single.append(alone.select("id", F.col("id").alias("head"), F.lit(0).cast("bigint").alias("offset"), "is_first", "next"))
        inside = pages.join(wide, ["seed", "block"], "left_anti")
    named = pages.filter(F.col("next").isNotNull()).groupBy(F.col("next").alias("id")).count()
    crowded = named.filter(F.col("count") > 1).select("id", F.lit(True).alias("crowded"))
    in_block = Window.partitionBy("seed", "block").orderBy("captured_no", "id")
    follows = F.lag("next").over(in_block).eqNullSafe(F.col("id"))
    begins = F.col("is_first") | F.coalesce("crowded", F.lit(False)) | ~follows
    numbered = inside.join(crowded, "id", "left").withColumn("stretch", F.sum(begins.cast("int")).over(in_block))
    in_stretch = Window.partitionBy("seed", "block", "stretch").orderBy("captured_no", "id")
    runs = numbered.select(
        "id",
        F.first("id").over(in_stretch).alias("head"),
        (F.row_number().over(in_stretch) - 1).cast("bigint").alias("offset"),
        "is_first",
        "next",
    )
    return reduce(DataFrame.unionByName, single, runs)


def _advance(state: DataFrame, hot_rows: int | None) -> DataFrame:
    """One round over ``id, pos, next, span``: a pointer leads ``span`` pages ahead.

    Reached heads take what they point at to its position; then pointers are joined end to end.
    """
    pointing = state.filter(F.col("next").isNotNull())
    ahead = state.select(F.col("id").alias("next"), F.col("next").alias("after"), F.col("span").alias("further"))
    # many pages may point at one page, so that page is a hot key of this join
    pairs = pointing.join(ahead, "next") if hot_rows is None else lookup(pointing, ahead, "next", F.col("id"), hot_rows)
    no_number, no_pointer = F.lit(None).cast("bigint"), F.lit(None).cast("binary")
    moved = F.array(
        F.struct(
            F.col("id").alias("id"), no_number.alias("pos"), F.col("after").alias("next"),
            (F.col("span") + F.col("further")).alias("span"),
        ),
        F.struct(
            F.col("next").alias("id"), (F.col("pos") + F.col("span")).alias("pos"), no_pointer.alias("next"),
            no_number.alias("span"),
        ),
    )
    moved = pairs.select(F.inline(F.filter(moved, lambda m: m["pos"].isNotNull() | m["next"].isNotNull())))
    kept = state.select("id", "pos", no_pointer.alias("next"), no_number.alias("span"))
    # a page reached before keeps its first position, which is where a loop ends
    return kept.unionByName(moved).groupBy("id").agg(
        F.min("pos").alias("pos"), F.max("next").alias("next"), F.max("span").alias("span")
    )


def missing_links(facts: DataFrame, chain: DataFrame) -> DataFrame:
    """Links from reached pages to pages that were not captured: ``seed, page_no, url``."""
    leaving = chain.join(
        facts.filter((F.col("n_entries") > 0) & F.col("next_url").isNotNull()).select("seed", "url", "next_url"),
        ["seed", "url"],
    ).select("seed", (F.col("page_no") + 1).alias("page_no"), F.col("next_url").alias("url"))
    return leaving.join(facts.select("seed", "url"), ["seed", "url"], "left_anti")


def pages_on_chain(responses: DataFrame, chain: DataFrame) -> DataFrame:
    """Responses of the reached pages, numbered along their chain.

    A reached set counted to be small is broadcast and bodies stay where they are; otherwise
    both sides meet on ``seed, url, page number``, a key of one page each, so no task gets
    more than its share. Responses bucketed by ``seed, url`` need no exchange there.
    """
    keys = chain.select("seed", "url", F.col("captured_no").alias("_captured"), F.col("page_no").alias("_pos"))
    keys, _ = broadcast_if_small(keys)
    joined = responses.withColumnRenamed("page_no", "_captured").join(keys, ["seed", "url", "_captured"])
    return joined.withColumn("page_no", F.col("_pos")).select(*responses.columns)
