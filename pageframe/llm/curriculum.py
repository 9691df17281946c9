"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pageframe.functions.lineage import stored
from pageframe.llm.rows import WORD, packed

WEIGHTS = (1.0, 2.0, 3.0)
MOST_EPOCHS = 3
#: Relative weight of a source over the training time 0 to 1, as (time, weight) knots with straight
#: lines between them; sources take them in turn. Light sources fade out, heavy ones grow.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (0.5, 1.25), (1.0, 0.75)), ((0.0, 0.5), (1.0, 1.5)))


def inverse(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the integral of the schedule reaches ``share`` (0 to 1) of its whole."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
    whole, before, out = sum(areas), 0.0, F.lit(float(knots[-1][0]))
    pieces = []
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        pieces.append((before, before + area, t0, t1, w0, (w1 - w0) / (t1 - t0)))
        before += area
    for low, high, t0, t1, w0, slope in reversed(pieces):
        rest = share * whole - low
        # w0 t + slope t^2 / 2 = rest, solved in the form that also holds for a slope of 0
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        time = F.when(w0 + root == 0, F.lit(t0)).otherwise(F.lit(t0) + 2 * rest / (F.lit(w0) + root))
        out = F.when(share * whole <= high, F.least(time, F.lit(t1))).otherwise(out)
    return out


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, kind, target) of each source of ``sizes`` (source, source_size).

    Sources by code point, null last, take the weights in turn and share the sum of all sizes; a
    target stops at ``most`` times its source, and the excess is shared by weight among the others.
    The shares follow one level: target = min(most * size, level * weight). The level is found by
    rounds of two sums, each of which closes a source at least.
    """
    order = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    kind = ((F.row_number().over(order) - 1) % len(weights)).alias("kind")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("kind") + 1)
    table = stored(sizes.select("source", "source_size", kind).withColumn("weight", weight), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, closed = 0.0, -1
    while True:
        full = F.lit(level) * F.col("weight") > F.col("source_size") * most if closed >= 0 else F.lit(False)
        got = table.agg(
            F.sum(F.when(full, F.col("source_size") * most).otherwise(0.0)).alias("stopped"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weights"),
            F.sum(full.cast("int")).alias("closed"),
        ).first()
        if not got["weights"] or got["closed"] == closed:
            break
        closed, level = got["closed"], (total - got["stopped"]) / got["weights"]
    target = F.least(F.col("source_size") * F.lit(float(most)), F.lit(level) * F.col("weight"))
    return table.select("source", "source_size", "kind", target.alias("target"))


def schedule(docs: DataFrame, keep: Sequence[str] | None = None, schedules: Sequence = SCHEDULES, **kw) -> DataFrame:
    """All rows of ``docs`` (struct ``row`` of the columns ``keep``, else of all) with size, source_size, target, copies and ``positions``.

    A source is read in the order of md5(doc_id), of the text where there is no id, again from its start for a second and third
    epoch, until its demand, the target, is used up; a copy is taken if its middle lies before that.
    Its place in the whole training is where the integral of the source's schedule reaches the
    share of the demand used up before it: ``positions`` has one value from 0 to 1 for each copy.

    Running sums are taken in 4,096 parts of each source by the first digits of the hash, so that
    no task sees a whole source. Null texts have size 0, null sources count as one source,
    repeated rows count each, and rows of size 0 are taken 0 or more times at no
    cost. Empty tables give no rows. Reruns agree.
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.coalesce("text", F.lit("")))))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    carried = packed(docs.select(*keep) if keep else docs)
    rows = docs.select(carried, size.alias("size"), F.col("source").alias("source"), digest.alias("digest"))
    rows = rows.withColumn("part", F.substring("digest", 1, 3))
    parts = stored(rows.groupBy("source", "part").agg(F.sum("size").alias("n")), "parts")
    table = stored(targets(parts.groupBy("source").agg(F.sum("n").alias("source_size")), **kw), "targets")
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    bases = bases.alias("b").join(table.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
    bases = bases.select(F.col("b.source").alias("source"), "part", "base", "source_size", "kind", "target")
    bases = bases.withColumnsRenamed({"source": "_s", "part": "_p"})
    joined = rows.join(bases, rows["source"].eqNullSafe(bases["_s"]) & (rows["part"] == bases["_p"]))
    inside = W.partitionBy("_s", "_p").orderBy("digest", "size").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = joined.withColumn("start", start)
    half = F.col("start") + F.col("size") / 2
    epochs = F.array(*[F.lit(e) for e in range(MOST_EPOCHS)])
    copies = F.filter(epochs, lambda e: half + e * F.col("source_size") < F.col("target"))

    def position(e: Column) -> Column:
        share = F.when(F.col("target") > 0, (F.col("start") + e * F.col("source_size")) / F.col("target")).otherwise(F.lit(0.0))
        share = F.least(share, F.lit(1.0))
        out = inverse(share, schedules[-1])
        for k, knots in enumerate(schedules[:-1]):
            out = F.when(F.col("kind") % len(schedules) == k, inverse(share, knots)).otherwise(out)
        return out

    return placed.select("row", "size", "source_size", "target", F.size(copies).alias("copies"), F.transform(copies, position).alias("positions"))


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, positions, ...) range-sorted by their first position; rows that are not taken come last."""
    order = F.get("positions", F.lit(0)).asc_nulls_last(), F.xxhash64("doc_id").asc()
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The training set: each document as often as it is taken, range-sorted by position, columns of ``docs``."""
    taken = schedule(docs, **kw).select("row", F.explode("positions").alias("position"))
    return taken.repartitionByRange("position", F.xxhash64("row.doc_id")).sortWithinPartitions("position").select("row.*")
