"""Mixing sources to target weights along a time-varying curriculum.

Sizes are word counts. Sources in code point order, null last, take the weights in turn; the
targets share all words by weight, stop at ``most`` times a source's size, and pass the excess
on by weight until none is above. With T the total, that is min(cap, level * weight) where
level is the largest (T - caps of the k sources of smallest cap / weight) / (weights of the
rest) over k: a closed form, no iteration.

Each source also has a schedule: piecewise linear weight over training time 0..1. Its integral,
scaled to the target, is the source's cumulative token demand. A source's documents are read in
the order of a hash of their id, again and again until the target is met; the last reading
ends in the middle of a document where the words run out. Inverting the demand at the words
read so far gives the time at which a placement is trained on.

Running sums are taken in two steps (per cell of the hash order, then inside a cell), so a
source with a third of all rows is no single group. The order is that of a hash of id and text, so rows that
share an id, or have none, spread over the cells too; the cells get finer with the corpus, to some PER_CELL
rows each. The number of sources is that of a class table.

A null text has size 0 and is taken 0 times. Repeated rows are separate documents. A null
doc_id counts as an empty id, and sorts first among equal hashes. Rows that agree in id and text are read one after the other. Extra columns pass through ``assign`` only when named in ``keep``.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelscope.llm.quality import words_of
from labelscope.runtime import stored

WEIGHTS = (5, 2, 1)
MOST = 3
#: Rows of a cell of the reading order, about.
PER_CELL = 1 << 12
#: (time, weight) knots per entry of WEIGHTS: heavy sources early, light ones late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def reading_order() -> Column:
    """32 bits of a digest of id and text."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("_digest"))), 1, 8), 16, 10).cast("long")


def sized(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", F.col("source").alias("source"), *keep,
        F.size(words_of(text)).cast("long").alias("size"), F.md5(text).alias("_digest"),
    ).withColumn("_order", reading_order())


def target_table(cells: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, slot (entry of the weights), target; one row per source."""
    sources = cells.groupBy("source").agg(F.sum("_words").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))  # one row per source
    number = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    named = sources.withColumn("slot", F.pmod(number, F.lit(len(weights)))).withColumn(
        "_weight", F.element_at(F.array(*map(F.lit, weights)), F.col("slot") + 1).cast("long")
    )
    by_cap = everything.orderBy(most * F.col("source_size") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("_weight").over(rest)
    return (
        named.withColumn("_level", level).withColumn("_level", F.max("_level").over(everything))
        .select("source", "source_size", "slot", F.least(
            (most * F.col("source_size")).cast("double"), F.col("_level") * F.col("_weight")
        ).alias("target"))
    )


def time_of(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which the integral of the piecewise linear weight reaches ``share`` of its total."""
    areas = [(b - a) * (u + v) / 2 for (a, u), (b, v) in zip(knots, knots[1:])]
    total, done, result = sum(areas), 0.0, F.lit(knots[-1][0])
    pieces = []
    for ((a, u), (b, v)), area in zip(zip(knots, knots[1:]), areas):
        pieces.append((a, u, (v - u) / (b - a), done / total, (done + area) / total))
        done += area
    for a, u, slope, low, high in reversed(pieces):
        if high <= low:
            continue
        due = (share - low) * total
        step = due / u if slope == 0 else (F.sqrt(F.greatest(F.lit(0.0), u * u + 2 * slope * due)) - u) / slope
        result = F.when(share <= high, a + step).otherwise(result)
    return result


def assign(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, schedules=SCHEDULES, most: int = MOST, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, before, readings, position.

    ``taken`` words are read in ``readings`` passes (the last perhaps in part); ``before`` words
    of the source come ahead of the document in a pass; ``position`` is the time of its first
    reading, null if it has none.
    """
    rows = stored(sized(docs, keep), "sizes")
    fine = max(1, -(-rows.count() // PER_CELL)).bit_length()
    rows = rows.withColumn("_cell", F.shiftright("_order", max(0, 32 - fine)))
    cells = stored(rows.groupBy("source", "_cell").agg(F.sum("size").alias("_words")), "cells")
    ahead = Window.partitionBy("source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_offset", F.coalesce(F.sum("_words").over(ahead), F.lit(0)))
    plan = target_table(cells, weights, most)
    named = offsets.join(plan, offsets.source.eqNullSafe(plan.source)).select(
        offsets.source.alias("_source"), offsets["_cell"].alias("_in"), "_offset", "source_size", "slot", "target"
    )
    inside = Window.partitionBy("source", "_cell").orderBy("_order", F.col("doc_id").asc_nulls_first(), "_digest", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("_within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(named, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_cell") == F.col("_in")))
        .withColumn("before", F.col("_offset") + F.col("_within"))
    )
    due = F.round("target").cast("long")
    placed = placed.withColumn("_full", F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0))
    rest = F.greatest(F.lit(0), F.least(F.col("size"), due - F.col("_full") * F.col("source_size") - F.col("before")))
    placed = placed.withColumn("_rest", rest).withColumn("taken", F.col("_full") * F.col("size") + F.col("_rest"))
    return (
        placed.withColumn("readings", (F.col("_full") + (F.col("_rest") > 0).cast("long")))
        .withColumn("readings", F.when(F.col("size") > 0, F.col("readings")).otherwise(0))
        .withColumn("position", F.when(F.col("readings") > 0, position(F.col("before"), schedules)))
        .select("doc_id", "source", *keep, "size", "source_size", "target", "taken", "before", "slot", "readings", "position")
    )


def in_training_order(assigned: DataFrame) -> DataFrame:
    """The rows of ``assign`` range-sorted by position; documents without a reading come last."""
    order = [F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_first()]
    return assigned.repartitionByRange(*order).sortWithinPartitions(*order)


def position(words: Column, schedules) -> Column:
    """Time at which a source has been asked for ``words`` words."""
    share = words / F.col("target")
    cases = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        cases = F.when(F.col("slot") == k, time_of(share, knots)).otherwise(cases)
    return cases


def placements(assigned: DataFrame, schedules=SCHEDULES) -> DataFrame:
    """One row per reading of a document, range-sorted by position; ``words`` of the text are due."""
    each = assigned.where("readings > 0").withColumn("reading", F.explode(F.sequence(F.lit(0).cast("long"), F.col("readings") - 1)))
    each = each.withColumn("words", F.least(F.col("size"), F.col("taken") - F.col("reading") * F.col("size")))
    each = each.withColumn("position", position(F.col("reading") * F.col("source_size") + F.col("before"), schedules))
    return each.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id", "reading")
