"""Order statistics without sorting: where a position falls is found by histograms that get finer.

A level counts the rows of every open cell in BINS equal steps between the smallest and the largest
key in it and keeps, for each wanted position, only the step it falls into. Rows outside these steps
are done with. When a cell has one key left, the next key column goes on; when no open cell has more than
FEW rows, these are ordered. What a group's task handles are BINS counts and FEW rows, however large the
group and however many rows share a key; only rows that agree in all keys stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelscope.runtime import stored

BINS, FEW = 1 << 12, 1 << 15


def first_rows(rows: DataFrame, positions: DataFrame, group: str, keys: Sequence[str], value: str | None = None) -> DataFrame:
    """(group, n, hits, cut): for each wanted position n of a group, the sum of ``value`` over its n first rows, and
    the keys of the n-th row as a struct.

    ``rows`` has (group, keys, value); ``keys`` are numeric columns, taken in ascending order, and should tell the
    rows of a group apart. ``positions`` has (group, n) with 1 <= n <= rows of the group, each once.
    Null keys are not allowed. Rows that agree in all keys come in any order.
    """
    names = [f"_k{j}" for j in range(len(keys))]
    total = F.col(value).cast("double") if value else F.lit(0.0)
    start = F.lit(0).cast("bigint")
    left = rows.select(group, *[F.col(k).alias(x) for k, x in zip(keys, names)], total.alias("_v"), start.alias("_cell"))
    n = F.col("n").cast("bigint")
    wanted = positions.select(group, n.alias("n"), start.alias("_cell"), n.alias("_rest"), F.lit(0.0).alias("_sum"))
    first_of = lambda value: F.coalesce(*[F.when(F.col(f"{x}_low") < F.col(f"{x}_high"), value(j, x)) for j, x in enumerate(names)])
    while True:
        ends = [f(x).alias(f"{x}_{end}") for x in names for end, f in (("low", F.min), ("high", F.max))]
        # the first key column that differs inside a cell is cut next
        spans = stored(left.groupBy(group, "_cell").agg(F.count("*").alias("_rows"), *ends).withColumn("_axis", first_of(lambda j, x: F.lit(j))), "selection-spans")
        if not spans.where((F.col("_rows") > FEW) & F.col("_axis").isNotNull()).count():
            break
        share = first_of(lambda j, x: (F.col(x) - F.col(f"{x}_low")) / (F.col(f"{x}_high") - F.col(f"{x}_low")))
        step = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BINS), F.lit(BINS - 1)).cast("bigint")
        binned = left.join(spans, [group, "_cell"]).withColumn("_bin", step).select(group, "_cell", "_bin", *names, "_v")
        counts = binned.groupBy(group, "_cell", "_bin").agg(F.count("*").alias("_n"), F.sum("_v").alias("_s"))
        up_to = Window.partitionBy(group, "_cell").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = counts.withColumns({"_upto": F.sum("_n").over(up_to), "_hits": F.sum("_s").over(up_to)})
        inside = (F.col("_upto") >= F.col("_rest")) & (F.col("_upto") - F.col("_n") < F.col("_rest"))
        found = stored(wanted.join(sums, [group, "_cell"]).where(inside).select(
            group, "n", "_cell", "_bin", F.xxhash64("_cell", "_bin").alias("_next"), (F.col("_rest") - F.col("_upto") + F.col("_n")).alias("_rest"),
            (F.col("_sum") + F.col("_hits") - F.col("_s")).alias("_sum"),
        ), "selection-found")
        open_cells = found.select(group, "_cell", "_bin", "_next").distinct()
        left = stored(binned.join(open_cells, [group, "_cell", "_bin"]).select(group, *names, "_v", F.col("_next").alias("_cell")), "selection-rows")
        wanted = found.select(group, "n", F.col("_next").alias("_cell"), "_rest", "_sum")
    order = Window.partitionBy(group, "_cell").orderBy(*names)
    placed = left.withColumns({"_at": F.row_number().over(order), "_hits": F.sum("_v").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    cut = F.struct(*[F.col(x).alias(k) for k, x in zip(keys, names)]).alias("cut")
    ends = placed.join(wanted, [group, "_cell"]).where(F.col("_at") == F.col("_rest"))
    return ends.select(group, "n", (F.col("_sum") + F.col("_hits")).alias("hits"), cut)
