"""Exact per-group quantiles without one group's values in one task.

The built-in ``percentile`` merges every distinct value of a group into a single buffer. Here a
group is cut along its value axis into narrow cells (a fixed number per power of two). Cell counts
give the rank at which each cell starts, so only the few cells that contain a wanted rank are looked
into. Those with many values are cut again, evenly between their least and largest value, and only
the parts with a wanted rank are sorted, each on its own. A key with a third of all rows costs many
small cells instead of one huge buffer, values crowded around a point are spread by the second cut,
and repeated values collapse to a count before the first shuffle. Where no cell is crowded, adaptive
execution finds the second cut's input empty and drops it. NaN sorts after every other value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS_PER_OCTAVE = 4096
PARTS_PER_CELL = 4096
CROWDED = 10_000  # values of a cell beyond which it is cut again


def _cell(value: Column, per_octave: int) -> Column:
    # Monotone in the value, and bounded: about 120,000 cells reach from 0 to a billion.
    size = F.log2(F.abs(value) + 1.0) * per_octave
    last = F.lit((1 << 62) - 1)
    cell = F.coalesce(F.floor(F.signum(value) * size).cast("bigint"), F.lit(0))
    return F.when(F.isnan(value.cast("double")), last).otherwise(cell)


def grouped_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    method: str = "linear",
    per_octave: int = CELLS_PER_OCTAVE,
    weight: str | None = None,
    crowded: int = CROWDED,
) -> DataFrame:
    """One row per non-null key with a column per entry of ``probs`` (output name -> probability).

    ``weight`` names a column with the number of times a row counts, above zero.

    ``linear`` interpolates between the two nearest ranks (PERCENTILE_CONT); ``nearest`` takes the
    value at zero-based rank min(floor(n * p), n - 1).
    """
    n, cell, before, total = "_n", "_cell", "_before", "_total"

    def position(p: float) -> Column:
        if method == "linear":
            return (F.col(total) - 1) * F.lit(float(p))
        if method == "nearest":
            return F.least(F.floor(F.col(total) * F.lit(float(p))), F.col(total) - 1).cast("double")
        raise ValueError(f"unknown quantile method: {method}")

    ranks = [side(position(p)) for p in probs.values() for side in (F.floor, F.ceil)]

    # Both uses of the counts must plan alike, null checks included, to share one scan and shuffle.
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, value]])
    counts = (
        df.where(complete)
        .groupBy(*keys, value)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias(n))
        .withColumn(cell, _cell(F.col(value), per_octave))
    )
    by_cell = Window.partitionBy(*keys).orderBy(cell)
    running = by_cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = (
        counts.groupBy(*keys, cell)
        .agg(
            F.sum(n).alias("_cell_n"),
            F.count(F.lit(1)).alias("_values"),
            F.min(value).alias("_low"),
            F.max(value).alias("_high"),
        )
        .withColumn(before, F.sum("_cell_n").over(running) - F.col("_cell_n"))
        .withColumn(total, F.sum("_cell_n").over(Window.partitionBy(*keys)))
    )

    def holds_a_rank(count: str) -> Column:
        inside = [(r >= F.col(before)) & (r < F.col(before) + F.col(count)) for r in ranks]
        return reduce(lambda a, b: a | b, inside)

    targets = cells.where(holds_a_rank("_cell_n")).drop("_cell_n")
    columns = [*keys, cell, "_part", value, n, before, total]

    def within(chosen: DataFrame) -> DataFrame:
        return counts.join(chosen, [*keys, cell])

    sparse = within(targets.where(F.col("_values") <= crowded))
    sparse = sparse.withColumn("_part", F.lit(0).cast("bigint")).select(columns)

    # The second cut. It is monotone in the value, like the first.
    low, high = F.col("_low").cast("double"), F.col("_high").cast("double")
    share = (F.col(value).cast("double") - low) / (high - low)
    part = F.when(high > low, F.floor(F.nanvl(share, F.lit(0.0)) * PARTS_PER_CELL)).otherwise(0)
    dense = within(targets.where(F.col("_values") > crowded))
    dense = dense.withColumn("_part", part.cast("bigint")).select(columns)
    by_part = Window.partitionBy(*keys, cell).orderBy("_part")
    upto_part = by_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = (
        dense.groupBy(*keys, cell, "_part", before, total)
        .agg(F.sum(n).alias("_part_n"))
        .withColumn(before, F.col(before) + F.sum("_part_n").over(upto_part) - F.col("_part_n"))
        .where(holds_a_rank("_part_n"))
        .drop("_part_n")
    )
    dense = dense.drop(before, total).join(parts, [*keys, cell, "_part"]).select(columns)
    in_part = (
        Window.partitionBy(*keys, cell, "_part")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # After a union nothing is known to be dealt by the keys alone, so each part can go its own way.
    ranked = (
        sparse.unionByName(dense)
        .withColumn("_upto", F.col(before) + F.sum(n).over(in_part))
        .withColumn("_from", F.col("_upto") - F.col(n))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_upto")), F.col(value)))

    picks = []
    for i, p in enumerate(probs.values()):
        picks += [
            at(F.floor(position(p))).alias(f"_lo{i}"),
            at(F.ceil(position(p))).alias(f"_hi{i}"),
        ]
    picked = ranked.groupBy(*keys).agg(F.max(total).alias(total), *picks)
    return picked.select(
        *keys,
        *[
            (
                F.col(f"_lo{i}")
                + (position(p) - F.floor(position(p))) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))
            ).alias(name)
            for i, (name, p) in enumerate(probs.items())
        ],
    )
