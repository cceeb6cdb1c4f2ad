"""Exact running totals and quantiles of groups too large for one task.

Rows are first reduced to (keys, value, count). Groups whose distinct values fit one task are
summed by a plain window. Larger ones are cut into value ranges, so each range is its own window
and only the ranges' totals are summed per group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrisk.session import BROADCAST_BYTES, TASK_ROWS, attach, broadcast_if_small, materialise, row_count, stored


def value_counts(df: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """(keys, value, n): how often each present value occurs, counted before the shuffle."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    present = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return present.groupBy(*keys, F.col(value).alias("value")).agg(n.cast("long").alias("n"))


def largest_group(counts: DataFrame, keys: list[str]) -> int:
    return counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).agg(F.max("rows")).first()[0] or 0


def fits_one_task(counts: DataFrame, keys: list[str], task_rows: int = TASK_ROWS) -> bool:
    """Whether no group of `counts` has more than `task_rows` rows."""
    return row_count(counts) <= task_rows or largest_group(counts, keys) <= task_rows


def running_totals(counts: DataFrame, keys: list[str], sums: list[str], order: str = "value",
                   task_rows: int = TASK_ROWS, ranges: int | None = None, small: bool | None = None) -> DataFrame:
    """Add `<s>_upto` and `<s>_all` for each of `sums`, and `next_<order>`, within each group.

    `counts` holds each (keys, order) once. Pass a materialised table unless `small` is known. A group too large for
    one task is cut into `ranges`, by default twice as many as the largest group needs.
    """
    if small is None:
        small = fits_one_task(counts, keys, task_rows)
    if small:
        whole = Window.partitionBy(*keys)
        upto = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return counts.withColumns({
            **{f"{s}_upto": F.sum(s).over(upto) for s in sums},
            **{f"{s}_all": F.sum(s).over(whole) for s in sums},
            f"next_{order}": F.lead(order).over(whole.orderBy(order)),
        })
    ranges = ranges or max(4, -(-2 * largest_group(counts, keys) // task_rows))
    return _ranged_totals(counts, keys, sums, order, ranges)


def _ranged_totals(counts: DataFrame, keys: list[str], sums: list[str], order: str, ranges: int) -> DataFrame:
    # The cuts only balance the work: every value falls in exactly one range whatever they are.
    steps = [i / ranges for i in range(1, ranges)]
    block = math.isqrt(ranges)
    cuts = counts.groupBy(*keys).agg(F.percentile_approx(order, steps, ranges * 20).alias("__cuts"))
    cuts = materialise(cuts.withColumn("__coarse", F.filter("__cuts", lambda _, i: (i + 1) % block == 0)))
    value = F.col(order)
    # Cuts below the value: whole blocks first, then inside the next block.
    blocks = F.size(F.filter("__coarse", lambda cut: cut < value)) * block
    inner = F.size(F.filter(F.slice("__cuts", F.col("__blocks") + 1, F.lit(block - 1)), lambda cut: cut < value))
    ranged = attach(counts, broadcast_if_small(cuts, BROADCAST_BYTES // ranges), keys).withColumn("__blocks", blocks)
    ranged = ranged.withColumn("__range", F.col("__blocks") + inner).drop("__cuts", "__coarse", "__blocks")
    per_range = ranged.groupBy(*keys, "__range").agg(
        *[F.sum(s).alias(f"__{s}") for s in sums], F.min(order).alias("__first"))
    group = Window.partitionBy(*keys)
    in_order = group.orderBy("__range")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(per_range.select(
        *keys, "__range",
        *[F.coalesce(F.sum(f"__{s}").over(before), F.lit(0)).alias(f"{s}_before") for s in sums],
        *[F.sum(f"__{s}").over(group).alias(f"{s}_all") for s in sums],
        F.lead("__first").over(in_order).alias("__next")))
    inside = Window.partitionBy(*keys, "__range")
    upto = inside.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumns({
        **{f"{s}_upto": F.sum(s).over(upto) for s in sums},
        f"next_{order}": F.lead(order).over(inside.orderBy(order)),
    })
    joined = attach(summed, broadcast_if_small(offsets), [*keys, "__range"], "inner")
    return joined.withColumns({
        **{f"{s}_upto": F.col(f"{s}_upto") + F.col(f"{s}_before") for s in sums},
        f"next_{order}": F.coalesce(F.col(f"next_{order}"), F.col("__next")),
    }).drop("__range", "__next", *[f"{s}_before" for s in sums])


def quantiles_of_counts(counts: DataFrame, keys: list[str], probs: dict[str, float], task_rows: int = TASK_ROWS,
                        ranges: int | None = None, small: bool | None = None) -> DataFrame:
    """One row per group with an exact, linearly interpolated quantile for each of `probs`."""
    totals = running_totals(counts, keys, ["n"], task_rows=task_rows, ranges=ranges, small=small)
    bounds = []
    for name, p in probs.items():
        position = (F.col("n_all") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            bounds.append(F.min(F.when(F.col("n_upto") > rank, F.col("value"))).alias(f"__{name}_{side}"))
    picked = totals.groupBy(*keys).agg(F.max("n_all").alias("__n"), *bounds)
    return picked.select(*keys, *[_interpolated(name, p).alias(name) for name, p in probs.items()])


def _interpolated(name: str, p: float) -> Column:
    position = (F.col("__n") - 1) * F.lit(float(p))
    low, high = F.col(f"__{name}_lo").cast("double"), F.col(f"__{name}_hi").cast("double")
    share = position - F.floor(position)
    return low * (1 - share) + high * share


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                      weight: str | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Exact quantiles of `value` per group; missing values are ignored (see `value_counts`)."""
    counts = materialise(value_counts(df, keys, value, weight))
    return quantiles_of_counts(counts, keys, probs, task_rows)


def placed(df: DataFrame, order: list[str | Column], name: str = "place", task_rows: int = TASK_ROWS // 4) -> DataFrame:
    """Add every row's place in `order`, counted from 1; equal rows get neighbouring places in any order.

    Rows are dealt over tasks by range and sorted there; what earlier tasks hold is added. No task sorts more than
    its range: equal rows, however many, are dealt on by their number in the stored table.
    """
    table = stored(df)
    tasks = max(1, -(-row_count(table) // task_rows))
    tie = table.withColumn("__tie", F.monotonically_increasing_id())
    ranged = tie.repartitionByRange(tasks, *order, "__tie").sortWithinPartitions(*order, "__tie").drop("__tie")
    # The id's upper bits are the task, its lower 33 bits the place inside it; stored, so that it stays as it is.
    numbered = materialise(ranged.withColumn("__spot", F.monotonically_increasing_id()))
    task = F.shiftright("__spot", 33)
    earlier = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    before = (numbered.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__rows"))
              .select("__task", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before")))
    joined = numbered.withColumn("__task", task).join(F.broadcast(before), "__task")
    place = F.col("__before") + F.col("__spot").bitwiseAND((1 << 33) - 1) + 1
    return joined.withColumn(name, place).drop("__task", "__before", "__spot")
