"""Repeatable random splits and folds that depend on row keys only, not on file layout."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrisk.session import BROADCAST_BYTES, TASK_ROWS, attach, broadcast_if_small, materialise, row_count

# Rows of one digest prefix, about: what one task sorts.
PREFIX_ROWS = TASK_ROWS // 16


def row_digest(keys: list[str], seed: str = "") -> Column:
    """md5 of the row's keys, as hex text; a missing key and a separator inside a key are written so that they
    differ from any other keys."""
    parts = []
    for key in keys:
        text = F.replace(F.replace(F.col(key).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        parts.append(F.coalesce(text, F.lit("\\N")))
    return F.md5(F.concat(F.lit(seed), F.concat_ws("|", *parts)))


def _check_share(share: float) -> None:
    if not 0 <= share <= 1:
        raise ValueError(f"share must lie in 0..1, not {share}")


def _prefix_digits(rows: int) -> int:
    """Hex digits of the digest that cut `rows` rows into prefixes of about PREFIX_ROWS."""
    return max(1, math.ceil(math.log(max(1, rows / PREFIX_ROWS), 16)))


def random_split(df: DataFrame, keys: list[str], share: float = 0.8, seed: str = "") -> DataFrame:
    """Add `split`: 'train' for about `share` of the rows, picked by digest, else 'test'."""
    _check_share(share)
    number = F.conv(F.substring(row_digest(keys, seed), 1, 8), 16, 10).cast("long")
    return df.withColumn("split", F.when(number < F.lit(round(share * 16**8)), F.lit("train")).otherwise(F.lit("test")))


def exact_split(df: DataFrame, keys: list[str], share: float = 0.8, seed: str = "") -> DataFrame:
    """Add `split` with exactly `floor(share * rows)` training rows: those with the lowest digests.

    `keys` must identify a row, so digests do not tie. The digests are stored once and counted by prefix; only the
    prefix in which the cut lies is sorted. The input is read twice: for its digests and for the result.
    """
    _check_share(share)
    digests = materialise(df.select(row_digest(keys, seed).alias("digest")))
    rows = row_count(digests)
    wanted, digits = math.floor(share * rows), _prefix_digits(rows)
    marked = df.withColumn("__digest", row_digest(keys, seed))
    if wanted == rows:
        return marked.withColumn("split", F.lit("train")).drop("__digest")
    prefix = F.substring("digest", 1, digits)
    counts = digests.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(Window.orderBy("prefix"))  # one row per prefix
    last = counts.withColumn("upto", upto).filter(F.col("upto") > wanted).orderBy("prefix").first()
    inside = wanted - (last.upto - last.rows)
    edge = digests.filter(prefix == last.prefix).orderBy("digest").limit(inside).agg(F.max("digest")).first()[0]
    # Without a digest of that prefix, all lower prefixes train.
    train = F.col("__digest") <= F.lit(edge) if edge else F.col("__digest") < F.lit(last.prefix)
    return marked.withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("test"))).drop("__digest")


def hashed_folds(df: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """Add `fold` 0..k-1 from the row's digest: no shuffle, fold sizes only about equal."""
    number = F.conv(F.substring(row_digest(keys), 1, 8), 16, 10).cast("long")
    return df.withColumn("fold", (number % k).cast("int"))


def stratified_folds(df: DataFrame, target: str, row_id: str, k: int = 5, task_rows: int = TASK_ROWS) -> DataFrame:
    """Add `fold` 0..k-1 so that every class and the whole table are spread evenly (within one row).

    Rows of a class are ranked by digest and cut into k runs. The rank is the row's place inside
    its digest prefix plus the rows of lower prefixes, so a class is never sorted in one task. The input is read once.
    """
    placed = materialise(df.withColumn("__digest", row_digest([row_id])))
    prefix = F.conv(F.substring("__digest", 1, _prefix_digits(row_count(placed))), 16, 10).cast("long")
    placed_in = placed.withColumn("__prefix", prefix)
    per_prefix = materialise(placed_in.groupBy(target, "__prefix").agg(F.count(F.lit(1)).alias("rows")))
    lower_prefixes = Window.partitionBy(target).orderBy("__prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_prefix.select(
        F.col(target), "__prefix", F.coalesce(F.sum("rows").over(lower_prefixes), F.lit(0)).alias("__before"))
    bounds = _class_bounds(per_prefix.groupBy(target).agg(F.sum("rows").alias("rows")), target, k, row_count(per_prefix), task_rows)
    inside = Window.partitionBy(target, "__prefix").orderBy("__digest", row_id)
    ranked = placed_in.withColumn("__place", F.row_number().over(inside) - 1)
    ranked = attach(ranked, broadcast_if_small(offsets, rows=row_count(per_prefix)), [target, "__prefix"], "inner")
    ranked = attach(ranked, broadcast_if_small(bounds, BROADCAST_BYTES // k, rows=row_count(per_prefix)), [target], "inner")
    rank = F.col("__before") + F.col("__place")
    fold = sum(((F.col(f"__end{i}") <= rank).cast("int") for i in range(1, k)), (F.col("__end0") <= rank).cast("int"))
    return ranked.withColumn("fold", fold).drop("__digest", "__prefix", "__place", "__before", *[f"__end{i}" for i in range(k)])


def _class_bounds(per_class: DataFrame, target: str, k: int, most: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """End rank `__end<i>` of each fold per class. Odd rows go round the folds from one class to the next.

    `most` bounds the number of classes. If one task should not add them up, they are dealt over tasks by range: each task
    adds up its own, and the tasks' totals shift the rest.
    """
    if most <= task_rows:
        earlier = Window.orderBy(target).rowsBetween(Window.unboundedPreceding, -1)
        shifted = per_class.withColumn("start", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    else:
        dealt = materialise(per_class.repartitionByRange(-(-most // task_rows), target).withColumn("__task", F.spark_partition_id()))
        totals = dealt.groupBy("__task").agg(F.sum("rows").alias("__rows"))
        earlier = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
        totals = totals.select("__task", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__shift"))
        lower = Window.partitionBy("__task").orderBy(target).rowsBetween(Window.unboundedPreceding, -1)
        shifted = (attach(dealt.withColumn("start", F.coalesce(F.sum("rows").over(lower), F.lit(0))), totals, ["__task"])
                   .withColumn("start", F.col("start") + F.col("__shift")))
    # Place j of the class-sorted table belongs to fold j % k: count the places below each end.
    below = [F.floor((F.col("start") + F.col("rows") + k - 1 - i) / k) - F.floor((F.col("start") + k - 1 - i) / k)
             for i in range(k)]
    ends, total = [], F.lit(0)
    for i, size in enumerate(below):
        total = total + size
        ends.append(total.alias(f"__end{i}"))
    return shifted.select(target, *ends)
