"""Cleaning of station readings, median imputation and per-product capping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.functions import scalars as S
from shelfrisk.operators.ordered import grouped_quantiles, quantiles_of_counts
from shelfrisk.session import TASK_ROWS, attach, broadcast_if_small, materialise, row_count


def clean_readings(df: DataFrame, trim_trace: bool = False) -> DataFrame:
    """Readings as numbers and the date as a date, with its year and month."""
    return (df.withColumns({"date": S.to_day(F.col("date")),
                            "preciptotal": S.rain_amount(F.col("preciptotal"), trim_trace),
                            "tavg": S.to_number(F.col("tavg"))})
            .withColumns({"year": F.year("date"), "month": F.month("date")}))


def add_flags(df: DataFrame) -> DataFrame:
    """Weekend, rain, snow and storm flags; a missing date or code text gives false."""
    return df.withColumns({"is_weekend": S.is_weekend(F.col("date")),
                           "is_rainy_day": S.is_rainy(F.col("codesum")),
                           "is_snowy_day": S.is_snowy(F.col("codesum")),
                           "is_stormy_day": S.is_stormy(F.col("codesum"))})


def reading_counts(df: DataFrame, keys: list[str], columns: list[str], weight: str | None = None) -> DataFrame:
    """(keys, column, value, n) of several numeric columns from one pass over `df`."""
    readings = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                   for c in columns]))
    n = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    long = df.select(*keys, n.alias("n"), readings.alias("r")).select(*keys, "n", "r.column", "r.value")
    return (long.filter(~S.is_missing(F.col("value")))
            .groupBy(*keys, "column", "value").agg(F.sum("n").alias("n")))


def with_medians(df: DataFrame, keys: list[str], columns: list[str], weight: str | None = None,
                 task_rows: int = TASK_ROWS) -> DataFrame:
    """Attach to each row, per column, its group's exact median (`<c>_group`) and the whole table's (`<c>_all`).

    Missing values are left out; a group without values has NULL. With `weight`, a row counts that
    many times. The groups' medians are joined on, so the rows themselves are not shuffled.
    """
    counts = materialise(reading_counts(df, keys, columns, weight))
    whole = counts.groupBy("column", "value").agg(F.sum("n").alias("n")).select(
        *[F.lit(None).cast(counts.schema[k].dataType).alias(k) for k in keys], "column", "value", "n")
    # The whole table is one more group, marked as such because a group's own keys may be NULL.
    levels = counts.withColumn("__whole", F.lit(False)).unionByName(whole.withColumn("__whole", F.lit(True)))
    small = row_count(counts) <= task_rows
    medians = quantiles_of_counts(levels if small else materialise(levels), [*keys, "column", "__whole"],
                                  {"median": 0.5}, task_rows, small=small or None)
    wide = materialise(medians.groupBy(*keys, "__whole").agg(
        *[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"{c}_group") for c in columns]))
    per_group, overall = wide.filter("not __whole").drop("__whole"), wide.filter("__whole")
    joined = attach(df, broadcast_if_small(per_group, rows=row_count(wide)), keys)
    return joined.withColumns({f"{c}_all": overall.select(f"{c}_group").scalar() for c in columns})


def impute_medians(df: DataFrame, keys: list[str], columns: list[str], weight: str | None = None,
                   task_rows: int = TASK_ROWS) -> DataFrame:
    """Fill missing values with the group's median, else with the median of the whole table.

    Medians are taken before filling, see `with_medians`.
    """
    ready = with_medians(df, keys, columns, weight, task_rows)
    filled = {}
    for c in columns:
        value = F.col(c).cast("double")
        filled[c] = F.coalesce(F.when(~S.is_missing(value), value), F.col(f"{c}_group"), F.col(f"{c}_all"))
    return ready.withColumns(filled).drop(*[f"{c}_{side}" for c in columns for side in ("group", "all")])


def upper_caps(df: DataFrame, keys: list[str], value: str, p: float = 0.99, task_rows: int = TASK_ROWS,
               weight: str | None = None) -> DataFrame:
    """The exact `p` quantile of each group as `cap`; with `weight`, a row counts that many times."""
    return materialise(grouped_quantiles(df, keys, value, {"cap": p}, weight, task_rows))


def apply_caps(df: DataFrame, caps: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Add `<value>_capped` and the 0/1 flag `<value>_was_capped`."""
    joined = attach(df, broadcast_if_small(caps), keys)
    return joined.withColumns({f"{value}_capped": S.cap_at(F.col(value), F.col("cap")),
                               f"{value}_was_capped": S.exceeds(F.col(value), F.col("cap"))}).drop("cap")


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows where any of `columns` is NULL or NaN."""
    return df.na.drop(subset=columns)
