"""Column profile of a table from exact value counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrisk.operators.ordered import quantiles_of_counts
from shelfrisk.operators.schema import quoted
from shelfrisk.operators.sales import JOINED, READINGS, sales_per_station_day, with_readings, with_station
from shelfrisk.session import TASK_ROWS, materialise, row_count

QUANTILES = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}


def profile(df: DataFrame, columns: list[str] | None = None, weight: str | None = None,
            task_rows: int = TASK_ROWS) -> DataFrame:
    """One row per column: type, rows, missing, complete rate; mean, sd and quartiles of numbers;
    lengths, empties, blanks and distinct values of text. Dates and flags are profiled as text.

    Each column's values are counted before the shuffle and everything is taken from those counts.
    With `weight`, a row stands for that many rows.
    """
    fields = [f for f in df.schema if (f.name in columns if columns else f.name != weight)]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in fields if not isinstance(f.dataType, T.NumericType)]
    counts = _counts(df, numeric, text, weight)
    parts = []
    if numeric:
        parts.append(_numbers(counts.filter(F.col("column").isin(numeric)).select("column", F.col("number").alias("value"), "n"), task_rows,
                              row_count(counts) <= task_rows))
    if text:
        parts.append(_texts(counts.filter(F.col("column").isin(text)).select("column", F.col("text").alias("value"), "n")))
    types = F.create_map(*[x for f in fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    joined = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    if not numeric:
        joined = joined.withColumns({c: F.lit(None).cast("double") for c in ("mean", "sd", *QUANTILES)})
    if not text:
        joined = joined.withColumns({c: F.lit(None).cast("long") for c in TEXT_COLUMNS})
    return joined.select(
        "column", F.element_at(types, F.col("column")).alias("dtype"), "n_rows", "n_missing",
        (F.col("n_rows") - F.col("n_missing")).alias("non_null"),
        (1 - F.col("n_missing") / F.col("n_rows")).alias("complete_rate"),
        "mean", "sd", *QUANTILES, *TEXT_COLUMNS)


TEXT_COLUMNS = ["min_length", "max_length", "empty", "n_unique", "whitespace"]


def _counts(df: DataFrame, numeric: list[str], text: list[str], weight: str | None) -> DataFrame:
    """Stored (column, number, text, n): how often each value of each column occurs, from one pass over `df`."""
    n = F.lit(1) if weight is None else F.col(weight)
    no_number, no_text = F.lit(None).cast("double").alias("number"), F.lit(None).cast("string").alias("text")
    # NaN counts as missing.
    cells = [F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("number"), no_text) for c in numeric]
    cells += [F.struct(F.lit(c).alias("column"), no_number, F.col(c).cast("string").alias("text")) for c in text]
    long = df.select(n.cast("long").alias("n"), F.explode(F.array(*cells)).alias("c")).select("n", "c.*")
    return materialise(long.groupBy("column", "number", "text").agg(F.sum("n").alias("n")))


def _numbers(counts: DataFrame, task_rows: int, small: bool) -> DataFrame:
    present = F.col("value").isNotNull()
    sizes = counts.groupBy("column").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("n_missing"),
        F.sum(F.col("value") * F.col("n")).alias("total"))
    sizes = sizes.withColumn("mean", F.try_divide(F.col("total"), F.col("n_rows") - F.col("n_missing"))).drop("total")
    filled = counts.filter(present)
    # One row per profiled column, so both broadcasts are bounded by the schema.
    apart = filled.join(F.broadcast(sizes.select("column", "mean")), "column")
    squares = apart.groupBy("column").agg(
        F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), F.lit(2))).alias("ss"), F.sum("n").alias("m"))
    spread = squares.select("column", F.sqrt(F.try_divide(F.col("ss"), F.col("m") - 1)).alias("sd"))
    quartiles = quantiles_of_counts(filled if small else materialise(filled), ["column"], QUANTILES, task_rows, small=small or None)
    return sizes.join(F.broadcast(spread), "column", "left").join(F.broadcast(quartiles), "column", "left")


def _texts(counts: DataFrame) -> DataFrame:
    value, n = F.col("value"), F.col("n")
    blank = value.rlike(r"^\s+$")
    return counts.groupBy("column").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("n_missing"),
        F.min(F.length(value)).cast("long").alias("min_length"), F.max(F.length(value)).cast("long").alias("max_length"),
        F.coalesce(F.sum(F.when(value == "", n)), F.lit(0)).alias("empty"),
        F.count(value).alias("n_unique"),
        F.coalesce(F.sum(F.when(blank, n)), F.lit(0)).alias("whitespace"))


def profile_join(sales: DataFrame, stores: DataFrame, weather: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Profile of `joined_table` without widening the sales: each side is weighted by its matches and read once."""
    days = weather.groupBy("station_nbr", "date").agg(F.count(F.lit(1)).alias("n_readings"))
    matched = with_readings(sales, stores, materialise(days))
    per_sale = profile(matched, ["date", "store_nbr", "item_nbr", "units"], "n_readings", task_rows)
    counted = weather.join(sales_per_station_day(sales, stores), ["station_nbr", "date"])
    per_reading = profile(counted, ["station_nbr", *READINGS], "n_sales", task_rows)
    return per_sale.unionByName(per_reading)


def listing_of_join(sales: DataFrame, stores: DataFrame, weather: DataFrame) -> DataFrame:
    """`column_listing` of `joined_table`, whose rows are never made: each station and day has so many sales, with so many values
    per column, and every reading of it meets them all."""
    per_sale = [c for c in JOINED if c not in ("station_nbr", *READINGS)]
    own = [c for c in per_sale if c != "date"]
    per_day = with_station(sales, stores).groupBy("station_nbr", "date").agg(
        F.count(F.lit(1)).alias("__sales"), *[F.count(c).alias(f"__{c}") for c in own])
    met = weather.join(per_day, ["station_nbr", "date"])
    types = {f.name: f.dataType.simpleString() for f in [*weather.schema, *sales.schema]}
    totals = {c: F.sum(f"__{c}") if c in own else F.sum(F.when(F.col(c).isNotNull(), F.col("__sales"))) for c in JOINED}
    counts = met.agg(*[F.coalesce(total, F.lit(0)).alias(c) for c, total in totals.items()])
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null"), F.lit(types[c]).alias("dtype")) for c in JOINED]
    return counts.select(F.inline(F.array(*cells)))


def column_listing(df: DataFrame) -> DataFrame:
    """Non-missing count and type of each column, from one aggregate."""
    counts = df.agg(*[F.count(quoted(f.name)).alias(f.name) for f in df.schema])
    cells = [F.struct(F.lit(f.name).alias("column"), quoted(f.name).alias("non_null"),
                      F.lit(f.dataType.simpleString()).alias("dtype")) for f in df.schema]
    return counts.select(F.inline(F.array(*cells)))
