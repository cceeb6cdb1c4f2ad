"""Sales joined with the readings of the store's station, and what is counted from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.functions import scalars as S
from shelfrisk.operators import cleaning as C
from shelfrisk.session import (CHEAP_ROWS, TASK_ROWS, broadcast_if_small, fits_broadcast, materialise, row_count,
                               stored)

# The input's reading columns, in its order.
READINGS = ["tmax", "tmin", "tavg", "depart", "dewpoint", "wetbulb", "heat", "cool", "sunrise", "sunset", "codesum",
            "snowfall", "preciptotal", "stnpressure", "sealevel", "resultspeed", "resultdir", "avgspeed"]
NEEDED = ["station_nbr", "date", "tavg", "preciptotal", "codesum"]
JOINED = ["date", "store_nbr", "item_nbr", "units", "station_nbr", *READINGS]
FLAGS = ["is_weekend", "is_rainy_day", "is_snowy_day", "is_stormy_day"]


def units_by_product(sales: DataFrame) -> DataFrame:
    return sales.groupBy("item_nbr").agg(F.sum("units").cast("double").alias("total_units_sold"))


def ranked_products(sales: DataFrame) -> DataFrame:
    """All products by total units, largest first; equal totals by product number."""
    return units_by_product(sales).orderBy(F.desc("total_units_sold"), "item_nbr")


def top_products(sales: DataFrame, k: int = 3) -> DataFrame:
    return ranked_products(sales).limit(k)


def nth_product(sales: DataFrame, n: int) -> DataFrame:
    """The product at place `n`, counted from 1."""
    return ranked_products(sales).offset(n - 1).limit(1)


def only_products(df: DataFrame, products: DataFrame) -> DataFrame:
    """Rows of the given products; best given a stored top-k, whose few rows are broadcast."""
    rows = row_count(products)
    return df.join(broadcast_if_small(products.select("item_nbr"), rows=rows), "item_nbr", "left_semi")


def with_station(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Add each sale's station; sales of stores without one are dropped."""
    lookup = ["store_nbr", "station_nbr"]
    # A stored table knows its size.
    return sales.join(broadcast_if_small(stores if stores.columns == lookup else stores.select(*lookup)), "store_nbr")


def with_readings(sales: DataFrame, stores: DataFrame, weather: DataFrame) -> DataFrame:
    """Sales with the readings of their station and day; unmatched sales are dropped.

    Select only the needed columns of `weather` first: it is broadcast when they fit. It is stored, so that counting
    it does not work it out twice.
    """
    return with_station(sales, stores).join(broadcast_if_small(stored(weather)), ["station_nbr", "date"])


def joined_table(sales: DataFrame, stores: DataFrame, weather: DataFrame) -> DataFrame:
    return with_readings(sales, stores, weather).select(*JOINED)


def daily_units(sales: DataFrame, stores: DataFrame, weather: DataFrame, n: int = 1,
                non_numeric: str = "ignore") -> DataFrame:
    """Units and mean temperature per day of the `n`-th best-selling product, by date.

    Text temperatures are left out of the mean, or count as the number they start with, else 0,
    with `non_numeric="zero"`.
    """
    number = S.leading_number if non_numeric == "zero" else S.to_number
    readings = weather.select("station_nbr", "date", number(F.col("tavg")).alias("tavg"))
    product = nth_product(sales, n).select("item_nbr").scalar()
    return (with_readings(sales.filter(F.col("item_nbr") == product), stores, readings)
            .groupBy("date", "item_nbr")
            .agg(F.sum("units").cast("double").alias("daily_units_sold"), F.avg("tavg").alias("avg_tavg"))
            .orderBy("date"))


def sales_per_station_day(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Number of sale rows per station and day."""
    lookup = stores.select("store_nbr", "station_nbr")
    if fits_broadcast(lookup):
        placed = sales.join(F.broadcast(lookup), "store_nbr").withColumn("n", F.lit(1))
    else:
        # Too many stores to send around: count per store before the rows move.
        per_store = sales.groupBy("store_nbr", "date").agg(F.count(F.lit(1)).alias("n"))
        placed = per_store.join(lookup, "store_nbr")
    return placed.groupBy("station_nbr", "date").agg(F.sum("n").alias("n_sales"))


def match_counts(sales: DataFrame, stores: DataFrame, weather: DataFrame) -> DataFrame:
    """One row: sale rows in all, rows the join keeps, rows it drops for want of a station or reading."""
    days = weather.select("station_nbr", "date").distinct()
    kept = sales_per_station_day(sales, stores).join(days, ["station_nbr", "date"], "left_semi")
    total = sales.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = kept.agg(F.coalesce(F.sum("n_sales"), F.lit(0)).cast("long").alias("n_matched"))
    return counts.select(total.alias("n_sales"), "n_matched", (total - F.col("n_matched")).alias("n_dropped"))


def sale_tallies(sales: DataFrame, stores: DataFrame, days: DataFrame,
                 products: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(station_nbr, date, n_sales) and (item_nbr, units, n) of the sales that a reading matches, from one pass.

    `days` has n_readings per station_nbr and date; `n` counts joined rows, one per sale and reading. Both are counted
    before the shuffle, which carries a row per task and different key, not the sales. With `products`, only their units are
    counted, but the sales of all: medians come from all sales.
    """
    placed = with_station(sales, stores).join(days, ["station_nbr", "date"])
    if products is not None:
        named = products.select("item_nbr").distinct().withColumn("__named", F.lit(True))
        placed = placed.join(broadcast_if_small(named, rows=row_count(products)), "item_nbr", "left")
        # The others share one group without product and units.
        placed = placed.withColumns({c: F.when(F.col("__named"), F.col(c)) for c in ("item_nbr", "units")})
    else:
        placed = placed.withColumn("__named", F.lit(True))
    sets = [["station_nbr", "date"], ["__named", "item_nbr", "units"]]
    counted = materialise(placed.groupingSets(sets, *sets[0], *sets[1]).agg(
        F.grouping("__named").alias("by_day"), F.count(F.lit(1)).alias("n_sales"), F.sum("n_readings").alias("n")))
    return (counted.filter("by_day = 1").select("station_nbr", "date", "n_sales"),
            counted.filter("by_day = 0 and __named").select("item_nbr", "units", "n"))


def clean_weather(sales: DataFrame, stores: DataFrame, weather: DataFrame) -> DataFrame:
    """Stored clean readings of each station and day with sales: `day` as joined on, `n_sales`, readings."""
    return _clean_of(sales_per_station_day(sales, stores), weather)


def _clean_of(per_day: DataFrame, weather: DataFrame) -> DataFrame:
    needed = weather.select("station_nbr", F.col("date").alias("day"), *NEEDED[1:])
    return materialise(C.clean_readings(needed.join(per_day, ["station_nbr", "date"])))


def imputed_weather(sales: DataFrame, stores: DataFrame, weather: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Clean readings and flags per station and day, gaps filled by station-month medians.

    A reading counts once per sale it is joined to, so filling the small readings table gives the
    values that filling the joined rows would give. Readings without any sale are dropped.
    """
    return _filled(clean_weather(sales, stores, weather), task_rows)


def _filled(clean: DataFrame, task_rows: int) -> DataFrame:
    filled = C.impute_medians(clean, ["station_nbr", "month"], ["preciptotal", "tavg"], weight="n_sales",
                              task_rows=task_rows)
    readings = C.add_flags(filled).select("station_nbr", F.col("day").alias("date"), "tavg", "preciptotal", "month",
                                          *FLAGS)
    # Several joins read the result. Filling adds no rows, so a small one may be sent around as it is.
    if row_count(clean) > CHEAP_ROWS:
        return broadcast_if_small(materialise(readings))
    return broadcast_if_small(readings, rows=row_count(clean))


def imputed_sales(sales: DataFrame, stores: DataFrame, weather: DataFrame, products: DataFrame | None = None,
                  task_rows: int = TASK_ROWS) -> DataFrame:
    """Joined rows (of `products`, if given) with clean, filled readings and flags."""
    readings = imputed_weather(sales, stores, weather, task_rows)
    wanted = sales if products is None else only_products(sales, products)
    return with_station(wanted, stores).join(readings, ["station_nbr", "date"])


def capped_sales(sales: DataFrame, stores: DataFrame, weather: DataFrame, products: DataFrame | None = None,
                 task_rows: int = TASK_ROWS) -> DataFrame:
    """`imputed_sales` with units capped at the product's 99th percentile over the joined rows.

    With `products`, only their rows are kept; medians still come from all sales. The sales are read twice: once to count
    what medians and caps need, once for the result, which meets the finished readings and caps. No copy of them is stored.
    """
    # Both passes read the products: rank them once.
    chosen = None if products is None else stored(products)
    stores, needed = materialise(stores.select("store_nbr", "station_nbr")), materialise(weather.select(*NEEDED))
    days = needed.groupBy("station_nbr", "date").agg(F.count(F.lit(1)).alias("n_readings"))
    per_day, units = sale_tallies(sales, stores, broadcast_if_small(days, rows=row_count(needed)), chosen)
    readings = _filled(_clean_of(per_day, needed), task_rows)
    caps = C.upper_caps(units, ["item_nbr"], "units", task_rows=task_rows, weight="n")
    wanted = sales if chosen is None else only_products(sales, chosen)
    joined = with_station(wanted, stores).join(readings, ["station_nbr", "date"])
    return C.apply_caps(joined, caps, ["item_nbr"], "units")


def product_days(capped: DataFrame) -> DataFrame:
    """One row per product and day: capped units summed, readings averaged, any-flag; no gaps left."""
    rolled = (capped.withColumn("date", S.to_day(F.col("date"))).groupBy("item_nbr", "date")
              .agg(F.coalesce(F.sum("units_capped"), F.lit(0.0)).alias("units"),
                   F.avg("tavg").alias("tavg"),
                   F.avg("preciptotal").alias("preciptotal"),
                   F.any_value("is_weekend").alias("is_weekend"),
                   *[F.max(F.col(f).cast("int")).alias(f) for f in FLAGS[1:]]))
    return C.drop_missing(rolled, ["units", "tavg", "preciptotal", *FLAGS])


def product_day_table(sales: DataFrame, stores: DataFrame, weather: DataFrame, products: DataFrame | None = None,
                      task_rows: int = TASK_ROWS) -> DataFrame:
    """Product-days of capped units and filled readings, from the two passes of `capped_sales`."""
    return product_days(capped_sales(sales, stores, weather, products, task_rows))


def units_by_flag(days: DataFrame) -> DataFrame:
    """Mean units per product and value of the weekend, rain and snow flags, in one pass."""
    flags = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).cast("int").alias("value"))
                                for f in FLAGS[:3]]))
    # The weekend flag is a truth value, the others are 0 or 1.
    truth = F.upper(F.col("f.value").cast("boolean").cast("string"))
    label = F.when(F.col("f.flag") == FLAGS[0], truth).otherwise(S.group_label(F.col("f.value")))
    return (days.select("item_nbr", "units", flags.alias("f"))
            .groupBy("item_nbr", F.col("f.flag").alias("flag"), label.alias("flag_value"))
            .agg(F.avg("units").alias("avg_units")))


def temperature_trend(days: DataFrame) -> DataFrame:
    """Straight-line fit of units on temperature per product; NULL where temperature is constant."""
    return days.groupBy("item_nbr").agg(
        F.regr_slope("units", "tavg").alias("slope"), F.regr_intercept("units", "tavg").alias("intercept"),
        F.regr_r2("units", "tavg").alias("r2"), F.count(F.lit(1)).alias("n_days"))
