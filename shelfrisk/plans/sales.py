"""Sales reports over a folder of the provided tables; each function is one registered query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrisk.operators import cleaning as C
from shelfrisk.operators import linear as L
from shelfrisk.operators import metrics as M
from shelfrisk.operators import ordered as O
from shelfrisk.operators import profile as Q
from shelfrisk.operators import sales as A
from shelfrisk.operators import split as P
from shelfrisk.operators import tree as R
from shelfrisk.sources import files, views
from shelfrisk.session import materialise

PREDICTORS = ["tavg", "preciptotal", *A.FLAGS]
# The linear model names a true/false predictor after its true level.
TERM_NAMES = {p: "is_weekendTRUE" if p == "is_weekend" else p for p in PREDICTORS}
LINEAR, TREE = "Linear Regression", "Decision Tree"
TOP = 3
# Cuts lie half-way between values of 6 digits.
CUT_DIGITS = 8


def _inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return views.sales(spark, folder), views.stores(spark, folder), views.weather(spark, folder)


def table_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of all attached tables, by SQL over the catalog's list."""
    files.attach_folder(spark, folder, views.TABLES, prefix="shelf_")
    names = [n for n in files.list_tables(spark) if n.startswith("shelf_")]
    sizes = files.query(spark, " union all ".join(
        f"select '{n.removeprefix('shelf_')}' as table_name, count(*) as n_rows from {n}" for n in names))
    files.detach(spark, names)
    return sizes


def top_products(spark: SparkSession, folder: str) -> DataFrame:
    return A.top_products(views.sales(spark, folder), TOP)


def ranked_products(spark: SparkSession, folder: str) -> DataFrame:
    """All products with their place by units."""
    units = A.units_by_product(views.sales(spark, folder))
    return O.placed(units, [F.desc("total_units_sold"), "item_nbr"])


def nth_top_product(spark: SparkSession, folder: str) -> DataFrame:
    return A.nth_product(views.sales(spark, folder), 2)


def sales_weather_join(spark: SparkSession, folder: str) -> DataFrame:
    return A.joined_table(*_inputs(spark, folder))


def daily_units_and_temp(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(A.daily_units(*_inputs(spark, folder)), ["avg_tavg"])


def daily_units_and_temp_untyped(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(A.daily_units(*_inputs(spark, folder), n=2, non_numeric="zero"), ["avg_tavg"])


def daily_units_placed(spark: SparkSession, folder: str) -> DataFrame:
    """Days of the best-selling product with their place by date."""
    return O.placed(daily_units_and_temp(spark, folder), ["date"])


def clean_precip(spark: SparkSession, folder: str) -> DataFrame:
    sales, stores, weather = _inputs(spark, folder)
    readings = C.clean_readings(weather.select("station_nbr", "date", "preciptotal", "tavg"))
    return A.with_readings(sales, stores, readings).select(
        "item_nbr", "store_nbr", "date", "station_nbr", "preciptotal", "tavg", "year", "month")


def match_counts(spark: SparkSession, folder: str) -> DataFrame:
    return A.match_counts(*_inputs(spark, folder))


def station_month_medians(spark: SparkSession, folder: str) -> DataFrame:
    """Each station-day's group and whole-table medians, as the joined rows would see them."""
    clean = A.clean_weather(*_inputs(spark, folder))
    medians = C.with_medians(clean, ["station_nbr", "month"], ["preciptotal", "tavg"], weight="n_sales")
    return medians.select("station_nbr", F.col("day").alias("date"), "preciptotal", "tavg", "preciptotal_group",
                          "preciptotal_all", "tavg_group", "tavg_all")


def impute_station_month(spark: SparkSession, folder: str) -> DataFrame:
    return A.imputed_sales(*_inputs(spark, folder)).select(
        "item_nbr", "store_nbr", "date", "station_nbr", "month", "preciptotal", "tavg")


def cap_units_p99(spark: SparkSession, folder: str) -> DataFrame:
    capped = A.capped_sales(*_inputs(spark, folder)).select(
        "item_nbr", "store_nbr", "date", "units", "units_capped", "units_was_capped")
    return _rounded(capped, ["units_capped"])


def weather_flags(spark: SparkSession, folder: str) -> DataFrame:
    sales, stores, weather = _inputs(spark, folder)
    flagged = C.add_flags(weather.select("station_nbr", "date", "codesum"))
    return A.with_readings(sales, stores, flagged).select("item_nbr", "store_nbr", "date", *A.FLAGS)


def product_day(spark: SparkSession, folder: str) -> DataFrame:
    return _day_digits(A.product_day_table(*_inputs(spark, folder)))


def first_product_days(spark: SparkSession, folder: str) -> DataFrame:
    return files.first_rows(product_day(spark, folder).orderBy("item_nbr", "date"))


def profile_joined(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(Q.profile_join(*_inputs(spark, folder)), ["mean", "sd", "complete_rate"], 6)


def column_listing(spark: SparkSession, folder: str) -> DataFrame:
    return Q.listing_of_join(*_inputs(spark, folder))


def split_membership(spark: SparkSession, folder: str) -> DataFrame:
    return P.random_split(product_day(spark, folder), ["item_nbr", "date"]).select("item_nbr", "date", "split")


def exact_split_membership(spark: SparkSession, folder: str) -> DataFrame:
    days = materialise(product_day(spark, folder).select("item_nbr", "date"))
    return P.exact_split(days, ["item_nbr", "date"])


def model_days(spark: SparkSession, folder: str) -> DataFrame:
    """Product-days of the top products with their split, stored because every model reads them."""
    sales, stores, weather = _inputs(spark, folder)
    days = A.product_day_table(sales, stores, weather, A.top_products(sales, TOP))
    return materialise(P.random_split(_day_digits(days), ["item_nbr", "date"]))


def train_days(days: DataFrame) -> DataFrame:
    return days.filter(F.col("split") == "train")


def held_out(days: DataFrame) -> DataFrame:
    return days.filter(F.col("split") == "test")


def units_by_flag(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(A.units_by_flag(train_days(model_days(spark, folder))), ["avg_units"])


def units_by_flag_chosen(spark: SparkSession, folder: str) -> DataFrame:
    """The chart's own product list, whatever the top products are."""
    chosen = spark.createDataFrame([(5,), (9,), (45,)], "item_nbr int")
    days = _day_digits(A.product_day_table(*_inputs(spark, folder), chosen))
    return _rounded(A.units_by_flag(train_days(P.random_split(days, ["item_nbr", "date"]))), ["avg_units"])


def temp_trend(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(A.temperature_trend(train_days(model_days(spark, folder))), ["slope", "intercept", "r2"])


def _linear(days: DataFrame) -> DataFrame:
    return L.fit_linear(train_days(days), "item_nbr", "units", PREDICTORS)


def _tree(days: DataFrame, max_depth: int = 30) -> R.TreeModel:
    return R.fit_trees(train_days(days), "item_nbr", "units", PREDICTORS, max_depth=max_depth)


def _linear_scores(days: DataFrame, models: DataFrame) -> DataFrame:
    predicted = L.predict_linear(held_out(days), models, "item_nbr", PREDICTORS)
    return _scores(models.filter("full_rank"), predicted, LINEAR)


def _tree_scores(days: DataFrame, model: R.TreeModel) -> DataFrame:
    return _scores(model.nodes.filter("node = 1"), R.predict_trees(held_out(days), model), TREE)


def _scores(models: DataFrame, predicted: DataFrame, name: str) -> DataFrame:
    scores = M.scores_of_models(models, predicted, ["item_nbr"], "units", "prediction")
    return _rounded(scores.select("item_nbr", F.lit(name).alias("model"), "R2", "RMSE", "MAE"), ["R2", "RMSE", "MAE"])


def ols_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    models = _linear(model_days(spark, folder))
    return _rounded(L.coefficient_rows(models, "item_nbr", TERM_NAMES, with_intercept=True), ["value"])


def ols_metrics(spark: SparkSession, folder: str) -> DataFrame:
    days = model_days(spark, folder)
    return _linear_scores(days, _linear(days))


def ols_status(spark: SparkSession, folder: str) -> DataFrame:
    """Why products have no linear model: each is fitted to so few days that flags are constant or rows too few for some."""
    days = product_day(spark, folder).filter("month(date) = 1 and day(date) <= item_nbr % 8 + 1")
    models = L.fit_linear(days, "item_nbr", "units", PREDICTORS)
    defined = sum((F.col(f"b_{p}").isNotNull().cast("int") for p in PREDICTORS[1:]), F.col(f"b_{PREDICTORS[0]}").isNotNull().cast("int"))
    return models.select("item_nbr", "n", "status", defined.alias("n_defined"))


def tree_root_split(spark: SparkSession, folder: str) -> DataFrame:
    nodes = _tree(model_days(spark, folder), max_depth=1).nodes
    splits = nodes.filter(F.col("feature").isNotNull()).select("item_nbr", "n", "mean", "feature", "cut", "gain")
    return _rounded(_rounded(splits, ["mean", "gain"]), ["cut"], CUT_DIGITS)


def tree_nodes(spark: SparkSession, folder: str) -> DataFrame:
    nodes = _tree(model_days(spark, folder)).nodes
    listed = nodes.select("item_nbr", "node", "n", "mean", "feature", "cut")
    return _rounded(_rounded(listed, ["mean"]), ["cut"], CUT_DIGITS)


def tree_metrics(spark: SparkSession, folder: str) -> DataFrame:
    days = model_days(spark, folder)
    return _tree_scores(days, _tree(days))


def fit_models(days: DataFrame) -> tuple[DataFrame, R.TreeModel]:
    """Both models of every product; comparison and impact are read from the same fit."""
    return _linear(days), _tree(days)


def comparison(days: DataFrame, linear: DataFrame, tree: R.TreeModel) -> DataFrame:
    return _linear_scores(days, linear).unionByName(_tree_scores(days, tree))


def impact(linear: DataFrame, tree: R.TreeModel) -> DataFrame:
    """Coefficients and importances per product with their place: strongest first, equal ones by name."""

    def labelled(rows: DataFrame, model: str, kind: str) -> DataFrame:
        return rows.select("item_nbr", F.lit(model).alias("model"), "variable", F.lit(kind).alias("metric_type"),
                           F.col("value"))

    both = labelled(L.coefficient_rows(linear, "item_nbr", TERM_NAMES), LINEAR, "Coefficient").unionByName(
        labelled(R.importance_rows(tree), TREE, "Importance"))
    return O.placed(_rounded(both, ["value"]), ["item_nbr", "model", "metric_type", F.desc(F.abs("value")), "variable"])


def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    days = model_days(spark, folder)
    return comparison(days, *fit_models(days))


def impact_summary(spark: SparkSession, folder: str) -> DataFrame:
    return impact(*fit_models(model_days(spark, folder)))


def _day_digits(days: DataFrame) -> DataFrame:
    """Product-days as both engines agree on them: sums and means of doubles depend on the order of the rows."""
    return _rounded(days, ["units", "tavg", "preciptotal"], 6)


def _rounded(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


QUERIES = [table_sizes, top_products, ranked_products, nth_top_product, sales_weather_join, daily_units_and_temp,
           daily_units_placed, daily_units_and_temp_untyped, clean_precip, match_counts, station_month_medians,
           impute_station_month, cap_units_p99, weather_flags, product_day,
           first_product_days, profile_joined, column_listing, split_membership, exact_split_membership, units_by_flag,
           units_by_flag_chosen, temp_trend, ols_coefficients, ols_metrics, ols_status, tree_root_split, tree_nodes, tree_metrics,
           model_comparison, impact_summary]
