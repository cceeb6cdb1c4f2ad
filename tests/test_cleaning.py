import datetime
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrisk.functions import scalars as S
from shelfrisk.operators import cleaning as C
from shelfrisk.operators import ordered as O
from shelfrisk.operators import profile as Q
from shelfrisk.operators import sales as A
from shelfrisk.operators import split as P
from shelfrisk import session as SS

day = datetime.date


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_rain_text(spark):
    texts = ["T", "", "M", "  T", " 0.10", "1d", None]
    assert column(spark, texts, "string", S.rain_amount) == [0.002, None, None, None, 0.10, None, None]
    assert column(spark, ["  T"], "string", lambda c: S.rain_amount(c, trim_trace=True)) == [0.002]


def test_numbers_and_days(spark):
    assert column(spark, ["5", " -1.5e2 ", "M", "1f", "nan", ""], "string", S.to_number) == [5, -150, None, None, None, None]
    assert column(spark, ["M", "50", "12x", None], "string", S.leading_number) == [0.0, 50.0, 12.0, None]
    texts = ["2024-01-06", "x", None, "2024/01/06", "2024-1-6 10:00", "2024", "2024-01", "2024-01/06", "2024-02-30", "2024-01-066"]
    assert column(spark, texts, "string", S.to_day) == [day(2024, 1, 6), None, None, day(2024, 1, 6), day(2024, 1, 6), *[None] * 5]
    nan, inf = float("nan"), float("inf")
    assert column(spark, [1.0, None, nan, inf], "double", S.is_finite) == [True, False, False, False]
    assert column(spark, [1.0, None, nan, inf], "double", S.is_missing) == [False, True, True, False]


def test_flags(spark):
    codes = [None, "", "tsra", "+FC", "FZDZ", "SN"]
    assert column(spark, codes, "string", S.is_rainy) == [False, False, True, False, True, False]
    assert column(spark, codes, "string", S.is_snowy) == [False, False, False, False, False, True]
    assert column(spark, codes, "string", S.is_stormy) == [False, False, True, True, False, False]
    days = [day(2024, 1, 6), day(2024, 1, 7), day(2024, 1, 8), None]
    assert column(spark, days, "date", S.is_weekend) == [True, True, False, False]


def test_impute_takes_group_then_whole_median(spark):
    rows = spark.createDataFrame([("A", 1.0), ("A", None), ("A", 3.0), ("B", None), ("C", 10.0), (None, float("nan")),
                                  (None, 4.0)], "g string, x double")
    filled = C.impute_medians(rows.filter("g is not null"), ["g"], ["x"]).groupBy("g").agg(F.sort_array(F.collect_list("x")))
    assert {r[0]: r[1] for r in filled.collect()} == {"A": [1, 2, 3], "B": [3], "C": [10]}
    # A missing key is a group of its own.
    null_group = C.impute_medians(rows, ["g"], ["x"]).filter("g is null")
    assert sorted(r["x"] for r in null_group.collect()) == [4.0, 4.0]


def test_weights_stand_for_repeated_rows(spark):
    rows = spark.createDataFrame([("A", 1.0, 5), ("A", 9.0, 2), ("A", None, 1)], "g string, x double, n int")
    repeated = rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n", "k")
    weighted = C.impute_medians(rows, ["g"], ["x"], weight="n").filter("n = 1").first()["x"]
    assert weighted == 1.0
    assert {r["x"] for r in C.impute_medians(repeated, ["g"], ["x"]).collect()} == {1.0, 9.0}


def test_cap_at_p99(spark):
    rows = spark.createDataFrame([(1, float(u)) for u in range(1, 11)] + [(1, None), (2, 7.0)], "item int, u double")
    caps = C.upper_caps(rows, ["item"], "u")
    assert {r["item"]: round(r["cap"], 9) for r in caps.collect()} == {1: 9.91, 2: 7.0}
    capped = {r["u"]: r for r in C.apply_caps(rows, caps, ["item"], "u").filter("item = 1").collect()}
    assert capped[10.0]["u_capped"] == pytest.approx(9.91) and capped[10.0]["u_was_capped"] == 1
    assert capped[9.0]["u_capped"] == 9.0 and capped[9.0]["u_was_capped"] == 0
    assert capped[None]["u_capped"] is None and capped[None]["u_was_capped"] is None


@pytest.mark.parametrize("task_rows", [1_000_000, 10])
def test_quantiles_are_exact_on_both_paths(spark, task_rows):
    pick = random.Random(3)
    rows = [("hot", pick.gauss(0, 1)) for _ in range(3000)] + [("hot", 0.5)] * 500 + [("cold", float(i)) for i in range(4)]
    rows += [("one", 2.0), ("gap", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = {"low": 0.0, "q": 0.37, "median": 0.5, "p99": 0.99, "top": 1.0}
    found = {r["g"]: r for r in O.grouped_quantiles(df, ["g"], "x", probs, task_rows=task_rows).collect()}
    assert set(found) == {"hot", "cold", "one", None}
    for g, r in found.items():
        values = [x for k, x in rows if k == g and x is not None]
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(values, p), abs=1e-12)


@pytest.mark.parametrize("task_rows", [1_000_000, 10])
def test_running_totals(spark, task_rows):
    rows = [("a", float(i), (i * 7) % 5 + 1) for i in range(500)] + [("b", 1.0, 4)]
    df = spark.createDataFrame(rows, "g string, value double, n long")
    got = {(r["g"], r["value"]): r for r in O.running_totals(df, ["g"], ["n"], task_rows=task_rows, ranges=16).collect()}
    total, everything = 0, sum(n for g, _, n in rows if g == "a")
    for g, value, n in rows[:-1]:
        total += n
        r = got[(g, value)]
        assert (r["n_upto"], r["n_all"]) == (total, everything)
        assert r["next_value"] == (value + 1 if value < 499 else None)
    assert got[("b", 1.0)]["next_value"] is None and len(got) == len(rows)


def test_product_days_keep_tiny_amounts(spark):
    row = (1, datetime.date(2024, 1, 1), 4e-7, 1.0, 1e-9, False, False, False, False)
    columns = ["item_nbr", "date", "units_capped", "tavg", "preciptotal", *A.FLAGS]
    (only,) = A.product_days(spark.createDataFrame([row], columns)).collect()
    assert (only.units, only.preciptotal) == (4e-7, 1e-9)


def test_product_days_rules(spark):
    schema = ("item_nbr int, date date, units_capped double, tavg double, preciptotal double, is_weekend boolean, "
              "is_rainy_day boolean, is_snowy_day boolean, is_stormy_day boolean")
    d = day(2024, 1, 6)
    rows = [(1, d, None, 50.0, 0.1, True, False, True, False), (1, d, None, 60.0, 0.3, True, True, False, False),
            (2, d, 5.0, None, 0.1, True, False, False, False)]
    (only,) = A.product_days(spark.createDataFrame(rows, schema)).collect()
    assert (only["item_nbr"], only["units"], only["tavg"], only["preciptotal"]) == (1, 0.0, 55.0, 0.2)
    assert (only["is_weekend"], only["is_rainy_day"], only["is_snowy_day"], only["is_stormy_day"]) == (True, 1, 1, 0)


@pytest.fixture(scope="module")
def shop(spark):
    pick = random.Random(5)
    days = [day(2024, 1, 1) + datetime.timedelta(n) for n in range(60)]
    sales = [(pick.choice(days), pick.randint(1, 4), pick.choice([1, 1, 1, 2, 3]), float(pick.randint(0, 30)))
             for _ in range(900)]
    weather = [(s, d, pick.choice(["M", "40", "55.5", "61"]), pick.choice(["", "T", "0.3", "M", "1.25"]),
                pick.choice(["RA", "SN", "", None])) for s in (10, 20) for d in days[:50]]
    return (spark.createDataFrame(sales, "date date, store_nbr int, item_nbr int, units double"),
            spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "store_nbr int, station_nbr int"),
            spark.createDataFrame(weather, "station_nbr int, date date, tavg string, preciptotal string, codesum string"))


def test_imputing_the_station_table_equals_imputing_joined_rows(shop):
    sales, stores, weather = shop
    joined = C.clean_readings(A.with_readings(sales, stores, weather)).drop("codesum", "year")
    direct = C.impute_medians(joined, ["station_nbr", "month"], ["preciptotal", "tavg"])
    columns = ["date", "store_nbr", "item_nbr", "units", "station_nbr", "preciptotal", "tavg", "month"]
    ours = A.imputed_sales(sales, stores, weather).select(columns)
    assert sorted(map(str, ours.collect())) == sorted(map(str, direct.select(columns).collect()))


def rounded(days):
    """Rows as text; sums and means of doubles depend on the order of the rows."""
    return sorted(map(str, days.withColumns({c: F.round(c, 9) for c in ("units", "tavg", "preciptotal")}).collect()))


def test_large_tables_take_the_shuffle_path_with_the_same_result(shop, monkeypatch):
    sales, stores, weather = shop
    usual = rounded(A.product_day_table(sales, stores, weather, task_rows=20))
    for module in (A, C, O, SS):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df, *_, **__: df)
    monkeypatch.setattr(A, "fits_broadcast", lambda *_, **__: False)
    monkeypatch.setattr(A, "CHEAP_ROWS", 10)
    assert rounded(A.product_day_table(sales, stores, weather)) == usual


def test_medians_come_from_all_products(shop):
    sales, stores, weather = shop
    top = A.top_products(sales, 1)
    part = rounded(A.product_day_table(sales, stores, weather, top))
    whole = rounded(A.product_day_table(sales, stores, weather).join(top, "item_nbr", "left_semi"))
    assert sorted(map(str, part)) == sorted(map(str, whole))


def test_tallies_count_joined_rows(shop):
    """Also where a station and day has two readings."""
    sales, stores, weather = shop
    twice = weather.unionByName(weather.filter("station_nbr = 10 and day(date) = 3"))
    joined = A.with_readings(sales, stores, twice)
    days = twice.groupBy("station_nbr", "date").agg(F.count(F.lit(1)).alias("n_readings"))
    per_day, units = A.sale_tallies(sales, stores, days)
    assert sorted(map(tuple, units.collect())) == sorted(map(tuple, joined.groupBy("item_nbr", "units").count().collect()))
    single = A.with_readings(sales, stores, weather).groupBy("station_nbr", "date").count()
    assert sorted(map(tuple, per_day.collect())) == sorted(map(tuple, single.collect()))
    chosen = A.materialise(A.top_products(sales, 1))
    some_day, some = A.sale_tallies(sales, stores, days, chosen)
    assert sorted(map(tuple, some_day.collect())) == sorted(map(tuple, per_day.collect()))
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, units.join(chosen, "item_nbr", "left_semi").collect()))


def test_product_days_read_the_sales_twice_and_store_no_copy(spark, shop):
    sales, stores, weather = shop
    sales = A.materialise(sales.withColumn("item_nbr", F.col("item_nbr") % 2))
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def watched(units):
        read.add(1)
        return units

    before = len(SS._STORED)
    table = A.product_day_table(sales.withColumn("units", watched("units")), stores, weather)
    assert read.value == sales.count()
    stored = sum(spark.read.parquet(path).count() for path in SS._STORED[before:])
    table.collect()
    assert read.value == 2 * sales.count()
    assert stored < sales.count()


def test_daily_units(spark, shop):
    sales = spark.createDataFrame([(day(2024, 1, 1), 1, 7, 2.0), (day(2024, 1, 1), 2, 7, 3.0)],
                                  "date date, store_nbr int, item_nbr int, units double")
    stores = spark.createDataFrame([(1, 10), (2, 20)], "store_nbr int, station_nbr int")
    weather = spark.createDataFrame([(10, day(2024, 1, 1), "M"), (20, day(2024, 1, 1), "50")],
                                    "station_nbr int, date date, tavg string")
    assert tuple(A.daily_units(sales, stores, weather).first()) == (day(2024, 1, 1), 7, 5.0, 50.0)
    assert A.daily_units(sales, stores, weather, non_numeric="zero").first()["avg_tavg"] == 25.0


def test_profile(spark):
    rows = [(1.0, "a", None, 2), (2.0, "", True, 1), (None, " ", False, 1), (float("nan"), None, True, 1)]
    df = spark.createDataFrame(rows, "x double, t string, b boolean, n int")
    got = {r["column"]: r for r in Q.profile(df, ["x", "t", "b"]).collect()}
    x, t = got["x"], got["t"]
    assert (x["n_rows"], x["n_missing"], x["non_null"], x["mean"], x["p50"], x["p100"]) == (4, 2, 2, 1.5, 1.5, 2.0)
    assert x["sd"] == pytest.approx(statistics.stdev([1, 2])) and x["dtype"] == "double"
    assert (t["n_missing"], t["min_length"], t["max_length"], t["empty"], t["n_unique"], t["whitespace"]) == (1, 0, 1, 1, 3, 1)
    assert got["b"]["n_unique"] == 2 and got["b"]["complete_rate"] == 0.75
    weighted = {r["column"]: r for r in Q.profile(df, weight="n").collect()}
    assert weighted["x"]["n_rows"] == 5 and weighted["x"]["mean"] == pytest.approx(4 / 3)


def test_profile_of_join_equals_profile_of_joined_rows(spark, shop):
    sales, stores, weather = shop
    for c in A.READINGS:
        if c not in weather.columns:
            weather = weather.withColumn(c, F.lit(1.5))
    joined = A.joined_table(sales, stores, weather)
    rounded = lambda df: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())
    assert rounded(Q.profile_join(sales, stores, weather)) == rounded(Q.profile(joined))


def test_profile_reads_its_input_once(spark, shop):
    sales, _, _ = shop
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def watched(units):
        read.add(1)
        return units

    mixed = sales.select(watched("units").alias("units"), "item_nbr", F.col("date").cast("string").alias("t"))
    assert Q.profile(mixed).count() == 3 and read.value == sales.count()


def test_listing_of_join_equals_listing_of_joined_rows(spark, shop):
    sales, stores, weather = shop
    for c in A.READINGS:
        if c not in weather.columns:
            weather = weather.withColumn(c, F.when(F.day("date") != 3, F.lit(1.5)))
    sales = sales.unionByName(sales.limit(20).withColumns({"units": F.lit(None).cast("double"), "item_nbr": F.lit(None).cast("int")}))
    weather = weather.unionByName(weather.filter("day(date) = 4"))
    joined = A.joined_table(sales, stores, weather)
    assert sorted(map(tuple, Q.listing_of_join(sales, stores, weather).collect())) == sorted(map(tuple, Q.column_listing(joined).collect()))


def test_splits(spark):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    split = P.random_split(rows, ["k"]).groupBy("split").count()
    assert dict(split.collect()).keys() == {"train", "test"}
    assert abs(dict(split.collect())["train"] - 800) < 60
    moved = P.random_split(rows.repartition(7), ["k"])
    assert not P.random_split(rows, ["k"]).exceptAll(moved).count()
    assert dict(P.exact_split(rows.filter("k < 999"), ["k"]).groupBy("split").count().collect()) == {"train": 799, "test": 200}
    assert dict(P.exact_split(rows.filter("k < 1"), ["k"]).groupBy("split").count().collect()) == {"test": 1}


def test_folds_are_even(spark):
    rows = spark.range(503).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("target"))
    sizes = P.stratified_folds(rows, "target", "k").groupBy("target", "fold").count().collect()
    for target in (0, 1):
        counts = [r["count"] for r in sizes if r["target"] == target]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
    totals = [sum(r["count"] for r in sizes if r["fold"] == f) for f in range(5)]
    assert sum(totals) == 503 and max(totals) - min(totals) <= 1


def test_shares_at_the_ends(spark):
    rows = spark.range(500).withColumnRenamed("id", "k")
    for split in (P.random_split, P.exact_split):
        assert dict(split(rows, ["k"], 0).groupBy("split").count().collect()) == {"test": 500}
        assert dict(split(rows, ["k"], 1).groupBy("split").count().collect()) == {"train": 500}
        with pytest.raises(ValueError):
            split(rows, ["k"], 1.5)


def test_exact_split_with_small_prefixes(spark, monkeypatch):
    rows = spark.range(3000).withColumnRenamed("id", "k")
    usual = sorted(map(str, P.exact_split(rows, ["k"], 0.37).collect()))
    monkeypatch.setattr(P, "PREFIX_ROWS", 5)
    assert sorted(map(str, P.exact_split(rows, ["k"], 0.37).collect())) == usual
    assert sum("train" in r for r in usual) == 1110


def test_missing_keys_have_their_own_digest(spark):
    rows = spark.createDataFrame([(None, "a"), ("a", None), ("a|", "b"), ("a", "|b"), ("", "a"), (None, None), ("\\N", "a")], "x string, y string")
    assert rows.select(P.row_digest(["x", "y"])).distinct().count() == 7


def test_folds_of_many_classes(spark):
    rows = spark.range(4500).selectExpr("id as k", "concat('c', id % 1500) as target")
    folds = P.stratified_folds(rows, "target", "k").groupBy("fold").count().collect()
    assert {r["fold"]: r["count"] for r in folds} == {f: 900 for f in range(5)}


def test_classes_dealt_over_tasks(spark):
    sizes = spark.range(40).selectExpr("id as target", "id % 7 as rows")
    one, many = (P._class_bounds(sizes, "target", 5, 40, rows) for rows in (1000, 6))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_splits_read_their_input_once_or_twice(spark):
    rows = spark.range(2000).selectExpr("id as k", "id % 3 as target")
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def watched(k):
        read.add(1)
        return k

    P.stratified_folds(rows.withColumn("k", watched("k")), "target", "k").collect()
    assert read.value == 2000
    stored = P.materialise(rows)
    folds = P.stratified_folds(stored, "target", "k", task_rows=2)
    assert sorted(map(str, folds.collect())) == sorted(map(str, P.stratified_folds(rows, "target", "k").collect()))
    read.value = 0
    P.exact_split(rows.withColumn("k", watched("k")), ["k"]).collect()
    assert read.value == 4000


@pytest.mark.parametrize("task_rows", [10**6, 7])
def test_places_in_a_total_order(spark, task_rows):
    """Ties, missing values and a value that half of the rows share."""
    pick = random.Random(2)
    rows = [(pick.choice([None, 1, 2, 2, 2, 3]), pick.choice(["a", "b", None]), i) for i in range(300)] + [(7, "same", 1)] * 300
    df = spark.createDataFrame(rows, "x int, t string, i int").repartition(5)
    got = O.placed(df, [F.desc("x"), "t"], task_rows=task_rows).collect()
    assert sorted(r.place for r in got) == list(range(1, 601))
    order = [(r.x, r.t) for r in sorted(got, key=lambda r: r.place)]
    assert order == sorted(order, key=lambda p: (p[0] is None, -(p[0] or 0), p[1] is not None, p[1] or ""))
    assert sorted((r.x or 0, r.t or "", r.i) for r in got) == sorted((x or 0, t or "", i) for x, t, i in rows)
    assert O.placed(df.limit(0), ["x"]).count() == 0
