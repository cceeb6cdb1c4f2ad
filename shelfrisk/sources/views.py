"""Sales, station and sparse-record inputs derived from the provided star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SALES_SQL = """
select cast(l_shipdate as date) as date, l_suppkey as store_nbr, p_size as item_nbr, l_quantity as units
from lineitem join part on l_partkey = p_partkey
"""

STORES_SQL = "select s_suppkey as store_nbr, s_nationkey as station_nbr from supplier"

# One text for both engines. `k` is the first order of a station's day and seeds every reading.
WEATHER_SQL = """
select station_nbr, wdate as date,
  case when k%19=0 then 'M' else cast(30 + k%80 as string) end as tmax,
  case when k%23=0 then 'M' else cast(10 + k%80 as string) end as tmin,
  case when k%17=0 then 'M' else cast(20 + k%80 as string) end as tavg,
  case when k%17=0 then 'M' else cast(k%31 - 15 as string) end as depart,
  cast(k%70 as int) as dewpoint,
  cast(k%75 as int) as wetbulb,
  case when k%17=0 then 'M' else cast(45 - k%45 as string) end as heat,
  case when k%17=0 then 'M' else cast(k%20 as string) end as cool,
  case when k%5=0 then '-' else lpad(cast(500 + k%200 as string), 4, '0') end as sunrise,
  case when k%5=0 then '-' else cast(1700 + k%200 as string) end as sunset,
  case when k%6=0 then 'TSRA' when k%6=1 then 'SN' when k%6=2 then 'RA BR' when k%6=3 then ''
       when k%6=4 then '+FC' else 'HZ' end as codesum,
  case when k%13=0 then '  T' when k%13=1 then 'M' else '0.0' end as snowfall,
  case when k%11=0 then '' when k%11=1 then 'T' when k%11=2 then '  T' when k%11=3 then 'M'
       else concat('0.', lpad(cast(k%100 as string), 2, '0')) end as preciptotal,
  cast(28 + (k%12) * 0.25 as double) as stnpressure,
  case when k%29=0 then null else cast(29 + (k%8) * 0.25 as double) end as sealevel,
  cast((k%60) * 0.5 as double) as resultspeed,
  cast(k%36 as int) as resultdir,
  cast((k%50) * 0.5 as double) as avgspeed
from (select min(o_orderkey) as k, c_nationkey as station_nbr, cast(o_orderdate as date) as wdate
      from orders join customer on o_custkey = c_custkey
      group by c_nationkey, cast(o_orderdate as date)) b
"""

SPARSE_LINES_SQL = """
select vec_id, label,
  concat('0.', cast(label as string), case when size(tok) = 0 then '' else ' ' end, array_join(tok, ' ')) as line
from (select vec_id, label,
        filter(transform(embedding, (e, i) -> case when floor(abs(cast(e as double)) * 10) > 0
          then concat(cast(i as string), ':', cast(cast(floor(abs(cast(e as double)) * 10) as int) as string)) end),
          x -> x is not null) as tok
      from embeddings) t
"""

N_FEATURES = 64

# Sparse lines that reach every rule: blank, no risk, no number, junk words, repeated, negative and far indices, NaN.
MESSY_LINES_SQL = """
select vec_id, case
    when vec_id % 8 = 0 then '  '
    when vec_id % 8 = 1 then concat('risk ', v, ':1')
    when vec_id % 8 = 2 then concat('0.4 ', v, ':abc')
    when vec_id % 8 = 3 then concat('0.5 junk ', v, ':1 7 ', v, ':2')
    when vec_id % 8 = 4 then concat('nan ', v, ':1.5')
    when vec_id % 8 = 5 then concat('0.3 -1:4 ', v, ':nan 9:5')
    when vec_id % 8 = 6 then concat('0.', v, ' ', v, ':3 6:1 6:nan')
    else concat(' 0.2  ', v, ':7 ') end as line
from (select vec_id, cast(vec_id % 6 as string) as v from embeddings) t
"""
MESSY_FEATURES = 8

# Orders with gaps in the price and with dates as text of several shapes.
GAPPY_ORDERS_SQL = """
select o_orderkey, o_custkey,
  case when o_orderkey % 7 = 0 then null when o_orderkey % 7 = 1 then cast('NaN' as double)
       else cast(o_totalprice as double) end as price,
  case when o_orderkey % 6 = 0 then day when o_orderkey % 6 = 1 then replace(day, '-', '/')
       when o_orderkey % 6 = 2 then substr(day, 1, 4) when o_orderkey % 6 = 3 then substr(day, 1, 7)
       when o_orderkey % 6 = 4 then concat(day, ' 10:00') else 'unknown' end as day_text
from (select o_orderkey, o_custkey, o_totalprice, cast(cast(o_orderdate as date) as string) as day from orders) t
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _query(spark: SparkSession, folder: str, text: str, names: list[str]) -> DataFrame:
    """Run `text` with each named table bound to its file, leaving no view behind."""
    for name in names:
        text = text.replace(f"from {name}", f"from {{{name}}}").replace(f"join {name}", f"join {{{name}}}")
    return spark.sql(text, **{name: table(spark, folder, name) for name in names})


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """`train`: one row per sale line (date, store_nbr, item_nbr, units)."""
    return _query(spark, folder, SALES_SQL, ["lineitem", "part"])


def stores(spark: SparkSession, folder: str) -> DataFrame:
    """`key`: the weather station of each store."""
    return _query(spark, folder, STORES_SQL, ["supplier"])


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """`weather`: one row of readings per station and day."""
    return _query(spark, folder, WEATHER_SQL, ["orders", "customer"])


def sparse_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse text records `risk idx:val …`, keyed by vec_id."""
    return _query(spark, folder, SPARSE_LINES_SQL, ["embeddings"]).drop("label")


def messy_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Good and faulty sparse lines in turn, keyed by vec_id."""
    return _query(spark, folder, MESSY_LINES_SQL, ["embeddings"])


def gappy_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with NULL and NaN prices and their day as text."""
    return _query(spark, folder, GAPPY_ORDERS_SQL, ["orders"])


def feature_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Feature dictionary (feature_name, feature_number) of the features that occur; four names repeat."""
    numbers = (table(spark, folder, "embeddings")
               .select(F.explode(F.sequence(F.lit(0), F.size("embedding") - 1)).alias("feature_number"))
               .distinct())
    return numbers.select(F.concat(F.lit("f"), F.col("feature_number") % 60).alias("feature_name"), "feature_number")
