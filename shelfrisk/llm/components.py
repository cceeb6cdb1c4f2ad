"""Connected components as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.session import materialise, row_count, total_of


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of a link (a, b): the smallest id that links reach.

    Alternates large and small stars: every node passes the smallest id it knows to its larger and then to its
    smaller neighbours, until only stars are left. The number of rounds grows with the logarithm of the longest
    path. Each round is stored, so a lost executor costs one round at most.
    """
    check = F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))
    stars = materialise(links.filter("a != b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), check=check)
    while True:
        both = stars.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(stars.select("hi", "lo"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi").filter("lo != m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
                 .union(least.select("m", "hi")).distinct())
        following = materialise(small, check=check)
        if row_count(following) == row_count(stars) and total_of(following, "check") == total_of(stars, "check"):
            own = following.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
            return following.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(own)
        stars = following
