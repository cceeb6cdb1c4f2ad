"""Sparse text records to fixed columns: parse, reject, widen, label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.functions import tokens as K
from shelfrisk.functions.scalars import at_least
from shelfrisk.session import materialise, total_of

# The number of features of the published model and the risk from which a record is high-risk.
FEATURES = 483
HIGH_RISK = 0.3
# Most columns of a table whose width comes from the data.
MOST_COLUMNS = 10_000
LEAST_INT = -(1 << 31)


def parse_lines(lines: DataFrame, text: str = "line") -> DataFrame:
    """Add `risk`, `pairs` (index, value; sorted by index, a repeated index keeps its last value) and `problem`.

    `problem` names why a line cannot be used (blank, bad risk, bad pair) and is NULL for good ones.
    """
    parts = K.computed_once(lines, __parts=K.words(F.col(text)))
    read = K.computed_once(parts, risk=K.as_float(F.get("__parts", F.lit(0))),
                           __sorted=F.array_sort(F.transform(K.pair_tokens(F.col("__parts")), K.pair)))
    in_order = F.col("__sorted")
    following = F.slice(in_order, 2, F.greatest(F.size(in_order), F.lit(1)))
    with_next = F.zip_with(in_order, following, lambda p, after: F.struct(
        p["index"].alias("index"), p["value"].alias("value"), after["index"].alias("after")))
    last_of_index = F.filter(with_next, lambda p: F.coalesce(p["after"] != p["index"], F.lit(True)))
    bad_pair = F.exists(in_order, lambda p: p["index"].isNull() | p["value"].isNull())
    problem = (F.when(F.coalesce(F.get("__parts", F.lit(0)), F.lit("")) == "", F.lit("blank"))
               .when(F.col("risk").isNull(), F.lit("bad risk")).when(bad_pair, F.lit("bad pair")))
    pairs = F.transform(last_of_index, lambda p: F.struct(p["index"].alias("index"), p["value"].alias("value")))
    return K.computed_once(read.withColumn("problem", problem), pairs=pairs).drop("__parts", "__sorted")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull()).drop("problem")


def rejected(parsed: DataFrame) -> DataFrame:
    """Lines that cannot be used, with the reason; they are never scored."""
    return parsed.filter(F.col("problem").isNotNull()).drop("risk", "pairs")


def as_map(parsed: DataFrame) -> DataFrame:
    """Replace `pairs` by a map from feature number to value."""
    return parsed.withColumn("features", F.map_from_entries("pairs")).drop("pairs")


def long_form(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """One row per record and present feature: `keep`, feature_number, value."""
    return parsed.select(*keep, F.explode("pairs").alias("p")).select(
        *keep, F.col("p.index").alias("feature_number"), F.col("p.value").alias("value"))


def labelled(parsed: DataFrame, threshold: float = HIGH_RISK) -> DataFrame:
    """Add `risk_score` (NaN becomes 0) and `target`: 1 from the threshold on, 0 below it and for NaN."""
    return parsed.withColumns({"risk_score": F.nanvl("risk", F.lit(0.0)),
                               "target": at_least(F.col("risk"), threshold)}).drop("risk")


def present(parsed: DataFrame, n_features: int = FEATURES) -> DataFrame:
    """`pairs` without indices outside 0 to `n_features` - 1 and without zeros; NaN is 0."""
    inside = F.filter("pairs", lambda p: (p["index"] >= 0) & (p["index"] < n_features) & (F.nanvl(p["value"], F.lit(0.0)) != 0))
    return parsed.withColumn("pairs", inside)


def observed_features(parsed: DataFrame, most: int = MOST_COLUMNS) -> list[int]:
    """The feature numbers that occur, in order, so that no width need be known. Raises beyond `most`.

    Numbers are set as bits before the shuffle, which moves at most one bitmap per task and 32,768 numbers.
    """
    numbers = parsed.select(F.explode("pairs.index").alias("index")).select((F.col("index").cast("long") - LEAST_INT + 1).alias("number"))  # from 1 on, as bitmaps count
    maps = (numbers.groupBy(F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))
    maps = materialise(maps, numbers=F.sum(F.bitmap_count("bits")))
    if (total_of(maps, "numbers") or 0) > most:
        raise ValueError(f"{total_of(maps, 'numbers')} different features; at most {most} can be columns")
    found = []
    for row in maps.collect():  # at most `most` rows
        first = (row["bucket"] - 1) * 32768 + LEAST_INT
        found += [first + 8 * at + bit for at, byte in enumerate(row["bits"]) for bit in range(8) if byte >> bit & 1]
    return sorted(found)


def wide_observed(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """`keep`, one column per feature that occurs (absent and NaN are 0), risk_score, target."""
    names = observed_features(parsed)
    flat = K.computed_once(labelled(parsed), values=F.map_from_entries("pairs")).drop("pairs")
    columns = [F.coalesce(F.nanvl(F.element_at("values", F.lit(i)), F.lit(0.0)), F.lit(0.0)).alias(f"feature_{i}") for i in names]
    return flat.select(*(keep or []), *columns, "risk_score", "target")


def dense(parsed: DataFrame, n_features: int = FEATURES) -> DataFrame:
    """Replace `pairs` by `values`, an array of `n_features` doubles; absent and NaN are 0, others are dropped.

    The sorted pairs are laid out with the gaps between them filled, one pass per record.
    """
    pairs = F.filter("pairs", lambda p: (p["index"] >= 0) & (p["index"] < n_features))
    before = F.concat(F.array(F.lit(-1)), F.transform(pairs, lambda p: p["index"]))

    def from_before(p, index):
        # The extra last element has no pair: it fills up to the end.
        gap = F.coalesce(p["index"], F.lit(n_features)) - index - 1
        value = F.when(p["index"].isNotNull(), F.array(F.nanvl(p["value"], F.lit(0.0)))).otherwise(
            F.array().cast("array<double>"))
        return F.concat(F.array_repeat(F.lit(0.0), gap), value)

    laid_out = F.flatten(F.zip_with(pairs, before, from_before))
    return K.computed_once(parsed, values=laid_out).drop("pairs")


def wide(parsed: DataFrame, keep: list[str] | None = None, n_features: int = FEATURES) -> DataFrame:
    """`keep`, then feature_0 … feature_<n-1>, risk_score, target: the fixed flat schema."""
    flat = dense(labelled(parsed), n_features)
    columns = [F.get("values", F.lit(i)).alias(f"feature_{i}") for i in range(n_features)]
    return flat.select(*(keep or []), *columns, "risk_score", "target")
