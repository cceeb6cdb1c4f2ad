"""Column names and shapes: fixed schema, unique names, renaming, scoring-input checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrisk.functions.tokens import feature_name
from shelfrisk.session import attach, broadcast_if_small


def quoted(name: str) -> Column:
    """Column whose name may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def force_columns(df: DataFrame, columns: list[str], fill: float = 0.0) -> DataFrame:
    """Exactly `columns` in that order: missing ones are filled, others dropped."""
    present = set(df.columns)
    return df.select(*[quoted(c) if c in present else F.lit(fill).alias(c) for c in columns])


def fill_zero(df: DataFrame) -> DataFrame:
    """NULL and NaN to 0 in every numeric column."""
    return df.na.fill(0)


def unique_names(mapping: DataFrame) -> DataFrame:
    """If any feature name repeats, append its number to every name; else leave all as they are."""
    repeats = mapping.agg((F.count("feature_name") > F.count_distinct("feature_name")).alias("any")).scalar()
    numbered = F.concat_ws("_", F.col("feature_name"), F.col("feature_number").cast("int").cast("string"))
    return mapping.withColumn("feature_name", F.when(repeats, numbered).otherwise(F.col("feature_name")))


def new_names(mapping: DataFrame, n_features: int) -> dict[str, str]:
    """Old to new column name; of a number listed twice the last row counts. At most `n_features` rows come back."""
    placed = mapping.withColumn("__row", F.monotonically_increasing_id())
    used = placed.filter((F.col("feature_number") >= 0) & (F.col("feature_number") < n_features))
    last = used.groupBy(F.col("feature_number").cast("int").alias("number")).agg(
        F.max_by("feature_name", "__row").alias("name"))
    return {f"feature_{row['number']}": row["name"] for row in last.collect()}


def rename_features(flat: DataFrame, mapping: DataFrame, n_features: int) -> DataFrame:
    """Feature columns by their mapped names, unmapped ones unchanged."""
    return flat.withColumnsRenamed(new_names(unique_names(mapping), n_features))


def named_long(long: DataFrame, mapping: DataFrame) -> DataFrame:
    """Long form with names instead of numbers; unmapped features keep `feature_<n>`.

    The mapping has one row per feature and is broadcast after a count.
    """
    names = unique_names(mapping).select(F.col("feature_number").cast("int").alias("feature_number"), "feature_name")
    joined = attach(long, broadcast_if_small(names, rows=mapping.count()), ["feature_number"])
    return joined.withColumn("feature_name", F.coalesce("feature_name", feature_name(F.col("feature_number"))))


MISSING = "scoring input has missing values; encode absent features as 0"


def check_scoring_columns(df: DataFrame, columns: list[str], reserved: tuple[str, ...] = ("target", "risk_score")) -> None:
    """Raise unless `df` has exactly `columns`, all numeric, in order."""
    found = [c for c in df.columns if c in reserved]
    if found:
        raise ValueError(f"scoring input must not hold {found}")
    if df.columns != columns:
        odd = sorted(set(df.columns) ^ set(columns))[:5]
        raise ValueError(f"expected {len(columns)} feature columns in order, got {len(df.columns)}; differing: {odd}")
    text = [f.name for f in df.schema if not isinstance(f.dataType, T.NumericType)]
    if text:
        raise ValueError(f"features must be numeric: {text[:5]}")


def no_missing(column: str) -> Column:
    """The column; a NULL or NaN ends the job that reads it."""
    value = quoted(column)
    missing = value.isNull() | F.isnan(value.cast("double"))
    return F.when(missing, F.raise_error(F.lit(MISSING))).otherwise(value).alias(column)


def check_scoring_input(df: DataFrame, columns: list[str], reserved: tuple[str, ...] = ("target", "risk_score")) -> None:
    """Raise unless `df` has exactly `columns`, all numeric, in order, without NULL or NaN. Reads all rows."""
    check_scoring_columns(df, columns, reserved)
    values = F.array(*[quoted(c).cast("double") for c in columns])
    # An aggregate, not a filter: a filter would be pushed into the expressions that made the columns.
    if df.agg(F.bool_or(F.exists(values, lambda v: v.isNull() | F.isnan(v)))).first()[0]:
        raise ValueError(MISSING)
