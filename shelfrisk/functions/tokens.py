"""Column expressions for sparse text records `risk idx:val idx:val …`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrisk.functions.scalars import NUMBER

# How non-finite numbers may be spelt.
NON_FINITE = r"^(?i)\s*[+-]?(nan|inf|infinity)\s*$"


def words(line: Column) -> Column:
    """Text cut at runs of white space, ends trimmed."""
    return F.split(F.regexp_replace(line, r"^\s+|\s+$", ""), r"\s+")


def as_float(text: Column) -> Column:
    """Number, infinity or NaN; NULL if the text is none of them."""
    return F.when(text.rlike(NUMBER) | text.rlike(NON_FINITE), F.trim(text).try_cast("double"))


def pair_tokens(parts: Column) -> Column:
    """The `idx:val` words after the first one; other words are ignored."""
    return F.filter(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda p: F.contains(p, F.lit(":")))


def pair(token: Column, place: Column) -> Column:
    """(index, place, value) of an `idx:val` word; what follows a second colon is ignored."""
    return F.struct(F.split_part(token, F.lit(":"), F.lit(1)).try_cast("int").alias("index"), place.alias("place"),
                    as_float(F.split_part(token, F.lit(":"), F.lit(2))).alias("value"))


def feature_name(number: Column | int, stem: str = "feature") -> Column:
    return F.concat(F.lit(f"{stem}_"), F.lit(number).cast("string"))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that later filters and projections read instead of repeating their expressions.

    Spark copies a plain column's expression into every filter above it; it does not look inside a generator.
    """
    packed = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.inline(packed))
