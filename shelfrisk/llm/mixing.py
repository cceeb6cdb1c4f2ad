"""Mix sources to target weights (operator 3), with DataFrame functions only.

A token budget runs down a tree of columns, such as domain, language and source. At each node it is shared
among the children by weight; a child that cannot fill its share (its tokens times `max_epochs`) passes the rest to
its siblings, and only what a whole family cannot use goes back up. Each leaf then takes whole epochs, and of the
last one the documents that come first in a seeded order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrisk.session import attach, materialise

WORDS = r"[^\x20\x09-\x0D]+"
BUCKET_DOCS = 4096  # documents of a leaf that one task sorts, about


def _weight(level: str, weights: dict[str, dict[str, float]]) -> Column:
    out = F.lit(1.0)
    for value, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(float(weight))).otherwise(out)
    return out


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, float]], share: float, max_epochs: int) -> DataFrame:
    """(levels, tokens, docs, budget) from (levels, tokens, docs). `share` is the budget as a part of all tokens; `weights`
    gives level -> value -> weight among siblings, 1 if not named; 0 leaves a branch out."""
    capable = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    for level in levels:
        capable = capable.withColumn(f"weight_{level}", _weight(level, weights))
    positive = capable
    for level in levels:
        positive = positive.filter(F.col(f"weight_{level}") > 0)
    positive = positive.withColumn("root", F.lit(0))
    budgets = positive.groupBy("root").agg(F.least((F.lit(float(share)) * F.sum("tokens")).cast("double"), F.sum("capacity").cast("double")).alias("budget"))
    for depth in range(1, len(levels) + 1):
        path, parent, weight = ["root", *levels[:depth]], ["root", *levels[:depth - 1]], F.col(f"weight_{levels[depth - 1]}")
        nodes = positive.groupBy(*path).agg(F.sum("capacity").cast("double").alias("capacity"),
                                            F.max(f"weight_{levels[depth - 1]}").alias(f"weight_{levels[depth - 1]}"))
        nodes = attach(nodes, budgets, parent, "inner")  # one row per node
        family = Window.partitionBy(*parent)
        order = family.orderBy(F.col("capacity") / weight, levels[depth - 1])
        used = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        left = F.sum(weight).over(order.rowsBetween(0, Window.unboundedFollowing))
        # Fill children in the order in which they get full; the highest level any step shows is the common one.
        nodes = nodes.withColumn("level", (F.col("budget") - used) / left)
        budgets = nodes.select(*path, F.least("capacity", F.max("level").over(family) * weight).alias("budget"))
    return attach(leaves, budgets.drop("root").withColumn("budget", F.floor(F.col("budget") + 1e-6).cast("long")), levels).withColumn(
        "budget", F.coalesce("budget", F.lit(0)).cast("long"))


def mix(docs: DataFrame, levels: list[str], weights: dict[str, dict[str, float]], share: float = 1.0, max_epochs: int = 2,
        seed: int = 17) -> DataFrame:
    """doc_id, the levels, epoch and n_tokens of every document taken, once per epoch.

    Tokens are runs of characters other than space and the controls 9 to 13. NULL and empty texts have none and come
    with every whole epoch and with any partial one; a leaf without any tokens is left out. A NULL level value is a value of its own; a NULL doc_id sorts by
    the empty id. Rows with equal doc_id in a leaf are taken together or not at all. Other columns are ignored; names
    of levels must not be doc_id, epoch or n_tokens.
    """
    small = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *levels, F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("n_tokens")))
    leaves = small.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    plan = leaf_budgets(leaves, levels, weights, share, max_epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long")
    plan = (plan.withColumn("whole", whole).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
            .withColumn("digits", F.greatest(F.lit(1), F.ceil(F.log(16.0, F.col("docs") / BUCKET_DOCS))).cast("int")))
    plan = materialise(plan.select(*levels, "whole", "rest", "digits").filter("whole > 0 or rest > 0"))
    taken = attach(small, plan, levels, "inner")
    out = [*levels, "epoch", "n_tokens"]
    full = taken.filter("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1))).select("doc_id", *out)

    spot = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    last = taken.filter("rest > 0").withColumn("spot", spot).withColumn("bucket", F.expr("substring(spot, 1, digits)"))
    sums = last.groupBy(*levels, "bucket").agg(F.sum("n_tokens").alias("size"))
    running = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0)))
    last = attach(last, sums, [*levels, "bucket"], "inner").filter("before <= rest")
    inside = last.filter("before + size <= rest")
    order = Window.partitionBy(*levels, "bucket").orderBy("spot", F.coalesce("doc_id", F.lit(-1)))
    cut = (last.filter("before + size > rest").withColumn("upto", F.col("before") + F.sum("n_tokens").over(order))
           .filter("upto <= rest"))
    partial = inside.select("doc_id", *levels, F.col("whole").alias("epoch"), "n_tokens").unionByName(
        cut.select("doc_id", *levels, F.col("whole").alias("epoch"), "n_tokens"))
    return full.unionByName(partial)
