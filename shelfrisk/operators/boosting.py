"""Gradient-boosted risk classifier: training vectors, cross-validation, ranking, saving, scoring."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrisk.operators.metrics import precision_recall
from shelfrisk.operators.schema import check_scoring_columns, no_missing, quoted
from shelfrisk.operators.sparse import FEATURES, HIGH_RISK, labelled, present
from shelfrisk.session import materialise, row_count, stored_as

# The published model's settings.
TREES, DEPTH, RATE, SEED = 100, 3, 0.1, 42
# Training data is read by no more tasks than one per this many rows.
ROWS_PER_TASK = 20_000


@dataclass
class RiskModel:
    """A classifier with its contract: the feature columns in order, and the risk from which a record counted as high."""

    classifier: GBTClassificationModel
    columns: list[str]
    threshold: float = HIGH_RISK

    def __post_init__(self):
        if self.classifier.numFeatures != len(self.columns):
            raise ValueError(f"the classifier has {self.classifier.numFeatures} features, the contract {len(self.columns)}")


def training_rows(parsed: DataFrame, keep: list[str], n_features: int = FEATURES) -> DataFrame:
    """`keep`, target, `features` and `label` from parsed records; no Python on the way.

    `features` has the parts of a sparse vector, taken from the record's pairs without widening them; `stored_rows` reads
    them back as vectors, which Spark stores in just these parts.
    """
    kept = present(labelled(parsed), n_features)
    vector = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(n_features).alias("size"),
                      F.transform("pairs", lambda p: p["index"]).alias("indices"), F.transform("pairs", lambda p: p["value"]).alias("values"))
    return kept.select(*keep, "target", vector.alias("features"), F.col("target").cast("double").alias("label"))


def wide_rows(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """`keep` and a `features` vector from wide numeric columns; sparse where that is shorter."""
    # Plain names, since feature names may hold dots.
    plain = [f"__f{i}" for i in range(len(columns))]
    renamed = df.select(*[quoted(c) for c in keep], *[quoted(c).cast("double").alias(p) for c, p in zip(columns, plain)])
    return VectorAssembler(inputCols=plain, outputCol="features").transform(renamed).select(*[quoted(c) for c in keep], "features")


def classifier(**settings) -> GBTClassifier:
    """The boosted-tree classifier with the published settings; `settings` override them."""
    base = {"maxIter": TREES, "maxDepth": DEPTH, "stepSize": RATE, "subsamplingRate": 1.0, "seed": SEED}
    return GBTClassifier(featuresCol="features", labelCol="label", **(base | settings))


def stored_rows(rows: DataFrame) -> DataFrame:
    """Training rows stored for the many passes of boosting, read as vectors in as few tasks as their number needs."""
    stored = materialise(rows)
    fields = [T.StructField("features", VectorUDT()) if f.name == "features" else f for f in stored.schema]
    tasks = max(1, row_count(stored) // ROWS_PER_TASK)
    return stored_as(stored, T.StructType(fields)).coalesce(tasks)


def fit(rows: DataFrame, **settings) -> GBTClassificationModel:
    return classifier(**settings).fit(rows)


def cross_validated(rows: DataFrame, fold: str, k: int = 5, parallel: int = 5, **settings) -> DataFrame:
    """Every row with the class predicted by the model that was trained without its fold."""

    def one(i: int) -> DataFrame:
        model = fit(rows.filter(F.col(fold) != i), **settings)
        scored = model.transform(rows.filter(F.col(fold) == i))
        return scored.withColumn("predicted", F.col("prediction").cast("int")).drop(
            "rawPrediction", "probability", "prediction", "features", "label")

    with ThreadPoolExecutor(parallel) as pool:
        return reduce(DataFrame.unionByName, pool.map(one, range(k)))


def fold_scores(rows: DataFrame, fold: str, k: int = 5, **settings) -> DataFrame:
    """Precision and recall of each held-out fold."""
    return precision_recall(cross_validated(rows, fold, k, **settings), [fold], "target", "predicted")


def top_importances(spark: SparkSession, model: RiskModel, k: int = 20) -> DataFrame:
    """The `k` features the model relies on most; the vector has one entry per feature, not per row."""
    pairs = [(name, float(value)) for name, value in zip(model.columns, model.classifier.featureImportances.toArray())]
    table = spark.createDataFrame(pairs, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def save_model(model: RiskModel, path: str) -> None:
    """The classifier and, beside it, its contract as one row of JSON."""
    spark = SparkSession.active()
    model.classifier.write().overwrite().save(f"{path}/classifier")
    contract = spark.createDataFrame([(model.columns, len(model.columns), model.threshold)], CONTRACT)
    contract.coalesce(1).write.mode("overwrite").json(f"{path}/contract")


def load_model(path: str, columns: list[str] | None = None) -> RiskModel:
    """The model with its contract. Raises if the folder's parts disagree, or if it was trained on other `columns` than given."""
    (found,) = SparkSession.active().read.schema(CONTRACT).json(f"{path}/contract").collect()
    if len(found.columns) != found.n_columns:
        raise ValueError(f"the contract lists {len(found.columns)} columns, not {found.n_columns}")
    if columns is not None and columns != found.columns:
        odd = sorted(set(columns) ^ set(found.columns))[:5] or "the order"
        raise ValueError(f"the model was trained on other columns; differing: {odd}")
    return RiskModel(GBTClassificationModel.load(f"{path}/classifier"), found.columns, found.threshold)


CONTRACT = "columns array<string>, n_columns int, threshold double"


def saved_nodes(spark: SparkSession, path: str, depth: int) -> DataFrame:
    """(tree, node, n, mean, feature, cut) of a saved model; the root is node 1, the children of t are 2t and 2t + 1.

    A model has a fixed number of nodes, whatever the data. Values up to the cut go to the left child.
    """
    raw = spark.read.parquet(f"{path}/classifier/data").selectExpr("treeID as tree", "nodeData.*")
    nodes = raw.selectExpr("tree", "id", "leftChild", "rightChild", "cast(rawCount as long) as n", "prediction as mean",
                           "case when leftChild >= 0 then split.featureIndex end as feature",
                           "case when leftChild >= 0 then split.leftCategoriesOrThreshold[0] end as cut")
    level = nodes.filter("id = 0").withColumn("node", F.lit(1).cast("long"))
    levels = [level]
    for _ in range(depth):
        children = level.filter("leftChild >= 0").selectExpr(
            "tree", "explode(array(struct(leftChild as id, node * 2 as node), struct(rightChild as id, node * 2 + 1 as node))) as child")
        level = nodes.join(children.selectExpr("tree", "child.id", "child.node"), ["tree", "id"])
        levels.append(level)
    return reduce(DataFrame.unionByName, [x.select("tree", "node", "n", "mean", "feature", "cut") for x in levels])


def score(df: DataFrame, model: RiskModel, keep: list[str] | None = None) -> DataFrame:
    """`keep` and `predicted_risk_class` (0 or 1) for a frame of exactly the model's columns, in its order.

    Values are checked while they are scored: a NULL or NaN feature ends the job.
    """
    kept = keep or []
    check_scoring_columns(df.drop(*kept), model.columns)
    checked = df.select(*[quoted(c) for c in kept], *[no_missing(c) for c in model.columns])
    scored = model.classifier.transform(wide_rows(checked, model.columns, kept))
    return scored.select(*[quoted(c) for c in kept], F.col("prediction").cast("int").alias("predicted_risk_class"))
