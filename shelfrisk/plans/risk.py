"""Risk-classifier jobs over a folder of the provided tables; each function is one registered query."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrisk.functions import scalars as S
from shelfrisk.operators import boosting as B
from shelfrisk.operators import metrics as M
from shelfrisk.operators import schema as H
from shelfrisk.operators import sparse as Z
from shelfrisk.operators import split as P
from shelfrisk.operators.sparse import HIGH_RISK
from shelfrisk.session import checkpoint_dir
from shelfrisk.sources import files, views

N = views.N_FEATURES
# A record is called high-risk by the plain scorer when its values add up to this much.
PLAIN_LIMIT = 36


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return Z.accepted(Z.parse_lines(views.sparse_lines(spark, folder)))


def sparse_long(spark: SparkSession, folder: str) -> DataFrame:
    return Z.long_form(_records(spark, folder), ["vec_id", "risk"])


def sparse_wide(spark: SparkSession, folder: str) -> DataFrame:
    return Z.wide(_records(spark, folder), ["vec_id"], N)


def text_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Records written as a folder of `.txt` files and ingested from it."""
    path = _scratch(spark, "lines")
    views.sparse_lines(spark, folder).select("line").write.text(path)
    lines = files.read_sparse_folder(spark, path)
    return Z.long_form(Z.accepted(Z.parse_lines(lines)), ["line", "risk"])


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Document texts are no sparse records: every line lands in the rejects with its reason."""
    return Z.rejected(Z.parse_lines(views.table(spark, folder, "documents"), "text")).select("doc_id", "problem")


def messy_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Faulty sparse lines with each of the three reasons."""
    return Z.rejected(Z.parse_lines(views.messy_lines(spark, folder))).select("vec_id", "problem")


def messy_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Good lines among faulty ones, with junk words, repeated, negative and far indices and NaN, in the fixed schema."""
    lines = Z.accepted(Z.parse_lines(views.messy_lines(spark, folder)))
    return Z.wide(lines, ["vec_id"], views.MESSY_FEATURES)


def messy_observed(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines with a column for every feature that occurs, far and negative ones too, and no others."""
    return Z.wide_observed(Z.accepted(Z.parse_lines(views.messy_lines(spark, folder))), ["vec_id"])


def filled_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """NULL and NaN prices as 0, then forced to known columns and a new one."""
    return H.force_columns(H.fill_zero(views.gappy_orders(spark, folder)), ["price", "o_discount", "o_orderkey"])


def text_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days read from text of several shapes."""
    return views.gappy_orders(spark, folder).select("o_orderkey", S.to_day(F.col("day_text")).alias("day"))


def risk_label(spark: SparkSession, folder: str) -> DataFrame:
    return Z.labelled(_records(spark, folder), HIGH_RISK).select("vec_id", "risk_score", "target")


def unique_feature_names(spark: SparkSession, folder: str) -> DataFrame:
    return H.unique_names(views.feature_mapping(spark, folder))


def labelled_features(spark: SparkSession, folder: str) -> DataFrame:
    return H.rename_features(sparse_wide(spark, folder), views.feature_mapping(spark, folder), N)


def labelled_long(spark: SparkSession, folder: str) -> DataFrame:
    return H.named_long(sparse_long(spark, folder), views.feature_mapping(spark, folder))


def flat_files(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled table written as CSV, with the mapping read from CSV, and read back."""
    names, flat = _scratch(spark, "names"), _scratch(spark, "flat")
    files.write_csv(views.feature_mapping(spark, folder), names)
    labelled = H.rename_features(sparse_wide(spark, folder), files.read_mapping(spark, names), N)
    files.write_csv(labelled, flat)
    return files.read_csv(spark, flat, labelled.schema)


def forced_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Order table forced to three known columns and a new one that is filled with 0."""
    orders = H.fill_zero(views.table(spark, folder, "orders"))
    return H.force_columns(orders, ["o_totalprice", "o_discount", "o_custkey", "o_orderkey"])


def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    labelled = Z.labelled(_records(spark, folder)).select("vec_id", "target")
    return P.stratified_folds(labelled, "target", "vec_id")


def hashed_folds(spark: SparkSession, folder: str) -> DataFrame:
    labelled = Z.labelled(_records(spark, folder)).select("vec_id", "target", "line")
    return P.hashed_folds(labelled, ["line"]).select("vec_id", "target", "fold")


def _plain_scores(spark: SparkSession, folder: str) -> DataFrame:
    total = F.aggregate("pairs", F.lit(0.0), lambda sum_, p: sum_ + p["value"])
    called = Z.labelled(_records(spark, folder)).select(
        "vec_id", "target", (total >= PLAIN_LIMIT).cast("int").alias("predicted"))
    return M.precision_recall(P.stratified_folds(called, "target", "vec_id"), ["fold"], "target", "predicted")


def fold_precision_recall(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_plain_scores(spark, folder))


def mean_precision_recall(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(M.mean_scores(_plain_scores(spark, folder)))


def _rounded(scores: DataFrame) -> DataFrame:
    return scores.withColumns({c: F.round(c, 4) for c in ("precision", "recall")})


def gbt_cv(spark: SparkSession, folder: str) -> DataFrame:
    return _cross_validated(spark, folder)


def gbt_cv_first_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Precision and recall of each held-out fold with two trees of depth 2."""
    return _rounded(_cross_validated(spark, folder, **FIRST_ROUNDS))


def _cross_validated(spark: SparkSession, folder: str, **settings) -> DataFrame:
    folded = P.stratified_folds(B.training_rows(_records(spark, folder), ["vec_id"], N), "target", "vec_id")
    return B.fold_scores(B.stored_rows(folded), "fold", **settings)


def _final_model(spark: SparkSession, folder: str, names: list[str], **settings) -> B.RiskModel:
    rows = B.stored_rows(B.training_rows(_records(spark, folder), ["vec_id"], N))
    return B.RiskModel(B.fit(rows, **settings), names)


def _feature_names(spark: SparkSession, folder: str) -> list[str]:
    """The features' columns by their mapped names, in order."""
    names = H.new_names(H.unique_names(views.feature_mapping(spark, folder)), N)
    return [names.get(f"feature_{i}", f"feature_{i}") for i in range(N)]


def _ranked_features(spark: SparkSession, folder: str, **settings) -> DataFrame:
    model = _final_model(spark, folder, _feature_names(spark, folder), **settings)
    return B.top_importances(spark, model)


def _scored(spark: SparkSession, folder: str, **settings) -> DataFrame:
    """Train, save, load with the contract, check the input against it and score every record."""
    path = _scratch(spark, "model")
    B.save_model(_final_model(spark, folder, _feature_names(spark, folder), **settings), path)
    named = labelled_features(spark, folder).drop("risk_score", "target")
    return B.score(named, B.load_model(path), keep=["vec_id"])


def top_importances(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked_features(spark, folder)


def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder)


# The first rounds of boosting, small enough to be written out in SQL.
FIRST_ROUNDS = {"maxIter": 2, "maxDepth": 2}


def gbt_first_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the first two trees, read from the saved model."""
    path = _scratch(spark, "model")
    B.save_model(_final_model(spark, folder, _feature_names(spark, folder), **FIRST_ROUNDS), path)
    nodes = B.saved_nodes(spark, path, FIRST_ROUNDS["maxDepth"])
    return nodes.withColumns({"tree": F.col("tree").cast("int"), "mean": F.round("mean", 6), "cut": F.round("cut", 6)})


def score_first_rounds(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, **FIRST_ROUNDS)


def importance_first_rounds(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked_features(spark, folder, **FIRST_ROUNDS).withColumn("importance", F.round("importance", 6))


QUERIES = [sparse_long, sparse_wide, text_folder, rejected_lines, messy_rejects, messy_wide,
           messy_observed, filled_gaps, text_days, risk_label, unique_feature_names, labelled_features,
           labelled_long, flat_files, forced_columns, stratified_folds, hashed_folds, fold_precision_recall,
           mean_precision_recall, gbt_cv, top_importances, score_batch,
           gbt_cv_first_rounds, gbt_first_rounds, score_first_rounds, importance_first_rounds]
