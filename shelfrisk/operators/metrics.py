"""Hold-out and cross-validation scores as plain aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.session import attach


def regression_scores(predictions: DataFrame, keys: list[str], observed: str, predicted: str) -> DataFrame:
    """R2, RMSE and MAE per group. R2 is 1 where the observed values do not vary."""
    error = F.col(observed) - F.col(predicted)
    spread = F.count(observed) * F.var_pop(observed)
    return predictions.groupBy(*keys).agg(
        F.when(spread == 0, F.lit(1.0)).otherwise(1 - F.try_divide(F.sum(error * error), spread)).alias("R2"),
        F.sqrt(F.avg(error * error)).alias("RMSE"), F.avg(F.abs(error)).alias("MAE"))


def scores_of_models(models: DataFrame, predictions: DataFrame, keys: list[str], observed: str,
                     predicted: str) -> DataFrame:
    """`regression_scores` for every fitted model; one without test rows has R2 1 and no errors (NaN)."""
    scores = regression_scores(predictions, keys, observed, predicted)
    nan = F.lit(float("nan"))
    return attach(models.select(*keys), scores, keys).withColumns({
        "R2": F.coalesce("R2", F.lit(1.0)), "RMSE": F.coalesce("RMSE", nan), "MAE": F.coalesce("MAE", nan)})


def precision_recall(predictions: DataFrame, keys: list[str], target: str, predicted: str) -> DataFrame:
    """Precision and recall of class 1 per group; 0 where nothing is predicted or present."""
    hit = F.count_if((F.col(target) == 1) & (F.col(predicted) == 1))
    return predictions.groupBy(*keys).agg(
        F.coalesce(F.try_divide(hit, F.count_if(F.col(predicted) == 1)), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(hit, F.count_if(F.col(target) == 1)), F.lit(0.0)).alias("recall"))


def mean_scores(per_fold: DataFrame) -> DataFrame:
    """Plain mean of the folds' precision and recall."""
    return per_fold.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"))
