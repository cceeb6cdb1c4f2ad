"""Least squares per group by a tall-skinny QR decomposition: tasks reduce rows to small triangles, triangles merge."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.session import attach, broadcast_if_small, materialise

# The steps below travel to the executors with the job, so only the driver needs this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: a predictor is undefined if what earlier ones leave of it is shorter than this share of its length.
TOLERANCE = 1e-7
# Groups whose triangles a task holds at once.
HELD_GROUPS = 4096
# Triangles of one group that are merged in one step are spread over this many first.
SALTS = 256


def fit_linear(rows: DataFrame, group: str, target: str, predictors: list[str], tolerance: float = TOLERANCE) -> DataFrame:
    """One row per group: `n`, `intercept`, `b_<predictor>`, `full_rank`, `status`.

    `status` says why a group has no usable model: 'fitted', 'missing values', 'too few rows' or 'undefined
    coefficients'. One failing group never stops the others. Coefficients of predictors that earlier ones determine are
    NULL and the others are fitted without them.

    The rows' own digits are kept: sums of products would lose all that is below 1e-8 of a column. A task turns its rows of a
    group into one triangle, so a hot group moves a triangle per task, and those are merged in two steps.
    """
    names = [*predictors, target]
    size = len(names) + 1
    key = f"`{group}` {rows.schema[group].dataType.simpleString()}"
    wide = rows.filter(F.col(group).isNotNull()).select(group, F.array(*[F.col(c).cast("double") for c in names]).alias("values"))
    parts = wide.mapInArrow(_triangles(group, size), f"{key}, n long, triangle array<double>")
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    merge = _merged(group, size)
    salted = parts.withColumn("salt", salt).groupBy(group, "salt").applyInPandas(merge, f"{key}, n long, triangle array<double>")
    whole = salted.groupBy(group).applyInPandas(merge, f"{key}, n long, triangle array<double>")
    fields = [key, "n long", "intercept double", *[f"`b_{p}` double" for p in predictors], "full_rank boolean"]
    solved = whole.mapInPandas(_solver(group, predictors, tolerance), ", ".join(fields))
    missing = F.col("intercept").isNull() | F.isnan("intercept")
    return materialise(solved.withColumn("status", F.when(F.col("full_rank") & ~missing, "fitted").when(missing, "missing values")
                                         .when(F.col("n") <= len(predictors), "too few rows").otherwise("undefined coefficients")))


def _triangles(group: str, size: int):
    """Batch step: the triangle of (1, predictors, target) of each group's rows. A group with a missing value has NaN throughout."""

    def run(batches):
        held, kind = {}, None

        def flushed():
            names = list(held)
            out = [held.pop(k) for k in names]
            return pa.RecordBatch.from_arrays([pa.array(names, kind), pa.array([n for n, _ in out], pa.int64()),
                                               pa.array([t.ravel() for _, t in out], pa.list_(pa.float64()))], names=[group, "n", "triangle"])

        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(group).dictionary_encode()
            kind = batch.column(group).type
            flat = batch.column("values").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            table = np.column_stack([np.ones(batch.num_rows), flat.reshape(-1, size - 1)])
            code = own.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            cut = np.flatnonzero(np.append(True, np.diff(code[order]) > 0))
            for a, b in zip(cut, np.append(cut[1:], len(order))):
                name = own.dictionary[int(code[order[a]])].as_py()
                n, triangle = held.get(name, (0, np.zeros((0, size))))
                held[name] = n + int(b - a), reduced(np.vstack([triangle, table[order[a:b]]]), size)
                if len(held) >= HELD_GROUPS:
                    yield flushed()
        if held:
            yield flushed()

    return run


def reduced(rows: np.ndarray, size: int) -> np.ndarray:
    """The triangle whose columns have the same products as those of `rows`; zeros below if there are few rows."""
    out = np.zeros((size, size))
    if np.isnan(rows).any() or np.isinf(rows).any():
        return np.full((size, size), np.nan)
    triangle = np.linalg.qr(rows, mode="r")
    out[:len(triangle)] = triangle
    return out


def _merged(group: str, size: int):
    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        stacked = np.vstack([np.asarray(t, dtype=float).reshape(size, size) for t in parts["triangle"]])
        return pd.DataFrame({group: [parts[group].iloc[0]], "n": [int(parts["n"].sum())], "triangle": [reduced(stacked, size).ravel()]})

    return merge


def solve(triangle: np.ndarray, tolerance: float) -> np.ndarray:
    """Coefficients of all columns but the last on the last, in order; NaN for a column that earlier ones determine."""
    size = len(triangle) - 1
    kept, basis = [], np.zeros((len(triangle), 0))
    for k in range(size):
        column = triangle[:, k]
        rest = column - basis @ (basis.T @ column)
        rest = rest - basis @ (basis.T @ rest)  # once more, for the digits that the first step lost
        length = np.linalg.norm(rest)
        if length > tolerance * np.linalg.norm(column):
            kept.append(k)
            basis = np.column_stack([basis, rest / length])
    found = np.full(size, np.nan)
    if kept:
        found[kept] = np.linalg.solve(basis.T @ triangle[:, kept], basis.T @ triangle[:, size])
    return found


def _solver(group: str, predictors: list[str], tolerance: float):
    """Batch step from triangles to coefficients."""
    size = len(predictors) + 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for triangle in batch["triangle"]:
                table = np.asarray(triangle, dtype=float).reshape(size, size)
                out.append(np.full(size - 1, np.nan) if np.isnan(table).any() else solve(table, tolerance))
            found = np.array(out).reshape(-1, size - 1)
            result = pd.DataFrame({group: batch[group], "n": batch["n"], "intercept": found[:, 0]})
            for i, p in enumerate(predictors):
                result[f"b_{p}"] = pd.Series(found[:, i + 1], index=batch.index, dtype="Float64").where(~np.isnan(found[:, i + 1]))
            result["full_rank"] = ~np.isnan(found).any(axis=1)
            yield result

    return run


def predict_linear(rows: DataFrame, models: DataFrame, group: str, predictors: list[str]) -> DataFrame:
    """Add `prediction` to rows of groups whose model has full rank; other rows are dropped."""
    usable = materialise(models.filter("full_rank").select(group, "intercept", *[f"b_{p}" for p in predictors]))
    joined = attach(rows, broadcast_if_small(usable), [group], "inner")
    value = F.col("intercept")
    for p in predictors:
        value = value + F.col(f"b_{p}") * F.col(p).cast("double")
    return joined.withColumn("prediction", value).drop("intercept", *[f"b_{p}" for p in predictors])


def coefficient_rows(models: DataFrame, group: str, labels: dict[str, str], with_intercept: bool = False) -> DataFrame:
    """Long form (group, variable, value) of the defined coefficients; `labels` maps predictor to name."""
    terms = [F.struct(F.lit("(Intercept)").alias("variable"), F.col("intercept").alias("value"))]
    terms += [F.struct(F.lit(label).alias("variable"), F.col(f"b_{p}").alias("value")) for p, label in labels.items()]
    long = models.select(group, F.explode(F.array(*terms)).alias("t")).select(group, "t.variable", "t.value")
    long = long.filter(F.col("value").isNotNull())
    return long if with_intercept else long.filter(F.col("variable") != "(Intercept)")
