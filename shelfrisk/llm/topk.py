"""Exact top-k search by inner product with a pivot-distance index (operator 5).

Vectors get one more component that brings all to the same norm; the largest inner product is then the smallest
distance. Each vector is keyed by its nearest pivot and the distance to it, and the sorted keys are cut into
blocks: annuli around a pivot. A query block first searches the annulus it falls into, which bounds its k-th score.
By the triangle inequality only annuli within that radius can hold anything better; they are searched and no others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrisk.llm.vectors import matrix, packed, usable
from shelfrisk.session import materialise, row_count

BLOCK_ROWS = 2048
PIVOTS = 16
PIVOT_SAMPLE = 1024  # vectors from which pivots are picked; any pivots give right results


def pick_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Vectors far from each other: each is the farthest from those before."""
    if not len(sample):
        return sample
    chosen, gap = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(most, len(sample)):
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        if not gap.max():
            break
        chosen.append(int(gap.argmax()))
    return sample[chosen]


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _blocks(keyed: DataFrame, tasks: int, width: int) -> DataFrame:
    """Rows (pivot, distance, vec_id, vector), sorted and packed: (block, pivot, low, high, ids, vectors, distances).
    Blocks are numbered by task and place in it; vec_id may repeat over many blocks."""

    def pack(batches):
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            pivot, distance, ids = (batch.column(c).to_numpy() for c in ("pivot", "distance", "vec_id"))
            if not len(ids):
                continue
            new = np.append(True, pivot[1:] != pivot[:-1])
            place = np.arange(len(ids)) - np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
            cut = np.flatnonzero(place % BLOCK_ROWS == 0)
            vectors = batch.column("vector").to_pylist()
            rows = []
            for block, (a, b) in enumerate(zip(cut, np.append(cut[1:], len(ids))), made):
                rows.append((block, int(pivot[a]), float(distance[a]), float(distance[b - 1]), ids[a:b].tobytes(), b"".join(vectors[a:b]),
                             distance[a:b].tobytes()))
            made += len(rows)
            yield pa.RecordBatch.from_pylist([dict(zip(("block", "pivot", "low", "high", "ids", "vectors", "distances"), r)) for r in rows], schema=schema)

    schema = pa.schema([("block", pa.int64()), ("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("ids", pa.binary()),
                        ("vectors", pa.binary()), ("distances", pa.binary())])
    return (keyed.repartitionByRange(tasks, "pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")
            .mapInArrow(pack, "block long, pivot int, low double, high double, ids binary, vectors binary, distances binary"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector of `queries` the k best of `vectors` but itself, all if fewer.

    Both have vec_id and embedding; components count as floor(scale * x). The score is the integer inner product;
    ties go to the smaller vec_id, and repeated rows with one vec_id are candidates each; equal rows of `queries` are one query. NULL vectors, empty ones
    and those with NULL or non-finite components take no part, nor do rows without vec_id. Vectors of
    different lengths are compared as if the shorter one ended in zeros. Other columns are ignored.
    """
    def clean(table):
        # A cast keeps the values: a float is the same number as a double.
        return (table.filter(F.col("vec_id").isNotNull() & usable("embedding"))
                .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")))

    data, asked = clean(vectors), clean(queries)
    grid = F.transform("embedding", lambda v: F.floor(v * F.lit(scale)).cast("double"))
    facts = (data.select(F.size("embedding").alias("size"), F.aggregate(grid, F.lit(0.0), lambda a, v: a + v * v).alias("square"),
                         F.array_max(F.transform(grid, lambda v: F.abs(v))).alias("top"))
             .agg(F.max("size").alias("width"), F.max("square").alias("square"), F.max("top").alias("top")).first())
    width = max(facts.width or 1, asked.agg(F.max(F.size("embedding"))).first()[0] or 1)
    top = max(facts.top or 0, asked.select(F.array_max(F.transform(grid, lambda v: F.abs(v))).alias("top")).agg(F.max("top")).first()[0] or 0)
    kind = next(t for t in ("int8", "int16", "int32", "int64") if top <= np.iinfo(t).max)
    norm = float(facts.square or 0)  # squared, of the longest vector
    sample = [r.embedding for r in data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).collect()]
    rows = np.zeros((len(sample), width))
    for row, vector in zip(rows, sample):
        row[:len(vector)] = np.floor(np.array(vector) * scale)
    lifted = np.column_stack([rows, np.sqrt(np.maximum(0, norm - (rows**2).sum(1)))])
    pivots = pick_pivots(lifted, PIVOTS)
    if not len(pivots):
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    names = ["pivot", "distance", "vec_id", "vector"]

    def key(lift: bool):
        def run(batches):
            for batch in batches:
                x = np.floor(matrix(batch.column("embedding"), width) * scale)
                square = (x**2).sum(1)
                last = np.sqrt(np.maximum(0, norm - square)) if lift else np.zeros(len(x))
                full = np.column_stack([x, last])
                apart = np.sqrt(np.maximum(0, (full**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * full @ pivots.T))
                near = apart.argmin(1)
                yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), pa.array(apart[np.arange(len(x)), near]), batch.column("vec_id"),
                                                  packed(x.astype(kind))], names=names)
        return run

    schema = "pivot int, distance double, vec_id long, vector binary"
    keyed, wanted = (materialise(t.mapInArrow(key(lift), schema)) for t, lift in ((data, True), (asked.dropDuplicates(), False)))
    tasks = [max(1, -(-row_count(t) // (8 * BLOCK_ROWS))) for t in (keyed, wanted)]
    blocks = materialise(_blocks(keyed, tasks[0], width))
    asking = materialise(_blocks(wanted, tasks[1], width).select(F.col("block").alias("asking"), "pivot", "low", "high",
                                                                 F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")))

    # The annulus a query block falls into bounds the k-th score of its queries.
    mine = asking.select("asking", "pivot", F.col("low").alias("from"), F.col("high").alias("to"))
    gap = F.greatest(F.lit(0.0), F.col("low") - F.col("to"), F.col("from") - F.col("high"))
    size = F.octet_length("ids")
    home = (mine.join(blocks.select("block", "pivot", "low", "high", size.alias("size")), "pivot")
            .groupBy("asking").agg(F.min_by("block", F.struct(gap, -F.col("size"), F.col("block"))).alias("block")))

    def scores(row):
        ids, query_ids = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["query_ids"], dtype=np.int64)
        x, q = (np.frombuffer(row[c], dtype=kind).reshape(-1, width) for c in ("vectors", "queries"))
        return ids, query_ids, q, inner(q, x), ids == query_ids[:, None]

    def bound(batches):
        for batch in batches:
            for row in batch.to_pylist():
                least, reach, apart = None, None, None
                q = np.frombuffer(row["queries"], dtype=kind).reshape(-1, width).astype(np.float64)
                square = (q**2).sum(1)
                kth = np.full(len(q), -np.inf)
                if row["ids"] is not None:
                    ids, _, _, got, own = scores(row)
                    got = np.where(own, np.iinfo(np.int64).min, got)
                    if len(ids) > k:
                        kth = np.partition(got, len(ids) - k, axis=1)[:, len(ids) - k].astype(np.float64)
                least = kth.tobytes()
                radius = np.sqrt(np.maximum(0, square + norm - 2 * kth)) * (1 + 1e-9) + 1e-6
                full = np.column_stack([q, np.zeros(len(q))])
                apart = np.sqrt(np.maximum(0, square[:, None] + (pivots**2).sum(1) - 2 * full @ pivots.T))
                reach = (apart - radius[:, None]).min(0), (apart + radius[:, None]).max(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["asking"]] * len(pivots), pa.int64()), pa.array(range(len(pivots)), pa.int32()), pa.array(reach[0]), pa.array(reach[1]),
                     pa.array([least] * len(pivots), pa.binary())], names=["asking", "pivot", "inside", "outside", "least"])

    payload = blocks.select("block", "ids", "vectors")
    bounds = materialise(asking.select("asking", "query_ids", "queries").join(home, "asking", "left").join(payload, "block", "left")
                         .select("asking", "query_ids", "queries", "ids", "vectors")
                         .mapInArrow(bound, "asking long, pivot int, inside double, outside double, least binary"))
    pairs = (bounds.select("asking", "pivot", "inside", "outside").join(blocks.select("block", "pivot", "low", "high"), "pivot")
             .filter("high >= inside and low <= outside").select("asking", "block"))
    least = bounds.filter("pivot = 0").select("asking", "least")

    def search(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                ids, query_ids, _, got, own = scores(row)
                who, what = np.nonzero((got >= np.frombuffer(row["least"])[:, None]) & ~own)
                score = got[who, what]
                order = np.lexsort((ids[what], -score, who))
                who, what, score = who[order], what[order], score[order]
                first = np.append(True, who[1:] != who[:-1]) if len(who) else np.zeros(0, dtype=bool)
                rank = np.arange(len(who)) - np.maximum.accumulate(np.where(first, np.arange(len(who)), 0))
                keep = rank < k
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[who[keep]]), pa.array(ids[what[keep]]), pa.array(score[keep])],
                                                 names=["query_id", "vec_id", "score"])

    found = (pairs.join(asking.select("asking", "query_ids", "queries").join(least, "asking"), "asking").join(payload, "block")
             .select("query_ids", "queries", "least", "ids", "vectors").mapInArrow(search, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
