"""Resample documents towards a target distribution (operator 13).

Words and runs of words are hashed into buckets. A bucket's gain is the logarithm of its share in the target texts
over its share in the documents, and a document's weight the mean gain of its features, read from one array of all
buckets. A seeded Gumbel number is added to the weight, and the documents with the highest scores are drawn: a
distributed quickselect finds the last score that is drawn, and only the winners are sorted.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrisk.llm.passages import slices
from shelfrisk.operators.ordered import placed
from shelfrisk.session import materialise, total_of

# Capital letters A-Z to small ones; bytes that are in no word to blanks. Bytes from 128 on are parts of letters.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PIVOTS = 16  # keys that one round of the quickselect compares with
KEY = ["down", "no_id", "id", "n_features"]  # a document's composite key, smallest first; equal keys are equal rows


def feature_buckets(text: bytes, buckets: int, longest: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to `longest` words."""
    words = text.translate(WORD_BYTES).split()
    following = [b" " + w for w in words[1:]]
    runs = [list(map(crc32, words))]
    for extra in range(longest - 1):  # a run's checksum goes on from that of the run one word shorter
        runs.append(list(map(crc32, following[extra:], runs[-1])))
    return len(words), (np.concatenate([np.array(r, dtype=np.int64) for r in runs]) % buckets).astype("<u2")


def featured(texts: DataFrame, buckets: int, longest: int, keep: list[str]) -> DataFrame:
    """The columns to keep, n_words and the buckets of every feature (packed), stored."""
    source = texts.select(*keep, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = [feature_buckets(t, buckets, longest) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array([n for n, _ in found], pa.int64()),
                                                  pa.array([b.tobytes() for _, b in found], pa.binary())], names=[*keep, "n_words", "buckets"])

    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in source.schema if f.name in keep)
    return materialise(source.mapInArrow(run, kept + "n_words long, buckets binary"))


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall in each bucket. A task sums its own rows, so no more than one array per task moves."""

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "buckets"):
                for packed in part.column("buckets").to_pylist():
                    total += np.bincount(np.frombuffer(packed, dtype="<u2"), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    sums = rows.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in sums.collect():  # one row per bucket, a fixed number
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(smoothed share of the target / smoothed share of the source)) of each bucket."""
    size, whole, aimed = len(source), float(source.sum()), float(target.sum())
    shares = [(t + 1.0) * (whole + size) / ((s + 1.0) * (aimed + size)) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(share)) for share in shares], dtype=np.int64)


def kth_key(keys: DataFrame, names: list[str], k: int, pivots: int = PIVOTS) -> tuple[tuple, int, int]:
    """The key at place `k` (from 1) of a stored table, how many rows come before it and how many equal it.

    Each round draws random pivot keys, counts the rows below, at and between them exactly and goes on with the part
    that holds place `k`. Only pivots and counts come to the driver. `names` are columns without NULL.
    """
    inside, before, turn = keys, 0, 0
    key = F.struct(*names)
    while True:
        drawn = inside.select(*names).orderBy(F.xxhash64(F.lit(turn), *names), *names).limit(pivots).collect()
        cuts = sorted({tuple(row) for row in drawn})
        table = F.array(*[F.struct(*[F.lit(v).cast(inside.schema[n].dataType).alias(n) for n, v in zip(names, cut)]) for cut in cuts])
        # 2i for rows between cuts i - 1 and i, 2i + 1 for rows at cut i.
        spot = 2 * F.size(F.filter(table, lambda c: c < key)) + F.array_contains(table, key).cast("int")
        marked = inside.withColumn("__spot", spot)
        sizes = {row["__spot"]: row["rows"] for row in marked.groupBy("__spot").agg(F.count(F.lit(1)).alias("rows")).collect()}
        for at in range(2 * len(cuts) + 1):
            if before + sizes.get(at, 0) >= k:
                break
            before += sizes.get(at, 0)
        if at % 2:
            return cuts[at // 2], before, sizes[at]
        inside, turn = materialise(marked.filter(F.col("__spot") == at).drop("__spot")), turn + 1


def _score(weight: str, doc_id: str, seed: int) -> Column:
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.col(weight) + F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, buckets: int = 10_000, longest: int = 2,
             seed: int = 7, pivots: int = PIVOTS) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of `docs`; `target` has a text column.

    `percent` of the documents with at least `least_words` words are drawn: those with the highest scores, ties to the
    smaller doc_id, NULL ids last. Undrawn documents have a NULL rank. NULL and empty texts have no features and
    weight 0. A NULL doc_id gets the random number of the empty text. Of rows with equal id and score the one with
    fewer features comes first; rows that are equal in all of it are interchangeable and as many as there is room for are
    drawn. Without any target text every feature counts by its rarity alone. Other columns are ignored.
    `buckets` is at most 65,536.
    """
    rows = featured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), buckets, longest, ["doc_id"])
    gain = gains(bucket_counts(rows, buckets), bucket_counts(featured(target.select("text"), buckets, longest, []), buckets))

    def weigh(batches):
        for batch in batches:
            for part in slices(batch, "buckets"):
                found = [gain[np.frombuffer(b, dtype="<u2")] for b in part.column("buckets").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_words"), pa.array([len(g) for g in found], pa.int64()),
                     pa.array([int(g.sum()) // len(g) if len(g) else 0 for g in found], pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    weighed = rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long").withColumn("score", _score("weight", "doc_id", seed))
    able = F.col("n_words") >= least_words
    keyed = materialise(weighed.select("doc_id", "n_features", "weight", "score", able.alias("able"), (-F.col("score")).alias("down"),
                                       F.col("doc_id").isNull().cast("int").alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id")),
                        able=F.count_if("able"))
    return _draw(keyed, percent * total_of(keyed, "able") // 100, pivots)


def _draw(keyed: DataFrame, wanted: int, pivots: int) -> DataFrame:
    """`keyed` with the places of the first `wanted` rows among those that are able."""
    out = ["doc_id", "n_features", "weight", "score"]
    able = keyed.filter("able")
    if not wanted:
        return keyed.select(*out, F.lit(None).cast("long").alias("rank"))
    last, before, equal = kth_key(able.select(*KEY), KEY, wanted, pivots)
    key, edge = F.struct(*KEY), F.struct(*[F.lit(v).cast(keyed.schema[n].dataType).alias(n) for n, v in zip(KEY, last)])
    winners = placed(able.filter(key < edge).select(*out, *KEY[:-1]), KEY, "rank").select(*out, "rank")
    rest = keyed.filter(~F.col("able") | (key > edge)).select(*out, F.lit(None).cast("long").alias("rank"))
    at_edge = able.filter(key == edge)
    if equal == 1:
        return winners.unionByName(at_edge.select(*out, F.lit(wanted).cast("long").alias("rank"))).unionByName(rest)
    row = at_edge.select(*out).first()  # its equals differ in nothing
    copies = keyed.sparkSession.range(equal).select(
        *[F.lit(row[c]).cast("long").alias(c) for c in out],
        F.when(F.col("id") < wanted - before, F.col("id") + before + 1).alias("rank"))
    return winners.unionByName(copies).unionByName(rest)
