"""N-gram Jaccard join: which documents share at least 85 % of their four-word shingles (operator 8).

The document by shingle incidence matrix is multiplied with its transpose block by block, a block being the
shingles of one task. A pair can only reach the bound if it meets in the first n - ceil(0.85 n) + 1 shingles of both,
in any fixed order, so only these rows enter the product; frequent shingles come last in the order. Equal sets
are one row. Two products are made. The first takes, per shingle, only the set with the fewest rarer shingles as
partner, the centre of a group of near copies, and so joins most of the group at once. The second takes all pairs
whose ends are still in different components and adds up their overlap: the shingles counted so far and all that may follow
the last common one must reach the bound. Both drop pairs that by their sizes and the place of a shingle cannot reach it, and
verify what is left on whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.llm import passages as P
from shelfrisk.llm.components import components
from shelfrisk.session import materialise, row_count

BUCKETS = 1 << 18  # of the table of shingle counts; it only orders shingles, so shared buckets cost time, not links
SHIFT = np.uint64(64 - 18)
PARTS = 64
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text: str, words: int) -> np.ndarray:
    """Distinct 64-bit hashes of the runs of `words` lower-cased words; of all words if there are fewer; sorted."""
    units = P.word_units(text.encode().translate(LOWER))
    size = min(words, len(units))
    if not size:
        return np.zeros(0, dtype=np.uint64)
    first = np.arange(len(units) - size + 1)
    return np.unique(P.mix(P.span_hash(P.prefix_sums(units), first, first + size) + np.uint64(size)))


def signature(found: np.ndarray) -> int:
    """One long for a set; equal sets have equal ones, others differ but for the chance of a 64-bit hash."""
    both = np.array([len(found), found.sum(dtype=np.uint64)], dtype=np.uint64)
    return int((P.mix(both)[0] ^ P.mix(both)[1] ^ P.mix(P.mix(found).sum(dtype=np.uint64).reshape(1))[0]).view(np.int64))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """One row per document (doc_id, signature, n), and per task the counts of its shingles by bucket (part, counts)."""

    def run(batches):
        counts = np.zeros(BUCKETS, dtype=np.int32)
        for batch in batches:
            for part in P.slices(batch, "text"):
                signs, sizes, every = [], [], [np.zeros(0, dtype=np.uint64)]
                for text in part.column("text").to_pylist():
                    found = shingles(text or "", words)
                    every.append(found)
                    signs.append(signature(found) if len(found) else None)
                    sizes.append(len(found))
                counts += np.bincount((np.concatenate(every) >> SHIFT).astype(np.int64), minlength=BUCKETS).astype(np.int32)
                none = pa.nulls(len(signs))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(signs, pa.int64()), pa.array(sizes, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())],
                    names=["doc_id", "signature", "n", "part", "counts"])
        if counts.any():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(PARTS, pa.int64())] * 3 + [pa.array(range(PARTS), pa.int32()), pa.array([c.tobytes() for c in np.split(counts, PARTS)])],
                names=["doc_id", "signature", "n", "part", "counts"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, signature long, n long, part int, counts binary")


def added(parts: DataFrame) -> np.ndarray:
    """The bucket counts of all tasks: BUCKETS numbers, whatever the data."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, dtype=np.int32).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()])], names=["part", "counts"])

    total = np.zeros((PARTS, BUCKETS // PARTS), dtype=np.int64)
    for row in parts.repartition("part").mapInArrow(add, "part int, counts binary").collect():
        total[row.part] += np.frombuffer(row.counts, dtype=np.int64)
    return total.ravel()


def prefix_rows(docs: DataFrame, words: int, percent: int, counts: np.ndarray) -> DataFrame:
    """(shingle, signature, n, place) of the first shingles of each set, rare ones first; once per slice for equal sets."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # BUCKETS numbers

    def run(batches):
        order = shared.value
        for batch in batches:
            for part in P.slices(batch, "text"):
                done, rows = set(), []
                for text in part.column("text").to_pylist():
                    found = shingles(text or "", words)
                    n = len(found)
                    if not n or (sign := signature(found)) in done:
                        continue
                    done.add(sign)
                    weight = order[(found >> SHIFT).astype(np.int64)]
                    first = n - -(-percent * n // 100) + 1
                    rows.append((found[np.argsort(weight, kind="stable")[:first]].view(np.int64), np.full(first, sign), np.full(first, n, dtype=np.int32),
                                 np.arange(first, dtype=np.int32)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], names=["shingle", "signature", "n", "place"])

    return docs.select("text").mapInArrow(run, "shingle long, signature long, n int, place int")


def reachable(n_a, place_a, n_b, place_b, percent: int):
    """Whether sets of these sizes can reach the bound if the shingle at these places is their first common one. An overlap
    of at least `percent` / (100 + `percent`) of both sizes together must lie at or after it. Takes numbers, arrays or columns."""
    spare_a = (n_a - place_a) * (100 + percent) - percent * (n_a + n_b)
    spare_b = (n_b - place_b) * (100 + percent) - percent * (n_a + n_b)
    return (spare_a >= 0) & (spare_b >= 0) & (100 * n_a >= percent * n_b) & (100 * n_b >= percent * n_a)


def enough(overlap, n_a, last_a, n_b, last_b, percent: int, least=min):
    """Whether sets of these sizes can reach the bound: `overlap` common shingles up to the last common one, at these places, and
    at most all that follows it."""
    return (overlap + least(n_a - last_a, n_b - last_b) - 1) * (100 + percent) >= percent * (n_a + n_b)


def shared_rows(rows: DataFrame, percent: int) -> DataFrame:
    """(shingle, signature, n, place, pivot) of shingles that at least two sets have. pivot: the set with the fewest rarer
    shingles, or the set itself if the two cannot reach the bound. Rows stream by in order, so no group is held."""

    def read(batches):
        last, head, waiting = (None, None), (0, 0, 0), None
        for batch in P.in_parts(batches):
            rows = [batch.column(c).to_numpy() for c in ("shingle", "signature", "n", "place")]
            if not batch.num_rows:
                continue
            shingle, sign = rows[:2]
            rows = [c[np.append((shingle[0], sign[0]) != last, (shingle[1:] != shingle[:-1]) | (sign[1:] != sign[:-1]))] for c in rows]
            shingle, sign, n, place = rows
            if not len(shingle):
                continue
            new = np.append(shingle[0] != last[0], shingle[1:] != shingle[:-1])
            grouped = ~new | np.append(~new[1:], False)
            at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            first = [np.where(at < 0, h, c[at]) for h, c in zip(head, (sign, n, place))]
            near = reachable(n.astype(np.int64), place.astype(np.int64), first[1].astype(np.int64), first[2].astype(np.int64), percent)
            out = [c[grouped] for c in (shingle, sign, n, place, np.where(near, first[0], sign))]
            if waiting and not new[0]:
                out = [np.append(w, c).astype(c.dtype) for w, c in zip(waiting, out)]
            waiting = (shingle[-1], sign[-1], n[-1], place[-1], sign[-1]) if new[-1] else None  # alone so far
            last, head = (shingle[-1], sign[-1]), tuple(c[-1] for c in first)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["shingle", "signature", "n", "place", "pivot"])

    return (rows.repartition("shingle").sortWithinPartitions("shingle", "place", "signature")
            .mapInArrow(read, "shingle long, signature long, n int, place int, pivot long"))


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets really share `percent` of their union."""

    def run(batches):
        for batch in P.in_parts(batches):
            keep, last, left = [], None, None
            for a, one, other in zip(*(batch.column(c).to_pylist() for c in ("a", "text_a", "text_b"))):
                if a != last:
                    last, left = a, shingles(one, words)
                right = shingles(other, words)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = pairs.join(texts.select(F.col("signature").alias("b"), F.col("text").alias("text_b")), "b")
    return (near.join(texts.select(F.col("signature").alias("a"), F.col("text").alias("text_a")), "a")
            .select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"))


def similar_components(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every document.

    Words are runs of characters other than space and the controls 9 to 13, with A-Z lower-cased. Two documents link
    if their sets of distinct `words`-word shingles share `percent` of the union; a text with fewer words has all
    of them as its one shingle; without words (NULL, blank) it is linked with nothing. component_id is the smallest
    doc_id that links reach. Rows that repeat a doc_id each have their own set. A row without doc_id joins
    the class of rows with an equal set and is otherwise linked with nothing, with component_id NULL. Other columns
    are ignored.
    """
    documents = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = materialise(signatures(documents, words))
    sets = first.filter("part is null").select("doc_id", "signature", "n")
    counts = added(first.filter("part is not null").select("part", "counts"))
    shared = materialise(shared_rows(prefix_rows(documents, words, percent, counts), percent))

    # A text of each set that may have a partner.
    owners = (sets.filter("signature is not null and doc_id is not null").groupBy("signature").agg(F.min("doc_id").alias("doc_id"))
              .join(shared.select("signature").distinct(), "signature"))
    marked = documents.filter("doc_id is not null")
    owned = marked.join(owners, "doc_id").mapInArrow(_own_text(words), "signature long, text string")
    texts = materialise(owned)
    if texts.select("signature").distinct().count() < row_count(texts):
        # One text per set: a repeated doc_id brings as many, and would make as many pairs times as many.
        texts = materialise(texts.groupBy("signature").agg(F.any_value("text").alias("text")))

    pairs = shared.filter("pivot != signature").select(F.col("pivot").alias("a"), F.col("signature").alias("b")).distinct()
    stars = materialise(verified(pairs, texts, words, percent))
    joined = materialise(components(stars))

    # Pairs between components that are still apart.
    named = (shared.join(joined.withColumnRenamed("id", "signature"), "signature", "left")
             .withColumn("component", F.coalesce("component", "signature")))
    apart = named.groupBy("shingle").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least != most").select("shingle")
    rows = materialise(named.join(apart, "shingle").select("shingle", "signature", "n", "place", "component"))
    left, right = (rows.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("signature", "n", "place", "component")]) for side in "ab")
    products = (left.join(right, "shingle")
                .filter((F.col("component_a") < F.col("component_b"))
                        & reachable(F.col("n_a"), F.col("place_a"), F.col("n_b"), F.col("place_b"), percent))
                .groupBy(F.col("signature_a").alias("a"), F.col("signature_b").alias("b"), "n_a", "n_b")
                .agg(F.count(F.lit(1)).alias("overlap"), F.max("place_a").alias("last_a"), F.max("place_b").alias("last_b"))
                .filter(enough(F.col("overlap"), F.col("n_a"), F.col("last_a"), F.col("n_b"), F.col("last_b"), percent, F.least))
                .select("a", "b"))
    more = verified(products, texts, words, percent)
    final = components(stars.union(more)).withColumnRenamed("id", "signature")

    classes = sets.join(final, "signature", "left").withColumn("class", F.coalesce("component", "signature"))
    least = classes.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    return (classes.join(least, "class", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")))


def _own_text(words: int):
    """(signature, text) of rows whose text has the signature; a repeated doc_id may carry another text."""

    def run(batches):
        for batch in P.in_parts(batches):
            keep = []
            for text, sign in zip(batch.column("text").to_pylist(), batch.column("signature").to_pylist()):
                found = shingles(text or "", words)
                keep.append(len(found) > 0 and signature(found) == sign)
            yield batch.select(["signature", "text"]).filter(pa.array(keep, pa.bool_()))

    return run
