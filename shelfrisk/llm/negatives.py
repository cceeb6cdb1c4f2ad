"""Hard negatives by an inverted multi-index (operator 11).

Vectors are cut in half and each half has a codebook; a pair of codewords is a cell. An anchor's product with any
vector of a cell is at most the sum of two half scores: its product with the codeword plus its length times the
codeword's radius. A heap walks the two sorted lists of half scores and gives the cells by falling sum, without
building all sums. An anchor goes on, a growing number of rows a round, until the next sum is below the last place of
each of its windows: then no cell left can change them. Its positives come first; they set the windows of its negatives.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.llm.topk import inner
from shelfrisk.llm.vectors import matrix, packed, usable
from shelfrisk.session import BROADCAST_BYTES, broadcast_if_small, materialise, row_count, table_bytes, total_of

CELL_ROWS = 256  # rows that a cell should hold, about
MOST_WORDS = 1024  # codewords of a half; beyond that cells hold more rows
SAMPLE_PER_WORD = 32  # vectors per codeword from which codebooks are learned; any codebooks give right results
BLOCK_ROWS = 4096  # rows of a cell that are searched at once
ASKING_ROWS = 512  # anchors that search together
FIRST_ROWS = 4096  # rows that an anchor may visit in the first round
GROWTH = 8  # times as many in each further round
HELD_ROWS = 1 << 20  # candidates of an anchor block after which a task keeps only the best
BLOCK = "block long, cell int, ids binary, labels binary, vectors binary"
FOUND = "asking long, place int, slot int, score long, vec_id long"
# One row per anchor block. Packed: `wanted` has rows of place, slot, low, high and least, `found` and `positives` of place, slot,
# score and vec_id; `visited` has a bit per cell.
STATE = ("asking long, anchor_ids binary, anchor_labels binary, anchors binary, wanted binary, found binary, positives binary, visited binary, "
         "cells array<int>")
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def codebook(sample: np.ndarray, words: int, rounds: int = 8) -> np.ndarray:
    """Up to `words` centres of the sample's rows, by Lloyd's steps from evenly spread first centres."""
    centres = np.unique(sample, axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(words, len(centres))).astype(int)].astype(np.float64)
    for _ in range(rounds):
        near = nearest(sample, centres)[0]
        size = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, sample)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre and the distance to it; the distance is taken from the difference itself."""
    near = ((centres**2).sum(1) - 2 * rows @ centres.T).argmin(1)
    return near, np.sqrt(((rows - centres[near]) ** 2).sum(1))


class Index:
    """What an anchor needs to order the cells: codebooks, rows and radii of each cell. At most MOST_WORDS² cells."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], cells: pa.Table):
        self.books = books
        self.shape = len(books[0]), len(books[1])
        number = cells.column("cell").to_numpy()
        self.rows = np.zeros(self.shape, dtype=np.int64)
        self.radius = np.zeros((2, *self.shape))
        self.rows.flat[number] = cells.column("rows").to_numpy()
        for side, name in enumerate(("first", "second")):
            self.radius[side].flat[number] = cells.column(name).to_numpy() * (1 + 1e-9) + 1e-9
        self.widest = self.radius[0].max(1), self.radius[1].max(0)

    def visits(self, anchor: np.ndarray, least: int, most: int, rows: int):
        """Cells by falling sum of half scores, until they have held `rows` rows or no sum reaches `least`. Cells whose
        own radii say that all scores lie below `least` or above `most` are passed over."""
        half = self.books[0].shape[1]
        parts = anchor[:half], anchor[half:]
        length = [float(np.sqrt((p**2).sum())) for p in parts]
        mid = [book @ p for book, p in zip(self.books, parts)]
        slack = 1e-9 * sum(float(np.abs(m).max()) + n * float(w.max()) for m, n, w in zip(mid, length, self.widest)) + 1e-6
        half_scores = [m + n * w for m, n, w in zip(mid, length, self.widest)]
        order = [np.argsort(-s, kind="stable") for s in half_scores]
        first, second = (s[o].tolist() for s, o in zip(half_scores, order))
        heap, seen = [(-first[0] - second[0], 0, 0)], 0
        while heap:
            bound, i, j = heapq.heappop(heap)
            if -bound < least - slack or seen >= rows:
                return
            if j + 1 < len(second):
                heapq.heappush(heap, (-first[i] - second[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(first):
                heapq.heappush(heap, (-first[i + 1] - second[0], i + 1, 0))
            at = order[0][i], order[1][j]
            if not self.rows[at]:
                continue
            reach = length[0] * self.radius[0][at] + length[1] * self.radius[1][at]
            centre = mid[0][at[0]] + mid[1][at[1]]
            if centre + reach < least - slack or centre - reach > most + slack:
                continue
            seen += int(self.rows[at])
            yield int(at[0]) * self.shape[1] + int(at[1])


def _blocks(keyed: DataFrame, tasks: int, by_cell: bool, most: int) -> DataFrame:
    """Rows sorted by cell and packed, `most` to a block, one cell to a block if `by_cell`; numbered by task and place in it."""

    def pack(batches):
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            cell, ids, labels = (batch.column(c).to_numpy() for c in ("cell", "vec_id", "label"))
            if not len(ids):
                continue
            at = np.arange(len(ids))
            new = np.append(True, cell[1:] != cell[:-1]) if by_cell else at == 0
            cut = np.flatnonzero((at - np.maximum.accumulate(np.where(new, at, 0))) % most == 0)
            vectors = batch.column("vector").to_pylist()
            rows = [{"block": made + k, "cell": int(cell[a]), "ids": ids[a:b].tobytes(), "labels": labels[a:b].tobytes(), "vectors": b"".join(vectors[a:b])}
                    for k, (a, b) in enumerate(zip(cut, np.append(cut[1:], len(ids))))]
            made += len(rows)
            for row in rows:  # one by one: a batch may hold many blocks
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("block", pa.int64()), ("cell", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())])
    tie = keyed.withColumn("tie", F.monotonically_increasing_id())  # equal rows of a hot cell are dealt over tasks
    return materialise(tie.repartitionByRange(tasks, "cell", "tie").sortWithinPartitions("cell", "tie").drop("tie").mapInArrow(pack, BLOCK))


def _clean(table: DataFrame) -> DataFrame:
    # A cast keeps the values: a float is the same number as a double.
    return (table.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("embedding"))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                    F.col("embedding").cast("array<double>").alias("embedding")))


def best_rows(found: np.ndarray, k: int) -> np.ndarray:
    """The `k` best rows (place, slot, score, vec_id) of every place and slot, in order."""
    found = found[np.lexsort((found[:, 3], -found[:, 2], found[:, 1], found[:, 0]))]
    new = np.append(True, (np.diff(found[:, :2], axis=0) != 0).any(axis=1))[:len(found)]
    spot = np.arange(len(found))
    return found[spot - np.maximum.accumulate(np.where(new, spot, 0)) < k]


def least_scores(wanted: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
    """The wants with the least score that still counts: the last place's, once a window has all its places. `found` as `best_rows` gives it."""
    wanted = wanted.copy()
    if len(found) >= k:
        last = found[k - 1:][(found[k - 1:, :2] == found[:len(found) - k + 1, :2]).all(axis=1)]
        full = {(place, slot): score for place, slot, score, _ in last.tolist()}
        wanted[:, 4] = [max(least, full.get((place, slot), least)) for place, slot, _, _, least in wanted.tolist()]
    return wanted


def unpack(data: bytes | None, width: int) -> np.ndarray:
    return np.frombuffer(data or b"", dtype=np.int64).reshape(-1, width)


class Search:
    """Packed rows and anchors, and the rounds that compare them."""

    def __init__(self, data: DataFrame, asked: DataFrame, scale: float):
        size, top = F.size("embedding"), F.array_max(F.transform("embedding", lambda v: F.abs(F.floor(v * F.lit(scale)).cast("double"))))
        sides = data.withColumn("asks", F.lit(0)).unionByName(asked.withColumn("asks", F.lit(1)))
        facts = sides.agg(F.max(size).alias("width"), F.max(top).alias("top"), F.count_if(F.col("asks") == 0).alias("rows"),
                          F.count_if(F.col("asks") == 1).alias("anchors")).first()
        self.empty = not facts.rows or not facts.anchors
        if self.empty:
            return
        self.width = width = facts.width + facts.width % 2
        if facts.top**2 * width >= 2**62:
            raise ValueError("inner products do not fit 64 bits")
        self.kind = kind = next(t for t in ("int16", "int32", "int64") if facts.top <= np.iinfo(t).max)
        words = int(min(MOST_WORDS, max(1, (facts.rows / CELL_ROWS) ** 0.5)))
        sample = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_PER_WORD * words).select("embedding").toArrow().column(0)
        sample = np.floor(matrix(sample.combine_chunks(), width) * scale)
        books = tuple(codebook(part, words) for part in np.split(sample, 2, axis=1))

        def key(batches):
            for batch in batches:
                x = np.floor(matrix(batch.column("embedding"), width) * scale)
                (i, first), (j, second) = (nearest(part, book) for part, book in zip(np.split(x, 2, axis=1), books))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((i * len(books[1]) + j).astype(np.int32)), batch.column("vec_id"), batch.column("label"), pa.array(first), pa.array(second),
                     packed(x.astype(kind))], names=["cell", "vec_id", "label", "first", "second", "vector"])

        schema = "cell int, vec_id long, label long, first double, second double, vector binary"
        keyed, wanted = (materialise(t.mapInArrow(key, schema)) for t in (data, asked.dropDuplicates()))
        cells = keyed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("first").alias("first"), F.max("second").alias("second"))
        self.index = data.sparkSession.sparkContext.broadcast(Index(books, cells.toArrow()))
        names = ["cell", "vec_id", "label", "vector"]
        self.blocks = _blocks(keyed.select(*names), -(-row_count(keyed) // (8 * BLOCK_ROWS)), True, BLOCK_ROWS).drop("block")
        asking = _blocks(wanted.select(*names), -(-row_count(wanted) // (8 * ASKING_ROWS)), False, ASKING_ROWS)
        self.asking = asking.select(F.col("block").alias("asking"), F.col("ids").alias("anchor_ids"), F.col("labels").alias("anchor_labels"),
                                    F.col("vectors").alias("anchors"))
        self.pairs = 0

    def best(self, start: DataFrame, windows, k: int, same: bool) -> DataFrame:
        """STATE rows whose `found` has the `k` best rows of each want among those with the anchor's label, or with others.

        `windows(row)` gives the wants of a row of `start`: (place, slot, low, high), whose scores lie between low and high. A
        round is one job: cells that are due meet their anchor blocks, and each block's candidates its state, which says what
        is due next.
        """
        rows = FIRST_ROWS
        state = materialise(start.mapInArrow(self._first(windows, rows), STATE), cells=F.sum(F.size("cells")))
        while total_of(state, "cells"):
            self.pairs += total_of(state, "cells")
            pairs = state.select("asking", F.explode("cells").alias("cell"))
            asking = state.select("asking", "anchor_ids", "anchor_labels", "anchors", "wanted")
            joined = (self.blocks.join(broadcast_if_small(pairs, rows=total_of(state, "cells")), "cell")
                      .join(F.broadcast(asking) if table_bytes(state) <= BROADCAST_BYTES else asking, "asking"))
            scored = joined.mapInArrow(self._score(k, same), FOUND)
            rows *= GROWTH
            both = state.drop("cells").withColumn("kind", F.lit(0)).unionByName(scored.withColumn("kind", F.lit(1)), allowMissingColumns=True)
            state = materialise(both.repartition("asking").sortWithinPartitions("asking", "kind").mapInArrow(self._merged(k, rows), STATE),
                                cells=F.sum(F.size("cells")))
        return state

    def _due(self, row: dict, rows: int) -> pa.RecordBatch:
        """The row with the cells that its anchors visit next, also marked as visited."""
        index = self.index.value
        cells = index.rows.size
        anchors = np.frombuffer(row["anchors"], dtype=self.kind).reshape(-1, self.width).astype(np.float64)
        wanted = unpack(row["wanted"], 5)
        seen = (np.zeros(cells, dtype=bool) if row["visited"] is None
                else np.unpackbits(np.frombuffer(row["visited"], dtype=np.uint8), count=cells).astype(bool))
        due = np.zeros(cells, dtype=bool)
        for place in np.unique(wanted[:, 0]):
            own = wanted[wanted[:, 0] == place]
            due[list(index.visits(anchors[place], int(own[:, 4].min()), int(own[:, 3].max()), rows))] = True
        due &= ~seen
        row = row | {"visited": np.packbits(seen | due).tobytes(), "cells": np.flatnonzero(due).tolist()}
        return pa.RecordBatch.from_pylist([{f.name: row[f.name] for f in STATE_FIELDS}], schema=STATE_FIELDS)

    def _first(self, windows, rows: int):
        due = _Later(self).due

        def run(batches):
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    wants, positives = windows(row)
                    # The least score that counts is the window's lower end, until the window has all its places.
                    yield due(row | {"wanted": np.column_stack([wants, wants[:, 2]]).tobytes(), "found": b"", "positives": positives, "visited": None}, rows)

        return run

    def _merged(self, k: int, rows: int):
        """Candidates of an anchor block join its state, then it says which cells are due. Rows arrive sorted by block, its state first."""
        due = _Later(self).due

        def finished(row, found):
            found = best_rows(np.concatenate(found), k)
            wanted = least_scores(unpack(row["wanted"], 5), found, k)
            return due(row | {"found": found.tobytes(), "wanted": wanted.tobytes()}, rows)

        def run(batches):
            row, found, held = None, [], 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                asking, kind = batch.column("asking").to_numpy(), batch.column("kind").to_numpy()
                cut = np.flatnonzero(np.append(True, (asking[1:] != asking[:-1]) | (kind[1:] != kind[:-1])))
                for a, b in zip(cut, np.append(cut[1:], len(asking))):
                    part = batch.slice(a, b - a)
                    if kind[a] == 0:
                        if row is not None:
                            yield finished(row, found)
                        row = part.to_pylist()[0]
                        found = [unpack(row["found"], 4)]
                        continue
                    found.append(np.column_stack([part.column(c).to_numpy().astype(np.int64) for c in ("place", "slot", "score", "vec_id")]))
                    held += b - a
                    if held >= HELD_ROWS:
                        found, held = [best_rows(np.concatenate(found), k)], 0
            if row is not None:
                yield finished(row, found)

        return run

    def _score(self, k: int, same: bool):
        """The best rows that a task's blocks hold for every slot of the anchor blocks they meet. What one block has shown
        raises the least score for the next, and a task emits the best of all its blocks, not of each."""
        kind, width = self.kind, self.width

        def emitted(held):
            for asking, (_, found) in held.items():
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), asking)), pa.array(found[:, 0].astype(np.int32)), pa.array(found[:, 1].astype(np.int32)),
                         pa.array(found[:, 2].copy()), pa.array(found[:, 3].copy())], names=["asking", "place", "slot", "score", "vec_id"])

        def run(batches):
            held, rows = {}, 0
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    ids, labels, anchor_ids, anchor_labels = (np.frombuffer(row[c], dtype=np.int64) for c in
                                                              ("ids", "labels", "anchor_ids", "anchor_labels"))
                    x, a = (np.frombuffer(row[c], dtype=kind).reshape(-1, width) for c in ("vectors", "anchors"))
                    fits = ((anchor_labels[:, None] == labels) == same) & (anchor_ids[:, None] != ids)
                    scores = np.where(fits, inner(a, x), LOWEST - 1)
                    wanted, found = held.get(row["asking"]) or (unpack(row["wanted"], 5), np.zeros((0, 4), dtype=np.int64))
                    more = [found]
                    for slot in np.unique(wanted[:, 1]):
                        own = wanted[wanted[:, 1] == slot]
                        part = scores[own[:, 0]]
                        who, what = np.nonzero((part >= own[:, 4:5]) & (part <= own[:, 3:4]))
                        more.append(np.column_stack([own[who, 0], np.full(len(who), slot), part[who, what], ids[what]]))
                    best = best_rows(np.concatenate(more), k)
                    held[row["asking"]] = least_scores(wanted, best, k), best
                    rows += len(best) - len(found)
                    if rows >= HELD_ROWS:
                        yield from emitted(held)
                        held, rows = {}, 0
            yield from emitted(held)

        return run


class _Later:
    """What tasks need of a search: its tables stay on the driver."""

    def __init__(self, search: Search):
        self.index, self.kind, self.width = search.index, search.kind, search.width

    due = Search._due


STATE_FIELDS = pa.schema([(n, pa.int64() if t == "long" else pa.list_(pa.int32()) if t.startswith("array") else pa.binary())
                          for n, t in (f.split() for f in STATE.split(", "))])


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, scale: float = 256.0, low: int = 30,
         high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Both tables have vec_id, label and embedding; components count as floor(scale * x) and a score is the integer inner
    product. An anchor's positives are its first `positives` rows of `vectors` with its label; for each of them the first
    `negatives` rows with another label and `low` to `high` per cent of the positive's score are returned. Higher scores come
    first, ties by smaller vec_id. Rows with the anchor's vec_id are neither. Rows with a NULL vec_id, label or vector, an
    empty vector, or a NULL or non-finite component take no part. Repeated rows are candidates each, equal anchors are one;
    one vec_id with several vectors or labels is as many rows. Vectors of different lengths are compared as if the shorter one
    ended in zeros. Other columns are ignored.
    """
    search = Search(_clean(vectors), _clean(anchors), scale)
    columns = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if search.empty:
        return vectors.sparkSession.createDataFrame([], columns)

    def everything(row):
        place = np.arange(len(row["anchor_ids"]) // 8)
        return np.column_stack([place, np.zeros_like(place), np.full_like(place, LOWEST), np.full_like(place, HIGHEST)]), b""

    def shares(row):
        """Slots are an anchor's positives in order; whole scores of at least `low` and at most `high` per cent count."""
        near = unpack(row["found"], 4).copy()
        new = np.append(True, np.diff(near[:, 0]) != 0)[:len(near)]
        spot = np.arange(len(near))
        near[:, 1] = spot - np.maximum.accumulate(np.where(new, spot, 0))
        wants = np.column_stack([near[:, :2], -(-low * near[:, 2] // 100), high * near[:, 2] // 100])
        return wants[wants[:, 2] <= wants[:, 3]], near.tobytes()

    def pairs(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                near, hard, ids = unpack(row["positives"], 4), unpack(row["found"], 4), np.frombuffer(row["anchor_ids"], dtype=np.int64)
                known = {(place, slot): (score, vec_id) for place, slot, score, vec_id in near.tolist()}
                out, key, rank = [], None, 0
                for place, slot, score, vec_id in hard.tolist():
                    rank = rank + 1 if key == (place, slot) else 1
                    key = place, slot
                    out.append((int(ids[place]), known[key][1], rank, vec_id, known[key][0], score))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(zip(*out))],
                                                     names=[c.split()[0] for c in columns.split(", ")])

    near = search.best(search.asking, everything, positives, True)
    return search.best(near, shares, negatives, False).mapInArrow(pairs, columns)
