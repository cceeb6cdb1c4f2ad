import heapq
import random

import numpy as np
import pyarrow as pa
import pytest

from shelfrisk.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(seed, n=400, width=7, spread=0.15):
    """Clustered vectors of three labels, equal rows, ties, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + spread * rng.normal(size=width)
        rows.append((i, v.astype(np.float32).tolist(), int(rng.integers(3))))
    same = rows[5][1]
    rows += [(1000 + i, same, i % 2) for i in range(90)]  # one vector, two labels
    rows += [(100, rows[7][1], 2), (100, rows[8][1], 0), (40, rows[40][1], rows[40][2])]  # a repeated id, a repeated row
    rows += [(2000, None, 1), (2020, [float("nan")] * width, 1), (2040, [None] * width, 1), (2060, [float("inf")] * width, 1), (2080, [], 1),
             (None, same, 1), (2100, same, None), (2120, same[:3], 1), (2140, [-x for x in same], 1), (2160, [0.0] * width, 0)]
    random.Random(seed).shuffle(rows)
    return rows


def brute(rows, step, positives, negatives_, low=30, high=90):
    known = []
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            x = [int(np.floor(256 * float(x))) for x in v]
            known.append((i, label, np.array(x + [0] * (8 - len(x)), dtype=np.int64)))
    out = []
    for key in {(i, label, tuple(v.tolist())) for i, label, v in known if i % step == 0}:
        i, label, v = key
        scored = sorted((-int(w @ np.array(v)), j, other) for j, other, w in known if j != i)
        near = [(-s, j) for s, j, other in scored if other == label][:positives]
        for score, positive in near:
            fit = [(-s, j) for s, j, other in scored if other != label and low * score <= -100 * s <= high * score]
            out += [(i, positive, rank, j, score, s) for rank, (s, j) in enumerate(fit[:negatives_], 1)]
    return sorted(out)


def ours(spark, rows, step, *args):
    data = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(tuple(r) for r in negatives.mine(data, data.filter(f"vec_id % {step} = 0"), *args).collect())


@pytest.mark.parametrize("seed, step, sizes", [(1, 20, (4096, 512, 4096)), (2, 5, (16, 8, 32)), (3, 20, (7, 3, 1))])
def test_matches_brute_force(spark, monkeypatch, seed, step, sizes):
    for name, value in zip(("BLOCK_ROWS", "ASKING_ROWS", "FIRST_ROWS"), sizes):
        monkeypatch.setattr(negatives, name, value)
    monkeypatch.setattr(negatives, "HELD_ROWS", sizes[0])
    monkeypatch.setattr(negatives, "CELL_ROWS", 4)
    rows = table(seed)
    assert ours(spark, rows, step) == brute(rows, step, 5, 10)


def test_other_windows_and_widths(spark):
    rows = table(4, n=150)
    assert ours(spark, rows, 10, 2, 3, 256.0, 60, 60) == brute(rows, 10, 2, 3, 60, 60)


def test_clusters_are_not_all_searched(spark, monkeypatch):
    """Far clusters lie below every window: their cells are never compared."""
    monkeypatch.setattr(negatives, "CELL_ROWS", 16)
    monkeypatch.setattr(negatives, "FIRST_ROWS", 64)
    rng = np.random.default_rng(9)
    rows = []
    for i in range(3000):
        at = i % 30
        v = np.zeros(8)
        v[at % 4], v[4 + at % 3] = 1 + at // 12, 1 + at // 6
        rows.append((i, (v + 0.01 * rng.normal(size=8)).astype(np.float32).tolist(), int(rng.integers(2))))
    data = spark.createDataFrame(rows, SCHEMA)
    search = negatives.Search(negatives._clean(data), negatives._clean(data.filter("vec_id = 29")), 256.0)
    everything = lambda row: (np.array([[0, 0, negatives.LOWEST, negatives.HIGHEST]]), b"")
    found = negatives.unpack(search.best(search.asking, everything, 5, True).first().found, 4)
    cells = int((search.index.value.rows > 0).sum())
    assert search.pairs < cells / 3
    known = [(int(np.floor(256 * np.array(v, dtype=np.float64)).astype(int) @ np.floor(256 * np.array(rows[29][1], dtype=np.float64)).astype(int)), i)
             for i, v, label in rows if label == rows[29][2] and i != 29]
    assert [(score, vec_id) for _, _, score, vec_id in found.tolist()] == heapq.nsmallest(5, known, key=lambda p: (-p[0], p[1]))


def test_cells_come_by_falling_sum():
    rng = np.random.default_rng(0)
    x = rng.integers(-50, 50, size=(300, 6)).astype(float)
    books = tuple(negatives.codebook(part, 5) for part in np.split(x, 2, axis=1))
    (i, first), (j, second) = (negatives.nearest(part, book) for part, book in zip(np.split(x, 2, axis=1), books))
    cell = i * len(books[1]) + j
    names = np.unique(cell)
    index = negatives.Index(books, pa.table({"cell": names, "rows": np.array([(cell == c).sum() for c in names]),
                                             "first": np.array([first[cell == c].max() for c in names]),
                                             "second": np.array([second[cell == c].max() for c in names])}))
    anchor = x[3]
    assert sorted(index.visits(anchor, negatives.LOWEST, negatives.HIGHEST, 10**9)) == names.tolist()
    kth = int(np.sort(x @ anchor)[-10])
    seen = set(index.visits(anchor, kth, negatives.HIGHEST, 10**9))
    assert {int(c) for c in cell[x @ anchor >= kth]} <= seen  # whatever is passed over holds nothing above
    assert len(list(index.visits(anchor, negatives.LOWEST, negatives.HIGHEST, 1))) == 1


def test_empty_and_lonely(spark):
    data = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], SCHEMA + "")
    assert negatives.mine(data.limit(0), data).count() == 0
    assert negatives.mine(data, data.limit(0)).count() == 0
    assert negatives.mine(data, data).count() == 0  # no positives
    assert negatives.mine(data.withColumns({"asking": data.label, "cell": data.vec_id}), data).columns[0] == "anchor_id"


def test_scores_that_do_not_fit(spark):
    data = spark.createDataFrame([(0, [1e30], 1), (1, [1e30], 1)], SCHEMA)
    with pytest.raises(ValueError, match="64 bits"):
        negatives.mine(data, data)
