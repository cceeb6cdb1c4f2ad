import random

import numpy as np
import pytest

from shelfrisk.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(seed, n=300, width=6):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.normal(size=width) * rng.choice([0.1, 1, 3])
        rows.append((i, v.astype(np.float32).tolist(), 0))
    same = rows[3][1]
    rows += [(1000 + i, same, 1) for i in range(60)]
    rows += [(2000, None, 1), (2020, [float("nan")] * width, 1), (2040, [None] * width, 1), (2060, [float("inf")] * width, 1), (2080, [], 1),
             (None, same, 1), (2100, same[:3], 1)]
    random.Random(seed).shuffle(rows)
    return rows


def brute(rows, k, step):
    known = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            known[i] = [int(np.floor(64 * float(np.float32(x)))) for x in v]
    out = []
    for q in (i for i in known if i % step == 0):
        scored = sorted((-sum(a * b for a, b in zip(known[q], v)), i) for i, v in known.items() if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("k, step, rows_per_block", [(20, 20, 16), (3, 5, 7), (500, 100, 2048)])
def test_matches_brute_force(spark, monkeypatch, k, step, rows_per_block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", rows_per_block)
    rows = table(k)
    data = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = topk.top_k(data, data.filter(f"vec_id % {step} = 0"), k).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, k, step)


def test_large_components_and_empty_table(spark):
    rows = [(20, [3e4, -2e4]), (21, [3.1e4, -2e4]), (22, [-3e4, 1.0])]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(data, data.filter("vec_id = 20"), 2).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(21, 64 * 64 * (93 * 10**7 + 4 * 10**8)), (22, -64 * 64 * 900000000 - 64 * 64 * 20000)]
    assert topk.top_k(data.limit(0), data.limit(0)).count() == 0


@pytest.mark.parametrize("repeated", [20, 21])
def test_one_vec_id_over_many_blocks(spark, monkeypatch, repeated):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(repeated)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist(), 0) for i in range(300)]
    known = [(i, np.floor(64 * np.array(v, dtype=np.float64)).astype(int)) for i, v, _ in rows]
    known += [known[repeated]] * 5000
    expected = []
    for q, v in known[:300:20]:
        best = sorted((-int(v @ w), i) for i, w in known if i != q)[:20]
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    data = spark.createDataFrame(rows + [rows[repeated]] * 5000, SCHEMA).repartition(4)
    got = topk.top_k(data, data.filter("vec_id % 20 = 0")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(expected)
