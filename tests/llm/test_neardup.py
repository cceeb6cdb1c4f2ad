import random

import numpy as np
import pytest

from shelfrisk.llm import neardup
from tests.llm.test_jaccard import smallest

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(seed, n=400, width=16):
    """Copies, scaled copies, chains of near copies, groups of near copies and unusable vectors."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.normal(size=width)
        if i % 4 == 1:
            v = np.array(rows[rng.integers(len(rows))][1])
        if i % 4 == 2:
            v = np.array(rows[rng.integers(len(rows))][1]) * 2 + rng.normal(size=width) * 0.25
        rows.append((i, v.astype(np.float32).tolist(), int(rng.integers(3)) if i % 50 else None))
    centre = rng.normal(size=width)
    rows += [(1000 + i, (centre + rng.normal(size=width) * 0.05).astype(np.float32).tolist(), 1) for i in range(150)]
    rows += [(2000, None, 1), (2001, [float("nan")] * width, 1), (2002, [None] * width, 1), (2003, [float("inf")] * width, 1), (2004, [], 1),
             (2005, [0.0] * width, 1), (2006, [1e-30] * width, 1), (2007, [1e30] * width, 1)]
    random.Random(seed).shuffle(rows)
    return rows


def brute(rows, threshold):
    good = [(i, np.array(v, dtype=np.float64), label) for i, v, label in rows
            if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = np.array([v / np.abs(v).max() for _, v, _ in good])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= threshold
    pairs = [(good[a][0], good[b][0]) for a, b in zip(*np.nonzero(near)) if a != b and good[a][2] == good[b][2]]
    least = smallest([i for i, _, _ in rows], pairs)
    links = {i: 0 for i in least}
    for a, _ in pairs:
        links[a] += 1
    return {i: (links[i], least[i], least[i] == i) for i in least}


@pytest.mark.parametrize("seed, shard, block", [(1, 32_768, 1024), (2, 64, 16)])
def test_matches_brute_force(spark, monkeypatch, seed, shard, block):
    monkeypatch.setattr(neardup, "SHARD_ROWS", shard)
    monkeypatch.setattr(neardup, "QUERY_ROWS", 2 * shard)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block)
    rows = table(seed)
    got = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    expected = brute(rows, 0.93)
    wrong = {i: (got[i], expected[i]) for i in expected if got[i] != expected[i]}
    assert not wrong


def test_graph_recall():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph = neardup.Graph(x)
    found, _ = graph.search(x[:200], 64)
    best = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(best.tolist(), found.tolist())]) > 0.9


def test_one_id_with_several_labels_and_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (5, [1.0, 0.1], 1), (1, [1.0, 0.01], 2), (6, [1.0, 0.2], 2), (9, [0.0, 1.0], 1), (1, [0.05, 1.0], 1)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    # Two links of label 1, one of label 2; the rows of id 1 are three nodes.
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (1, 1, 1), (1, 1, 1), (5, 1, 1), (6, 1, 1), (9, 1, 1)]
    rows = [(4, [1.0, 0.0], 1), (5, [1.0, 0.1], 1), (4, [0.0, 1.0], 2), (3, [0.1, 1.0], 2)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id, r.component_id) for r in got) == [(3, 3), (4, 3), (4, 4), (5, 4)]


def test_missing_ids_and_empty_table(spark):
    rows = [(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [2.0, 0.0], 1)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in got if r.vec_id) == [(3, 2, 3, True), (3, 2, 3, True), (4, 2, 3, False)]
    assert [(r.n_links, r.component_id, r.kept) for r in got if not r.vec_id] == [(0, None, False)]
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def joined(ids, x, threshold=0.93):
    """Smallest reachable id of each node by the links that shard_links gives, and by all true links."""
    blocks = [(ids[at:at + 2048], x[at:at + 2048]) for at in range(0, len(ids), 2048)]
    got = [(a, b) for block in neardup.shard_links(ids, x, blocks, threshold) for a, b in zip(*(side.tolist() for side in block))]
    a, b = np.nonzero(np.triu(x @ x.T >= threshold, 1))
    return smallest(ids.tolist(), got), smallest(ids.tolist(), zip(ids[a].tolist(), ids[b].tolist())), len(got)


def unit(x):
    return x / np.linalg.norm(x, axis=1)[:, None]


def sparse_beside_hot(hot, pairs=30, n=3000, width=64):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, width))
    x[:hot] = rng.normal(size=width) + rng.normal(size=(hot, width)) * 0.1
    twin = rng.permutation(np.arange(hot, n))[:2 * pairs]
    x[twin[pairs:]] = x[twin[:pairs]] + rng.normal(size=(pairs, width)) * 0.1
    order = rng.permutation(n)
    return np.arange(n) * 3, unit(x[order])


@pytest.mark.parametrize("hot", [0, 1000])
@pytest.mark.parametrize("blind", [False, True])
def test_sparse_links_are_not_passed_unseen(monkeypatch, hot, blind):
    """A search that finds at most the hot group does not stand, however rare the other links are."""
    ids, x = sparse_beside_hot(hot)
    if blind:
        search = neardup.Graph.search

        def poor(self, q, beam):
            found, sims = search(self, q, beam)
            sparse = (sims > 0.93).sum(1) < 10
            return np.where(sparse[:, None], -1, found), sims

        monkeypatch.setattr(neardup.Graph, "search", poor)
    got, expected, links = joined(ids, x)
    assert got == expected and links <= 3 * len(ids)


def test_later_blocks_are_audited(monkeypatch):
    """Links are common, and the search fails from the second block on."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(1200, 64))
    x = unit(np.stack([base, base + rng.normal(size=base.shape) * 0.1], axis=1).reshape(-1, 64))
    ids, search, late = np.arange(2400), neardup.Graph.search, []

    def poor(self, q, beam):
        late.append(not np.array_equal(q[0], x[0]))
        found, sims = search(self, q, beam)
        return (np.full_like(found, -1) if late[-1] else found), sims

    monkeypatch.setattr(neardup.Graph, "search", poor)
    got, expected, _ = joined(ids, x)
    assert np.mean([got[i] == expected[i] for i in got]) >= 0.99


def test_dense_groups_joined_by_one_link():
    rng = np.random.default_rng(7)
    at = lambda degrees: [np.cos(np.radians(degrees)), np.sin(np.radians(degrees))] + [0] * 14
    noise = rng.normal(size=(600, 16)) * 0.004
    x = unit(np.concatenate([np.array([at(0)] * 300 + [at(31)] * 300) + noise, [at(5), at(26)]]))
    got, expected, _ = joined(np.arange(602), x)
    assert set(expected.values()) == {0} and got == expected
