import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest

from shelfrisk.llm import importance
from tests.llm.texts import SCHEMA, corpus

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, longest):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=25, least=20, buckets=10_000, longest=2, seed=7):
    source, aimed = ([0] * buckets for _ in range(2))
    for texts, counts in (([r[1] for r in rows], source), (target, aimed)):
        for text in texts:
            for f in runs(text, longest)[1]:
                counts[crc32(f.encode()) % buckets] += 1
    s_all, t_all = sum(source), sum(aimed)
    gain = [math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in zip(source, aimed)]
    out = []
    for doc, text, *_ in rows:
        n, features = runs(text, longest)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = percent * len(able) // 100
    ranked = [(*r[:4], i + 1 if i < drawn else None) for i, r in enumerate(able)] + [(*r[:4], None) for r in out if not r[4]]
    return sorted(ranked, key=repr)


def ours(spark, rows, target, **settings):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    return sorted((tuple(r) for r in importance.resample(docs, wanted, **settings).collect()), key=repr)


TARGET = ["w1 w2 W3 w4 w5 é7, w6 again again", None, "", "w1 w2 w3 unseen ÄÖ 漢字"]


@pytest.mark.parametrize("settings", [{}, {"percent": 60, "least": 5, "buckets": 97, "seed": 3}, {"percent": 100, "least": 0, "longest": 3},
                                      {"percent": 0}, {"percent": 1, "least": 20}])
def test_matches_brute_force(spark, settings):
    rows = corpus(11, 90)
    expected = brute(rows, TARGET, **settings)
    renamed = {"least_words" if k == "least" else k: v for k, v in settings.items()}
    assert ours(spark, rows, TARGET, pivots=3, **renamed) == expected


def test_equal_rows_at_the_edge(spark):
    """Hundreds of equal rows: exactly as many are drawn as there is room for."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = corpus(2, 40) + [(None, text, None, None, None)] * 300 + [(5, text, None, None, None)] * 50 + [(5, text + " w1", None, None, None)]
    for percent in (10, 50, 95):
        assert ours(spark, rows, TARGET, percent=percent) == brute(rows, TARGET, percent)


def test_empty_tables_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA + ", score int, rank string, id long")
    target = spark.createDataFrame([], "text string, doc_id string")
    assert importance.resample(empty, target).count() == 0
    rows = corpus(4, 30)
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = docs.withColumns({"score": docs.lang, "weight": docs.text, "able": docs.n_chars, "bucket": docs.source})
    got = importance.resample(docs, target).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, [])


def test_a_very_long_text(spark):
    rng = random.Random(8)
    rows = [(0, " ".join(rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(200_000)), None, None, None), *corpus(4, 12)]
    assert ours(spark, rows, TARGET) == brute(rows, TARGET)


@pytest.mark.parametrize("pivots", [1, 2, 16])
def test_quickselect_finds_any_place(spark, pivots):
    rng = np.random.default_rng(pivots)
    values = sorted((int(a), int(b)) for a, b in zip(rng.integers(0, 9, 200), rng.integers(0, 5, 200)))
    table = importance.materialise(spark.createDataFrame(values, "a long, b long").repartition(6))
    for k in (1, 77, 200):
        key, before, equal = importance.kth_key(table, ["a", "b"], k, pivots)
        assert key == values[k - 1] and before == values.index(key) and equal == values.count(key)
