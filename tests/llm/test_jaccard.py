import random
import re

import pytest

from shelfrisk.llm import components, jaccard
from tests.llm.texts import SCHEMA, corpus, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(rows, size):
    out = {}
    for doc, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = WORD.findall(lower)
        k = min(size, len(found))
        out[doc] = {tuple(found[i:i + k]) for i in range(len(found) - k + 1)} if k else set()
    return out


def smallest(ids, links):
    least = {i: i for i in ids}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        least[b] = a
    return {i: root(i) for i in ids}


def brute(rows, size, percent):
    own = sets(rows, size)
    links = [(a, b) for a in own for b in own if a < b and own[a] and 100 * len(own[a] & own[b]) >= percent * len(own[a] | own[b]) > 0]
    least = smallest(own, links)
    return {d: (len(own[d]), least[d]) for d in own}


def chains(rng):
    """Near copies of near copies, near the bound, and short texts."""
    rows, doc = [], 1000
    for length in (3, 4, 5, 12, 30, 60, 120):
        text = words(rng, length)
        for _ in range(12):
            rows.append((doc, " ".join(text).upper() if rng.random() < 0.3 else "  ".join(text)))
            doc += 1
            text = list(text)
            if rng.random() < 0.8:
                text[rng.randrange(len(text))] = f"n{rng.randrange(50)}"
    rng.shuffle(rows)
    return [(d, t, None, None, None) for d, t in rows]


@pytest.mark.parametrize("size, percent, seed", [(4, 85, 1), (2, 60, 2)])
def test_matches_brute_force(spark, size, percent, seed):
    rows = corpus(seed) + chains(random.Random(seed))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(docs, size, percent).collect()}
    assert got == brute([r[:2] for r in rows], size, percent)


def test_repeated_and_missing_ids(spark):
    rows = [(i, t, 5, 5) for i, t in [(7, "a b c d e"), (7, "a b c d e"), (3, "A b c d  e"), (None, "a b c d e"), (None, "x"), (9, "")]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, signature long, n int")
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in jaccard.similar_components(docs).collect() if r.component_id)
    assert got == [(0, 2, 3), (3, 2, 3), (7, 2, 3), (7, 2, 3), (9, 0, 9)]


def test_many_texts_and_rows_under_one_id(spark):
    """A repeated id makes neither wrong links nor pairs times repeats."""
    rng = random.Random(9)
    base = words(rng, 60)
    near = [*base[:30], "edited", *base[31:]]
    rows = [(1, " ".join(base)), (2, " ".join(near))] * 40 + [(1, " ".join(words(rng, 50))) for _ in range(40)]
    got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.component_id for r in got} == {1} and len(got) == len(rows)


def test_overlap_bound_loses_no_pair():
    """Any two sets that reach the bound pass with the common shingles of their prefixes counted."""
    rng = random.Random(4)
    for _ in range(3000):
        percent = rng.choice([50, 80, 85])
        a = sorted(rng.sample(range(40), rng.randrange(1, 30)))
        b = sorted(set(a) - set(rng.sample(a, min(len(a) - 1, rng.randrange(4)))) | set(rng.sample(range(40), rng.randrange(4))))
        both = len(set(a) & set(b))
        first = [s[:len(s) - -(-percent * len(s) // 100) + 1] for s in (a, b)]
        common = sorted(set(first[0]) & set(first[1]))
        if 100 * both >= percent * (len(a) + len(b) - both):
            assert common and jaccard.enough(len(common), len(a), a.index(common[-1]), len(b), b.index(common[-1]), percent)


def test_empty_table(spark):
    assert jaccard.similar_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 140)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {i for link in links if link[0] != link[1] for i in link}
    assert got == smallest(ids, [link for link in links if link[0] != link[1]])
