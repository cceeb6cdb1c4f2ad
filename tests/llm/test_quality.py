import math
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfrisk.llm import quality
from tests.llm.texts import SCHEMA, corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeats = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(re.findall("[A-Z]", text or "")),
            len(re.findall("[!?]", text or "")), sum(a == b for a, b in zip(words, words[1:])), len(lines), len(lines) - len(set(lines)), len(repeats))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é漢A!#|   \n\t\x0b\x85"), max_size=120))
def test_counts(text):
    assert quality.counts(text.encode()) == brute_counts(text)


def test_counts_of_a_long_text():
    rng = random.Random(5)
    text = " ".join(rng.choice("ab") + rng.choice("ab") + rng.choice(["", "c"]) for _ in range(20000))
    assert quality.counts(text.encode()) == brute_counts(text)


@pytest.mark.parametrize("x, n, p", [(0, 100, 0.05), (3, 200, 0.05), (40, 1000, 0.05), (5, 60, 0.3), (0, 1, 0.01)])
def test_binomial_tail(x, n, p):
    whole = sum(math.comb(n, k) * p**k * (1 - p)**(n - k) for k in range(x + 1))
    assert quality.binomial_tail(x, n, p) == pytest.approx(whole, rel=1e-9)
    assert quality.binomial_tail(math.ceil(n * p), n, p) == 1.0  # at the mean or above nothing can be certified


def test_tail_of_many_rows_is_quick():
    # 10,000 below a mean of ten million, which has a standard deviation of 3,146: the normal tail below -3.178.
    assert quality.binomial_tail(9_990_000, 10**9, 0.01) == pytest.approx(0.00074, rel=0.03)


def labelled_corpus(seed, n=900):
    """Good and bad texts of two languages; bad ones mostly have symbols, capitals or stutters."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(8, 40))]
        kind = rng.randrange(4) if bad else 4
        if kind == 0:
            words = [w + "&&" for w in words]
        if kind == 1:
            words = [w.upper() + "!" for w in words]
        if kind == 2:
            words = [w for w in words for _ in range(2)]
        if kind == 4 and rng.random() < 0.02:
            words[0] += "###"
        rows.append((i, " ".join(words), rng.choice(["en", "en", "fr", None]), "s", 0))
        if rng.random() < 0.8:
            labels.append((i, int(not bad) if rng.random() < 0.99 else int(bad)))
    return rows, labels


def brute_verdicts(rows, labels, risk, failure):
    known = {}
    for i, q in labels:
        if i is not None and q is not None:
            known.setdefault(i, set()).add(q > 0)
    known = {i: q.pop() for i, q in known.items() if len(q) == 1}
    names = quality.COUNTS
    judged = {}
    for i, text, lang, _, _ in rows:
        c = dict(zip(names, brute_counts(text)))
        judged[i] = (lang, c, c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"])
    strata = {judged[i][0] for i in known if i in judged and not judged[i][2]}
    chosen = {}
    for lang in strata:
        for rule in quality.RULES:
            rejected = lambda c, cut: 1000 * c[rule.part] > cut * c[rule.whole]  # noqa: B023, E731
            good = [judged[i][1] for i, q in known.items() if i in judged and q and judged[i][0] == lang and not judged[i][2]]
            bad = [judged[i][1] for i, q in known.items() if i in judged and not q and judged[i][0] == lang and not judged[i][2]]
            best = 0
            for cut in rule.cutoffs:
                x, p, n = sum(rejected(c, cut) for c in good), risk / len(quality.RULES), len(good)
                if sum(math.comb(n, k) * p**k * (1 - p)**(n - k) for k in range(x + 1)) > failure / len(quality.RULES) / len(strata):
                    break
                gain = sum(rejected(c, cut) for c in bad) - x
                if gain > best:
                    best, chosen[lang, rule.name] = gain, cut
    out = {}
    for i, (lang, c, failed) in judged.items():
        hit = any((lang, r.name) in chosen and 1000 * c[r.part] > chosen[lang, r.name] * c[r.whole] for r in quality.RULES)
        out[i] = (*c.values(), failed, not failed and not hit)
    return out, chosen


@pytest.mark.parametrize("seed, risk, failure", [(1, 0.4, 0.05), (2, 0.7, 0.2), (3, 0.05, 0.05)])
def test_verdicts_match_brute_force(spark, seed, risk, failure):
    rows, labels = labelled_corpus(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = quality.filter_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"), risk=risk, failure=failure).drop("failed_rules")
    expected, chosen = brute_verdicts(rows, labels, risk, failure)
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == expected
    assert bool(chosen) == (risk > 0.1)  # too few labels for a small risk: nothing is certified, so nothing is rejected


def test_false_rejections_stay_within_the_risk(spark):
    """Cutoffs learned on some documents hold on others."""
    rows, labels = labelled_corpus(7, 4000)
    truth = dict(labels)
    docs = spark.createDataFrame(rows, SCHEMA)
    learned = spark.createDataFrame([p for p in labels if p[0] % 2], "doc_id long, quality int")
    got = quality.filter_quality(docs, learned, risk=0.3)
    fresh = [r for r in got.collect() if r.doc_id in truth and r.doc_id % 2 == 0 and not r.base_failed]
    good, bad = ([r.kept for r in fresh if truth[r.doc_id] == q] for q in (1, 0))
    assert good.count(False) <= 0.05 * len(good) and bad.count(False) >= 0.5 * len(bad)


def test_odd_rows(spark):
    rows = corpus(3)
    text = rows[0][1]
    rows += [(None, text, "en", None, None), (500, text, "en", None, None), (500, text + " more", "fr", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA + "")
    docs = docs.withColumns({"n_words": docs.n_chars, "stratum": docs.lang, "limits": docs.text, "kept": docs.doc_id})
    labels = spark.createDataFrame([(500, 1), (500, 0), (None, 1), (3, None), (9999, 1)], "doc_id long, quality int")
    got = quality.filter_quality(docs, labels).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, tuple(r)[1:10]) for r in got) == sorted((i is None, i or 0, brute_counts(t)) for i, t, *_ in rows)
    assert all(r.kept != r.base_failed for r in got)  # no usable label: only the base rules
    assert all(r.base_failed for r in got if not r.n_words)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.filter_quality(docs, labels).count() == 0
    assert quality.filter_quality(spark.createDataFrame(corpus(1), SCHEMA), labels).count() == 63


def test_ladders_run_from_lenient_to_strict():
    for rule in quality.RULES:
        assert list(rule.cutoffs) == sorted(rule.cutoffs, reverse=True)
