import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfrisk.llm import passages, substring
from tests.llm.texts import SCHEMA, corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    first, split = {}, {}
    for doc, text in rows:
        split[doc] = found = WORD.findall(text or "")
        for i in range(len(found) - window + 1):
            key = tuple(found[i:i + window])
            first[key] = min(first.get(key, doc), doc)
    out = {}
    for doc, found in split.items():
        gone = set()
        for i in range(len(found) - window + 1):
            if first[tuple(found[i:i + window])] < doc:
                gone.update(range(i, i + window))
        out[doc] = (" ".join(w for i, w in enumerate(found) if i not in gone), len(found), len(gone))
    return out


def ours(spark, rows, window, gram):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = substring.drop_repeated_passages(docs, window, gram).collect()
    return {r.doc_id: (r.text, r.n_words, r.n_removed) for r in got}


@pytest.mark.parametrize("window, gram", [(50, 16), (20, 5), (5, 2)])
def test_matches_brute_force(spark, window, gram):
    rows = corpus(window)
    assert ours(spark, rows, window, gram) == brute([r[:2] for r in rows], window)


def test_hot_anchor_goes_window_by_window(spark, monkeypatch):
    monkeypatch.setattr(passages, "HOT_PASSAGES", 1)
    rows = corpus(3)
    assert ours(spark, rows, 20, 5) == brute([r[:2] for r in rows], 20)


def test_repeated_and_missing_ids(spark):
    text = " ".join(f"a{i}" for i in range(60))
    rows = [(1, text, None, None, None), (1, text, None, None, None), (2, text, None, None, None), (None, text, None, None, None)]
    got = substring.drop_repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 60)]


def test_many_texts_under_one_id(spark):
    """3,000 different texts share an id; every second one ends with the passage of an earlier document."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"own{i} " + " ".join(f"t{i}x{k}" for k in range(30)) + (f" {passage}" if i % 2 else "") for i in range(3000)]
    rows = [(0, passage, None, None, None), *((1, t, None, None, None) for t in texts)]
    got = substring.drop_repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    expected = [(0, passage, 60, 0)] + [(1, " ".join(t.split()[:31]), len(t.split()), 60 * (i % 2)) for i, t in enumerate(texts)]
    assert sorted((r.doc_id, r.text, r.n_words, r.n_removed) for r in got) == sorted(expected)


def test_empty_table_and_extra_columns(spark):
    docs = spark.createDataFrame([], SCHEMA + ", mark int, places string, anchor long, size int, shared int")
    assert substring.drop_repeated_passages(docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), max_size=4), st.lists(st.sampled_from("abc"), max_size=15))
def test_matching_statistics(known, text):
    automaton = substring.Automaton()
    for sequence in known:
        automaton.add(sequence)
    pieces = {tuple(s[i:j]) for s in known for i in range(len(s)) for j in range(i, len(s) + 1)} | {()}
    for end, got in enumerate(automaton.matching(text), 1):
        assert got == max(n for n in range(end + 1) if tuple(text[end - n:end]) in pieces)
