"""Quality rules with risk-controlled thresholds (operator 12).

Each rule compares a ratio of a document's counts with a cutoff. Cutoffs are chosen per stratum on labelled holdouts: a
cutoff is certified if the exact binomial bound says that at most the rule's part of `risk` of all good documents lie
beyond it. Cutoffs of a rule are tested from the most lenient one on until the first fails, so they need no
correction among themselves; rules and strata share `failure` equally. Of the certified cutoffs of a rule
the one stays that rejects the most bad labelled documents more than good ones. With probability 1 - `failure`, no
stratum then loses more than `risk` of its good documents to the rules.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrisk.llm.passages import slices
from shelfrisk.session import attach, broadcast_if_small, materialise

SPACES = b" \t\n\v\f\r"
INSIDE = bytes(range(128, 192))  # UTF-8 bytes that go on with a character
SYMBOLS = b"#*$%&|<>"
LETTERS = bytes(range(65, 91))
MARKS = b"!?"
GRAM = 5  # words of a window that counts as repeated
COUNTS = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_marks", "n_stutters", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Rejects a document if 1000 * part > cutoff * whole; `cutoffs` run from the most lenient one on."""

    name: str
    part: str
    whole: str
    cutoffs: tuple[int, ...]


# Per mille. The word-length rules see the mean length of a word from both sides.
RULES = [
    Rule("symbols", "n_symbols", "word_chars", (400, 300, 200, 150, 100, 70, 50, 30, 20, 10)),
    Rule("capitals", "n_capitals", "word_chars", (900, 800, 700, 600, 500, 400, 300, 200)),
    Rule("marks", "n_marks", "word_chars", (400, 300, 200, 150, 100, 70, 50, 30)),
    Rule("stutters", "n_stutters", "n_words", (800, 700, 600, 500, 400, 300, 200, 150, 100)),
    Rule("dup_lines", "n_dup_lines", "n_lines", (900, 800, 700, 600, 500, 400, 300, 200, 100)),
    Rule("repeats", "n_repeat_words", "n_words", (190, 170, 150, 130, 110, 90, 70, 50)),
    Rule("long_words", "word_chars", "n_words", (30000, 20000, 15000, 12000, 10000, 9000, 8000)),
    Rule("short_words", "n_words", "word_chars", (1000, 800, 600, 500, 450, 400, 350)),
]


def repeated_words(words: list[bytes], gram: int = GRAM) -> int:
    """Words in windows of `gram` words that occur twice or more."""
    if len(words) <= gram:
        return 0
    numbers: dict[bytes, int] = {}
    own = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    window = own[:len(own) - gram + 1]
    for i in range(1, gram):  # one number for equal windows of i + 1 words
        _, window = np.unique(window * len(numbers) + own[i:len(own) - gram + 1 + i], return_inverse=True)
    twice = np.bincount(window)[window] > 1
    covered = np.zeros(len(own) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + gram, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def counts(text: bytes) -> tuple[int, ...]:
    """COUNTS of one text."""
    words = text.split()  # bytes split at exactly the space and the controls 9 to 13
    lines = [line for line in text.split(b"\n") if line.strip()]
    without = len(text.translate(None, SYMBOLS)), len(text.translate(None, LETTERS)), len(text.translate(None, MARKS))
    symbols, capitals, marks = (len(text) - n for n in without)
    return (len(words), len(text.translate(None, SPACES + INSIDE)), symbols, capitals, marks, sum(map(eq, words, words[1:])),
            len(lines), len(lines) - len(set(lines)), repeated_words(words))


def measured(docs: DataFrame, stratum: str) -> DataFrame:
    """doc_id, stratum, COUNTS and base_failed of every whole text."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(stratum).cast("string").alias("stratum"),
                         F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = np.array([counts(t) for t in part.column("text").to_pylist()], dtype=np.int64).reshape(-1, len(COUNTS))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("stratum"), *(pa.array(c) for c in found.T.copy())],
                                                 names=["doc_id", "stratum", *COUNTS])

    rows = source.mapInArrow(run, "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS))
    return rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def steps(rule: Rule) -> Column:
    """How many of the rule's cutoffs reject the document: the last ones, as they run from lenient to strict."""
    beyond = [(1000 * F.col(rule.part) > cutoff * F.col(rule.whole)).cast("int") for cutoff in rule.cutoffs]
    return sum(beyond[1:], beyond[0])


def binomial_tail(x: int, n: int, p: float) -> float:
    """P(X <= x) of a binomial variable, summed downwards from x until terms no longer count."""
    if x >= n * p:  # then at least about one half: no bound can hold
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) + x * math.log(p) + (n - x) * math.log1p(-p))
    total = 0.0
    while x >= 0 and term > 1e-18 * total:
        total += term
        term *= x * (1 - p) / ((n - x + 1) * p)
        x -= 1
    return total


def certified(tallies: DataFrame, rules: list[Rule], risk: float, failure: float, strata: int) -> DataFrame:
    """(stratum, rule, cutoff, n_good, false_rejections, caught): the cutoffs chosen from `tallies` (stratum, rule, good, step, rows).
    Both tables have at most one row per stratum, rule and step."""
    part, least = risk / len(rules), failure / (len(rules) * max(1, strata))
    names = {i: rule.name for i, rule in enumerate(rules)}
    ladders = {i: rule.cutoffs for i, rule in enumerate(rules)}
    fields = "stratum string, rule string, cutoff int, n_good long, false_rejections long, caught long"

    def choose(own: pd.DataFrame) -> pd.DataFrame:
        at = int(own["rule"].iloc[0])
        rows = {True: np.zeros(len(ladders[at]) + 1, dtype=np.int64), False: np.zeros(len(ladders[at]) + 1, dtype=np.int64)}
        for good, step, n in zip(own["good"], own["step"], own["rows"]):
            rows[bool(good)][int(step)] += n
        beyond = {kind: n[::-1].cumsum()[:-1] for kind, n in rows.items()}  # rows that each cutoff rejects
        total, best, gained = int(rows[True].sum()), None, 0
        for i, cutoff in enumerate(ladders[at]):
            if not total or binomial_tail(int(beyond[True][i]), total, part) > least:
                break
            gain = int(beyond[False][i] - beyond[True][i])
            if gain > gained:
                best, gained = (cutoff, int(beyond[True][i]), int(beyond[False][i])), gain
        chosen = [] if best is None else [(own["stratum"].iloc[0], names[at], best[0], total, best[1], best[2])]
        return pd.DataFrame(chosen, columns=["stratum", "rule", "cutoff", "n_good", "false_rejections", "caught"])

    return tallies.groupBy("stratum", "rule").applyInPandas(choose, fields)


def learn(rows: DataFrame, labels: DataFrame, rules: list[Rule], risk: float, failure: float) -> DataFrame:
    """Stored cutoffs per stratum and rule, from the labelled rows of `measured` that pass the base rules.

    All labelled documents are used. A document with labels of both kinds, or without a quality, is not labelled; a
    repeated one counts once. A rule without a certified cutoff, or that catches no more bad than good documents, has no row.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("label_id"))
             .agg(F.min("quality").alias("low"), F.max("quality").alias("high")).filter("low = high")
             .select("label_id", (F.col("low") > 0).alias("good")))
    judged = rows.filter(~F.col("base_failed")).select(
        "doc_id", "stratum", F.array(*[F.struct(F.lit(i).alias("rule"), steps(r).alias("step")) for i, r in enumerate(rules)]).alias("steps"))
    # Repeated documents go before the join, so a hot id is one row.
    labelled = judged.distinct().join(broadcast_if_small(materialise(known)), F.col("doc_id") == F.col("label_id"))
    tallies = materialise(labelled.select("stratum", "good", F.inline("steps")).groupBy("stratum", "rule", "good", "step")
                          .agg(F.count(F.lit(1)).alias("rows")))
    strata = tallies.select("stratum").distinct().count()
    return materialise(certified(tallies, rules, risk, failure, strata))


def filter_quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules: list[Rule] = RULES, risk: float = 0.05,
                   failure: float = 0.05) -> DataFrame:
    """doc_id, COUNTS, base_failed, failed_rules and kept of every row.

    `labels` has doc_id and quality (above 0: good). NULL and empty texts have no words and fail the base rules (under
    10 words, or over 20 % of the words in repeated windows of five). A NULL stratum is a stratum of its own; one with too
    few labelled documents for the bound has no rules, so that only the base rules apply. Rows stand alone: repeated rows
    and NULL ids are judged like any other. Other columns are ignored.
    """
    rows = materialise(measured(docs, stratum))
    chosen = learn(rows, labels, rules, risk, failure)
    limits = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    judged = attach(rows, broadcast_if_small(materialise(limits)), ["stratum"])
    fails = [F.when(1000 * F.col(r.part) > F.element_at("limits", F.lit(r.name)) * F.col(r.whole), F.lit(r.name)) for r in rules]
    failed = F.array_compact(F.array(*fails))
    return (judged.select("doc_id", *COUNTS, "base_failed", failed.alias("failed_rules"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))
