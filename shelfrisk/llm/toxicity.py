"""Toxicity: a lexicon learned from labels, matched with Levenshtein automata (operator 4).

Terms are words, or stems of inflected words, that labelled documents show in toxic texts only. All terms form one
trie; the Levenshtein automata of its terms are run on it together, as one automaton whose states are built when
first reached. Each hit is judged in its context window: within quotation marks it counts as quotation. A small
logistic model turns the counts of a document into a score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrisk.llm.langid import held_out
from shelfrisk.llm.passages import slices
from shelfrisk.session import materialise

TOKEN = re.compile(r"[^\W_]+")
CONTEXT = 80  # characters on each side of a hit in which its quotation marks are looked for
NEAR = 200  # characters within which hits are counted as one outburst
# Opening and closing quotation marks.
QUOTES = [('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"), ("‘", "’")]
QUOTED = re.compile("|".join(f"{a}[^{b}\n]{{1,{2 * CONTEXT}}}{b}" for a, b in QUOTES))
SHORTEST_STEM, FUZZY_FROM = 3, 5
LONGEST_STEM = 24  # letters; longer words are learned whole
MOST_WORDS = 100_000  # whose matches a task remembers
MOST_STATES = 20_000  # of the automaton that a task holds; beyond that it forgets them and builds them again as needed
PLAIN, FUZZY_WORD, FUZZY_STEM = 1, 2, 3


class Lexicon:
    """Terms in a trie, met by one automaton that allows `edits` changes in terms of FUZZY_FROM letters and more."""

    def __init__(self, words: list[str], stems: list[str], edits: int = 1):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [0]  # 1: a word ends here, 2: a stem
        self.deep: list[int] = [0]
        self.edits = edits
        for terms, kind in ((words, 1), (stems, 2)):
            for term in terms:
                node = 0
                for letter in term:
                    if letter not in self.children[node]:
                        self.children[node][letter] = len(self.children)
                        self.children.append({})
                        self.ends.append(0)
                        self.deep.append(self.deep[node] + 1)
                    node = self.children[node][letter]
                self.ends[node] |= kind
        self.forget()

    def forget(self) -> None:
        """Back to the first state; the others follow when they are reached."""
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.verdicts: list[tuple[int, int]] = []
        self.known: dict[frozenset, int] = {}
        self.state(self.closed({(0, 0)}))

    def closed(self, items: set) -> frozenset:
        """With the positions reached by leaving out letters of the term."""
        todo = list(items)
        while todo:
            node, errors = todo.pop()
            if errors < self.edits:
                for child in self.children[node].values():
                    if (child, errors + 1) not in items and (child, errors) not in items:
                        items.add((child, errors + 1))
                        todo.append((child, errors + 1))
        return frozenset(items)

    def state(self, items: frozenset) -> int:
        if items not in self.known:
            self.known[items] = len(self.states)
            self.states.append(items)
            self.moves.append({})
            ending = stem = 0
            for node, errors in items:
                if errors and self.deep[node] < FUZZY_FROM:
                    continue
                if self.ends[node] & 1:
                    ending = PLAIN if not errors else ending or FUZZY_WORD
                if self.ends[node] & 2:
                    stem = PLAIN if not errors else stem or FUZZY_STEM
            self.verdicts.append((ending, stem))
        return self.known[items]

    def step(self, state: int, letter: str) -> int:
        """The state after one more letter; -1 if no term can match any longer."""
        reached = set()
        for node, errors in self.states[state]:
            child = self.children[node].get(letter)
            if child is not None:
                reached.add((child, errors))
            if errors < self.edits:
                reached.add((node, errors + 1))
                reached.update((other, errors + 1) for other in self.children[node].values() if other != child)
        to = self.state(self.closed(reached)) if reached else -1
        self.moves[state][letter] = to
        return to

    def match(self, word: str) -> int:
        """PLAIN, FUZZY_WORD, FUZZY_STEM or 0."""
        if len(self.states) > MOST_STATES:
            self.forget()
        state = best = 0
        for letter in word:
            to = self.moves[state].get(letter)
            state = self.step(state, letter) if to is None else to
            if state < 0:
                return best
            stem = self.verdicts[state][1]
            if stem == PLAIN:
                return PLAIN
            best = best or stem
        ending = self.verdicts[state][0]
        return ending if ending == PLAIN or not best else best


def quoted(text: str, start: int, end: int) -> bool:
    """Whether a hit stands inside quotation marks on its line, within CONTEXT characters."""
    left = text[max(0, start - CONTEXT):start].rpartition("\n")[2]
    right = text[end:end + CONTEXT].partition("\n")[0]
    for opening, closing in QUOTES:
        if opening == closing:
            if left.count(opening) % 2 and closing in right:
                return True
        elif left.rfind(opening) > left.rfind(closing) and closing in right:
            return True
    return False


def features(text: str, lexicon: Lexicon, cache: dict[str, int]) -> list[float]:
    """Logarithms of the counts of plain, quoted and misspelled hits, misspelled stems and the densest outburst."""
    low = text.lower()
    hits = {}
    for word in set(TOKEN.findall(low)):
        kind = cache.get(word)
        if kind is None:
            kind = lexicon.match(word)
            if len(cache) >= MOST_WORDS:
                cache.clear()
            cache[word] = kind
        if kind:
            hits[word] = kind
    if not hits:
        return [0.0] * 5
    counts, spots = [0, 0, 0, 0], []
    for found in TOKEN.finditer(low):
        kind = hits.get(found[0])
        if kind:
            inside = quoted(low, found.start(), found.end())
            counts[1 if inside and kind == PLAIN else {PLAIN: 0, FUZZY_WORD: 2, FUZZY_STEM: 3}[kind]] += 1
            if kind == PLAIN and not inside:
                spots.append(found.start())
    at = np.array(spots)
    dense = int((np.searchsorted(at, at + NEAR) - np.arange(len(at))).max()) if spots else 0
    return np.log1p([*counts, dense]).tolist()


def term_counts(labelled: DataFrame) -> DataFrame:
    """(word, toxic, clean): different contexts in toxic texts, so that copies of a text count once, and uses in others.
    What stands in quotation marks is left out: harmless texts quote what others said."""

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                clean, toxic = Counter(), set()
                for text, label in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    words = TOKEN.findall(QUOTED.sub(" ", text.lower()))
                    if not label:
                        clean.update(words)
                        continue
                    for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                        toxic.add((word, zlib.crc32(f"{before} {after}".encode())))
                rows = [(w, None, n) for w, n in clean.items()] + [(w, c, 0) for w, c in toxic]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))],
                                                     names=["word", "context", "n"])

    return (labelled.select("text", "toxic").mapInArrow(count, "word string, context long, n long")
            .groupBy("word").agg(F.count_distinct("context").alias("toxic"), F.sum("n").alias("clean")))


def learn_terms(labelled: DataFrame, least_evidence: float = 15.0, precision: float = 0.8) -> tuple[list[str], list[str]]:
    """(words, stems) that mark toxic texts: at least `precision` of their uses are in toxic texts, which beats
    chance by `least_evidence` nats. Beginnings of up to LONGEST_STEM letters and whole words are looked at."""
    words = term_counts(labelled)
    totals = words.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    if not totals.toxic or not totals.clean:
        return [], []
    share = totals.toxic / (totals.toxic + totals.clean)
    ends = F.sequence(F.lit(SHORTEST_STEM), F.greatest(F.least(F.length("word"), F.lit(LONGEST_STEM)), F.lit(SHORTEST_STEM)))
    begins = words.select("word", "toxic", "clean", F.explode(F.array_union(ends, F.array(F.length("word")))).alias("n"))
    stems = (begins.filter(f"length(word) >= {SHORTEST_STEM}")
             .groupBy(F.substring("word", F.lit(1), F.col("n")).alias("stem"))
             .agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"), F.sum(F.when(F.length("word") == F.col("n"), F.col("toxic"))).alias("whole")))
    rate = F.col("a") / (F.col("a") + F.col("b"))
    evidence = (F.col("a") * F.log(rate / share)
                + F.when(F.col("b") > 0, F.col("b") * F.log((1 - rate) / (1 - share))).otherwise(0.0))
    # So much evidence takes several of the labelled texts, whose number is bounded.
    found = (stems.filter("a > 0").withColumn("evidence", evidence)
             .filter((rate >= precision) & (F.col("evidence") >= least_evidence)).collect())
    known = {r.stem: r for r in sorted(found, key=lambda r: (-r.evidence, r.stem))}
    children: dict[str, list[str]] = {}
    for stem in known:
        children.setdefault(stem[:-1], []).append(stem)
    chosen: dict[str, bool] = {}
    todo = [s for s in known if not any(s[:n] in known for n in range(SHORTEST_STEM, len(s)))]
    while todo:
        stem = todo.pop()
        below = children.get(stem, [])
        # Go on while two longer beginnings say nearly all: only inflected stems fan out more.
        if below and len(below) <= 2 and sum(known[s].a for s in below) >= 0.95 * known[stem].a:
            todo += below
        else:
            chosen[stem] = (known[stem].whole or 0) >= 0.9 * known[stem].a
    return sorted(s for s in chosen if chosen[s]), sorted(s for s in chosen if not chosen[s])


class Model:
    def __init__(self, words: list[str], stems: list[str], weights: np.ndarray):
        self.words, self.stems, self.weights = words, stems, weights

    def score(self, row: list[float]) -> float:
        return float(1 / (1 + np.exp(-(self.weights[0] + np.dot(self.weights[1:], row)))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 40) -> np.ndarray:
    """Intercept and weights by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        w -= np.clip(move, -3, 3)
        if np.abs(move).max() < 1e-8:
            break
    return w


def _featured(docs: DataFrame, words: list[str], stems: list[str], carry: list[str]) -> DataFrame:
    """carried (a struct of the columns to carry), held_out, features."""
    source = docs.select("text", held_out().alias("held_out"), F.struct(*carry).alias("carried"))
    schema = T.StructType([source.schema["carried"], source.schema["held_out"], T.StructField("features", T.ArrayType(T.DoubleType()))])

    def run(batches):
        lexicon, cache = Lexicon(words, stems), {}
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [features(t or "", lexicon, cache) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("carried"), part.column("held_out"), pa.array(rows, pa.list_(pa.float64()))],
                                                 names=["carried", "held_out", "features"])

    return source.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, most_labels: int = 20_000) -> Model:
    """Learn from at most `most_labels` labelled documents, picked by a hash of doc_id, none of them held out.
    A document labelled twice is toxic if any label says so; of several texts under one doc_id one counts."""
    usable = (labels.filter(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    chosen = usable.orderBy(F.xxhash64("label_id"), "label_id").limit(most_labels)
    # At most most_labels small rows, and as many texts: repeated ones are reduced before they move.
    labelled = (docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
                .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic")))
    labelled = materialise(labelled)
    words, stems = learn_terms(labelled)
    rows = _featured(labelled, words, stems, ["toxic"]).select("features", "carried.toxic").collect()
    if not rows:
        return Model([], [], np.zeros(6))
    x, y = np.array([r.features for r in rows]), np.array([float(r.toxic) for r in rows])
    use = np.ones(x.shape[1], dtype=bool)
    while True:  # a hit of any kind is no sign of a harmless text: features that come out so are left out
        weights = np.zeros(x.shape[1] + 1)
        weights[np.append(True, use)] = fit_logistic(x[:, use], y)
        if (weights[1:] >= 0).all():
            return Model(words, stems, weights)
        use &= weights[1:] >= 0


def score(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """doc_id, the columns to carry, held_out, score, predicted of every whole text.

    NULL and empty texts get the score of a text without hits. Rows stand alone; a NULL doc_id is not held out. Without
    any labels every score is 0.5. Columns not carried are ignored;
    carried ones must not be called held_out, score or predicted.
    """
    weights = [float(w) for w in model.weights]
    z = F.lit(weights[0])
    for i, w in enumerate(weights[1:]):
        z = z + F.col("features")[i] * F.lit(w)
    kept = ["doc_id", *(carry or [])]
    return (_featured(docs.withColumn("doc_id", F.col("doc_id").cast("long")), model.words, model.stems, kept)
            .select("carried.*", "held_out", (1 / (1 + F.exp(-z))).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
