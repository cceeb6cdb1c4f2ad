"""Substring dedup: drop words that repeat a passage of an earlier document (operator 2).

Reference passages are sharded by anchor (see `passages`), a suffix automaton is built for each shard, and later
documents' passages are streamed through it: wherever the matching statistic reaches the window length, the
window is removed. Sending every shard to every task would compare all documents with all others, so a
passage visits only the automaton of its own anchor. Shards grow in document order: a passage is matched before
it is added, and equal passages are added once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfrisk.llm import passages as P
from shelfrisk.session import materialise


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self):
        self.next, self.link, self.length = [{}], [-1], [0]

    def _clone(self, p: int, q: int, word) -> int:
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        clone = len(self.next) - 1
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word)
                continue
            self.next.append({})
            self.link.append(0)
            self.length.append(self.length[last] + 1)
            state, p = len(self.next) - 1, last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
            last = state

    def matching(self, words) -> list[int]:
        """For each word, the length of the longest known sequence that ends there."""
        state, length, out = 0, 0, []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            out.append(length)
        return out


def repeated_windows(groups, window: int):
    """(doc_id, mark, place) of runs of windows that start in an earlier document; input is sorted by anchor, doc_id."""
    for table in P.in_groups(groups, "anchor", 4096):
        docs, marks, places = [], [], []
        shard = anchor = None
        waiting, waiting_doc = [], None
        for key, doc, mark, place, body in zip(*(table.column(c).to_pylist() for c in ("anchor", "doc_id", "mark", "place", "body"))):
            size, first, _, flags = P.unpack(np.int64(place))
            if flags & P.GONE:
                docs.append([doc])
                marks.append([mark])
                places.append([place])
                continue
            if key != anchor:
                anchor, shard, waiting, waiting_doc = key, Automaton(), [], None
            if doc != waiting_doc:
                for words in waiting:
                    shard.add(words)
                waiting, waiting_doc = [], doc
            words = body.split(b" ")
            hits = np.flatnonzero(np.array(shard.matching(words)) >= window) - window + 1
            if len(hits):
                cut = np.flatnonzero(np.append(True, np.diff(hits) > 1))
                count = np.diff(np.append(cut, len(hits)))
                docs.append([doc] * len(cut))
                marks.append([mark] * len(cut))
                places.append(P.pack(size, first + hits[cut], count, np.zeros_like(count)))
            waiting.append(words)
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in (docs, marks, places)],
                                             names=["doc_id", "mark", "place"])


def word_spans(data: bytes, first: np.ndarray, last: np.ndarray):
    starts, ends = P.word_bounds(np.frombuffer(data, dtype=np.uint8))
    return starts[first], ends[last - 1]


def _plain(data: bytes) -> bytes:
    """The words joined by single spaces."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not ((raw >= 9) & (raw <= 13)).any() and b"  " not in data and data[:1] != b" " and data[-1:] != b" ":
        return data
    return b" ".join(w for w in data.translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if w)


def drop_repeated_passages(docs: DataFrame, window: int = 50, gram: int = 16) -> DataFrame:
    """doc_id, text, n_words, n_removed of every document: `text` holds the words that stay, joined by one space.

    A word goes if it lies in a run of `window` words that also starts in a document with a smaller doc_id; runs are
    judged on the input. NULL and blank texts have no words and come back empty. Rows that repeat a doc_id count as
    one document: their passages never remove each other. A NULL doc_id is neither smaller nor larger than
    any other: such rows come back unchanged. Other columns are ignored.
    """
    keyed = P.with_mark(docs)
    # Words are compared, so a passage travels with single spaces.
    spans = word_spans
    classified = materialise(P.classify(P.passage_rows(keyed, window, gram, P.word_units, True), True))
    contested = classified.filter(f"place & {P.GONE} = 0")
    texts = P.passage_texts(keyed, contested, window, P.word_units, spans, True)

    def match(batches):
        def plain():
            for batch in batches:
                at = batch.schema.get_field_index("body")
                yield batch.set_column(at, "body", pa.array([_plain(b) for b in batch.column("body").to_pylist()], pa.binary()))
        yield from repeated_windows(plain(), window)

    found = (texts.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "mark", "place")
             .mapInArrow(match, "doc_id long, mark long, place long"))
    gone = P.removed_spans(classified, found)

    def keep(batches):
        for batch in batches:
            for part in P.slices(batch, "text"):
                out = ([], [], [], [])
                for doc, text, places in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "places"))):
                    data = text.encode()
                    starts, ends = P.word_bounds(np.frombuffer(data, dtype=np.uint8))
                    n, pieces, at, lost = len(starts), [], 0, 0
                    for a, b in zip(*P.merged(places, window)):
                        if a > at:
                            pieces.append(_plain(data[starts[at]:ends[a - 1]]))
                        at, lost = b, lost + int(b - a)
                    if at < n:
                        pieces.append(_plain(data[starts[at]:ends[n - 1]]))
                    for column, value in zip(out, (doc, b" ".join(pieces).decode(), n, lost)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                    names=["doc_id", "text", "n_words", "n_removed"])

    return P.attach_places(keyed, gone).mapInArrow(keep, "doc_id long, text string, n_words long, n_removed long")
