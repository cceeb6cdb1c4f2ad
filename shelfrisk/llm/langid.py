"""Language ID by prediction by partial matching (operator 6).

For each language a tree of byte contexts of up to three bytes holds how often each byte followed. A byte seen in a
context costs n / (N + D) there (N bytes seen, D different ones); any other escapes with D / (N + D) to the
context one byte shorter, and from the empty one to 1 / 256. Statistics are frozen after training, so the code
length of a text under a language is a sum of table entries. The shortest code wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.llm.passages import slices

ORDER = 3
MODEL_BYTES = 256 << 20  # of the table of code lengths that each worker holds


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text leaves no remainder by 5."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def context_counts(docs: DataFrame) -> DataFrame:
    """(lang, order, context, byte, n): how often a byte followed a context of 0 to 3 bytes."""

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                texts = part.column("text").to_pylist()
                for lang in sorted(set(langs)):
                    found = []
                    for text in (t for t, own in zip(texts, langs) if own == lang):
                        raw = np.frombuffer(text.encode(), dtype=np.uint8).astype(np.int64)
                        for order in range(ORDER + 1):
                            key = raw[order:].copy()
                            for i in range(order):
                                key |= raw[order - 1 - i:len(raw) - 1 - i] << (8 * (i + 1))
                            found.append(key | order << 32)
                    keys, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys)), pa.array(keys), pa.array(n.astype(np.int64))], names=["lang", "key", "n"])

    return (docs.select("lang", "text").mapInArrow(count, "lang string, key long, n long")
            .groupBy("lang", "key").agg(F.sum("n").alias("n")))


class Model:
    """Code lengths in bits: `bits[node * symbols + symbol]` has one entry per language.

    `node` is the longest kept context; `nodes` finds it from the last three symbols. Bytes that training never saw
    share one symbol.
    """

    def __init__(self, langs: list[str], lang: np.ndarray, key: np.ndarray, n: np.ndarray, most_contexts: int):
        self.langs = langs
        order, context, byte = key >> 32, (key >> 8) & 0xFFFFFF, key & 0xFF
        seen = np.unique(byte)
        self.symbol = np.full(256, len(seen), dtype=np.int64)
        self.symbol[seen] = np.arange(len(seen))
        s = self.symbols = len(seen) + 1
        # The table has a number per context, symbol and language: with many languages it holds fewer contexts.
        most_contexts = max(1, min(most_contexts, MODEL_BYTES // (4 * ORDER * s * max(1, len(langs)))))
        shares = n / np.maximum(1, np.bincount(lang, weights=n, minlength=len(langs)))[lang] if len(n) else n
        where = {(0, 0): 0}
        for k in range(1, ORDER + 1):
            at = order == k
            names, total = np.unique(context[at], return_inverse=True)
            # By their share in each language, so that one with few texts does not lose its own contexts first.
            weight = np.bincount(total, weights=shares[at], minlength=len(names))
            if len(names) > most_contexts:  # the rarest have least to say
                names = np.sort(names[np.lexsort((names, -weight))[:most_contexts]])
            for c in names.tolist():
                if k == 1 or (k - 1, c & (256 ** (k - 1) - 1)) in where:
                    where[k, c] = len(where)
        counts = np.zeros((len(langs), len(where), s), dtype=np.float32)
        node = np.array([where.get(p, -1) for p in zip(order.tolist(), context.tolist())], dtype=np.int64)
        kept = node >= 0
        counts[lang[kept], node[kept], self.symbol[byte[kept]]] = n[kept]
        self.nodes = np.zeros((s, s, s), dtype=np.int32)
        bits = np.empty((len(where), s, len(langs)), dtype=np.float32)
        for (k, c), at in where.items():
            total, kinds = counts[:, at].sum(1, keepdims=True), (counts[:, at] > 0).sum(1, keepdims=True)
            if k:
                shorter = bits[where[k - 1, c & (256 ** (k - 1) - 1)]].T
            else:
                shorter = np.full((len(langs), s), 8, dtype=np.float32)
            with np.errstate(divide="ignore", invalid="ignore"):
                own = np.log2(total + kinds) - np.log2(counts[:, at])
                escape = np.where(kinds > 0, np.log2(total + kinds) - np.log2(kinds), 0) + shorter
            bits[at] = np.where(counts[:, at] > 0, own, escape).T
            last = [self.symbol[c >> 8 * i & 255] for i in range(k)]
            if k == 1:
                self.nodes[:, :, last[0]] = at
            elif k == 2:
                self.nodes[:, last[1], last[0]] = at
            elif k == 3:
                self.nodes[last[2], last[1], last[0]] = at
        self.bits = bits.reshape(len(where) * s, len(langs))

    def code_lengths(self, data: bytes, piece: int = 1 << 20) -> np.ndarray:
        """Bits that each language's statistics need for the whole text."""
        total = np.zeros(len(self.langs))
        for at in range(0, len(data), piece):
            own = self.symbol[np.frombuffer(data[max(0, at - ORDER):at + piece], dtype=np.uint8)]
            if at == 0:
                own = np.append(np.full(ORDER, self.symbols - 1), own)
            node = self.nodes[own[:-3], own[1:-2], own[2:-1]]
            total += self.bits[node * np.int64(self.symbols) + own[3:]].sum(0, dtype=np.float64)
        return total


def train(docs: DataFrame, docs_per_language: int = 400, most_contexts: int = 12_000) -> Model:
    """Fit on a bounded sample: of the rows with text and lang, about `docs_per_language` of each language, picked by
    a hash of doc_id. At most `most_contexts` contexts of each length are kept, those with the largest shares of their
    languages, and no more than MODEL_BYTES hold."""
    usable = docs.filter("lang is not null and text is not null and text != '' and doc_id is not null")
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = (usable.join(F.broadcast(sizes), "lang")  # one row per language
              .filter(place < F.lit(float(docs_per_language)) / F.col("rows")))
    rows = context_counts(chosen).toArrow()
    langs = sorted(rows.column("lang").unique().to_pylist())
    number = {name: i for i, name in enumerate(langs)}
    lang = np.array([number[v] for v in rows.column("lang").to_pylist()], dtype=np.int64)
    return Model(langs, lang, rows.column("key").to_numpy(), rows.column("n").to_numpy(), most_contexts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every whole text.

    score is the weight of the best language when code lengths are read as probabilities; equal lengths go to the
    first name. A text that is NULL or has no letter is `und` with score 0, and so is every text if nothing was
    learned. Rows stand alone; a NULL doc_id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MODEL_BYTES

    def run(batches):
        known = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                names, scores = [], []
                for text, letters in zip(part.column("text").to_pylist(), part.column("letters").to_pylist()):
                    if not letters or not known.langs:
                        names.append("und")
                        scores.append(0.0)
                        continue
                    bits = known.code_lengths(text.encode())
                    best = int(bits.argmin())
                    names.append(known.langs[best])
                    scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text",
                        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))
