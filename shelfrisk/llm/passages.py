"""Cut documents into anchored passages, so that equal windows of two documents meet under one key.

A window of `window` units (bytes or words) is anchored at the smallest hash among its `gram`-unit pieces.
Neighbouring windows mostly share their anchor and form one passage. Equal windows have equal anchors, so
comparing passages anchor by anchor misses nothing, and equal passages need only be looked at once.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrisk.session import broadcast_if_small, materialise, row_count

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
CHUNK = 1 << 18  # units hashed at once; longer documents are taken in overlapping pieces
MOST_WINDOWS = 256  # of one passage; periodic text makes longer runs, which are split
WORD = re.compile(r"[^\x20\x09-\x0D]+")
START_BITS, RUN_BITS, FLAGS = 34, 9, 2  # the remaining bits of a place hold the text's size, see `with_mark`
SIZE_BITS = 18
SHIFT = START_BITS + RUN_BITS + FLAGS
TWICE, GONE = 1, 2
WANTED_BYTES = 2 << 20  # of texts whose wanted passages are listed as Python values at once
HOT_PASSAGES = 2000  # an anchor with more different passages is compared window by window
ROWS = "anchor long, body long, doc_id long, mark long, place long"
TEXT = ["doc_id", "mark", "size"]  # what names a text
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    if len(_POWERS.get("up", ())) < n:
        size = max(2 * n, 1 << 16)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_sums(units: np.ndarray) -> np.ndarray:
    """Sums from which `span_hash` takes the hash of any span of the units."""
    up, _ = powers(len(units) + 1)
    sums = np.zeros(len(units) + 1, dtype=np.uint64)
    np.cumsum(units * up[:-1], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


def byte_units(data: bytes) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64))[np.frombuffer(data, dtype=np.uint8)]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 bytes; words end at a space or one of the controls 9 to 13."""
    inside = np.ones(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_units(data: bytes) -> np.ndarray:
    """One hash per word; the length is part of it."""
    raw = np.frombuffer(data, dtype=np.uint8)
    starts, ends = word_bounds(raw)
    sums = prefix_sums(byte_units(data))
    return span_hash(sums, starts, ends) + (ends - starts).astype(np.uint64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n, out, step = len(values) - width + 1, values, 1
    while 2 * step <= width:
        out, step = np.minimum(out[:-step], out[step:]), 2 * step
    rest = width - step
    return np.minimum(out[:n], out[rest:rest + n]) if rest else out[:n]


def passages(units: np.ndarray, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, passage hash, first unit, windows, whether the anchor occurs twice) of each passage, piece by piece."""
    width = window - gram + 1
    for at in range(0, len(units) - window + 1, CHUNK):
        sums = prefix_sums(units[at:at + CHUNK + window - 1])
        first = np.arange(len(sums) - gram)
        grams = span_hash(sums, first, first + gram)
        lowest = sliding_min(grams, width)
        cut = np.flatnonzero(np.concatenate([[True], lowest[1:] != lowest[:-1]]))
        ends = np.append(cut[1:], len(lowest))
        if (ends - cut).max() > MOST_WINDOWS:
            cut = np.unique(np.concatenate([np.arange(a, b, MOST_WINDOWS) for a, b in zip(cut, ends)]))
            ends = np.append(cut[1:], len(lowest))
        anchor, steps = lowest[cut], np.arange(width)
        left = cut + (grams[cut[:, None] + steps] == anchor[:, None]).argmax(1)
        right = ends - 1 + (width - 1) - (grams[(ends - 1)[:, None] + steps[::-1]] == anchor[:, None]).argmax(1)
        yield anchor, span_hash(sums, cut, ends - 1 + window), cut + at, ends - cut, left != right


def pack(size, first: np.ndarray, count: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """One long that sorts by first unit inside a text."""
    return ((np.int64(size) << SHIFT) | (first.astype(np.int64) << (RUN_BITS + FLAGS))
            | (count.astype(np.int64) << FLAGS) | flags.astype(np.int64))


def unpack(place: np.ndarray) -> tuple[np.ndarray, ...]:
    """size, first unit, windows, flags."""
    return (place >> SHIFT, (place >> (RUN_BITS + FLAGS)) & ((1 << START_BITS) - 1),
            (place >> FLAGS) & ((1 << RUN_BITS) - 1), place & ((1 << FLAGS) - 1))


def give_back() -> None:
    """Return freed memory to the system, so that idle workers hold nothing back from the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the allocator of numpy's arrays, where it can
    if trim:
        trim(0)


def in_parts(batches) -> Iterator[pa.RecordBatch]:
    """The batches as they come, with memory given back at the end of the task."""
    yield from batches
    give_back()


def slices(table: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes in a text or binary column, so that long texts do not pile up."""
    lengths = np.frombuffer(pa.compute.fill_null(pa.compute.binary_length(table.column(column)), 0)
                            .cast(pa.int64()).to_numpy(zero_copy_only=False), dtype=np.int64)
    block = np.cumsum(lengths) // most
    cuts = np.flatnonzero(np.diff(block)) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, table.num_rows)):
        if b > a:
            yield table.slice(a, b - a)
    give_back()


def with_mark(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc_id, text, mark, size and `carried` columns. Where different texts share a doc_id, `mark` (64 bits of hash) and
    `size` (18 bits of the length) tell them apart; elsewhere both are 0. Texts are ordered by doc_id, then mark and size."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *([F.struct(*carry).alias("carried")] if carry else []))
    digest = F.struct(F.xxhash64("text").alias("mark"), F.octet_length("text").bitwiseAND((1 << SIZE_BITS) - 1).alias("size"))
    shared = materialise(named.filter("doc_id is not null").groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high"))
                         .filter("low != high").select("doc_id"))
    if not row_count(shared):
        return named.withColumns({"mark": F.lit(0).cast("long"), "size": F.lit(0)})
    told = named.join(broadcast_if_small(shared.withColumn("shared", F.lit(True))), "doc_id", "left")
    return told.withColumns({"mark": F.when(F.col("shared"), digest["mark"]).otherwise(F.lit(0)),
                             "size": F.when(F.col("shared"), digest["size"]).otherwise(F.lit(0))}).drop("shared")


def settle(key: np.ndarray, doc: np.ndarray, mark: np.ndarray, place: np.ndarray, whole_docs: bool) -> np.ndarray:
    """Which rows repeat an earlier row of the same key; with `whole_docs`, of a smaller document only."""
    order = np.lexsort((place, mark, doc, key))
    k, d, m, p = key[order], doc[order], mark[order], place[order]
    fresh = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, dtype=bool)
    owner = np.maximum.accumulate(np.where(fresh, np.arange(len(k)), 0))
    repeat = np.empty(len(k), dtype=bool)
    repeat[order] = (d != d[owner]) | (not whole_docs) & ((m != m[owner]) | (p != p[owner]))
    return repeat


def passage_rows(keyed: DataFrame, window: int, gram: int, units, whole_docs: bool) -> DataFrame:
    """ROWS of every passage; `body` is its hash.

    Repeats inside one slice of the input are settled at once and flagged GONE under a scattered anchor, so
    that a passage which a third of all documents hold does not send a third of them to one task.
    """

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = []
                for doc, text, mark, size in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "mark", "size"))):
                    for anchor, body, first, count, twice in passages(units(text.encode()), window, gram):
                        found.append((anchor, body, np.full(len(first), doc), np.full(len(first), mark), pack(size, first, count, twice)))
                if not found:
                    continue
                anchor, body, doc, mark, place = (np.concatenate(c).view(np.int64) for c in zip(*found))
                gone = settle(mix((anchor ^ (body * 3)).view(np.uint64)), doc, mark, place, whole_docs)
                place = place | np.where(gone, GONE, 0)
                anchor = np.where(gone, mix((place ^ doc ^ mark).view(np.uint64)).view(np.int64), anchor)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (anchor, body, doc, mark, place)],
                                                 names=["anchor", "body", "doc_id", "mark", "place"])

    return keyed.filter("doc_id is not null").select("doc_id", "text", "mark", "size").mapInArrow(cut, ROWS)


def classify(rows: DataFrame, whole_docs: bool) -> DataFrame:
    """The passages that matter: flagged GONE if an earlier equal passage exists, else sharing their anchor with
    a different passage (or, unless `whole_docs`, holding their anchor twice), so that parts may be repeated.
    """

    def read(batches):
        last = body_at = None
        owner = (0, 0, 0)
        bodies, pending = 0, []
        for batch in in_parts(batches):
            if not batch.num_rows:
                continue
            anchor, body, doc, mark, place = (batch.column(c).to_numpy() for c in ("anchor", "body", "doc_id", "mark", "place"))
            goes_on = anchor[0] == last
            new = np.append(not goes_on, anchor[1:] != anchor[:-1])
            fresh = new | np.append(not goes_on or body[0] != body_at, body[1:] != body[:-1])
            at = np.maximum.accumulate(np.where(fresh, np.arange(len(body)), -1))
            owners, marks, held = (np.where(at < 0, o, c[at]) for o, c in zip(owner, (doc, mark, place)))
            repeat = (doc != owners) | (not whole_docs) & ((mark != marks) | (place != held))
            run = np.cumsum(new) - (0 if goes_on else 1)
            settled = (place & GONE) > 0
            seen = np.bincount(run, weights=fresh & ~settled).astype(np.int64)
            if not whole_docs:
                seen += 2 * (np.bincount(run, weights=(place & TWICE) * fresh) > 0)
            if goes_on:
                seen[0] += bodies
                if seen[0] > 1:
                    yield from pending
            if not goes_on or seen[0] > 1 or len(seen) > 1:
                pending = []
            place = place | np.where(repeat, GONE, 0)
            out = pa.RecordBatch.from_arrays([pa.array(c) for c in (anchor, doc, mark, place)], names=["anchor", "doc_id", "mark", "place"])
            keep = (place & GONE > 0) | (seen[run] > 1)
            yield out.filter(pa.array(keep))
            if seen[-1] < 2:
                pending.append(out.filter(pa.array((run == run[-1]) & ~keep)))
            last, body_at, owner, bodies = anchor[-1], body[-1], (owners[-1], marks[-1], held[-1]), seen[-1]

    return (rows.repartition("anchor").sortWithinPartitions("anchor", "body", "doc_id", "mark", "place")
            .mapInArrow(read, "anchor long, doc_id long, mark long, place long"))


def in_groups(batches, key: str, most: int) -> Iterator[pa.Table]:
    """Whole groups of rows that arrive sorted by `key`, joined to tables of about `most` rows."""
    held, rows = [], 0
    for batch in in_parts(batches):
        held.append(batch)
        rows += batch.num_rows
        if rows < most:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        end = int(np.searchsorted(keys, keys[-1]))
        if end:
            yield table.slice(0, end)
        held, rows = table.slice(end).to_batches(), table.num_rows - end
    if rows:
        yield pa.Table.from_batches(held)


def passage_texts(keyed: DataFrame, contested: DataFrame, window: int, units, spans, whole_docs: bool) -> DataFrame:
    """(anchor, doc_id, mark, place, body) with the bytes of each contested passage.

    `spans(data, first, last)` gives the byte ranges of units first to last of a document. Passages of an anchor
    with too many of them are sent window by window under the window's hash; repeats inside one slice come
    back flagged GONE and without bytes.
    """
    hot = contested.groupBy("anchor").count().filter(F.col("count") > HOT_PASSAGES).select("anchor", F.lit(True).alias("hot"))
    listed = (contested.join(hot, "anchor", "left")
              .withColumn("size", F.shiftrightunsigned("place", SHIFT).cast("int"))
              .groupBy(*TEXT).agg(F.collect_set(F.struct("anchor", "place", "hot")).alias("wanted")))

    def take(batches):
        for batch in batches:
            for part in slices(batch, "text", WANTED_BYTES):
                out, windows = ([], [], [], [], []), []
                for doc, text, mark, size, want in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "mark", "size", "wanted"))):
                    data = text.encode()
                    place = np.array([w["place"] for w in want if not w["hot"]], dtype=np.int64)
                    _, first, count, _ = unpack(place)
                    begin, end = spans(data, first, first + count + window - 1)
                    out[0].extend(w["anchor"] for w in want if not w["hot"])
                    out[1].extend([doc] * len(place))
                    out[2].extend([mark] * len(place))
                    out[3].extend(place.tolist())
                    out[4].extend(data[a:b] for a, b in zip(begin.tolist(), end.tolist()))
                    place = np.array([w["place"] for w in want if w["hot"]], dtype=np.int64)
                    if len(place):
                        _, first, count, _ = unpack(place)
                        at = np.concatenate([np.arange(a, a + c) for a, c in zip(first, count)])
                        begin, end = spans(data, at, at + window)
                        key = span_hash(prefix_sums(units(data)), at, at + window).view(np.int64)
                        windows.append((key, np.full(len(at), doc), np.full(len(at), mark), pack(size, at, np.ones_like(at), np.zeros_like(at)),
                                        [data[a:b] for a, b in zip(begin.tolist(), end.tolist())]))
                if windows:
                    key, doc, mark, place = (np.concatenate(c) for c in list(zip(*windows))[:4])
                    gone = settle(key, doc, mark, place, whole_docs)
                    place = place | np.where(gone, GONE, 0)
                    key = np.where(gone, mix((place ^ doc ^ mark).view(np.uint64)).view(np.int64), key)
                    bodies = [b for w in windows for b in w[4]]
                    for column, values in zip(out, (key, doc, mark, place)):
                        column.extend(values.tolist())
                    out[4].extend(b"" if g else b for g, b in zip(gone.tolist(), bodies))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["anchor", "doc_id", "mark", "place", "body"])

    return (keyed.filter("doc_id is not null").join(listed, TEXT).select(*keyed.columns, "wanted")
            .mapInArrow(take, "anchor long, doc_id long, mark long, place long, body binary"))


def removed_spans(classified: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, mark, size, places) of passages flagged GONE and of the runs of windows `found` (doc_id, mark, place)."""
    gone = classified.filter(F.col("place").bitwiseAND(GONE) > 0).select("doc_id", "mark", "place").unionByName(found)
    return (gone.withColumn("size", F.shiftrightunsigned("place", SHIFT).cast("int"))
            .groupBy(*TEXT).agg(F.collect_list("place").alias("places")))


def merged(places, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The union of the spans of some places as disjoint, non-touching spans of units."""
    if places is None or not len(places):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    _, first, count, _ = unpack(np.asarray(places, dtype=np.int64))
    order = np.argsort(first, kind="stable")
    starts, reach = first[order], np.maximum.accumulate((first + count + window - 1)[order])
    cut = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
    return starts[cut], reach[np.append(cut[1:], len(starts)) - 1]


def attach_places(keyed: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents with places (NULL if nothing goes), also those without an id.

    Reads the same columns as `passage_texts`, so that both joins share one shuffle of the texts.
    """
    known = keyed.filter("doc_id is not null").join(gone, TEXT, "left").select(*keyed.columns, "places")
    return known.unionByName(keyed.filter("doc_id is null").withColumn("places", F.lit(None).cast("array<long>")))
