"""Byte-level BPE by the tiktoken library with a local rank file (operator 1)."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from shelfrisk.llm.passages import slices

PIECE = 1 << 16  # characters after which a long text is cut at the next safe boundary


def pieces(text: str, size: int = PIECE):
    """Cut a text where no match of the usual splitting patterns can run across: after a character that is no white
    space and before a blank or a line feed. Any white space belongs to the match that follows it, so the matches of
    the pieces are the matches of the text. A stretch without such a place stays whole."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and not (text[cut] in " \n" and not text[cut - 1].isspace()):
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def encoding(rank_file: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines()) if token}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _shared(docs: DataFrame, path: str):
    """The rank file (some hundred kilobytes, whatever the data) as a broadcast."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers in one binary) of every whole text.

    Special tokens are ordinary text. NULL and empty texts have no ids. Rows stand alone: repeated rows, NULL ids of
    documents and further columns change nothing. `path` names the rank file on the driver.
    """
    ranks = _shared(docs, path)

    def run(batches):
        coder = encoding(ranks.value, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [b"".join(np.array(coder.encode_ordinary(p), dtype="<u4").tobytes() for p in pieces(text or ""))
                       for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n_tokens", "ids"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """`encoded` (doc_id, n_tokens, ids) with `decoded`, the raw bytes the ids stand for; NULL ids give none."""
    ranks = _shared(encoded, path)

    def run(batches):
        coder = encoding(ranks.value, pattern)
        for batch in batches:
            for part in slices(batch, "ids"):
                found = [coder.decode_bytes(np.frombuffer(i or b"", dtype="<u4").tolist()) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "n_tokens", "ids")), pa.array(found, pa.binary())],
                                                 names=["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")
