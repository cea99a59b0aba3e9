"""Packing documents into sequences along a space-filling curve.

A document's vector is the mean of a fixed random direction for each of its tokens (hashed features projected to a few
dimensions). Its place on the Hilbert curve through that space is one long, documents are range-sorted by it, and
neighbours along the curve fill sequences one after the other. Documents are cut where a sequence is full, so nothing is
padded; the last tokens of a task's stretch of the curve are cut into sequences whose lengths are powers of two.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm import bpe, common

SEQUENCE_TOKENS = 4096
#: The id that ends every document.
END_ID = 2
DIMENSIONS, DIMENSION_BITS = 3, 16
#: A coordinate is a mean of directions in [-1, 1]; beyond this it is at the edge.
REACH = 0.25
_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


@functools.lru_cache(maxsize=2)
def directions(size: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """One fixed direction per token id, from a hash of id and dimension."""
    x = np.arange(size * dimensions, dtype=np.uint64) + np.uint64(1)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return (x.astype(np.float64) / 2.0**63 - 1).astype(np.float32).reshape(size, dimensions)


def coordinates(ids: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """Whole-number coordinates of each document (rows)."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    together, doc = np.concatenate([np.empty(0, np.int64), *ids]).astype(np.int64), np.repeat(np.arange(len(ids)), lengths)
    sums = [np.bincount(doc, column[together], len(ids)) for column in table.T.astype(np.float64)]
    mean = np.stack(sums, axis=1) / np.maximum(lengths, 1)[:, None]
    cells = 1 << DIMENSION_BITS
    return np.clip((mean / REACH + 1) / 2 * cells, 0, cells - 1).astype(np.int64)


def hilbert_keys(points: np.ndarray, bits: int = DIMENSION_BITS) -> np.ndarray:
    """Places on the Hilbert curve of whole-number points (rows): turn each subcube as the curve does, from coarse to fine."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for d in range(dims):
            set_ = (x[d] & level) != 0
            swapped = np.where(set_, 0, (x[0] ^ x[d]) & below)
            x[0] ^= np.where(set_, below, swapped)
            if d:
                x[d] ^= swapped
        level >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> bit) & 1)
    return key


def curve_places(docs: DataFrame, path: str, id_col: str, text_col: str) -> DataFrame:
    """doc_id, place, ids (little-endian unsigned integers, the shortest that hold the vocabulary)."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        size = bpe.encoder(path).size
        table, kind = directions(size), id_type(size)
        ids = [np.frombuffer(raw, "<u4") for raw in bpe.encode_texts(batch["text"].to_pylist(), path)]
        points = coordinates(ids, table)
        raw = pa.array([i.astype(kind).tobytes() for i in ids], pa.binary())
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(hilbert_keys(points)), raw], ["doc_id", "place", "ids"]
        )

    return common.map_batches(common.texts(docs, id_col, text_col), step, "doc_id long, place long, ids binary")


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


class Sequences:
    """Fills sequences with documents one after the other; rows: the pieces of finished sequences."""

    def __init__(self, first_id: int, length: int, with_ids: bool):
        self.next_id, self.length, self.with_ids = first_id, length, with_ids
        self.open: list[tuple] = []
        self.filled = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            taken = min(len(ids) - start, self.length - self.filled)
            self.open.append((doc_id, start, ids[start : start + taken], len(ids)))
            self.filled += taken
            start += taken
            if self.filled == self.length:
                self._close()

    def _close(self) -> None:
        offset = 0
        for doc_id, start, ids, total in self.open:
            raw = ids.tobytes()
            row = (doc_id, start, len(ids), zlib.crc32(raw), total, self.next_id, offset, raw if self.with_ids else None)
            self.rows.append(row)
            offset += len(ids)
        self.next_id += 1
        self.open, self.filled = [], 0

    def finish(self) -> None:
        """What is left becomes sequences of the powers of two that add up to it: none is padded."""
        left, self.open, rest = self.open, [], self.filled
        pieces = iter(left)
        piece = next(pieces, None)
        while rest:
            part = 1 << (rest.bit_length() - 1)
            self.filled, rest = 0, rest - part
            while self.filled < part:
                doc_id, start, ids, total = piece
                taken = min(part - self.filled, len(ids))
                self.open.append((doc_id, start, ids[:taken], total))
                self.filled += taken
                piece = (doc_id, start + taken, ids[taken:], total) if taken < len(ids) else next(pieces, None)
            self._close()

    def take(self) -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 7, pa.binary()]
        names = [field.split(" ")[0] for field in _SCHEMA.split(", ")]
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pack(
    docs: DataFrame,
    length: int = SEQUENCE_TOKENS,
    path: str = bpe.WORD_BPE,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for.

    A null or empty text is the end id alone. Every row is packed, repeated rows and null ids too. Sequences are full, or
    have a power of two as length; their ids are unique and rise along the curve. Texts that are equal lie at the same
    place and are told apart by id, so a large group of copies is dealt over many tasks. Encoded once; what is shuffled
    is the ids.
    """
    size = bpe.encoder(path).size
    kind = id_type(size)
    placed = common.store(curve_places(docs, path, id_col, text_col), "curve")
    along = placed.repartitionByRange("place", "doc_id", F.xxhash64("ids")).sortWithinPartitions("place", "doc_id", "ids")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        out = Sequences((context.partitionId() if context else 0) << 40, length, with_ids)
        for batch in batches:
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                out.add(doc_id, np.append(np.frombuffer(raw, kind).astype("<u4"), np.uint32(END_ID)))
            if out.rows:
                yield out.take()
        out.finish()
        if out.rows:
            yield out.take()

    packed = common.map_partitions(along.select("doc_id", "ids"), fill, _SCHEMA)
    return packed if with_ids else packed.drop("ids")
