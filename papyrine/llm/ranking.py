"""Ranked lexical search with bit-sliced Bloom signatures.

Every document has a Bloom signature of its terms, each entered once for every level of its frequency that it reaches (found
at least once, twice, three times, ...). Blocks of documents with signatures of one width are stored slice by slice: for each
bit of the signature, one bitmap with a bit per document. The slices of a term, intersected, hold every document that has the
term at that level, and a few that do not. Summed with the weights of an item's terms they give each document a score that is
never below its true one.

The documents with the highest bounds are scored exactly; the tenth best score so found is a floor for each item, and every
document whose bound reaches the floor is then scored exactly too. What is left out is proven to be no better, so that the
result does not depend on the signatures.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyrine.llm import common
from papyrine.llm.common import store

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TOP = 10
#: Frequencies at which a term is entered into the signature.
LEVELS = np.array([1, 2, 3, 4, 6, 9, 14, 24, 50])
#: Signature bits per entry at least (at most twice as many, as widths are powers of two), and hashes per entry.
ENTRY_BITS = 16
HASHES = 4
#: A block holds at most so many documents and entries.
BLOCK_DOCS = 512
BLOCK_ENTRIES = 1 << 20
#: Items that are searched at a time, and bytes of their text.
ITEMS_AT_ONCE = 2000
#: Hashes of query terms up to which document frequencies are counted for them only; beyond, for all terms.
FILTER_TERMS = 1 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
INDEX = "width int, doc_ids array<long>, hashes array<long>, lengths array<long>, slices binary, df_terms array<long>, df array<int>"


def terms(text: str | None) -> list[str]:
    """All terms of a whole text, with repeats."""
    return TERM.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass"))


def hashed(words: list[str]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)


def positions(hashes: np.ndarray, level: np.ndarray | int, width: int) -> np.ndarray:
    """The ``HASHES`` slices of each (term hash, level) in a signature of ``2 ** width`` bits."""
    mixed = (hashes ^ (np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    step = (mixed * np.uint64(0x94D049BB133111EB)) >> np.uint64(20) | np.uint64(1)
    return (mixed[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64((1 << width) - 1)


class _Block:
    """Documents of one signature width until they fill a block."""

    def __init__(self, width: int) -> None:
        self.width, self.entries, self.rows, self.bits = width, 0, [], []

    def add(self, row: tuple, hashes: np.ndarray, levels: np.ndarray) -> None:
        self.rows.append(row)
        self.bits.append((hashes, levels))
        self.entries += len(hashes)

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_DOCS or self.entries >= BLOCK_ENTRIES

    def slices(self) -> bytes:
        """One bitmap per bit of the signature: document i is bit ``7 - i % 8`` of its byte ``i // 8``."""
        out = np.zeros((1 << self.width, (len(self.rows) + 7) // 8), np.uint8)
        for i, (hashes, levels) in enumerate(self.bits):
            out[np.unique(positions(hashes, levels, self.width)).astype(np.int64), i // 8] |= np.uint8(128 >> i % 8)
        return out.tobytes()


def index(docs: DataFrame, wanted: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of bit-sliced signatures (see ``INDEX``) of all documents that hold a term.

    ``df_terms`` and ``df`` count in how many documents of the block a term occurs, for the sorted hashes ``wanted`` (None:
    all terms).
    """
    own = common.texts(docs, id_col, text_col).withColumn("hash", F.xxhash64("text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Block] = {}
        for batch in batches:
            for doc_id, text, key in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "hash")), strict=True):
                found = Counter(terms(text))
                if not found:
                    continue
                hashes, tf = hashed(list(found)), np.fromiter(found.values(), np.int64, len(found))
                reached = np.searchsorted(LEVELS, tf, side="right")
                levels = np.concatenate([np.arange(n) for n in reached]) if reached.max() > 1 else np.zeros(len(tf), np.int64)
                width = max(6, (ENTRY_BITS * len(levels) - 1).bit_length())
                block = blocks.setdefault(width, _Block(width))
                block.add((doc_id, key, int(tf.sum()), hashes), np.repeat(hashes, reached), levels)
                if block.full():
                    yield sent(blocks.pop(width))
        for block in blocks.values():
            yield sent(block)

    def sent(block: _Block) -> pa.RecordBatch:
        ids, keys, lengths, held = zip(*block.rows, strict=True)
        held_terms, df = np.unique(np.concatenate(held), return_counts=True)
        if wanted is not None:
            mine = np.isin(held_terms, wanted, assume_unique=True)
            held_terms, df = held_terms[mine], df[mine]
        kinds = [pa.list_(pa.int64())] * 3
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block.width], pa.int32()),
                *[pa.array([list(c)], k) for c, k in zip((ids, keys, lengths), kinds, strict=True)],
                pa.array([block.slices()], pa.binary()),
                pa.array([held_terms.view(np.int64).tolist()], pa.list_(pa.int64())),
                pa.array([df.tolist()], pa.list_(pa.int32())),
            ],
            [c.split()[0] for c in INDEX.split(", ")],
        )

    return common.map_partitions(own, build, INDEX)


def contribution(tf: np.ndarray | int, lengths: np.ndarray, docs: int, total: int) -> np.ndarray:
    """What one unit of weight adds for ``tf`` occurrences in documents of ``lengths`` terms."""
    m = 100 - 90 + (90 * lengths * docs) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Items:
    """Items with the weights of their terms."""

    def __init__(self, items: list[tuple[int | None, list[str]]], df: dict[int, int], docs: int, total: int) -> None:
        """``items``: (number, distinct terms); ``df``: documents per term hash."""
        self.numbers = [i for i, _ in items]
        self.docs, self.total = docs, total
        self.terms = [t for _, ts in items for t in ts]
        self.hashes = hashed(self.terms)
        counts = np.array([df.get(int(h), 0) for h in self.hashes.view(np.int64)], np.float64)
        self.weights = np.floor(1000 * np.log((2.0 * docs + 2) / (2 * counts + 1))).astype(np.int64)
        self.sizes = np.array([len(ts) for _, ts in items], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        # Terms that no document holds take part in no sum.
        self.live = counts > 0

    def bounds(self, width: int, lengths: np.ndarray, slices: bytes) -> np.ndarray:
        """For each item and document of a block a score that is not below the true one."""
        rows = np.frombuffer(slices, np.uint8).reshape(1 << width, -1)
        live = np.flatnonzero(self.live)
        hashes, back = np.unique(self.hashes[live], return_inverse=True)
        item_of = np.repeat(np.arange(len(self.sizes)), self.sizes)[live]
        out = np.zeros((len(self.sizes), len(lengths)), np.int64)
        below = np.zeros(len(lengths), np.int64)
        held = None
        for level in range(len(LEVELS)):
            most = np.minimum(LEVELS[level + 1] - 1, lengths) if level + 1 < len(LEVELS) else lengths
            value = contribution(most, lengths, self.docs, self.total)
            bits = np.bitwise_and.reduce(rows[positions(hashes, level, width).astype(np.int64)], axis=1)
            held = bits if held is None else held & bits
            some = held.any(axis=1)
            if not some.any():
                break
            mine = np.flatnonzero(some[back])
            present = np.unpackbits(held[back[mine]], axis=1, count=len(lengths))
            weighted = present * self.weights[live[mine], None]
            cuts = np.flatnonzero(np.diff(item_of[mine], prepend=-1))
            out[item_of[mine][cuts]] += np.add.reduceat(weighted, cuts, axis=0) * (value - below)
            below = value
        return out

    def scores(self, places: list[int], text: str) -> list[int]:
        """The exact scores of one document for the items at ``places``."""
        found = Counter(terms(text))
        length = np.array(found.total(), np.int64)
        out = []
        for place in places:
            at, size = int(self.starts[place]), int(self.sizes[place])
            tf = np.array([found.get(t, 0) for t in self.terms[at : at + size]], np.int64)
            out.append(int((self.weights[at : at + size] * contribution(tf, length, self.docs, self.total)).sum()))
        return out


def _candidates(blocks: DataFrame, items: Items, floors: np.ndarray | None, top: int) -> DataFrame:
    """place, doc_id, hash, bound: per block the documents whose bound reaches the item's floor (none: the ``top`` highest)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                bounds = items.bounds(row["width"], lengths, row["slices"])
                if floors is None:
                    chosen = np.argpartition(-bounds, min(top, len(lengths)) - 1, axis=1)[:, :top]
                    place, doc = np.repeat(np.arange(len(bounds)), chosen.shape[1]), chosen.ravel()
                    some = bounds[place, doc] > 0
                    place, doc = place[some], doc[some]
                else:
                    place, doc = np.nonzero(bounds >= floors[:, None])
                ids, keys = row["doc_ids"], row["hashes"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place, pa.int64()),
                        pa.array([ids[d] for d in doc.tolist()], pa.int64()),
                        pa.array([keys[d] for d in doc.tolist()], pa.int64()),
                        pa.array(bounds[place, doc], pa.int64()),
                    ],
                    ["place", "doc_id", "hash", "bound"],
                )

    return common.map_partitions(blocks, search, "place long, doc_id long, hash long, bound long")


def _highest(candidates: DataFrame, top: int) -> DataFrame:
    """Of each place the candidates with the ``top`` highest bounds."""
    spread = candidates.withColumn("part", F.spark_partition_id())
    for keys in (["place", "part"], ["place"]):
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("bound"), "doc_id", "hash"))
        spread = spread.withColumn("nth", nth).filter(F.col("nth") <= top)
    return spread.select("place", "doc_id", "hash")


def _scored(own: DataFrame, chosen: DataFrame, items: Items) -> DataFrame:
    """place, doc_id, score: the exact scores of the chosen (place, doc_id, hash), once for every row with that id and text."""
    by_doc = store(chosen.groupBy("doc_id", "hash").agg(F.collect_set("place").alias("places")), "chosen")
    keys = common.broadcast_if_bytes(by_doc.select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "places"))
    rows = own.join(keys, own["doc_id"].eqNullSafe(keys["_id"]) & (own["hash"] == keys["_hash"])).select("doc_id", "text", "places")

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc_ids, places, scores = [], [], []
        for doc_id, text, wanted in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "places")), strict=True):
            doc_ids += [doc_id] * len(wanted)
            places += wanted
            scores += items.scores(wanted, text)
        return pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(scores, pa.int64())], ["place", "doc_id", "score"]
        )

    return common.map_batches(rows, score, "place long, doc_id long, score long").filter("score > 0")


def _best(scored: DataFrame, top: int) -> DataFrame:
    """``scored`` with rank, the ``top`` best of each place: per partition first, so that no task gets all of an item."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    spread = scored.withColumn("part", F.spark_partition_id())
    some = spread.withColumn("rank", F.row_number().over(Window.partitionBy("place", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select("place", "rank", "doc_id", "score")


def _item_blocks(numbered: DataFrame, items_at_once: int) -> list[tuple[int, int]]:
    """First and last ``row`` of each block of ``items_at_once`` items, in the order of ``row`` (by ``monotonically_increasing_id``).

    Blocks are counted, not partitions of a range: each block is a search of its own, and Spark may make many partitions.
    """
    parts = numbered.groupBy(F.shiftrightunsigned("row", 33).alias("part")).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts, before = [], 0
    for part in parts.orderBy("part").collect():
        firsts += [part["first"] + i for i in range(-before % items_at_once, part["n"], items_at_once)]
        before += part["n"]
    return [(first, after - 1) for first, after in zip(firsts, [*firsts[1:], 1 << 62], strict=False)]


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    items_at_once: int = ITEMS_AT_ONCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every row of ``items`` with a score above 0.

    Null and empty texts have no term and are in no result; rows that share an id or a text are documents of their own (one
    id may then fill several ranks). Null ids come last among equal scores. Rows of ``items`` that share an id are searched
    separately, and each has its own ranks. Items are searched in blocks of ``items_at_once``; the index is built once.
    """
    spark = docs.sparkSession
    own = common.texts(docs, id_col, text_col).withColumn("hash", F.xxhash64("text"))
    asked = items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.coalesce(F.col("`text`"), F.lit("")).alias("text"))
    numbered = store(asked.withColumn("row", F.monotonically_increasing_id()), "items")

    def term_hashes(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = {h for t in batch["text"].to_pylist() for h in hashed(list(set(terms(t)))).tolist()}
        return pa.RecordBatch.from_arrays([pa.array(np.array(sorted(found), np.uint64).view(np.int64))], ["term"])

    asked_terms = store(common.map_batches(numbered.select("text"), term_hashes, "term long").distinct(), "terms")
    wanted = None
    if asked_terms.count() <= FILTER_TERMS:
        wanted = np.sort(np.array([r[0] for r in asked_terms.collect()], np.int64).view(np.uint64))
    blocks = store(index(docs, wanted, id_col, text_col), "signatures")
    corpus = blocks.select(F.sum(F.size("doc_ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b))).first()
    n_docs, total = corpus[0] or 0, corpus[1] or 0
    counts = blocks.select(F.explode(F.arrays_zip("df_terms", "df")).alias("x")).groupBy(F.col("x.df_terms").alias("term"))
    counts = store(counts.agg(F.sum("x.df").alias("df")).join(asked_terms, "term", "left_semi"), "df")
    out = None
    for first_row, last_row in _item_blocks(numbered, items_at_once) if n_docs else []:
        rows = numbered.filter(F.col("row").between(first_row, last_row))
        own_terms = common.map_batches(rows.select("text"), term_hashes, "term long").distinct()
        df = dict(counts.join(own_terms, "term", "left_semi").select("term", "df").collect())
        texts = rows.orderBy("row").select("item_id", "text").collect()
        packed = Items([(i, sorted(set(terms(t)))) for i, t in texts], df, n_docs, total)
        first = _highest(_candidates(blocks, packed, None, top), top)
        scored = store(_best(_scored(own, first, packed), top), "first_scores")
        floors = np.ones(len(texts), np.int64)
        for r in scored.groupBy("place").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= top).collect():
            floors[r["place"]] = r["floor"]
        best = _best(_scored(own, _candidates(blocks, packed, floors, top), packed), top)
        names = spark.createDataFrame([(p, i) for p, i in enumerate(packed.numbers)], "place long, item_id long")
        best = best.join(F.broadcast(names), "place").select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
