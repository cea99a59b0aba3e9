"""Language-model scores by a probabilistic suffix tree over words.

A state of the tree is a context of up to ``depth`` words before a token. The root is the smoothed distribution of single
words. Every context that has been seen ``min_context`` times is a candidate, and it is retained if its next-token
distribution diverges from that of its longest retained suffix: the tokens seen there, counted one by one with each left out of
the estimate, must be better predicted by ``min_gain`` bits in all. A retained state s gives a token x

    P(x | s) = (c(s x) - D) / c(s)  [if c(s x) >= 2]  +  rest(s) * P(x | parent of s)

where rest(s) is the mass that the first part leaves, so that every state's probabilities sum to one. A token is scored in
the state of its longest retained suffix. Contexts do not reach across documents; held-out documents are scored, never counted.

Documents are cut into chunks of bounded size, whose tokens are stored as numbers of the chunk's own dictionary. The buckets that
count single words also number them, frequent words first, so that all chunks speak of a word by the same small number; chunks are
stored anew with these numbers, and what held the words' hashes is removed, as are the shuffles of every answer that stands. For every
depth in turn each chunk sends its distinct (context, next token) pairs, counted, to buckets; a bucket adds up what the chunks have
sent and answers each of them with counts and with the sums that the divergence test needs. With the answers a chunk knows which
states its positions are in, and asks for the next depth only where the context is frequent enough. A context that
holds a large share of the corpus is dealt to many buckets, whose partial sums its chunks add up. Messages hold columns of small
numbers in order, whose bytes are compressed place by place.
"""

from __future__ import annotations

import contextlib
import math
import pickle
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.llm import common
from papyrine.session import scratch_path


class Settings(NamedTuple):
    """``depth``: words of context at most. ``min_context``: occurrences in training documents from which a context is tested.
    ``min_gain``: bits by which a state must predict its tokens better than its parent. ``min_lift``: bits by which a word must
    be likelier in its state than in the root for the two to be tried as a longer context (by default all are tried). ``discount``: D above.
    ``chunk_tokens``: tokens after which a chunk ends. ``split_context``: occurrences of a context that one bucket answers for.
    """

    depth: int = 2
    min_context: int = 4
    min_gain: float = 8.0
    min_lift: float = -math.inf
    discount: float = 0.75
    chunk_tokens: int = 1_500_000
    split_context: int = 2_000_000


#: Documents after which a chunk ends.
CHUNK_DOCS = 50_000
#: Documents are held out where crc32(doc_id) leaves this remainder.
HELD_OUT = (7, 2)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
END = b""
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def tokens(text: str) -> list[bytes]:
    """The words of a whole text, A-Z lower-cased, and one end."""
    return [*text.encode("utf-8", "surrogatepass").translate(_LOWER).split(), END]


def held_out(doc_id: int | None) -> bool:
    """Whether a document is kept from training (a null id: crc32 of the empty string)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_OUT[0] == HELD_OUT[1]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX[1]
    values = (values ^ (values >> np.uint64(27))) * _MIX[2]
    return values ^ (values >> np.uint64(31))


def _blob(value: object) -> bytes:
    return zstandard.compress(pickle.dumps(value, protocol=5))


def _unblob(data: bytes) -> object:
    return pickle.loads(zstandard.decompress(data))


def chunks(docs: DataFrame, chunk_tokens: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """chunk, data: documents in chunks, each with its dictionary of hashed words and its tokens as numbers of it."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        words, ids, held = _Numbers(), [], []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own = tokens(text)
                ids.append(doc_id)
                held.append(np.fromiter(map(words.__getitem__, own), np.uint32, len(own)))
                size += len(own)
                if size >= chunk_tokens or len(ids) >= CHUNK_DOCS:
                    yield sent((part << 33) + number, words, ids, held)
                    number, size, words, ids, held = number + 1, 0, _Numbers(), [], []
        if ids:
            yield sent((part << 33) + number, words, ids, held)

    def sent(chunk: int, words: dict[bytes, int], ids: list, held: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        numbers = np.concatenate(held)
        # Frequent words get small numbers, equally frequent ones in the order of their hashes.
        order = np.lexsort((hashes, -np.bincount(numbers, minlength=len(hashes))))
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        data = _blob((ids, np.array([len(h) for h in held], np.int64), _packed_hashes(hashes[order]), _packed(place[numbers])))
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([data], pa.binary())], ["chunk", "data"])

    return common.map_partitions(common.texts(docs, id_col, text_col), build, "chunk long, data binary")


class _Numbers(dict):
    """Words, numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


_ZSTD = zstandard.ZstdCompressor()


def _packed(values: np.ndarray) -> tuple[int, list[bytes]]:
    """Numbers of at least 0, the bytes of each place compressed on their own."""
    values = np.ascontiguousarray(values, np.uint64)
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    places = values.view(np.uint8).reshape(-1, 8)
    return len(values), [_ZSTD.compress(np.ascontiguousarray(places[:, k])) for k in range(width)]


def _unpacked(data: tuple[int, list[bytes]]) -> np.ndarray:
    places = np.zeros((data[0], 8), np.uint8)
    for k, place in enumerate(data[1]):
        places[:, k] = np.frombuffer(zstandard.decompress(place), np.uint8)
    return places.view(np.uint64).ravel().astype(np.int64)


def _packed_small(values: np.ndarray) -> tuple[int, list[bytes]]:
    """Numbers that are 0, 1 or 2 for the most part: four to a byte, and what larger ones have above 3."""
    low = np.append(np.minimum(values, 3), np.zeros(-len(values) % 4, np.int64)).reshape(-1, 4)
    fours = (low << np.arange(0, 8, 2)).sum(axis=1).astype(np.uint8)
    return len(values), [_ZSTD.compress(fours), *_packed(values[values >= 3] - 3)[1]]


def _unpacked_small(data: tuple[int, list[bytes]]) -> np.ndarray:
    fours = np.frombuffer(zstandard.decompress(data[1][0]), np.uint8)
    values = ((fours[:, None] >> np.arange(0, 8, 2)) & 3).ravel()[: data[0]].astype(np.int64)
    large = np.flatnonzero(values == 3)
    values[large] += _unpacked((len(large), data[1][1:]))
    return values


def _packed_hashes(hashes: np.ndarray) -> tuple[int, list[bytes]]:
    """Hashes that are in order for the most part, by their differences (modulo 2**64)."""
    return _packed(np.diff(hashes, prepend=np.uint64(0)))


def _unpacked_hashes(data: tuple[int, list[bytes]]) -> np.ndarray:
    return np.cumsum(_unpacked(data).view(np.uint64), dtype=np.uint64)


def _steps(values: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Numbers that grow within runs, by what they grow; the first of a run (where ``new``) as it is."""
    return np.where(new, values, np.diff(values, prepend=0))


def _summed(steps: np.ndarray, new: np.ndarray) -> np.ndarray:
    values, first = np.cumsum(steps), np.flatnonzero(new)
    return values - np.repeat((values - steps)[first], np.diff(first, append=len(steps)))


def _starts(sizes: np.ndarray, length: int) -> np.ndarray:
    """Where runs of these sizes begin."""
    new = np.zeros(length, bool)
    new[np.cumsum(sizes) - sizes] = True
    return new


def _bits(values: np.ndarray) -> int:
    return int(values.max(initial=0)).bit_length()


def _ordered(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by (high, low), and which of the ordered rows differ from the one before.

    Both numbers and the row's own make one where that has room: plain numbers are sorted in a fraction of the time.
    """
    bits, rows = _bits(low), len(low)
    if _bits(high) + bits + rows.bit_length() > 63:
        order = np.lexsort((low, high))
        new = (np.diff(high[order], prepend=-1) != 0) | (np.diff(low[order], prepend=-1) != 0)
        return order, new
    room = rows.bit_length()
    key = np.sort((((high << bits) | low) << room) | np.arange(rows))
    return key & ((1 << room) - 1), np.diff(key >> room, prepend=-1) != 0


class Entries:
    """The distinct pairs (context, symbol) of a chunk's positions at one depth, and the order in which they are sent.

    Pairs are in the order of (context, symbol); after them come pairs that are only asked for the sums of their context.
    """

    def __init__(self, context: np.ndarray, symbol: np.ndarray, train: np.ndarray, numbers: np.ndarray, hashes: np.ndarray, counts: np.ndarray, buckets: int, split_context: int):
        """``train``: whether a position is counted; ``numbers``: the words' common numbers; ``hashes``, ``counts``: hash and occurrences of each context."""
        order, new = _ordered(context, symbol)
        first = np.flatnonzero(new)
        self.of = np.empty(len(order), np.int64)  # entry of each position
        self.of[order] = np.cumsum(new) - 1
        self.lead = order[first]  # a position of each entry
        self.context, self.symbol = context[self.lead], symbol[self.lead]
        self.seen = np.add.reduceat(train[order], first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
        self.own = len(first)
        n = counts[self.context]
        share = np.zeros(len(first), np.uint64)
        # Of a context in several buckets every chunk asks all of them, as it needs the sums of all.
        some = np.flatnonzero(n > split_context)
        if len(some):
            split = np.minimum(buckets, -(-n[some] // split_context))
            share[some] = mixed(numbers[self.symbol[some]].astype(np.uint64)) % split.astype(np.uint64)
            once = np.flatnonzero(np.diff(self.context[some], prepend=-1))
            asked = np.repeat(self.context[some][once], split[once])
            probes = np.arange(len(asked)) - np.repeat(np.cumsum(split[once]) - split[once], split[once])
            none = np.zeros(len(asked), np.int64)
            # Where they belong in the order: after the pair with symbol 0, if there is one.
            place = np.searchsorted(self.context, asked)
            place += self.symbol[place] == 0
            self.context, self.symbol = np.concatenate([self.context, asked]), np.concatenate([self.symbol, none])
            self.seen, share = np.concatenate([self.seen, none]), np.concatenate([share, probes.astype(np.uint64)])
        bucket = ((mixed(hashes + _MIX[0])[self.context] + share) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
        self.order = np.arange(self.own)
        if len(some):
            self.order = np.insert(self.order, place, self.own + np.arange(len(asked)))
        self.order = self.order[np.argsort(bucket[self.order], kind="stable")]
        self.ends = np.searchsorted(bucket[self.order], np.arange(buckets + 1))
        # Runs of a context in one bucket, in the order in which they are sent.
        sent = self.context[self.order]
        new = np.diff(sent, prepend=-1) != 0
        new[self.ends[:-1][self.ends[:-1] < len(sent)]] = True
        runs = np.flatnonzero(new)
        self.run_ends = np.searchsorted(runs, self.ends)
        self.run_context, self.run_sizes = sent[runs], np.diff(runs, append=len(sent))
        self.run_counts = counts[self.run_context]
        self.run_split = self.run_counts > split_context

    def messages(self, chunk: int, words: list[np.ndarray], numbers: np.ndarray, parent: np.ndarray, by_word: bool) -> Iterator[tuple]:
        """(chunk, bucket, data) for every bucket that is asked.

        ``words``: columns of the words of each context; ``numbers``: the words' common numbers. ``parent``: log2 P of each position in
        the parent; ``by_word``: it depends on the symbol alone.
        """
        code = np.zeros(len(self.symbol), np.uint8)
        code[: self.own] = np.clip(np.rint(-4 * parent[self.lead]), 0, 255).astype(np.uint8)
        of_word = np.zeros(len(numbers), np.uint8)
        of_word[self.symbol[: self.own]] = code[: self.own]
        marked, place = np.zeros(len(numbers), bool), np.empty(len(numbers), np.int64)
        for b in np.flatnonzero(np.diff(self.ends)).tolist():
            at, runs = self.order[self.ends[b] : self.ends[b + 1]], slice(self.run_ends[b], self.run_ends[b + 1])
            symbol, columns = self.symbol[at], [w[self.run_context[runs]] for w in words]
            # The words of a message are numbered by themselves.
            for column in (symbol, *columns):
                marked[column] = True
            used = np.flatnonzero(marked)
            place[used], marked[used] = np.arange(len(used)), False
            # Only what is counted needs the probability in the parent.
            codes = code[at[(self.seen[at] > 0) & (symbol > 0)]]
            if by_word:
                # Frequent words come first, so neighbours have about the same.
                codes = np.diff(of_word[used].astype(np.int64), prepend=0)
                codes = np.abs(2 * codes) - (codes < 0)
            split, new, steps = self.run_split[runs], np.zeros(len(columns[0]), bool), []
            new[0] = True
            for column in columns:
                steps.append(_steps(place[column], new))
                new = new | (steps[-1] > 0)
            values = (
                np.diff(numbers[used], prepend=0),
                *steps,
                self.run_sizes[runs],
                np.flatnonzero(split),
                self.run_counts[runs][split],
                _steps(place[symbol], _starts(self.run_sizes[runs], len(at))),
                codes,
                self.seen[at],
            )
            # Sizes of runs and counts are small.
            small = len(columns) + 1, len(values) - 1
            yield chunk, b, pickle.dumps([_packed_small(v) if k in small else _packed(v) for k, v in enumerate(values)], protocol=5)


def retained(sums: np.ndarray, n: np.ndarray, min_gain: float) -> np.ndarray:
    """Whether contexts seen ``n`` times diverge enough; ``sums``: gain, tokens seen twice or more, their discounted count."""
    rest = np.maximum(1 - sums[2] / n, 1e-12)
    return (sums[0] + (n - sums[1]) * np.log2(rest) >= min_gain) & (sums[1] > 0)


def answer(messages: list[tuple[int, bytes]], level: int, settings: Settings) -> list[bytes]:
    """The answers of one bucket to the messages (chunk, data) of its chunks: counts of entries, and sums per context.

    Of contexts that are known here not to be retained only counts are told, and not even these at the last depth or where a lift
    is asked for: then no longer context is tried on their account.
    """
    parts = [pickle.loads(d) for _, d in messages]
    for p in parts:
        small = level + 1, len(p) - 1
        p[:] = [_unpacked_small(v) if k in small else _unpacked(v) for k, v in enumerate(p)]
        new = np.zeros(len(p[1]), bool)
        new[0] = True
        for k in range(1, level + 1):
            # A new word in one column begins a run of the next.
            grown = p[k] > 0
            p[k] = _summed(p[k], new)
            new = new | grown
        p[-3] = _summed(p[-3], _starts(p[level + 1], len(p[-3])))
    sizes = [len(p[1]) for p in parts]  # contexts of each message
    lengths = [len(p[-3]) for p in parts]  # and its entries
    numbers, place = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts]), return_inverse=True)
    places = np.split(place, np.cumsum([len(p[0]) for p in parts])[:-1])
    # The contexts of all messages, numbered word by word.
    context = np.zeros(sum(sizes), np.int64)
    for k in range(1, level + 1):
        column = np.concatenate([w[p[k]] for w, p in zip(places, parts, strict=True)])
        order, new = _ordered(context, column)
        context[order] = np.cumsum(new) - 1
    contexts = int(context.max(initial=-1)) + 1
    where = np.repeat(context, np.concatenate([p[level + 1] for p in parts]))
    symbol = np.concatenate([w[p[-3]] for w, p in zip(places, parts, strict=True)])
    rare = numbers[symbol] == 0
    seen = np.concatenate([p[-1] for p in parts])
    if level == 1:
        code = np.concatenate([np.cumsum(np.where(p[-2] % 2, -p[-2] - 1, p[-2]) // 2)[p[-3]] for p in parts])
    else:
        code = np.zeros(len(symbol), np.int64)
        code[(seen > 0) & ~rare] = np.concatenate([p[-2] for p in parts])
    # A context's occurrences: all are asked here, but for one in several buckets, of which they are told.
    n = np.bincount(where, weights=seen, minlength=contexts)
    split = np.zeros(contexts, bool)
    for own, p in zip(np.split(context, np.cumsum(sizes)[:-1]), parts, strict=True):
        split[own[p[level + 2]]] = True
        n[own[p[level + 2]]] = p[level + 3]
    order, new = _ordered(where, symbol)
    first = np.flatnonzero(new)
    at = order[first]
    total = np.add.reduceat(seen[order], first)
    total[(total < 2) | rare[at]] = 0
    # Sums of each context over the symbols that were seen twice or more.
    often = np.flatnonzero(total)
    own, c = where[at[often]], total[often].astype(float)
    gain = c * (np.log2((c - 1) / n[own]) + np.maximum.reduceat(code[order], first)[often] / 4)
    gain, c, k = (np.bincount(own, weights=w, minlength=contexts) for w in (gain, c, np.ones(len(own))))
    with np.errstate(divide="ignore", invalid="ignore"):
        kept = split | retained(np.stack([gain, c, c - settings.discount * k]), n, settings.min_gain)
    told = kept if level == settings.depth or settings.min_lift > 0 else np.ones(contexts, bool)
    back = np.empty(len(order), np.int64)
    back[order] = total[np.cumsum(new) - 1]
    out = []
    cuts, ends = np.cumsum(sizes), np.cumsum(lengths)
    for size, cut, length, end in zip(sizes, cuts.tolist(), lengths, ends.tolist(), strict=True):
        of = context[cut - size : cut]
        some = of[kept[of]]
        mine = back[end - length : end][told[where[end - length : end]]]
        values = (np.packbits(kept[of]), c[some], k[some], np.packbits(mine > 0), mine[mine > 0])
        # What is decided here needs no exact gain.
        out.append(pickle.dumps(([_packed(v) for v in values], gain[of[split[of]]]), protocol=5))
    return out


def count_words(messages: list[tuple[int, bytes]]) -> tuple[list[bytes], int, int]:
    """The answers of one bucket to messages of (word hashes, counts); the tokens and the distinct words that it counted.

    Words get counts and, where they are seen twice or more, numbers from 1, frequent words first (else 0).
    """
    parts = [(_unpacked_hashes(h), _unpacked(c)) for h, c in (pickle.loads(d) for _, d in messages)]
    words, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    total = np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
    number = np.empty(len(words), np.int64)
    number[np.argsort(-total, kind="stable")] = np.arange(1, len(words) + 1)
    number[total < 2] = 0
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    out = []
    for w in np.split(where, cuts):
        # The numbers follow the order of counts and hashes, which a chunk finds by itself.
        own = np.sort(number[w])
        out.append(pickle.dumps((_packed(total[w]), _packed(np.diff(own[own > 0], prepend=0))), protocol=5))
    return out, int(total.sum()), int((total > 0).sum())


class Chunk:
    """A chunk's documents and what the answers so far say of them.

    ``counted``: the chunk was stored anew when its words had been counted, and holds their numbers and counts instead of hashes.
    """

    def __init__(self, data: bytes, buckets: int, settings: Settings, counted: bool = False) -> None:
        self.settings = settings
        self.ids, self.sizes, words, numbers = _unblob(data)
        self.numbers = _unpacked(numbers)
        self.buckets, self.counted = buckets, counted
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.held = np.array([held_out(i) for i in self.ids], bool)
        self.train = ~self.held[self.doc]
        starts = np.cumsum(self.sizes) - self.sizes
        self.before = np.arange(len(self.numbers)) - np.repeat(starts, self.sizes)
        if counted:
            # Numbers are stored one higher, below them the words seen once (1) and never (0).
            self.word_numbers = np.maximum(np.cumsum(_unpacked(words[0])) - 1, 0)
            self.word_counts = _unpacked(words[1])
            return
        self.hashes = _unpacked_hashes(words)
        self.word_bucket = ((self.hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)

    def word_messages(self, chunk: int) -> Iterator[tuple]:
        counts = np.bincount(self.numbers, weights=self.train, minlength=len(self.hashes)).astype(np.int64)
        for b in np.unique(self.word_bucket).tolist():
            mine = self.word_bucket == b
            yield chunk, int(b), pickle.dumps((_packed_hashes(self.hashes[mine]), _packed(counts[mine])), protocol=5)

    def told(self, answers: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Counts and common numbers of the words."""
        if self.counted:
            return self.word_counts, self.word_numbers
        counts, numbers = np.zeros(len(self.hashes), np.int64), np.zeros(len(self.hashes), np.int64)
        for b, data in answers:
            mine = np.flatnonzero(self.word_bucket == b)
            counts[mine], own = (_unpacked(v) for v in pickle.loads(data))
            mine = mine[np.lexsort((self.hashes[mine], -counts[mine]))][: len(own)]
            numbers[mine] = (np.cumsum(own) - 1) * self.buckets + b + 1
        return counts, numbers

    def with_counts(self, answers: list[tuple[int, bytes]]) -> bytes:
        """The chunk without hashes: words in the order of their common numbers; those that have none are one word a count."""
        counts, numbers = self.told(answers)
        words, first, place = np.unique(np.where(numbers > 0, numbers + 1, counts), return_index=True, return_inverse=True)
        known = _packed(np.diff(words, prepend=0)), _packed(counts[first])
        return _blob((self.ids, self.sizes, known, _packed(place[self.numbers])))

    def learn_words(self, answers: list[tuple[int, bytes]], total: int, distinct: int) -> None:
        """Counts of the words and the probabilities of the root; a chunk whose words are counted needs no answers."""
        counts, numbers = self.told(answers)
        self.counts = counts[self.numbers]
        base = np.log10((counts + 1) / (total + distinct + 1))
        self.base = base[self.numbers]
        self.log2p = self.base * np.log2(10)
        self.root = self.log2p.copy() if self.settings.min_lift > -math.inf else None
        # Symbols: 0 for tokens that cannot have been seen twice after a longer context, which are not told apart, others in the
        # order of their common numbers.
        common = np.sort(np.append(numbers, 0))
        self.common = common[np.diff(common, prepend=-1) > 0]
        place = np.searchsorted(self.common, numbers)
        self.symbol = place[self.numbers]
        # Contexts of depth one: the word before. Of each numbered context its hash, occurrences and words.
        self.context = self.symbol
        self.context_hash = mixed(self.common.astype(np.uint64))
        self.context_counts = np.zeros(len(self.common), np.int64)
        self.context_counts[place] = counts
        self.context_counts[0] = 0
        self.context_words = [np.arange(len(self.common))]
        self.shift = 1

    def entries(self) -> Entries:
        """The positions that are asked at the next depth: the context is long and frequent enough.

        A context seen once is never retained, so at least two occurrences are asked for.
        """
        often = self.context_counts >= max(2, self.settings.min_context)
        context = np.roll(self.context, 1)
        self.at = np.flatnonzero((self.before >= self.shift) & (context >= 0) & often[context])
        self.of_context = context[self.at]
        own = self.common, self.context_hash, self.context_counts, self.buckets, self.settings.split_context
        return Entries(self.of_context, self.symbol[self.at], self.train[self.at], *own)

    def pair_messages(self, entries: Entries, chunk: int) -> Iterator[tuple]:
        return entries.messages(chunk, self.context_words, self.common, self.log2p[self.at], self.shift == 1)

    def learn(self, entries: Entries, answers: list[tuple[int, bytes]]) -> None:
        """The states that the positions are in after one more depth."""
        settings, last = self.settings, self.shift == self.settings.depth
        count = np.zeros(len(entries.order), np.int64)
        sums = np.zeros((3, len(entries.run_context)))
        for b, data in answers:
            at = entries.order[entries.ends[b] : entries.ends[b + 1]]
            runs = slice(entries.run_ends[b], entries.run_ends[b + 1])
            values, gain = pickle.loads(data)
            some, c, k, seen, values = (_unpacked(v) for v in values)
            split, sizes = entries.run_split[runs], entries.run_sizes[runs]
            told = kept = np.unpackbits(some.astype(np.uint8), count=len(split)).astype(bool)
            if not (last or settings.min_lift > 0):
                told = np.ones(len(split), bool)
            own = sums[:, runs]
            own[0, kept] = np.inf
            own[0, split] = gain
            own[1, kept], own[2, kept] = c, c - settings.discount * k
            at = at[np.repeat(told, sizes)]
            at = at[np.unpackbits(seen.astype(np.uint8), count=len(at)).astype(bool)]
            count[at] = values
        count = count[: entries.own]
        n = np.maximum(self.context_counts, 1)
        sums = np.stack([np.bincount(entries.run_context, weights=s, minlength=len(n)) for s in sums])
        rest, kept = 1 - sums[2] / n, retained(sums, n, settings.min_gain)
        mass = np.where(count >= 2, (count - settings.discount) / n[entries.context[: entries.own]], 0.0)
        some = np.flatnonzero(kept[self.of_context])
        at = self.at[some]
        self.log2p[at] = np.log2(mass[entries.of[some]] + rest[self.of_context[some]] * np.exp2(self.log2p[at]))
        if last:
            return
        # Of a context that is not retained a bucket may keep the counts to itself.
        known = kept[self.of_context] | (settings.min_lift <= 0)
        rare = np.zeros(len(self.symbol), bool)
        rare[self.at] = known & (count[entries.of] < 2)
        # The next depth's contexts: this depth's pairs, where they were seen often enough.
        self.context = np.full(len(self.symbol), -1)
        self.context[self.at] = entries.of
        context, symbol = entries.context[: entries.own], entries.symbol[: entries.own]
        self.context_hash = mixed(self.context_hash[context] * _MIX[1] + self.common[symbol].astype(np.uint64) + _MIX[0])
        self.context_counts = count
        if self.root is not None:
            lead = self.at[entries.lead]
            self.context_counts = np.where(self.log2p[lead] - self.root[lead] >= settings.min_lift, count, 0)
        self.context_words = [*[w[context] for w in self.context_words], symbol]
        self.symbol = np.where(rare, 0, self.symbol)
        self.shift += 1


MESSAGES = "chunk long, bucket long, data binary"
ANSWERS = "chunk long, level int, bucket long, data binary"


def _said(rows: pa.Table | None) -> dict[int, list[tuple[int, bytes]]]:
    """The answers (bucket, data) to a chunk, by level."""
    answers: dict[int, list[tuple[int, bytes]]] = {}
    if rows is not None:
        for k, b, own in zip(*(rows[c].to_pylist() for c in ("level", "bucket", "data")), strict=True):
            answers.setdefault(k, []).append((b, own))
    return answers


def _restored(
    data: bytes, rows: pa.Table | None, level: int, buckets: int, sums: tuple[int, int], settings: Settings
) -> tuple[Chunk, Entries | None]:
    """A counted chunk after the answers ``rows`` to all depths before ``level``, and what it asks at that depth."""
    answers = _said(rows)
    state = Chunk(data, buckets, settings, counted=True)
    state.learn_words([], *sums)
    entries = state.entries()
    for k in range(1, level):
        state.learn(entries, answers.get(k, []))
        entries = state.entries() if k < settings.depth else None
    return state, entries


def _messages(rows: Iterator[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["chunk", "bucket", "data"])


def _answered(messages: DataFrame, level: int, settings: Settings) -> DataFrame:
    """The answers of every bucket; of single words also the tokens and distinct words counted there (else 0)."""

    def step(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["chunk"].to_pylist(), table["data"].to_pylist(), strict=True))
        total = distinct = 0
        if level == 0:
            out, total, distinct = count_words(rows)
        else:
            out = answer(rows, level, settings)
        n = len(rows)
        return pa.table(
            {
                "chunk": pa.array([c for c, _ in rows], pa.int64()),
                "level": pa.array([level] * n, pa.int32()),
                "bucket": pa.array([key[0].as_py()] * n, pa.int64()),
                "data": pa.array(out, pa.binary()),
                "total": pa.array([total, *[0] * (n - 1)], pa.int64()),
                "distinct": pa.array([distinct, *[0] * (n - 1)], pa.int64()),
            }
        )

    return common.map_groups(messages, ["bucket"], step, f"{ANSWERS}, total long, distinct long")


class _ByChunk:
    """A table stored in buckets of ``chunk``, so that what is stored with as many buckets is joined without moving it again."""

    def __init__(self, spark: SparkSession, buckets: int) -> None:
        self.spark, self.buckets, self.path, self.name = spark, buckets, scratch_path(spark, "chunks"), f"chunks_{uuid.uuid4().hex}"

    def __enter__(self) -> _ByChunk:
        return self

    def __exit__(self, *_: object) -> None:
        """No table is left in the catalogue; its files stay, and frames that read them."""
        self.spark.sql(f"drop table if exists {self.name}")

    def add(self, df: DataFrame) -> DataFrame:
        """All rows that were added so far."""
        writer = df.write.format("parquet").option("path", self.path).bucketBy(self.buckets, "chunk")
        writer.mode("append").saveAsTable(self.name)
        return self.spark.table(self.name)

    def remove(self) -> None:
        """The files too, where no frame reads them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when what is written meanwhile stands, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def _counted(
    docs: DataFrame, id_col: str, text_col: str, settings: Settings, buckets: int, partitions: int
) -> tuple[DataFrame, tuple[int, int]]:
    """chunk, data: the counted chunks of all documents; the tokens and distinct words of the training documents.

    What the words were counted from is not kept.
    """
    spark = docs.sparkSession

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(batch["chunk"].to_pylist(), batch["data"].to_pylist(), strict=True)
        made = (m for chunk, data in rows for m in Chunk(data, buckets, settings).word_messages(chunk))
        return _messages(made).combine_chunks().to_batches()[0]

    def renumbered(key: tuple[pa.Scalar, ...], own: pa.Table, said: pa.Table) -> pa.Table:
        data = Chunk(own["data"][0].as_py(), buckets, settings).with_counts(_said(said).get(0, []))
        return pa.table([own["chunk"], pa.array([data], pa.binary())], ["chunk", "data"])

    with _ByChunk(spark, partitions) as hashed, _ByChunk(spark, partitions) as said, _ByChunk(spark, partitions) as table:
        plain = hashed.add(chunks(docs, settings.chunk_tokens, id_col, text_col))
        with _shuffles_removed(spark):
            answered = _answered(common.map_batches(plain, words, MESSAGES), 0, settings)
            answers = said.add(answered.repartition(partitions, "chunk"))
            total, distinct = answers.agg(F.sum("total"), F.sum("distinct")).first()
        answers = answers.select("chunk", "level", "bucket", "data")
        both = plain.groupBy("chunk").cogroup(answers.groupBy("chunk"))
        stored = table.add(both.applyInArrow(renumbered, "chunk long, data binary"))
        hashed.remove()
        said.remove()
    return stored, (total or 0, distinct or 0)


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    ``base_score``: log10 probability by single words; ``score``: by the suffix tree. A null or empty text is one end. Rows
    that share an id or a text are documents of their own, and count as often as they are there. If every document is held
    out, the root knows no word and the tree has no other state. The last depth is worked out when the result is read: store it
    where it is read more than once.
    """
    spark = docs.sparkSession
    settings, partitions = settings or Settings(), common.shuffle_partitions(spark)
    buckets = buckets or 2 * partitions
    stored, sums = _counted(docs, id_col, text_col, settings, buckets, partitions)

    def with_answers(answers: DataFrame | None, step, schema: str) -> DataFrame:
        if answers is None:
            return common.map_groups(stored, ["chunk"], lambda key, own: step(key, own, None), schema)
        own, said = stored.groupBy("chunk"), answers.select("chunk", "level", "bucket", "data").groupBy("chunk")
        return own.cogroup(said).applyInArrow(step, schema)

    def ask(level: int, answers: DataFrame | None) -> DataFrame:
        def pairs(key: tuple[pa.Scalar, ...], own: pa.Table, said: pa.Table | None) -> pa.Table:
            chunk, data = own["chunk"][0].as_py(), own["data"][0].as_py()
            state, entries = _restored(data, said, level, buckets, sums, settings)
            return _messages(state.pair_messages(entries, chunk))

        return with_answers(answers, pairs, MESSAGES)

    answers = None
    with _ByChunk(spark, partitions) as table:
        for level in range(1, settings.depth + 1):
            # Each answer moves to its chunk once, though all later depths read it; the last ones are read once and not stored.
            own = _answered(ask(level, answers), level, settings).repartition(partitions, "chunk")
            if level < settings.depth:
                with _shuffles_removed(spark):
                    answers = table.add(own)
            else:
                answers = own if answers is None else answers.unionByName(own)

    def finish(key: tuple[pa.Scalar, ...], own: pa.Table, said: pa.Table | None) -> pa.Table:
        state, _ = _restored(own["data"][0].as_py(), said, settings.depth + 1, buckets, sums, settings)
        docs_in = len(state.sizes)
        known = np.bincount(state.doc, weights=state.counts > 0, minlength=docs_in).astype(np.int64)
        base = np.bincount(state.doc, weights=state.base, minlength=docs_in)
        tree = np.bincount(state.doc, weights=state.log2p, minlength=docs_in) / np.log2(10)
        return pa.table(
            {
                "doc_id": pa.array(state.ids, pa.int64()),
                "held_out": pa.array(state.held),
                "n_tokens": pa.array(state.sizes),
                "n_known": pa.array(known),
                "train_tokens": pa.array([sums[0]] * docs_in, pa.int64()),
                "base_score": pa.array(base),
                "score": pa.array(tree),
            }
        )

    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return with_answers(answers, finish, kind)
