"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of the tree hold the merge rank of each pair of neighbouring symbols, a node the minimum of its two children
together with its place. The root is the leftmost pair of lowest rank. A merge changes three leaves (the pair itself and
those on its two sides), each in a logarithmic number of steps. It ends when the root holds no rank.

``Encoder.encode_symbols`` is that loop for one word of any length. ``Encoder.encode_many`` is the same loop for many short
words at once: one tree per row of a matrix, all roots read and all paths updated together by numpy.
"""

from __future__ import annotations

import functools
import itertools
import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from papyrine.llm import common

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Words that a worker keeps encoded; then it starts afresh.
CACHE_WORDS = 1_200_000
#: Symbols of a word up to which words are merged together.
BATCH_SYMBOLS = 64
#: Symbols held in one matrix of trees.
MATRIX_SYMBOLS = 1 << 19
_NONE = np.iinfo(np.int64).max
#: No character above U+017F: normal form C is the identity there, and letters and digits are the same in all Unicode versions.
_UNUSUAL = regex.compile("[^\x00-ſ]")


class Encoder:
    """A byte-pair model of the tokenizers library read from its JSON file, for files that drop or keep white space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.library = tokenizers.Tokenizer.from_file(path)
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.special_at = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")")
        self.size = max(self.tokens) + 1
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        joined = [a + b for a, b in pairs]
        self.merged = np.array([self.vocab[t] for t in joined], np.int64)
        keys = left * self.size + right
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        characters = _byte_characters()
        self.first = np.array([self.vocab[c] for c in characters], np.int64)
        self.last = np.array([self.vocab[c + self.suffix] for c in characters], np.int64)
        self.patterns = _split_pattern(spec["pre_tokenizer"])
        self.lines_pattern = self.patterns and regex.compile(self.patterns.pattern + "|\n")
        self.lowers = spec["normalizer"] is not None

    def pieces(self, chunk: str) -> list[bytes]:
        """The byte strings that merges do not cross. ``chunk``: text without special strings."""
        if self.patterns is None or _UNUSUAL.search(chunk):
            if self.library.normalizer is not None:
                chunk = self.library.normalizer.normalize_str(chunk)
            return [from_characters(p) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]
        return [p.encode() for p in self.patterns.findall(chunk.lower() if self.lowers else chunk)]

    def symbols(self, piece: bytes) -> np.ndarray:
        raw = np.frombuffer(piece, np.uint8)
        out = self.first[raw]
        out[-1] = self.last[raw[-1]]
        return out

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs, ``_NONE`` where there is no merge."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NONE)

    def encode_symbols(self, symbols: list[int]) -> list[int]:
        """One word: a segment tree in a list, log(n) steps per changed pair."""
        n, size, rank_of, merged = len(symbols), self.size, self.rank_of, self.merged
        leaves = 1 << max(1, (n - 1).bit_length())
        none = (1 << 62, 0)
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            if (rank := rank_of.get(symbols[i] * size + symbols[i + 1])) is not None:
                tree[leaves + i] = (rank, i)
        for i in range(leaves - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, a: int, b: int) -> None:
            rank = rank_of.get(a * size + b) if a >= 0 and b >= 0 else None
            node = leaves + i
            tree[node] = none if rank is None else (rank, i)
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low

        symbols = [*symbols, -1]
        after, before = [*range(1, n + 1), n], [*range(-1, n)]
        while tree[1] is not none and tree[1] != none:
            rank, i = tree[1]
            gone = after[i]
            follower = after[gone]
            symbols[i], symbols[gone] = int(merged[rank]), -1
            after[i], before[follower] = follower, i
            put(gone, -1, -1)
            put(i, symbols[i], symbols[follower] if follower < n else -1)
            if before[i] >= 0:
                put(before[i], symbols[before[i]], symbols[i])
        return [s for s in symbols if s >= 0]

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece (little-endian, 32 bits); words of like length go through one matrix of trees."""
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for i in np.flatnonzero(lengths > BATCH_SYMBOLS):
            out[i] = np.array(self.encode_symbols(self.symbols(pieces[i]).tolist()), "<u4").tobytes()
        low = 0
        for width in (2, 4, 8, 16, 32, BATCH_SYMBOLS):
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            low, step = width, max(1, MATRIX_SYMBOLS // width)
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                ids, counts = self._merge_matrix([pieces[i] for i in part], lengths[part], width)
                raw, ends = ids.astype("<u4").tobytes(), 4 * np.cumsum(counts)
                for i, a, b in zip(part.tolist(), (ends - 4 * counts).tolist(), ends.tolist(), strict=True):
                    out[i] = raw[a:b]
        return out

    def _merge_matrix(self, words: list[bytes], lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        count, every = len(words), np.arange(len(words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(count, width)
        symbols = self.first[raw]
        symbols[every, lengths - 1] = self.last[raw[every, lengths - 1]]
        symbols[np.arange(width)[None, :] >= lengths[:, None]] = -1
        tree = np.full((count, 2 * width), _NONE, np.int64)
        ranks = self.lookup(symbols[:, :-1], symbols[:, 1:])
        ranks[symbols[:, 1:] < 0] = _NONE
        tree[:, width : 2 * width - 1] = np.where(ranks == _NONE, _NONE, ranks * width + np.arange(width - 1))
        level = width
        while level > 1:
            half = level >> 1
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        # Links hold places in a row; place ``width`` stands for the end, place 0 of ``before`` may be -1.
        after = np.tile(np.arange(1, width + 2, dtype=np.int64), (count, 1))
        after[:, width] = width
        before = np.tile(np.arange(-1, width, dtype=np.int64), (count, 1))
        symbols = np.concatenate([symbols, np.full((count, 1), -1)], axis=1)
        symbols_f, tree_f, after_f, before_f = symbols.ravel(), tree.ravel(), after.ravel(), before.ravel()
        wide, nodes, live = width + 1, 2 * width, every
        while len(live := live[tree_f[live * nodes + 1] != _NONE]):
            row, trees = live * wide, live * nodes
            rank, place = np.divmod(tree_f[trees + 1], width)
            gone = after_f[row + place]
            follower = after_f[row + gone]
            new = self.merged[rank]
            symbols_f[row + place], symbols_f[row + gone] = new, -1
            after_f[row + place], before_f[row + follower] = follower, place
            previous = before_f[row + place]
            head = np.maximum(previous, 0)
            next_symbol, head_symbol = symbols_f[row + follower], symbols_f[row + head]
            right = self.lookup(new, next_symbol)
            tree_f[trees + width + gone] = _NONE
            tree_f[trees + width + place] = np.where((right == _NONE) | (next_symbol < 0), _NONE, right * width + place)
            left = self.lookup(head_symbol, new)
            # Without a left neighbour the leaf of ``place`` itself is rewritten with its own value.
            tree_f[trees + width + head] = np.where(
                previous < 0,
                tree_f[trees + width + head],
                np.where(left == _NONE, _NONE, left * width + head),
            )
            touched = [width + gone, width + place, width + head]
            while int(touched[0][0]) > 1:
                touched = [t >> 1 for t in touched]
                for node in touched:
                    at = trees + 2 * node
                    tree_f[trees + node] = np.minimum(tree_f[at], tree_f[at + 1])
        kept = symbols[:, :width] >= 0
        return symbols[:, :width][kept], kept.sum(axis=1)

    def words(self, text: str) -> list[bytes]:
        """The words of a text for a file that drops white space; special strings are words of their own."""
        data = text.encode("utf-8", "surrogatepass")
        if "<|" in text and self.special_at.search(text):
            words: list[bytes] = []
            for part in self.special_at.split(text):
                words += [part.encode()] if part in self.special else part.encode().split()
            return words
        return data.split()

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word (little-endian, 32 bits); words hold no white space."""
        if not words:
            return []
        together = b"\n".join(words).decode()
        if self.patterns is None or _UNUSUAL.search(together) or self.special_at.search(together):
            of_special = {t.encode(): np.array([i], "<u4").tobytes() for t, i in self.special.items()}
            plain = [w for w in words if self.patterns and w not in of_special and not _UNUSUAL.search(w.decode())]
            found = dict(zip(plain, self._encode_lines(b"\n".join(plain).decode()), strict=True)) if plain else {}
            rest = {w: self.pieces(w.decode()) for w in words if w not in found and w not in of_special}
            distinct = list({p for own in rest.values() for p in own})
            ids = dict(zip(distinct, self.encode_many(distinct), strict=True))
            found |= of_special | {w: b"".join(map(ids.__getitem__, own)) for w, own in rest.items()}
            return [found[w] for w in words]
        return self._encode_lines(together)

    def _encode_lines(self, lines: str) -> list[bytes]:
        """The ids of each line of usual characters, all found in one pass of the pattern."""
        pieces = self.lines_pattern.findall(lines.lower() if self.lowers else lines)
        distinct = list(set(pieces) - {"\n"})
        ids = dict(zip(distinct, self.encode_many([p.encode() for p in distinct]), strict=True))
        ids["\n"] = b""  # no other piece is without ids
        parts = list(map(ids.__getitem__, pieces))
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        raw, ends = b"".join(parts), np.cumsum(lengths)
        cuts = [0, *ends[lengths == 0].tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def decode(self, ids: list[int]) -> str:
        """As the library's ``decode`` for a file without a decoder: the tokens, joined by one space."""
        return " ".join(map(self.tokens.__getitem__, ids))


class WordCache:
    """``table``: word -> ``make(ids)``; missing words are encoded together, memory is bounded by starting afresh."""

    def __init__(self, encoder: Encoder, make, limit: int = CACHE_WORDS):
        self.encoder, self.make, self.limit, self.table = encoder, make, limit, {}

    def fill(self, texts_words: list[list[bytes]]) -> None:
        """Afterwards every word of ``texts_words`` is a key."""
        if len(self.table) > self.limit:
            self.table.clear()
        # Nearly all words are known: only the others go through a set.
        missing = list(set(itertools.filterfalse(self.table.__contains__, itertools.chain.from_iterable(texts_words))))
        self.table.update(zip(missing, map(self.make, self.encoder.encode_words(missing)), strict=True))


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@functools.lru_cache(maxsize=4)
def _text_cache(path: str) -> WordCache:
    model = encoder(path)

    def make(raw: bytes) -> tuple[str, str, int]:
        ids = np.frombuffer(raw, "<u4").tolist()
        return " ".join(map(str, ids)), model.decode(ids), len(ids)

    return WordCache(model, make)


@functools.lru_cache(maxsize=4)
def bytes_cache(path: str) -> WordCache:
    """Word -> its ids as little-endian unsigned 32-bit integers."""
    return WordCache(encoder(path), bytes)


def groups(batch_texts: list[str], size: int = 4 << 20):
    """Runs of texts of about ``size`` characters together: what one filling of the cache sees is bounded."""
    run: list[str] = []
    total = 0
    for text in batch_texts:
        run.append(text)
        total += len(text)
        if total >= size:
            yield run
            run, total = [], 0
    if run:
        yield run


def encode_texts(batch_texts: list[str], path: str = WORD_BPE) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    cache, out = bytes_cache(path), []
    for run in groups(batch_texts):
        words = [cache.encoder.words(t) for t in run]
        cache.fill(words)
        out += [b"".join(map(cache.table.__getitem__, w)) for w in words]
    return out


def encode_decode(docs: DataFrame, path: str = WORD_BPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>), decoded: the ids of every whole text, and what they decode to.

    Nulls and empty texts give no ids and an empty string; rows stay rows, repeated ones too, null ids stay null. Words are
    encoded once per worker and kept in a bounded cache; special strings in the text give their own ids, as in the library.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.frombuffer(raw, "<u4").astype(np.int32) for raw in encode_texts(batch["text"].to_pylist(), path)]
        model = encoder(path)
        decoded = [model.decode(i.tolist()) for i in ids]
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
            ["doc_id", "ids", "decoded"],
        )

    return common.map_batches(common.texts(docs, id_col, text_col), step, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str = WORD_BPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what ``encode_decode`` gives, as digests and without its arrays."""
    import hashlib

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        cache = _text_cache(path)
        counts, ids_digest, decoded_digest = [], [], []
        for run in groups(batch["text"].to_pylist()):
            words = [cache.encoder.words(t) for t in run]
            cache.fill(words)
            for own in words:
                found = [x for x in map(cache.table.__getitem__, own) if x[2]]
                ids, decoded, n = zip(*found, strict=True) if found else ((), (), ())
                counts.append(sum(n))
                ids_digest.append(hashlib.sha256(" ".join(ids).encode()).hexdigest())
                decoded_digest.append(hashlib.sha256(" ".join(decoded).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(ids_digest), pa.array(decoded_digest)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return common.map_batches(common.texts(docs, id_col, text_col), step, schema)


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next free one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


_BYTE_OF = {c: b for b, c in enumerate(_byte_characters())}


def from_characters(piece: str) -> bytes:
    return bytes(map(_BYTE_OF.__getitem__, piece))


def as_text(pieces: list[bytes]) -> list[str]:
    return [p.decode() for p in pieces]


def _split_pattern(spec: dict) -> regex.Pattern | None:
    """The pattern whose matches are the pieces, where the file states one that is understood here."""
    parts = spec.get("pretokenizers", [spec])
    if len(parts) == 2 and parts[0]["type"] == "Split" and parts[0]["invert"] and parts[0]["behavior"] == "Removed":
        return regex.compile(parts[0]["pattern"]["Regex"])
    if len(parts) == 1 and parts[0]["type"] == "ByteLevel" and parts[0]["use_regex"]:
        return regex.compile(public_tokenizers.PATTERN)
    return None
