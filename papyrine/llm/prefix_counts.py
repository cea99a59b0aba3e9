"""Exact token counts at every prefix of a text, by dynamic programming over the tokens that may end there.

The encoding of a prefix is the encoding of a shorter prefix plus one token, and a row of tokens is what the merges give
exactly if each two neighbours are. So the last token of each prefix is the one token ending there that may follow the last
token of the prefix before it, and its count is one more. Whether two tokens may be neighbours is decided on their merge
histories along the border. With the counts stored, the length of a truncated text and the longest prefix within a budget
are look-ups.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm import bpe, common

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: The limit that ``over_limit`` compares with.
TOKEN_LIMIT = 1024
#: Entries that a worker keeps of chunks and of token pairs; then it starts afresh.
CACHE_CHUNKS, CACHE_PAIRS = 500_000, 1_000_000
#: A space with white space on both sides: only there do pieces depend on what lies beyond the space before a word.
_DEPENDENT = re.compile(r"\s \s")
_NEVER = 1 << 40


class PrefixCounter:
    """Token counts for a byte-level model without end-of-word marks."""

    def __init__(self, path: str):
        self.encoder = model = bpe.encoder(path)
        self.path = path
        to_bytes = bpe.from_characters
        self.text_of = {i: to_bytes(t) for t, i in model.vocab.items()}
        # Tokens that the merges make of their own bytes; no other token is ever in an encoding.
        made = model.encode_many(list(self.text_of.values()))
        self.id_of = {
            raw: i for (i, raw), ids in zip(self.text_of.items(), made, strict=True) if ids == i.to_bytes(4, "little")
        }
        self.longest = max(map(len, self.id_of))
        self.parts: dict[int, tuple[int, int, int]] = {}
        for key, rank in model.rank_of.items():
            left, right = divmod(key, model.size)
            self.parts[int(model.merged[rank])] = (left, right, rank)
        self.pairs: dict[int, bool] = {}
        self.chunks: dict[str, int] = {}

    @functools.cached_property
    def history(self) -> tuple[dict, dict]:
        """Of each token: its last symbols and its first symbols over time, each with the rank that absorbs it."""

        def edge(token: int, side: int) -> list[tuple[int, int]]:
            out = [(token, _NEVER)]
            while (parts := self.parts.get(out[-1][0])) is not None:
                out.append((parts[side], parts[2]))
            return out[::-1]

        return {t: edge(t, 1) for t in self.text_of}, {t: edge(t, 0) for t in self.text_of}

    def neighbours(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border between two tokens before both are complete."""
        key = left * self.encoder.size + right
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._neighbours(left, right)
        return known

    def _neighbours(self, left: int, right: int) -> bool:
        lasts, firsts = self.history[0][left], self.history[1][right]
        size, rank_of, i, j = self.encoder.size, self.encoder.rank_of, 0, 0
        while True:
            (a, until_a), (b, until_b) = lasts[i], firsts[j]
            crossing = rank_of.get(a * size + b, _NEVER)
            # Of equal ranks the leftmost pair merges first.
            if crossing < until_a and crossing <= until_b and crossing < _NEVER:
                return False
            if until_a == until_b == _NEVER:
                return True
            if until_a <= until_b:
                i += 1
            else:
                j += 1

    def piece_counts(self, piece: bytes) -> list[int]:
        """Token count of every prefix of a piece, the empty one first."""
        counts, last = [0], [-1]
        get, longest = self.id_of.get, self.longest
        for end in range(1, len(piece) + 1):
            for start in range(max(0, end - longest), end):
                token = get(piece[start:end])
                if token is not None and (start == 0 or self.neighbours(last[start], token)):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        return counts

    def chunk_count(self, chunk: str) -> int:
        pieces = self.encoder.pieces(chunk)
        return sum(1 if p in self.id_of else self.piece_counts(p)[-1] for p in pieces)

    def count(self, text: str) -> int:
        """Tokens of a whole text; chunks (a word with the space before it) are counted once per worker."""
        if "<|" in text and self.encoder.special_at.search(text):
            special = self.encoder.special
            return sum(1 if p in special else self.count(p) for p in self.encoder.special_at.split(text))
        if not text:
            return 0
        if len(self.chunks) > CACHE_CHUNKS:
            self.chunks.clear()
        if _DEPENDENT.search(text):
            chunks = bpe.as_text(self.encoder.pieces(text))
        else:
            first, *rest = text.split(" ")
            chunks = [first, *[" " + c for c in rest]]
        known = self.chunks
        for chunk in set(chunks).difference(known):
            known[chunk] = self.chunk_count(chunk)
        return sum(map(known.__getitem__, chunks))

    def prefix_counts(self, text: str) -> np.ndarray:
        """Token count of every prefix of ``text`` in bytes, the empty one first.

        Counts at places inside a character are those of the bytes so far; all others are what the library gives for
        the prefix as a text of its own: a trailing run of white space is one piece, an unfinished contraction two.
        """
        parts = self.encoder.special_at.split(text)
        out, done = [np.zeros(1, np.int64)], 0
        for ordinary, special in zip(parts[::2], [*parts[1::2], ""], strict=True):
            # Unfinished, a special string is ordinary text that goes on from what stands before it.
            counts = self._ordinary_counts(ordinary + special)
            if special:
                counts[-1] = counts[len(ordinary.encode())] + 1
            out.append(done + counts[1:])
            done += int(counts[-1])
        return np.concatenate(out)

    def _ordinary_counts(self, text: str) -> np.ndarray:
        out, done, run, run_at = [0], 0, b"", 0
        for piece in self.encoder.pieces(text):
            counts = self.piece_counts(piece)
            blank = not piece.decode(errors="replace").strip() if piece[:1].isspace() or piece[0] > 127 else False
            if blank:
                # Until a word follows, all white space so far is one piece.
                if not run:
                    run_at = done
                run += piece
                ends = self.piece_counts(run)
                out += [run_at + c for c in ends[len(run) - len(piece) + 1 :]]
                whole = done + counts[-1]
            else:
                own = [done + c for c in counts[1:]]
                if run and piece[:1] == b" ":
                    own[0] = run_at + self.piece_counts(run + b" ")[-1]
                if len(piece) == 3 and piece in (b"'re", b"'ve", b"'ll"):
                    own[1] = done + 2
                out += own
                run, whole = b"", done + counts[-1]
            done = whole
        return np.array(out, np.int64)

    def truncate(self, text: str, budget: int, counts: np.ndarray | None = None) -> str:
        """The longest prefix of whole characters with at most ``budget`` tokens."""
        counts = self.prefix_counts(text) if counts is None else counts
        raw = text.encode()
        fitting = np.flatnonzero(counts <= budget)[::-1]
        return next(raw[:i].decode() for i in fitting.tolist() if i == len(raw) or raw[i] & 0xC0 != 0x80)


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(
    docs: DataFrame, limit: int = TOKEN_LIMIT, path: str = BYTE_BPE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text.

    Nulls and empty texts have no bytes and no tokens; rows stay rows, repeated ones too, null ids stay null.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(path)
        found = batch["text"].to_pylist()
        counts = [own.count(t) for t in found]
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array([len(t.encode()) for t in found], pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array([n > limit for n in counts], pa.bool_()),
            ],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return common.map_batches(common.texts(docs, id_col, text_col), step, schema)


def prefix_table(docs: DataFrame, path: str = BYTE_BPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, counts (array<int>): element k is the token count of the first k characters. To be stored, for questions
    about truncation and budgets. Null texts are empty, with the count 0 of the empty prefix; rows stay rows."""

    def at_characters(text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        ends = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))
        return counter(path).prefix_counts(text)[ends].astype(np.int32)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = pa.array([at_characters(t) for t in batch["text"].to_pylist()], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"], counts], ["doc_id", "text", "counts"])

    return common.map_batches(common.texts(docs, id_col, text_col), step, "doc_id long, text string, counts array<int>")


def truncated(stored: DataFrame, budget: int) -> DataFrame:
    """doc_id, text, n_tokens: the longest prefix of whole characters within ``budget`` tokens, and its tokens.

    Read off the counts of a stored ``prefix_table``; nothing is encoded again. Budgets below zero leave no row.
    """
    # Counts may fall again where a merge ends, so the last prefix within the budget is looked for.
    last = F.expr(f"size(counts) - array_position(transform(reverse(counts), c -> c <= {int(budget)}), true)")
    own = stored.filter(F.lit(budget >= 0)).select("doc_id", "text", "counts", last.cast("int").alias("last"))
    return own.select(
        "doc_id", F.expr("substring(text, 1, last)").alias("text"), F.expr("get(counts, last)").cast("long").alias("n_tokens")
    )


def prefix_tokens(stored: DataFrame, chars: int) -> DataFrame:
    """doc_id, n_tokens: the tokens of the first ``chars`` characters of every text (of all of it, if it is shorter)."""
    at = F.least(F.lit(max(0, chars)), F.size("counts") - 1)
    return stored.select("doc_id", F.get("counts", at).cast("long").alias("n_tokens"))
