"""What the operators must give, by plain loops over small tables, and a table of awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def awkward_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, copies, near copies, shared passages."""
    rng = random.Random(5)
    words = ["the", "of", "Größe", "élève", "rain", "Stone", "river", "x", "ßa", "don't", "12", "日本語", "end."]

    def prose(n: int) -> str:
        return " ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(n))

    passage, base = prose(60), prose(150)
    rows = [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, "   \n\t ", "en", "a"),
        (None, "a text without an id " + passage, "en", None),
        (None, "a text without an id " + passage, "en", None),
        (4, base, "en", "a"),
        (5, base, "en", "b"),
        (5, base, "en", "b"),
        (5, "another text with the same id " + passage, "en", "b"),
        (6, base.replace(" ", "  ", 3), "en", "c"),
        (7, " ".join([*base.split()[:-1], "changed"]), "en", "c"),
        (8, prose(20) + "\n" + passage + "\n" + prose(30), "de", "c"),
        (9, passage + " " + passage, "de", "c"),
        (10, "a" * 700, "de", "d"),
        (11, "ab" * 333 + " " + "a" * 150, "de", "d"),
        (12, prose(3000), "fr", "d"),
        (13, " ".join(["same line of words"] * 80), "fr", "d"),
        (14, "\n".join(["same line of words"] * 80), "fr", "d"),
        (15, "<|endoftext|> and <|startoftext|>the end<|endoftext|>", "fr", "e"),
        (16, "tab\there\x1cand there　wide   spaces İΣ́", "fr", "e"),
        (17, "Released under the MIT License.\n\n" + prose(30), "fr", "e"),
        (18, "# * $ % & | < > " * 30, "fr", "e"),
        (19, "one", "fr", "e"),
        (20, "ONE", "fr", "e"),
    ]
    rows += [(100 + i, prose(rng.randrange(1, 120)), "en", "a") for i in range(60)]
    rows += [(200 + i, base + " tail " + str(i), "en", "a") for i in range(25)]
    rng.shuffle(rows)
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


def raw(text: str | None) -> bytes:
    return (text or "").encode()


def removed(rows: list[tuple[int | None, str | None]], length: int = 100) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row; ids unique."""
    first: dict[bytes, tuple] = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    out = []
    for i in order:
        data = raw(rows[i][1])
        gone = np.zeros(len(data) + 1, bool)
        for start in range(len(data) - length + 1):
            string = data[start : start + length]
            if first.setdefault(string, (i, start)) != (i, start):
                gone[start : start + length] = True
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
        left = np.frombuffer(data, np.uint8)[~gone[:-1]].tobytes()
        out.append((rows[i][0], len(data), len(data) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return out


def simhash(text: str | None) -> int:
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw(text)))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(prints: list[tuple[int | None, int]], radius: int = 4) -> list[int | None]:
    """Smallest id reachable for each row, by all pairs."""
    distinct = np.array(sorted({p for _, p in prints}), np.uint64)
    label = np.arange(len(distinct))
    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(distinct ^ distinct[i]) <= radius):
            a, b = label[i], label[j]
            if a != b:
                label[label == max(a, b)] = min(a, b)
    of = dict(zip(distinct.tolist(), label.tolist(), strict=True))
    least: dict[int, int] = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[of[p]] = min(doc_id, least.get(of[p], doc_id))
    return [least.get(of[p]) for _, p in prints]


def crc(data: bytes) -> int:
    return zlib.crc32(data)
