"""Repeated passages by longest-previous-factor arrays over suffixes in order.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier, in a document before it or further up in its
own. In suffix order the earlier start with the longest common prefix is the previous or the next suffix of smaller
position; LPF is the larger of the two common prefixes, and a string repeats an earlier one if its LPF is at least
``LENGTH``.

So that no task needs the suffixes of all texts, strings are dealt by content. Every string of ``LENGTH`` bytes has an
anchor, the place in it where a hash of ``GRAM`` bytes is smallest: equal strings have equal anchors. Strings whose
anchor's hash occurs only once cannot repeat and stay where they are. The others are sent, as the stretch of text that
holds all strings of one anchor, to the task of their hash, and are sorted there. Equal stretches within a task's input are
reduced to the earliest before they are sent, so a passage that a third of all documents share arrives once per task.
A hash met in very many different surroundings (a common line, the edge of a shared passage) would fill one task all the
same: its stretches are cut into their single strings, each dealt by a hash of all its bytes, so that only equal strings
meet, and those are reduced before they are sent.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm import common

LENGTH, GRAM = 100, 32
#: Bytes of text whose anchors are found together, anchors and stretches that a task holds before it sends them on.
CHUNK_BYTES, HELD_ANCHORS, HELD_BYTES = 1 << 21, 2_000_000, 48 << 20
#: Bytes of text per partition that partitions are made for, and strings sorted together.
PARTITION_BYTES, SORTED_STRINGS = 64 << 20, 100_000
_U = np.uint64
#: Different stretches around one hash from which it is dealt string by string; results do not depend on it.
HOT_STRETCHES = 10_000
#: Stands for a null id where texts are joined by id; it is the smallest.
_NULL_ID = -(2**63)
#: The bits of a text's hash that go with its id.
_PART = (1 << 32) - 1
#: Bit 62 of a span marks a hash known to repeat, and later on a hash of very many stretches.
_KNOWN = _HOT = 1 << 62


def _byte_hashes() -> np.ndarray:
    x = (np.arange(256, dtype=_U) + _U(1)) * _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_OF_BYTE = _byte_hashes()


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two) from every place on, by doubling."""
    out, length = _OF_BYTE[data], 1
    while length < gram:
        out = out[:-length] * _U(0xD6E8FEB86659FD93 + 2 * length) + (out[length:] ^ (out[length:] >> _U(29)))
        length *= 2
    out ^= out >> _U(32)
    out *= _U(0xD6E8FEB86659FD93)
    return out ^ (out >> _U(32))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in every window of ``width``, by doubling."""
    place, low, length = np.arange(len(values)), values, 1
    while length < width:
        step = min(length, width - length)
        left, right = low[: len(low) - step], low[step:]
        first = left <= right
        place = np.where(first, place[: len(place) - step], place[step:])
        low = np.where(first, left, right)
        length += step
    return place


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """All anchors of the texts: (hash, text, first string start, last string start, hash of their stretch in 32 bits).

    Starts are within the text.
    """
    rows = [i for i, t in enumerate(texts) if len(t) >= LENGTH]
    if not rows:
        return (np.empty(0, _U), *[np.empty(0, np.int64)] * 3, np.empty(0, np.uint32))
    lengths = np.array([len(texts[i]) for i in rows])
    ends = np.cumsum(lengths)
    begins = ends - lengths
    hashes = gram_hashes(np.frombuffer(b"".join(texts[i] for i in rows), np.uint8))
    place = window_minima(hashes, LENGTH - GRAM + 1)
    # String starts that lie in one text, as runs of one anchor each.
    of = np.repeat(np.arange(len(rows)), lengths)[: len(place)]
    inside = np.arange(len(place)) + LENGTH <= ends[of]
    starts = np.flatnonzero(inside)
    place, of = place[starts], of[starts]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (of[1:] != of[:-1])]))
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    of = of[first]
    around = _around(hashes, starts[first], starts[last] + LENGTH)
    return hashes[place[first]], np.array(rows)[of], starts[first] - begins[of], starts[last] - begins[of], around


def _around(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of each stretch, from those of the pieces of ``GRAM`` bytes that cover it."""
    out = (stop - start).astype(_U)
    for step in range(0, 2 * LENGTH - GRAM, GRAM):
        out = _mix(out, hashes[np.minimum(start + step, stop - GRAM)])
        out ^= out >> _U(32)
    return out.astype(np.uint32)


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= CHUNK_BYTES or i == len(texts) - 1:
            yield at, texts[at : i + 1]
            at, held = i + 1, 0


def find_anchors(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed hash, doc_id, part, span, meets, around, more: of each hash in this task's input one row meets those of other tasks,
    marked if the hash occurs again here, with the hash of its stretch and the number of further stretches here; the other
    rows are known to repeat."""
    held: list[tuple] = []
    count = 0
    for batch in batches:
        ids = batch["doc_id"].to_numpy(zero_copy_only=False)
        texts = [t.encode("utf-8", "surrogatepass") for t in batch["text"].to_pylist()]
        # As Spark's xxhash64 of the text.
        parts = np.array([xxhash.xxh64_intdigest(t, seed=42) & _PART for t in texts], np.uint32)
        for at, part in _chunks(texts):
            hashes, rows, first, last, around = anchors(part)
            held.append((hashes, ids[at + rows], parts[at + rows], (first << 8) | (last - first), around))
            count += len(hashes)
        if count >= HELD_ANCHORS:
            yield _one_of_each(held, buckets)
            held, count = [], 0
    if count:
        yield _one_of_each(held, buckets)


def _one_of_each(held: list[tuple], buckets: int) -> pa.RecordBatch:
    hashes, ids, parts, spans, around = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.lexsort((around, hashes))
    ordered, stretch = hashes[order], around[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    other = ~new & np.concatenate([[False], stretch[1:] != stretch[:-1]])
    more = np.zeros(len(hashes), np.int64)
    more[order[new]] = np.add.reduceat(other, np.flatnonzero(new), dtype=np.int64)
    meets, again = np.empty(len(hashes), bool), np.empty(len(hashes), bool)
    meets[order], again[order] = new, np.concatenate([~new[1:], [False]])
    goes = np.where(meets, hashes, _mix(hashes, np.arange(len(hashes)))) % _U(buckets)
    table = pa.table(
        {
            "hash": hashes.view(np.int64),
            "doc_id": ids,
            "part": parts,
            "span": np.where(~meets | again, spans | _KNOWN, spans),
            "meets": meets,
            "around": np.where(meets, around, 0).astype(np.uint32),
            "more": more,
        }
    )
    return common.packed(table, goes.astype(np.int64))


def _mix(hashes: np.ndarray, salt: np.ndarray) -> np.ndarray:
    return (hashes ^ (salt.astype(_U) * _U(0x9E3779B97F4A7C15))) * _U(0xBF58476D1CE4E5B9)


def repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """hash, doc_id, part, span of the anchors whose hash occurs more than once, and in those that met the number of its different
    stretches (others: 0). All rows of a hash that meet are in one partition."""
    table = common.unpacked(batches)
    if table is None:
        return
    names = ("hash", "around", "doc_id", "part", "span", "meets", "more")
    hashes, around, ids, parts, spans, meets, more = (table[n].to_numpy() for n in names)
    order = np.lexsort((around, ~meets, hashes))
    hashes, around, ids, parts, spans, meets, more = (c[order] for c in (hashes, around, ids, parts, spans, meets, more))
    own = np.cumsum(np.concatenate([[True], hashes[1:] != hashes[:-1]])) - 1
    met, known = np.bincount(own, meets), np.bincount(own, meets & (spans >= _KNOWN))
    keep = ~meets | (met[own] > 1) | (known[own] > 0)
    new = np.concatenate([[True], (own[1:] != own[:-1]) | (around[1:] != around[:-1])])
    stretches = np.where(meets, np.bincount(own, meets * (new + more))[own], 0).astype(np.int64)
    columns = (hashes[keep], ids[keep], parts[keep].astype(np.int64), spans[keep] & (_KNOWN - 1), stretches[keep])
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hash", "doc_id", "part", "span", "stretches"])


_STRETCH = pa.schema(
    [
        ("hash", pa.int64()),
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("start", pa.int64()),
        ("stretch", pa.binary()),
        ("stop", pa.int64()),
    ]
)


def _stretch_rows(rows: list[tuple], buckets: int) -> pa.RecordBatch:
    table = pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _STRETCH, strict=True)], _STRETCH)
    return common.packed(table, (table["hash"].to_numpy().view(_U) % _U(buckets)).astype(np.int64))


def cut_stretches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The stretches to be sorted (earliest of equal ones), and runs already known to be later copies (no stretch)."""
    held: dict[tuple[int, bytes], tuple] = {}
    later: dict[tuple[int, int], list[tuple[int, int]]] = {}
    size = 0
    for batch in batches:
        names = ("doc_id", "text_hash", "text", "hashes", "spans")
        for doc_id, text_hash, text, hashes, spans in zip(*[batch[n].to_pylist() for n in names], strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for gram, start, stop in _pieces(data, hashes, spans):
                key, own = (gram, data[start:stop]), (doc_id, text_hash, start)
                first = held.setdefault(key, own)
                if first == own:
                    size += stop - start
                elif first < own:
                    later.setdefault(own[:2], []).append((start, stop))
                elif own < first:
                    held[key] = own
                    later.setdefault(first[:2], []).append((first[2], first[2] + stop - start))
                size += 100
        if size >= HELD_BYTES:
            yield _stretch_rows(list(_send(held, later)), buckets)
            held, later, size = {}, {}, 0
    if held or later:
        yield _stretch_rows(list(_send(held, later)), buckets)


def _pieces(data: bytes, hashes: list[int], spans: list[int]) -> Iterator[tuple[int, int, int]]:
    """The hash that each stretch goes by, its start and stop; of hot hashes the single strings by hashes of their own."""
    for gram, span in zip(hashes, spans, strict=True):
        start = (span & (_HOT - 1)) >> 8
        stop = start + (span & 255) + LENGTH
        if stop > len(data):
            continue  # of another row with this id and part
        if span & _HOT:
            for at in range(start, stop - LENGTH + 1):
                yield xxhash.xxh64_intdigest(data[at : at + LENGTH]) - (1 << 63), at, at + LENGTH
        else:
            yield gram, start, stop


def _send(held: dict, later: dict) -> Iterator[tuple]:
    for (gram, stretch), (doc_id, text_hash, start) in held.items():
        yield gram, doc_id, text_hash, start, stretch, None
    for (doc_id, text_hash), runs in later.items():
        for start, stop in merged_runs(runs):
            # Meets nothing: spread by itself.
            yield text_hash ^ (start & 0xFFFFFFFF), doc_id, text_hash, start, None, stop


def longest_previous(places: list[int], common_prefix: list[int]) -> list[int]:
    """LPF of each suffix. ``places``: positions in suffix order; ``common_prefix[i]``: of suffixes ``i - 1`` and ``i``.

    Taken from the last position to the first, the neighbours still in the list are the previous and the next smaller
    position in suffix order; the common prefix with each is carried along as the smallest met on the way.
    """
    n = len(places)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    prefix = [*common_prefix, 0]
    out = [0] * n
    for i in sorted(range(n), key=places.__getitem__, reverse=True):
        left, right = before[i], after[i]
        to_left, to_right = prefix[i], prefix[right]
        out[i] = max(to_left, to_right)
        prefix[right] = min(to_left, to_right)
        if left >= 0:
            after[left] = right
        if right < n:
            before[right] = left
    return out


def later_strings(stretches: list[bytes], starts: np.ndarray) -> list[np.ndarray]:
    """Of each stretch, which of its strings repeat a string of smaller position. ``starts``: position of each first string."""
    counts = np.array([len(s) - LENGTH + 1 for s in stretches])
    ends = np.cumsum(counts)
    data = np.frombuffer(b"".join(stretches) + bytes(4), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in stretches])[:-1]])
    within = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
    places = np.repeat(starts, counts) + within
    # A string that two stretches hold is one suffix.
    places, once, which = np.unique(places, return_index=True, return_inverse=True)
    strings = np.lib.stride_tricks.sliding_window_view(data, LENGTH + 4)[(np.repeat(offsets, counts) + within)[once]].copy()
    strings[:, LENGTH:] = 0
    words = strings.view(">u8")
    order = np.lexsort([words[:, i] for i in range(words.shape[1] - 1, -1, -1)])
    ordered = strings[order, :LENGTH]
    differ = ordered[1:] != ordered[:-1]
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)
    longest = longest_previous(places[order].tolist(), [0, *prefix.tolist()])
    repeats = np.empty(len(places), bool)
    repeats[order] = np.array(longest) >= LENGTH
    return np.split(repeats[which.ravel()], ends[:-1])


def sort_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_hash, start, stop: runs covered by strings that start earlier. All stretches of a hash are here."""
    table = common.unpacked(batches)
    if table is None:
        return
    grams, ids, text_hashes, starts, stretches, stops = (c.to_pylist() for c in table.columns)
    runs = [(ids[i], text_hashes[i], starts[i], stops[i]) for i in range(len(grams)) if stretches[i] is None]
    order = sorted(
        (i for i in range(len(grams)) if stretches[i] is not None),
        key=lambda i: (grams[i], stretches[i], ids[i], text_hashes[i], starts[i]),
    )
    # Equal stretches are one entry: the earliest stands for them, the others are later copies as a whole.
    groups: list[list[int]] = []
    for k, i in enumerate(order):
        j = order[k - 1] if k else -1
        if k and grams[i] == grams[j] and stretches[i] == stretches[j]:
            first = groups[-1][-1]
            if (ids[i], text_hashes[i], starts[i]) != (ids[first], text_hashes[first], starts[first]):
                runs.append((ids[i], text_hashes[i], starts[i], starts[i] + len(stretches[i])))
        elif k and grams[i] == grams[j]:
            groups[-1].append(i)
        else:
            groups.append([i])
    held: list[int] = []
    strings = 0
    for group in [*(g for g in groups if len(g) > 1), None]:
        if held and (group is None or strings >= SORTED_STRINGS):
            runs += _runs(held, ids, text_hashes, starts, stretches)
            held, strings = [], 0
        if group:
            held += group
            strings += sum(len(stretches[i]) - LENGTH + 1 for i in group)
    of_doc: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for doc_id, text_hash, start, stop in runs:
        of_doc.setdefault((doc_id, text_hash), []).append((start, stop))
    merged = [(*key, *run) for key, own in of_doc.items() for run in merged_runs(own)]
    if merged:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*merged, strict=True)], ["doc_id", "text_hash", "start", "stop"]
        )


def _runs(held: list[int], ids: list, text_hashes: list, starts: list, stretches: list) -> Iterator[tuple]:
    # Positions in one number: the documents at hand, in order, with room for their offsets.
    docs = {d: n for n, d in enumerate(sorted({(ids[i], text_hashes[i]) for i in held}))}
    room = max(starts[i] + len(stretches[i]) for i in held) + 1
    first = np.array([docs[ids[i], text_hashes[i]] * room + starts[i] for i in held], np.int64)
    for i, repeats in zip(held, later_strings([stretches[i] for i in held], first), strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], repeats, [False]]).astype(np.int8)))
        for a, b in edges.reshape(-1, 2).tolist():
            yield ids[i], text_hashes[i], starts[i] + a, starts[i] + b - 1 + LENGTH


def merged_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs; runs that touch are one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def removals(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rest: list[str] | None = None,
    hot_stretches: int = HOT_STRETCHES,
) -> DataFrame:
    """doc_id, text, rest (struct of the columns named there), runs (array of start, stop): for every row the bytes to go.

    Nulls are empty; texts shorter than ``LENGTH`` lose nothing. Rows that share an id are ordered by a hash of their
    text, a null id comes first; repeated rows (id and text) are one document and lose the same. Texts are shuffled once,
    by id and ``part`` (32 bits of the hash of the text, so that no id gathers the anchors of many texts): both joins read the
    same exchange, which is why each of them asks for the same columns.
    """
    spark = docs.sparkSession
    others = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("int")
    plain = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NULL_ID)).alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        others.alias("rest"),
    ).withColumn("part", F.xxhash64("text").bitwiseAND(F.lit(_PART)))
    size = plain.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(common.shuffle_partitions(spark), -(-size // PARTITION_BYTES))
    buckets = parts * common.BUCKETS_PER_PARTITION
    found = common.map_partitions(
        plain.select("doc_id", "text"), functools.partial(find_anchors, buckets=buckets), common.PACKED
    )
    again = common.map_partitions(
        found.repartition(parts, "bucket"), repeated_anchors, "hash long, doc_id long, part long, span long, stretches long"
    )
    again = common.store(again, "anchors")
    hot = common.store(again.filter(F.col("stretches") > hot_stretches).select("hash").distinct(), "hot")
    marked = F.when(F.col("hot"), F.col("span").bitwiseOR(F.lit(_HOT))).otherwise(F.col("span"))
    again = again.join(common.broadcast_if_bytes(hot).withColumn("hot", F.lit(True)), "hash", "left").select(
        "hash", "doc_id", "part", marked.alias("span")
    )
    # One row per document, no longer than its text: equal rows have the same anchors.
    key = ["doc_id", "part"]
    wanted = again.groupBy(*key).agg(F.collect_set(F.struct("hash", "span")).alias("found"))
    by_id = plain.repartition(parts, *key)
    suspects = by_id.join(wanted, key).select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        "text",
        F.col("found.hash").alias("hashes"),
        F.col("found.span").alias("spans"),
        "rest",
    )
    stretches = common.map_partitions(suspects, functools.partial(cut_stretches, buckets=buckets), common.PACKED)
    runs = common.map_partitions(
        stretches.repartition(parts, "bucket"), sort_stretches, "doc_id long, text_hash long, start long, stop long"
    )
    runs = runs.withColumn("part", F.col("text_hash").bitwiseAND(F.lit(_PART)))
    of_doc = runs.groupBy(*key).agg(F.collect_set(F.struct("text_hash", "start", "stop")).alias("runs"))
    mine = F.filter("runs", lambda r: r["text_hash"] == F.xxhash64("text"))
    return by_id.join(of_doc, key, "left").select(
        F.nullif("doc_id", F.lit(_NULL_ID)).alias("doc_id"),
        "text",
        "rest",
        F.transform(mine, lambda r: F.struct(r["start"].alias("start"), r["stop"].alias("stop"))).alias("runs"),
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later copies of passages cut out of the text; a character cut through goes as a whole."""
    rest = [c for c in docs.columns if c != text_col]
    kind = removals(docs, id_col, text_col, rest).schema["rest"].dataType.simpleString() if rest else "int"

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        left = [
            _kept(text, runs)[1].decode(errors="ignore") if runs else text
            for text, runs in zip(batch["text"].to_pylist(), batch["runs"].to_pylist(), strict=True)
        ]
        return pa.RecordBatch.from_arrays([batch["rest"], pa.array(left, pa.string())], ["rest", "left"])

    found = removals(docs, id_col, text_col, rest).select("text", "runs", "rest")
    cut = common.map_batches(found, step, f"rest {kind}, left string")
    return cut.select(*[F.col("left").alias(c) if c == text_col else F.col(f"rest.`{c}`") for c in docs.columns])


def _kept(text: str, runs: list[dict] | None) -> tuple[bytes, bytes, list[tuple[int, int]]]:
    data = text.encode("utf-8", "surrogatepass")
    spans = merged_runs([(r["start"], r["stop"]) for r in runs or []])
    edges = [0, *(edge for span in spans for edge in span), len(data)]
    return data, b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), spans


def digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_stretches: int = HOT_STRETCHES
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text, runs in zip(*[batch[n].to_pylist() for n in ("doc_id", "text", "runs")], strict=True):
            data, left, spans = _kept(text, runs)
            rows.append((doc_id, len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest()))
        kinds = [*[pa.int64()] * 4, pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    found = removals(docs, id_col, text_col, hot_stretches=hot_stretches).select("doc_id", "text", "runs")
    return common.map_batches(found, step, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
