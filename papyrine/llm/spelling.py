"""Spelling variants: words one edit apart, found by walking a distributed trie, and the form each word is a variant of.

A trie is kept as a table of edges. States (word, position, node, edits) are joined with it level by level: a state without
an edit goes on along its own word, and at every node where another branch leaves it also takes that branch with one edit
spent (a letter replaced by a later one, or one inserted), if the letters after the edit are there; a state with one edit goes
on only where the branch reads as the rest of its word. A one-edit state that reaches the end of a word has found a neighbour.
Each pair is found by one of its words: by the one with the earlier letter, or by the shorter one.

Two words one edit apart share half of the shorter one at their beginning or at their end. So one walk starts in the middle
of each word of the trie, and one in the middle of each reversed word of the trie of reversed words; the crowded upper levels
are never entered. Chains of nodes without a branch are one edge, so that long words take no more levels than short ones.
A node is named by a hash of its prefix, and pairs are compared letter by letter at the end.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm import common
from papyrine.llm.common import store

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LETTERS = 5
MIN_COUNT = 3
#: One run in so many is damaged, by the contract of the query.
DAMAGE = 97
#: Distinct words that a task holds before it sends its counts on.
HELD_WORDS = 300_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def runs(doc_id: int | None, text: str, damage: int | None = DAMAGE) -> Iterator[tuple[str, int]]:
    """(word, count) of the runs of letters of a whole text, A-Z lower-cased.

    With ``damage``, the letter ``h % length`` of a run is left out if ``damage`` divides h, the crc32 of ``<doc_id>:<run>``
    (a null id: ``:<run>``).
    """
    found = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")))
    if damage is None:
        yield from found.items()
        return
    crc32, start = zlib.crc32, zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for (run, n), h in zip(found.items(), [crc32(r.encode(), start) for r in found], strict=True):
        if h % damage == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = DAMAGE) -> DataFrame:
    """word, n: the words of at least five letters that occur three times or more. Null texts have none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for word, n in runs(doc_id, text, damage):
                    if len(word) >= MIN_LETTERS:
                        held[word] = held.get(word, 0) + n
                if len(held) >= HELD_WORDS:
                    yield sent(held)
                    held = {}
        if held:
            yield sent(held)

    def sent(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    parts = common.map_partitions(common.texts(docs, id_col, text_col), count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def trie_paths(spelt: DataFrame) -> DataFrame:
    """key, depth, node, next: the nodes of every path from one letter before its middle on, and the letter after (-1: none).

    A node is named by a 64-bit hash of its prefix; the two tries (keys below 0 are reversed words) share no names.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        paths, keys = batch["path"].to_pylist(), np.asarray(batch["key"])
        letters = np.frombuffer("".join(paths).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.array([len(p) for p in paths], np.int64)
        begins = np.cumsum(lengths) - lengths
        mixed = (letters.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
        powers = np.cumprod(np.full(lengths.max(), 0x94D049BB133111EB, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers[np.arange(len(letters)) - np.repeat(begins, lengths)])])
        # One row per node from one letter before the middle to the end.
        cuts = (lengths - 1) // 2
        sizes = lengths + 1 - cuts
        row = np.repeat(np.arange(len(paths)), sizes)
        depth = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + cuts[row]
        at = begins[row] + depth
        name = sums[at] - sums[begins[row]] + (keys[row] < 0).astype(np.uint64)
        name = (name ^ (name >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + depth.astype(np.uint64)
        node = (name ^ (name >> np.uint64(32))).view(np.int64)
        after = np.where(depth < lengths[row], np.append(letters, -1)[at], -1)
        # The word itself stays behind: a long word would be sent once for each of its letters.
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[row]), pa.array(depth.astype(np.int32)), pa.array(node), pa.array(after.astype(np.int32))],
            ["key", "depth", "node", "next"],
        )

    return common.map_batches(spelt.select("key", "path"), step, "key long, depth int, node long, next int")


#: Letters that a branch must have after an edit for a state to take it. Results do not depend on it.
AHEAD = 2


def _slot(node: str, kind: str, letter: str) -> str:
    """SQL of the key under which an edge is found: by its first letter (kind F) or by the ``AHEAD`` letters after it (kind A)."""
    return f"xxhash64({node}, '{kind}', {letter})"


def trie(spelt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (slot, label, to, near_key, near, near_n) and starting states (key, word, n, pos, node) of the words ``key, path, n``.

    ``near`` is the word that ends with an edge, and null for edges to a further node. Only nodes where the words part are
    kept. An edge stands once under its first letter, and once under all letters that follow the first below it: a state
    that spends its edit on the first letter looks up only branches that read on as its word does.
    """
    paths = store(trie_paths(spelt), "trie_paths")
    parted = paths.groupBy("node").agg(F.min("next").alias("a"), F.max("next").alias("b")).filter("a <> b").select("node")
    kept = paths.join(parted, "node").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("nodes"))
    own = store(spelt.join(kept, "key"), "trie_words")
    steps = F.expr(
        """transform(nodes, (x, i) -> named_struct(
             'node', x.node, 'depth', x.depth, 'to', get(nodes, i + 1).node, 'stop', get(nodes, i + 1).depth))"""
    )
    slots = f"""if(e.depth < length(path),
          array({_slot('e.node', 'F', 'substring(path, e.depth + 1, 1)')}, {_slot('e.node', 'A', f'substring(path, e.depth + 2, {AHEAD})')}),
          array({_slot('e.node', 'F', "''")}))"""
    edges = own.select("key", "path", "n", F.explode(steps).alias("e")).select(
        F.explode(F.expr(slots)).alias("slot"),
        F.expr("substring(path, e.depth + 1, coalesce(e.stop, length(path)) - e.depth)").alias("label"),
        F.col("e.to").alias("to"),
        F.expr("if(e.to is null, key, null)").alias("near_key"),
        F.expr("if(e.to is null, path, null)").alias("near"),
        F.expr("if(e.to is null, n, null)").alias("near_n"),
    )
    first = F.expr("get(filter(nodes, x -> x.depth >= length(path) div 2), 0)")
    starts = own.select("key", F.col("path").alias("word"), "n", first.alias("s")).filter("s is not null")
    return store(edges.distinct(), "edges"), starts.select(
        "key", "word", "n", F.col("s.depth").alias("pos"), F.col("s.node").alias("node")
    )


def _probe(kind: str, letter: str, skip_label: int, skip_rest: int, edits: int) -> str:
    """SQL of one look-up of a state: an edge, and how many letters of its label and of the word the edit takes."""
    return f"""named_struct('slot', {_slot('node', kind, letter)}, 'skip_label', {skip_label},
                 'from', pos + {skip_rest}, 'edits', {edits})"""


#: What a state looks up at its node: its own branch; another branch for the next letter; another branch before it.
_NEXT = "substring(word, pos + 1, 1)"
_PROBES = f"""if(edits = 1, array({_probe('F', _NEXT, 0, 0, 1)}), array_compact(array(
    {_probe('F', _NEXT, 0, 0, 0)},
    if({_NEXT} <> '', {_probe('A', f'substring(word, pos + 2, {AHEAD})', 1, 1, 1)}, null),
    {_probe('A', f'substring(word, pos + 1, {AHEAD})', 1, 0, 1)})))"""
_PAIR = ["key", "word", "n", "near_key", "near", "near_n"]


def walk(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """key, word, n, near_key, near, near_n: pairs reached with one edit, by joining states with edges until no state is left."""
    found, states = [], store(starts.withColumn("edits", F.lit(0)), "states")
    label, rest, other = "substring(label, 1 + p.skip_label)", "substring(word, 1 + p.from)", "substring(label, 1, 1)"
    while not states.isEmpty():
        probes = states.select("key", "word", "n", "pos", F.explode(F.expr(_PROBES)).alias("p")).withColumn("slot", F.col("p.slot"))
        # An edit is spent at the first letter in which both words differ. Where a branch ends a word, both end.
        reads_on = F.expr(
            f"""(p.skip_label = 0 or if(p.from > pos, {other} > {_NEXT}, {other} <> {_NEXT}))
                and if(to is null, p.edits = 1 and {label} = {rest}, startswith({rest}, {label}))"""
        )
        reached = probes.join(edges, "slot").filter(reads_on).select(
            *_PAIR, "to", F.expr("cast(p.from + length(label) - p.skip_label as int)").alias("pos"), F.col("p.edits").alias("edits")
        )
        reached = store(reached, "reached")
        found.append(reached.filter("to is null").select(_PAIR))
        states = reached.filter("to is not null").select("key", "word", "n", "pos", F.col("to").alias("node"), "edits")
    out = found[0] if found else starts.select("key", "word", "n", *[F.col(c).alias(f"near_{c}") for c in ("key", "word", "n")]).limit(0).toDF(*_PAIR)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def neighbours(keyed: DataFrame) -> DataFrame:
    """key, n, near, near_n: every ordered pair of words of ``keyed`` (key from 0, word, n) that one edit parts, once.

    Words and reversed words (keys below 0) walk their two tries in the same joins. A pair that differs behind the middle of
    the word that finds it is found forwards; backwards it is left out.
    """
    both = keyed.select("key", F.col("word").alias("path"), "n").unionByName(
        keyed.select((-1 - F.col("key")).alias("key"), F.reverse("word").alias("path"), "n")
    )
    pairs = walk(*trie(both)).filter(
        """levenshtein(word, near, 1) = 1 and (key >= 0 or
           substring(reverse(word), 1, length(word) div 2) <> substring(reverse(near), 1, length(word) div 2))"""
    )
    own = "if(key < 0, -1 - key, key) as key", "if(key < 0, -1 - near_key, near_key) as near_key"
    spelt = "if(key < 0, reverse(word), word) as word", "if(key < 0, reverse(near), near) as near"
    pairs = pairs.selectExpr(*own, *spelt, "n", "near_n")
    ways = "struct(key, n, near, near_n)", "struct(near_key as key, near_n as n, word as near, n as near_n)"
    return pairs.selectExpr(f"inline(array({', '.join(ways)}))")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of the chain of forms (word, form) that starts at each word; chains are halved in every round."""
    chain = store(forms.select("word", F.col("form").alias("root")), "chain")
    while True:
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = store(chain.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"), "chain")
        if longer.filter("further is not null").isEmpty():
            return longer.select("word", "root")
        chain = longer.select("word", "root")


def variants(vocabulary: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of ``vocabulary`` (word, n; words distinct)."""
    keyed = store(vocabulary.select(F.monotonically_increasing_id().alias("key"), "word", "n"), "vocabulary")
    pairs = store(neighbours(keyed), "pairs")
    # Numbers first; only the near words of the wanted count are compared as strings.
    counted = pairs.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_near"), F.max(F.expr("if(near_n >= 2 * n, near_n, null)")).alias("form_n")
    )
    counted = store(counted, "counted")
    best = counted.filter("form_n is not null").select("key", F.col("form_n").alias("near_n"))
    forms = pairs.join(best, ["key", "near_n"]).groupBy("key").agg(F.min("near").alias("form"))
    named = store(
        keyed.join(counted, "key", "left")
        .join(forms, "key", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n"),
        "forms",
    )
    ends = roots(named.filter("form is not null"))
    return named.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = DAMAGE) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the corpus.

    Null and empty texts give no word, repeated rows count again, an empty table gives no row. Of near words of equal count the
    first in code-point order is the form.
    """
    return variants(words(docs, id_col, text_col, damage))
