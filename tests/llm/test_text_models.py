"""Spelling variants, language-model scores and ranked search against plain loops."""

import collections
import math
import pathlib
import random
import re
import time
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from papyrine.llm import ranking, spelling, suffix_tree
from papyrine.session import shared_folder


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def key(row):
    return tuple((x is not None, x) for x in row)


def plain_variants(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lowered(text)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        p = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        return a[p + 1 :] == b[p + 1 :] or a[p + 1 :] == b[p:] or a[p:] == b[p + 1 :]

    by_size = collections.defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    mates = {w: [x for k in (-1, 0, 1) for x in by_size[len(w) + k] if near(w, x)] for w in words}
    form = {}
    for w, found in mates.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n, len(mates[w]), words.get(form.get(w))) for w, n in words.items()), key=key)


def test_variants(docs, rows):
    found = sorted((tuple(r) for r in spelling.spelling_variants(docs).collect()), key=key)
    assert found == plain_variants([r[:2] for r in rows])


def test_variants_of_dense_words(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abÀ÷") for _ in range(rng.randrange(4, 9))) for _ in range(150)]
    words += ["a" * n for n in range(5, 30)] + ["a" * 400 + "b" + "c" * 300, "a" * 400 + "c" * 300, "stone", "stones", "sstone"]
    words += ["planet", "planett", "plannett"]
    weights = [2 ** (i % 8) for i in range(len(words) - 3)] + [900, 200, 40]
    rows = [(i, " ".join(rng.choices(words, weights, k=90))) for i in range(80)]
    rows += [(None, "STONE stone-stone's"), (900, "a" * 400 + "b" + "c" * 300), (901, "a" * 400 + "c" * 300)] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in spelling.spelling_variants(frame).collect()), key=key)
    wanted = plain_variants(rows)
    assert found == wanted and any(w[4] > 1 for w in wanted) and any(w[2] not in (w[0], w[1]) for w in wanted)


def plain_scores(rows, settings):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base, score) by plain counting."""
    texts = [(i, [w.decode() for w in brute.WORD.findall(lowered(t).encode())] + [None]) for i, t in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in texts]
    words, pairs = collections.Counter(), collections.defaultdict(collections.Counter)
    for (_, own), out in zip(texts, held, strict=True):
        for at, word in enumerate(own):
            if not out:
                words[word] += 1
                for n in range(1, settings.depth + 1):
                    if at >= n:
                        pairs[tuple(own[at - n : at])][word] += 1
    total, distinct, kept = sum(words.values()), len(words), {}

    def probability(context, word):
        if not context:
            return (words[word] + 1) / (total + distinct + 1)
        parent = probability(context[1:], word)
        if context not in kept:
            kept[context] = state(context)
        if not kept[context]:
            return parent
        c, n = pairs[context][word], sum(pairs[context].values())
        return ((c - settings.discount) / n if c >= 2 else 0) + kept[context] * parent

    def state(context):
        """The mass left to the parent, 0 where the context is no state."""
        own = pairs.get(context, {})
        n = sum(own.values())
        often = {w: c for w, c in own.items() if c >= 2}
        if n < settings.min_context or not often or not tried(context):
            return 0
        rest = 1 - sum(c - settings.discount for c in often.values()) / n
        gain = sum(c * (math.log2((c - 1) / n) + np.clip(np.rint(-4 * np.log2(probability(context[1:], w))), 0, 255) / 4) for w, c in often.items())
        return rest if gain + (n - sum(often.values())) * math.log2(rest) >= settings.min_gain else 0

    def tried(context):
        """Every start of a context must have led on to its next word."""
        return all(
            math.log2(probability(context[:k], context[k])) - math.log2(probability((), context[k])) >= settings.min_lift
            and pairs[context[:k]][context[k]] >= settings.min_context
            for k in range(1, len(context))
        )

    out = []
    for (i, own), h in zip(texts, held, strict=True):
        base = sum(math.log10(probability((), w)) for w in own)
        score = sum(math.log10(probability(tuple(own[max(0, at - settings.depth) : at]), w)) for at, w in enumerate(own))
        out.append((i, h, len(own), sum(words[w] > 0 for w in own), total, base, score))
    states = [c for c, r in kept.items() if r]
    for context in states[:20]:
        mass = sum(probability(context, w) for w in words) + 1 / (total + distinct + 1) * math.prod(kept.get(context[k:], 0) or 1 for k in range(len(context)))
        assert math.isclose(mass, 1, rel_tol=1e-9)
    return out, states


@pytest.mark.parametrize("settings", [
    suffix_tree.Settings(),
    suffix_tree.Settings(chunk_tokens=300, split_context=7),
    suffix_tree.Settings(depth=4, chunk_tokens=2000, min_context=2, min_gain=1.0, min_lift=0.5),
])
def test_suffix_tree(docs, rows, settings):
    wanted, states = plain_scores([r[:2] for r in rows], settings)
    assert {len(s) for s in states} >= {1, 2}
    found = suffix_tree.score(docs, settings=settings, buckets=5).collect()
    assert len(found) == len(rows)
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(wanted, key=key), strict=True):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-7, abs_tol=1e-9)
    # Copies of training texts are likelier by far than single words say.
    gain = [b[6] - b[5] for b in wanted if b[0] is not None and 200 <= b[0] < 225]
    assert min(gain) > 10


def test_suffix_tree_tries_every_frequent_context(spark):
    """``a b`` is no likelier than ``b`` alone, but decides what follows."""
    rows = [(i, "a b x" if i % 2 else "c b y") for i in range(80)]
    wanted, states = plain_scores(rows, suffix_tree.Settings())
    assert ("a", "b") in states and ("c", "b") in states
    found = suffix_tree.score(spark.createDataFrame(rows, "doc_id long, text string"), buckets=3).collect()
    for a, b in zip(sorted(map(tuple, found)), sorted(wanted), strict=True):
        assert math.isclose(a[6], b[6], rel_tol=1e-7)


def test_suffix_tree_moves_little(spark):
    """Messages hold a few bytes a pair, the last answers nothing of contexts that are not retained, and an answer moves once."""
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{min(int(rng.paretovariate(0.7)), 5000)}" for _ in range(300))) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    settings = suffix_tree.Settings(depth=1)
    [(_, data)] = suffix_tree.chunks(frame, 10**6).collect()
    state = suffix_tree.Chunk(bytes(data), 1, settings)
    [(_, _, message)] = state.word_messages(0)
    said, total, distinct = suffix_tree.count_words([(0, message)])
    state.learn_words([(0, said[0])], total, distinct)
    entries = state.entries()
    messages = [d for *_, d in state.pair_messages(entries, 0)]
    assert len(messages[0]) < 3.5 * len(entries.symbol) and len(entries.symbol) > 5_000
    [last], [other] = (suffix_tree.answer([(0, messages[0])], 1, settings._replace(depth=d)) for d in (1, 2))
    assert len(last) < 0.8 * len(other)
    plan = suffix_tree.score(frame, settings=suffix_tree.Settings(depth=2), buckets=5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(chunk") == 1


def shuffle_blocks(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {b for b in blocks.split() if b.startswith("shuffle_")}


def test_suffix_tree_keeps_little_on_disk(spark):
    """Of what was stored and shuffled only the counted chunks and the answers that are read again are left."""
    rng = random.Random(12)
    rows = [(i, " ".join(f"w{min(int(rng.paretovariate(0.7)), 5000)}" for _ in range(300))) for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    folder = pathlib.Path(shared_folder(spark).removeprefix("file:"))
    stored, shuffled, setting = set(folder.glob("chunks-*")), shuffle_blocks(spark), spark.conf.get(suffix_tree._CLEANUP)
    scores = suffix_tree.score(frame, settings=suffix_tree.Settings(depth=2), buckets=5)
    for _ in range(50):  # files may go a little later
        if shuffle_blocks(spark) <= shuffled:
            break
        time.sleep(0.1)
    assert shuffle_blocks(spark) <= shuffled and spark.conf.get(suffix_tree._CLEANUP) == setting
    [(_, plain)] = suffix_tree.chunks(frame, 10**6).collect()
    kept = [spark.read.parquet(str(p)) for p in set(folder.glob("chunks-*")) - stored]
    [(_, data)] = next(k for k in kept if k.columns == ["chunk", "data"]).collect()
    assert len(kept) == 2 and len(data) < 0.75 * len(plain)
    # The frame that is left can be read more than once.
    assert scores.count() == len(scores.collect()) == len(rows)


def test_counted_chunks_know_the_same(spark, docs):
    [(_, data)] = suffix_tree.chunks(docs.coalesce(1), 10**6).collect()
    plain = suffix_tree.Chunk(bytes(data), 3, suffix_tree.Settings())
    messages = {b: m for _, b, m in plain.word_messages(0)}
    answers = {b: suffix_tree.count_words([(0, m)]) for b, m in messages.items()}
    said = [(b, a[0][0]) for b, a in answers.items()]
    counted = suffix_tree.Chunk(plain.with_counts(said), 3, suffix_tree.Settings(), counted=True)
    plain.learn_words(said, 1000, 100)
    counted.learn_words([], 1000, 100)
    assert counted.ids == plain.ids
    for name in ("sizes", "counts", "base", "common", "symbol", "context_counts", "context_hash"):
        assert np.array_equal(getattr(counted, name), getattr(plain, name))


@pytest.mark.parametrize("values", [[], [0], [1, 2, 3], [3, 4, 0, 1, 1], [1] * 99 + [2**40, 700, 3]])
def test_small_numbers_are_packed_whole(values):
    values = np.array(values, np.int64)
    assert suffix_tree._unpacked_small(suffix_tree._packed_small(values)).tolist() == values.tolist()


def plain_ranking(rows, items):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(i, collections.Counter(term.findall(lowered(t)))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    total, n_docs = sum(c.total() for _, c in docs), len(docs)
    df = collections.Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in docs:
            m = 10 + 90 * c.total() * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(term.findall(lowered(text))) if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, rank, s[2], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:10], 1)]
    return sorted(out, key=key)


@pytest.mark.parametrize("at_once", [2, 1000])
def test_search(spark, docs, rows, at_once):
    texts = [r[1] for r in rows if r[1]]
    items = [(i, texts[7 * i % len(texts)][:300]) for i in range(12)] + [(3, "one"), (50, None), (51, "..."), (52, "nowhereinthecorpus"), (None, "the rain")]
    frame = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, place string").repartition(2)
    found = sorted((tuple(r) for r in ranking.search(docs, frame, items_at_once=at_once).collect()), key=key)
    assert found == plain_ranking([r[:2] for r in rows], items)


def test_items_are_searched_in_full_blocks(spark):
    """However many partitions hold the items: a block of one item each took a search of its own."""
    sizes = [3, 0, 1, 5, 0, 0, 4, 1]
    items = spark.sparkContext.parallelize([[p] * n for p, n in enumerate(sizes)], len(sizes)).flatMap(lambda rows: [(p,) for p in rows])
    numbered = ranking.store(spark.createDataFrame(items, "part long").withColumn("row", F.monotonically_increasing_id()), "items")
    every = sorted(r.row for r in numbered.collect())
    assert len(every) == 14 and len({r >> 33 for r in every}) == 5
    for at_once, wanted in ((1, 14), (4, 4), (7, 2), (14, 1), (2000, 1)):
        blocks = ranking._item_blocks(numbered, at_once)
        held = [[r for r in every if low <= r <= high] for low, high in blocks]
        assert len(blocks) == wanted and sum(held, []) == every
        assert all(len(h) == at_once for h in held[:-1])
    assert ranking._item_blocks(numbered.limit(0), 4) == []


def test_one_block_whatever_the_partitions(spark, docs, monkeypatch):
    """A range of one partition may become many; the items stay one block."""
    plain, seen = type(docs).repartitionByRange, []
    monkeypatch.setattr(type(docs), "repartitionByRange", lambda self, n, *c: plain(self, max(n, 7) if isinstance(n, int) else n, *c))
    monkeypatch.setattr(ranking, "Items", lambda items, *a, f=ranking.Items: seen.append(len(items)) or f(items, *a))
    items = spark.createDataFrame([(i, "the rain") for i in range(9)], "item_id long, text string").repartition(5)
    ranking.search(docs, items)
    assert seen == [9]


def test_bounds_are_never_low():
    rng = random.Random(3)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.choice([1, 5, 60, 900]))) for _ in range(60)]
    found = [collections.Counter(ranking.terms(t)) for t in texts]
    df = collections.Counter(h for c in found for h in ranking.hashed(list(c)).view(np.int64).tolist())
    items = ranking.Items([(i, sorted(c)) for i, c in enumerate(found)], df, len(texts), sum(c.total() for c in found))
    for width in (6, 9, 14):
        block = ranking._Block(width)
        for c in found:
            tf = np.array(list(c.values()))
            reached = np.searchsorted(ranking.LEVELS, tf, side="right")
            levels = np.concatenate([np.arange(n) for n in reached])
            block.add((), np.repeat(ranking.hashed(list(c)), reached), levels)
        bounds = items.bounds(width, np.array([c.total() for c in found]), block.slices())
        exact = np.array([items.scores(list(range(len(texts))), t) for t in texts]).T
        assert (bounds >= exact).all()
    assert (bounds == exact).mean() > 0.5


def test_empty_tables(spark, no_docs, docs):
    assert spelling.spelling_variants(no_docs).collect() == []
    assert suffix_tree.score(no_docs).collect() == []
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ranking.search(no_docs, items).collect() == []
    assert ranking.search(docs, items.limit(0)).collect() == []
