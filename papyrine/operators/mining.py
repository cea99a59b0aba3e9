"""Term statistics, keyphrases, anchors and topic vectors."""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.functions.text import tokens, without
from papyrine.operators.barrier import computed_once
from papyrine.operators.sizing import broadcast_if_small, frequent_from
from papyrine.session import stage, store


def top_per_group(df: DataFrame, group: str, order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their 1-based rank; each task passes on at
    most ``n`` rows of a group."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col(rank) <= n)


# Class-based term statistics.


def class_documents(df: DataFrame, class_col: str, id_col: str, text_col: str, ids_per_piece: int = 1000) -> DataFrame:
    """The texts of each class joined with blanks in id order, as numbered pieces.

    A piece covers ``ids_per_piece`` consecutive numeric ids; the pieces of a class, joined
    with blanks in order, are its whole text. A class is never one string in one task.
    """
    piece = F.floor(F.col(id_col) / ids_per_piece).cast("bigint")
    return df.groupBy(class_col, piece.alias("piece")).agg(
        F.expr(f"listagg(`{text_col}`, ' ') within group (order by `{id_col}`)").alias("class_text"),
        F.count(text_col).alias("documents"),
    )


def ctfidf(df: DataFrame, class_col: str, text_col: str, stop_words: list[str]) -> DataFrame:
    """``class, term, n, tf, idf, score``: share of the term in its class times the log of
    the number of documents over the term's total count."""
    found = computed_once(df.select(class_col, text_col), _terms=without(tokens(F.col(text_col)), stop_words))
    words = found.select(class_col, F.explode("_terms").alias("term"))
    counts = stage(words.groupBy(class_col, "term").agg(F.count(F.lit(1)).alias("n")))
    of_class = counts.groupBy(F.col(class_col).alias("_class")).agg(F.sum("n").alias("_class_n"))
    of_term = counts.groupBy(F.col("term").alias("_term")).agg(F.sum("n").alias("_term_n"))
    documents = df.agg(F.count(F.lit(1))).scalar()
    return (
        counts.join(broadcast_if_small(of_class), F.col(class_col).eqNullSafe(F.col("_class")))
        .join(of_term, F.col("term") == F.col("_term"))
        .withColumn("tf", F.col("n") / F.col("_class_n"))
        .withColumn("idf", F.log(documents / F.col("_term_n")))
        .withColumn("score", F.col("tf") * F.col("idf"))
        .select(class_col, "term", "n", "tf", "idf", "score")
    )


def top_terms(scores: DataFrame, class_col: str, n: int) -> DataFrame:
    return top_per_group(scores, class_col, [F.desc("score"), F.asc("term")], n)


def topic_sizes(df: DataFrame, class_col: str) -> DataFrame:
    return df.groupBy(class_col).agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), F.asc_nulls_last(class_col))


# Keyphrases.


def word_candidates(text: Column, stop_words: list[str]) -> Column:
    return without(tokens(text), stop_words)


def chunk_candidates(text: Column, stop_words: list[str], max_words: int | None = None) -> Column:
    """Runs of words between stop words and punctuation, of any length; with ``max_words`` longer ones are left out."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}_ ]+", " | ")
    words = F.filter(F.split(plain, " "), lambda w: w != "")
    marked = F.transform(words, lambda w: F.when(w.isin(*stop_words), F.lit("|")).otherwise(w)) if stop_words else words
    runs = F.transform(F.split(F.array_join(marked, " "), r"\|"), lambda run: F.trim(run))
    if max_words is None:
        return F.filter(runs, lambda run: run != "")
    return F.filter(runs, lambda run: (run != "") & (F.size(F.split(run, " ")) <= max_words))


def keyphrases(df: DataFrame, id_col: str, candidates: Column, n: int = 5) -> DataFrame:
    """The ``n`` candidates of each document with the highest tf-idf: ``id, phrase, score, rank``.

    Rows move once, by id, and a document's candidates are counted where it is. Counts of the phrases that very many
    documents have, which are most of the rows, meet a broadcast; only those of the others are shuffled by phrase.
    """
    found = computed_once(df.repartition(id_col), _candidates=candidates)
    phrases = found.select(id_col, F.size("_candidates").alias("_all"), F.explode("_candidates").alias("phrase"))
    counts = store(phrases.groupBy(id_col, "_all", "phrase").agg(F.count(F.lit(1)).alias("n")), "phrases")
    documents = df.agg(F.count(F.lit(1))).scalar()
    spread = store(counts.groupBy("phrase").agg(F.count(F.lit(1)).alias("_documents")), "spread")
    order = [F.round("score", 12).desc(), F.asc("phrase")]  # equal up to rounding noise is a tie

    def best(some: DataFrame) -> DataFrame:
        scored = some.withColumn("score", F.col("n") / F.col("_all") * F.log(documents / F.col("_documents")))
        return top_per_group(scored, id_col, order, n).select(id_col, "phrase", "score")

    often = frequent_from(spread, "_documents", "phrase")
    common = F.broadcast(spread.filter(F.col("_documents") >= often))
    rare = spread.filter(F.col("_documents") < often)
    both = best(counts.join(common, "phrase")).unionByName(
        best(counts.join(common.select("phrase"), "phrase", "left_anti").join(rare, "phrase"))
    )
    return top_per_group(both, id_col, order, n).select(id_col, "phrase", "score", "rank")


def _trigrams(phrase: str) -> set[str]:
    padded = f"  {phrase} "
    return {padded[i : i + 3] for i in range(len(padded) - 2)}


@functools.cache
def _choices(candidates: int, n: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """All choices of ``n`` places in order, and how to cost them step by step: for each size from two to ``n`` the choice
    that every choice of that size extends, and the flat places of its further pairs in a square matrix (one row each)."""
    at = {(i,): i for i in range(candidates)}
    steps = []
    for size in range(2, n + 1):
        found = list(itertools.combinations(range(candidates), size))
        shorter = np.array([at[c[:-1]] for c in found], dtype=int)
        steps.append((shorter, np.array([[i * candidates + c[-1] for i in c[:-1]] for c in found], dtype=int).T.copy()))
        at = {c: k for k, c in enumerate(found)}
    return np.array(list(itertools.combinations(range(candidates), n))), steps


def _similarities(phrases: list[str]) -> np.ndarray:
    """Shared letter trigrams over all of both, for each two phrases."""
    grams = [_trigrams(p) for p in phrases]
    numbers = {g: i for i, g in enumerate(set().union(*grams))}
    held = np.zeros((len(grams), len(numbers)))
    for row, own in zip(held, grams, strict=True):
        row[[numbers[g] for g in own]] = 1
    both, sizes = held @ held.T, held.sum(axis=1)
    return both / (sizes[:, None] + sizes - both)


def least_similar(phrases: list[str], n: int) -> list[int]:
    """Places of the ``n`` phrases with the smallest sum of pairwise similarities (shared
    letter trigrams); the first such choice in rank order."""
    if len(phrases) <= n:
        return list(range(len(phrases)))
    similarity = _similarities(phrases).ravel()
    choices, steps = _choices(len(phrases), n)
    cost = np.zeros(len(phrases) if steps else len(choices))
    for shorter, pairs in steps:
        cost = cost[shorter]
        for pair in pairs:
            cost += similarity[pair]
    return [int(i) for i in choices[int(np.argmin(np.round(cost, 12)))]]


def diversify(ranked: DataFrame, id_col: str, n: int = 5, candidates: int = 20) -> DataFrame:
    """Of the best ``candidates`` phrases of each document the ``n`` that are least alike.

    With ``n`` >= ``candidates`` all come back. All choices are tried, so ``candidates`` is
    small; a document's candidates travel as one short array.
    """

    @F.pandas_udf("array<int>")
    def choose(phrases: pd.Series) -> pd.Series:
        return phrases.map(lambda p: least_similar(list(p), n))

    packed = (
        ranked.filter(F.col("rank") <= candidates)
        .groupBy(id_col)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "phrase", "score"))).alias("best"))
    )
    chosen = packed.withColumn("places", choose("best.phrase"))
    kept = F.transform("places", lambda i: F.get("best", i))
    return chosen.select(id_col, F.inline(kept))


# Vectors.


def _doubles(vector: str) -> Column:
    return F.col(vector).cast("array<double>")


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return _dot(a, b) / (F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def nearest_anchor(
    items: DataFrame, anchors: DataFrame, id_col: str, vector: str, group: str | None = None, n: int | None = None,
    block_anchors: int = 10_000,
) -> DataFrame:
    """Distance of every item to its closest anchor, and which one it is (NULL without anchors).

    Anchors (same column names) are a query set, such as nine phrases. They travel with the plan as arrays, in blocks of
    about ``block_anchors``; every item keeps the best of the blocks so far, and is stored after each eight of them.
    Items are not shuffled. With ``group`` and ``n``, only the ``n`` closest items of each group.
    """
    blocks = max(1, -(-anchors.count() // block_anchors))
    block = F.pmod(F.xxhash64(F.col(id_col)), F.lit(blocks))
    distances = F.transform(
        F.col("_anchors"),
        lambda a: F.struct(euclidean(F.col("_vector"), a["v"]).alias("distance"), a["id"].alias("anchor")),
    )
    found = items.withColumn("_vector", _doubles(vector)).drop(vector)
    for at in range(blocks):
        listed = (
            anchors.filter(block == at)
            .agg(F.collect_list(F.struct(F.col(id_col).alias("id"), _doubles(vector).alias("v"))))
            .scalar()
        )
        best = F.least("_best", F.array_min(distances)) if at else F.array_min(distances)
        found = found.withColumn("_anchors", listed).withColumn("_best", best).drop("_anchors")
        if at % 8 == 7:
            found = store(found, "nearest")
    nearest = found.select(
        *[c for c in items.columns if c != vector],
        F.col("_best.anchor").alias("anchor"),
        F.col("_best.distance").alias("distance"),
    )
    if group is None:
        return nearest
    return top_per_group(nearest, group, [F.asc("distance"), F.asc(id_col)], n)


def topic_vectors(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per label, summed up inside the tasks first."""
    means = df.groupBy(label).agg(Summarizer.mean(array_to_vector(_doubles(vector))).alias("_mean"))
    return means.select(label, vector_to_array("_mean").alias(vector))


def topic_search(vectors: DataFrame, label: str, vector: str, query: Column, n: int = 10) -> DataFrame:
    """The ``n`` labels whose vectors are most similar (cosine) to the query vector."""
    both = vectors.select(label, _doubles(vector).alias("_v"), query.cast("array<double>").alias("_q"))
    scored = both.select(label, cosine(F.col("_v"), F.col("_q")).alias("score"))
    return scored.orderBy(F.desc("score"), F.asc(label)).limit(n)
