"""The operators' queries over whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from papyrine.llm import bpe, exact, html, licences, packing, prefix_counts, quality, ranking, sharding, simhash, spelling, suffix, suffix_tree

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding of every text, as digests."""
    return bpe.digests(_documents(spark, sf_dir))


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdicts of every document."""
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.verdicts(_documents(spark, sf_dir)).select("doc_id", *measures, "base_failed", "kept")


def op3_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes."""
    return sharding.shards(_documents(spark, sf_dir))


def op4_suffix_lpf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later copies of 100-byte strings removed, as digests."""
    return suffix.digests(_documents(spark, sf_dir))


def op5_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components."""
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op6_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return packing.pack(_documents(spark, sf_dir))


def op7_tree_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_quotient_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts."""
    return exact.groups(_documents(spark, sf_dir))


def op9_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text."""
    return prefix_counts.token_counts(_documents(spark, sf_dir))


def op10_licence_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best licence template of every document."""
    return licences.scan(_documents(spark, sf_dir))


def op11_trie_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, their near words and the form each is a variant of."""
    return spelling.spelling_variants(_documents(spark, sf_dir))


def op12_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by single words and by the suffix tree."""
    return suffix_tree.score(_documents(spark, sf_dir))


def op13_bit_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranking.search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_bpe,
        op2_host_rules,
        op3_differencing,
        op4_suffix_lpf,
        op5_simhash_ball,
        op6_hilbert_packing,
        op7_tree_model,
        op8_quotient_filters,
        op9_prefix_counts,
        op10_licence_dice,
        op11_trie_frontier,
        op12_suffix_tree,
        op13_bit_slices,
    )
} | {"pipeline": corpus_pipeline.run}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_SQL = rf"""
with base as (
  select doc_id, coalesce(source, '') as host, coalesce(text, '') as t, {_WORDS} as w, row_number() over () as rid
  from documents),
lines as (select rid, l, count(*) as n
  from (select rid, unnest(string_split(t, chr(10))) as l from base) where regexp_matches(l, '[^\x20\x09-\x0D]')
  group by all),
dups as (select rid, sum(n)::bigint as n_lines, sum(n - 1)::bigint as n_dup_lines from lines group by rid),
grams as (
  select rid, i, [w[i], w[i + 1], w[i + 2]] as g from (select rid, w, unnest(range(1, len(w) - 1)) as i from base)),
again as (select rid, i, count(*) over (partition by rid, g) as c from grams),
covered as (
  select rid, count(distinct k) as n_repeat_words
  from (select rid, unnest([i, i + 1, i + 2]) as k from again where c > 1) group by rid),
m as (
  select doc_id, host, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols, coalesce(n_lines, 0) as n_lines,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from base left join dups using (rid) left join covered using (rid)),
f as (
  select *, 10 * n_symbols > n_words as f1, 100 * n_dup_lines > 30 * n_lines as f2,
    word_chars < 3 * n_words or word_chars > 10 * n_words as f3,
    n_words < 50 or 100 * n_repeat_words > 50 * n_words as f4 from m),
h as (
  select host, count(*) as docs, unnest([1, 2, 3, 4]) as r,
    unnest([count(*) filter (f1), count(*) filter (f2), count(*) filter (f3), count(*) filter (f4)]) as k
  from f group by host),
sums as (select r, sum(k) / sum(docs) as mean, sum(k * k / docs) / sum(docs) as squares, count(*) / sum(docs) as share
  from h group by r),
prior as (select r, mean, squares - mean * mean - mean * (1 - mean) * share as spread from sums),
weight as (
  select r, mean, case when spread <= 0 then 1e6 else least(1e6, greatest(1.0, mean * (1 - mean) / spread - 1)) end as wt
  from prior),
strict as (
  select host, bool_or(r = 1) as s1, bool_or(r = 2) as s2, bool_or(r = 3) as s3
  from h join weight using (r) where (k + mean * wt) / (docs + wt) > 0.5 group by host)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f4 as base_failed,
  not f4 and not (f1 and coalesce(s1, false) or f2 and coalesce(s2, false) or f3 and coalesce(s3, false)) as kept
from f left join strict using (host)"""

EXACT_SQL = r"""
with n as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t, row_number() over () as rid
  from documents),
g as (select *, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size from n)
select doc_id, keep_id, group_size,
  doc_id is not distinct from keep_id and row_number() over (partition by t, doc_id order by rid) = 1 as kept,
  sha256(t) as text_sha256
from g"""

RANKING_SQL = r"""
with d as (
  select row_number() over () as rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents),
lengths as (select rid, doc_id, len(w)::bigint as n from d where len(w) > 0),
corpus as (select count(*)::bigint as docs, sum(n)::bigint as total from lengths),
q as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
tf as (select rid, term, count(*)::bigint as tf from (select rid, unnest(w) as term from d) group by all),
weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from tf, corpus where term in (select term from q) group by term, docs),
scores as (
  select item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::bigint as score
  from q join weights using (term) join tf using (term) join lengths using (rid), corpus group by all),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10"""

ORACLES: dict[str, str] = {
    "op2_host_rules": QUALITY_SQL,
    "op8_quotient_filters": EXACT_SQL,
    "op13_bit_slices": RANKING_SQL,
    "op10_licence_dice": licences.scan_sql(),
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
