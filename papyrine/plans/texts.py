"""Term statistics and keyphrases over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from papyrine.functions import text as words
from papyrine.operators import mining
from papyrine.plans.registry import query, table

STOP_WORDS = ["and", "the", "of", "to", "in", "is", "it", "on", "by", "for", "with", "at", "as", "an", "are",
              "un", "la", "le", "en", "de", "el", "der", "die", "das", "und"]
STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"
TOKENS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]{2,}')"

TERMS_SQL = f"""counts as (select lang, term, count(*) as n from (select lang, unnest({TOKENS_SQL}) as term from documents)
    where term not in {STOP_SQL} group by lang, term),
scores as (select lang, term, n, n::double / sum(n) over (partition by lang) as tf,
    ln((select count(*) from documents)::double / sum(n) over (partition by term)) as idf from counts)"""


def _scores(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("lang", "text")
    return mining.ctfidf(documents, "lang", "text", STOP_WORDS)


@query(
    "ctfidf",
    f"with {TERMS_SQL} select lang, term, n, round(tf, 9) as tf, round(idf, 6) as idf, round(tf * idf, 9) as score from scores",
)
def ctfidf(spark, sf_dir):
    return _scores(spark, sf_dir).withColumns({c: F.round(c, d) for c, d in (("tf", 9), ("idf", 6), ("score", 9))})


@query(
    "ctfidf_top_terms",
    f"""with {TERMS_SQL} select * from (select lang, term, row_number() over (partition by lang
      order by round(tf * idf, 12) desc, term) as rank from scores) where rank <= 20""",
)
def ctfidf_top_terms(spark, sf_dir):
    scores = _scores(spark, sf_dir).withColumn("score", F.round("score", 12))
    return mining.top_terms(scores, "lang", 20).select("lang", "term", "rank")


@query("topic_sizes", "select lang, count(*) as size from documents group by lang")
def topic_sizes(spark, sf_dir):
    return mining.topic_sizes(table(spark, sf_dir, "documents"), "lang")


@query(
    "doc_concat_by_class",
    """select lang, doc_id // 1000 as piece, string_agg(text, ' ' order by doc_id) as class_text, count(*) as documents
    from documents group by lang, doc_id // 1000""",
)
def doc_concat_by_class(spark, sf_dir):
    return mining.class_documents(table(spark, sf_dir, "documents"), "lang", "doc_id", "text")


@query(
    "token_truncate",
    f"""select doc_id, array_to_string(({TOKENS_SQL})[1:512], ' ') as tokens, len({TOKENS_SQL}) as n_tokens,
      case when len({TOKENS_SQL}) > 512 then 1 else 0 end as is_truncated from documents""",
)
def token_truncate(spark, sf_dir):
    tokens = table(spark, sf_dir, "documents").select("doc_id", words.tokens(F.col("text")).alias("w"))
    return tokens.select(
        "doc_id",
        F.array_join(words.truncated(F.col("w")), " ").alias("tokens"),
        F.size("w").alias("n_tokens"),
        F.when(F.size("w") > 512, 1).otherwise(0).alias("is_truncated"),
    )


def _phrases_sql(candidates: str, n: int) -> str:
    return f"""phrases as (select doc_id, unnest({candidates}) as phrase from documents),
    counted as (select doc_id, phrase, count(*) as n from phrases group by doc_id, phrase),
    ranked as (select doc_id, phrase, round(score, 9) as score, row_number() over (partition by doc_id
        order by round(score, 12) desc, phrase) as rank
      from (select doc_id, phrase, n::double / sum(n) over (partition by doc_id)
          * ln((select count(*) from documents)::double / count(*) over (partition by phrase)) as score from counted))
    select * from ranked where rank <= {n}"""


WORDS_SQL = f"list_filter({TOKENS_SQL}, lambda w: w not in {STOP_SQL})"
CHUNKS_SQL = f"""list_filter(list_transform(string_split(array_to_string(list_transform(list_filter(string_split(
    regexp_replace(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}_ ]+', ' | ', 'g'), ' '), lambda w: w <> ''),
    lambda w: case when w in {STOP_SQL} then '|' else w end), ' '), '|'), lambda r: trim(r)),
    lambda r: r <> '')"""


def _rounded(frame):
    return frame.withColumn("score", F.round("score", 9))


@query("keyphrases_tfidf", f"with {_phrases_sql(WORDS_SQL, 5)}")
def keyphrases_tfidf(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _rounded(mining.keyphrases(documents, "doc_id", mining.word_candidates(F.col("text"), STOP_WORDS), 5))


@query("keyphrases_chunks", f"with {_phrases_sql(CHUNKS_SQL, 20)}")
def keyphrases_chunks(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    chunks = mining.chunk_candidates(F.col("text"), STOP_WORDS)
    return _rounded(mining.keyphrases(documents, "doc_id", chunks, 20))


@query("keyphrases_maxsum")
def keyphrases_maxsum(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    best = mining.keyphrases(documents, "doc_id", mining.chunk_candidates(F.col("text"), STOP_WORDS), 20)
    return _rounded(mining.diversify(best, "doc_id", 5, 20))
