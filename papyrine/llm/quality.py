"""Quality rules per document and per host.

Every document is measured against a few rules. Failures are counted by host, each host's rate of failure is shrunk towards
the corpus by a beta prior whose two parameters are estimated from the hosts themselves, and a host whose shrunk rate for a
rule passes a limit is strict for that rule. Back at the documents, a document goes if it fails a rule for which its host is
strict, or the base rule. A document that fails no rule always stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm import common
from papyrine.llm.common import store

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
MIN_WORDS = 50
#: The rules that hosts are judged by. Measures are compared as whole numbers.
RULES = {
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 3 * n_words or word_chars > 10 * n_words",
    "base": f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words",
}
#: A host is strict for a rule if its shrunk rate of failure is above this.
HOST_LIMIT = 0.5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def measure(text: str) -> tuple[int, ...]:
    """The measures of one whole text, in the order of ``MEASURES``."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    joined = np.frombuffer(b"".join(words), np.uint8)
    lines = [line for line in data.split(b"\n") if line.strip(BLANKS)]
    return (
        len(words),
        int(np.count_nonzero((joined & 0xC0) != 0x80)),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of three words found twice or more, the first one included."""
    if len(words) <= window:
        return 0
    numbers = dict(zip(dict.fromkeys(words), range(len(words)), strict=False))
    if len(words) - len(numbers) < window:
        return 0  # two equal windows, overlapping or not, hold as many words that occurred before
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    # Words that occur once are in no repeated window; keys stay below the square of the number of words.
    key = ids
    for step in range(1, window):
        key = np.unique(key, return_inverse=True)[1] if step > 1 else key
        key = key[: len(words) - step] * len(words) + ids[step:]
    _, place, counts = np.unique(key, return_inverse=True, return_counts=True)
    repeated = counts[place] > 1
    covered = np.zeros(len(words), bool)
    for step in range(window):
        covered[step : step + len(repeated)] |= repeated
    return int(covered.sum())


def measured(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """row (all columns of ``docs``), host, the measures and one flag per rule; null text: empty, null host: a host."""
    own = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([measure(t) for t in batch["text"].to_pylist()], np.int64).reshape(-1, len(MEASURES))
        return pa.RecordBatch.from_arrays(
            [batch["row"], batch["host"], *[pa.array(c) for c in found.T.copy()]], ["row", "host", *MEASURES]
        )

    kind = own.schema["row"].dataType.simpleString()
    out = common.map_batches(own, step, f"row {kind}, host string, " + ", ".join(f"{m} long" for m in MEASURES))
    return out.select("*", *[F.expr(rule).alias(f"fails_{name}") for name, rule in RULES.items()])


def host_rates(flags: DataFrame) -> DataFrame:
    """host, docs, and per rule its failures, its beta prior's shrunk rate: one row per host."""
    counts = flags.groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"), *[F.count_if(f"fails_{r}").alias(f"failed_{r}") for r in RULES]
    )
    counts = store(counts, "hosts")
    # Sums over the hosts: one row.
    sums = counts.agg(
        F.sum("docs").alias("docs"),
        F.count(F.lit(1)).alias("hosts"),
        *[F.sum(f"failed_{r}").alias(f"failed_{r}") for r in RULES],
        *[F.sum(F.col(f"failed_{r}") * F.col(f"failed_{r}") / F.col("docs")).alias(f"squares_{r}") for r in RULES],
    ).first()
    out = counts
    for r in RULES:
        mean, weight = prior(sums["docs"] or 1, sums["hosts"], sums[f"failed_{r}"] or 0, sums[f"squares_{r}"] or 0.0)
        shrunk = (F.col(f"failed_{r}") + F.lit(mean * weight)) / (F.col("docs") + F.lit(weight))
        out = out.withColumn(f"rate_{r}", shrunk)
    return out


def prior(docs: int, hosts: int, failed: int, squares: float) -> tuple[float, float]:
    """Mean of the prior and the documents that it counts for (1 to a million), by the method of moments.

    ``squares``: sum of failed * failed / docs over the hosts. The spread of the hosts' rates, weighted by their documents,
    less what chance alone gives, is the spread of the beta distribution.
    """
    mean = failed / docs
    spread = squares / docs - mean * mean - mean * (1 - mean) * hosts / docs
    return mean, 1e6 if spread <= 0 else min(1e6, max(1.0, mean * (1 - mean) / spread - 1))


def strict_hosts(rates: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """host and one flag per rule, for the hosts that are strict for some rule."""
    strict = [(F.col(f"rate_{r}") > limit).alias(f"strict_{r}") for r in RULES]
    return rates.select("host", *strict).filter(" or ".join(f"strict_{r}" for r in RULES))


def judged(flags: DataFrame, hosts: DataFrame) -> DataFrame:
    """``flags`` with base_failed and kept. The hosts' side holds one row per strict host: no key of it repeats."""
    joined = flags.join(common.broadcast_if_bytes(hosts), "host", "left")
    against = " or ".join(f"(fails_{r} and coalesce(strict_{r}, false))" for r in RULES)
    return joined.select(
        *flags.columns, F.col("fails_base").alias("base_failed"), (~F.col("fails_base") & ~F.expr(against)).alias("kept")
    )


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, host, the measures, base_failed and kept for every row; the texts are read once."""
    narrow = measured(docs, text_col, host_col).withColumn("doc_id", F.col(f"row.`{id_col}`").cast("long"))
    flags = store(narrow.drop("row"), "measures")
    out = judged(flags, store(strict_hosts(host_rates(flags)), "strict"))
    return out.select("doc_id", "host", *MEASURES, "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. No text is moved: it is measured a second time instead."""
    flags = measured(docs.select(text_col, host_col), text_col, host_col).drop("row")
    hosts = store(strict_hosts(host_rates(flags)), "strict")
    return judged(measured(docs, text_col, host_col), hosts).filter("kept").select("row.*")
