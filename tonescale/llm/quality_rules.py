"""Quality rules by host, in DataFrame functions only.

Counts are taken of each text; rules that a text fails are summed up by host;
each host's failure rate is drawn towards the mean by a beta prior fitted to all
hosts (method of moments); hosts whose rate stays above a bound are rejected, and
their verdict is joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescale.runtime import write_once

LEAST_WORDS, MOST_REPEATED = 50, 50  # words; per cent of words
MOST_HOST_RATE = 0.5
#: Hosts up to this number are broadcast (about 50 MB); more are joined by a shuffle.
BROADCAST_HOSTS = 1_000_000

WHITE = " \t\n\x0b\x0c\r"
SPLIT = "[\\x20\\x09-\\x0D]+"
NO_SYMBOL = "[^#*$%&|<>]+"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, n_lines and the five counts of every whole text.

    Windows of three words are compared by 64-bit hashes.  Only texts in which
    one occurs twice have their windows sorted.
    """
    long = "bigint"
    texts = docs.select(
        F.col("doc_id").cast(long).alias("doc_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    bare = F.btrim("text", F.lit(WHITE))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    split = texts.select(
        "doc_id",
        "host",
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPLIT)).alias("words"),
        F.length(F.translate("text", WHITE, "")).cast(long).alias("word_chars"),
        F.length(F.regexp_replace("text", NO_SYMBOL, "")).cast(long).alias("n_symbols"),
        lines.alias("lines"),
    )
    hashed = split.select(
        "doc_id",
        "host",
        F.size("words").cast(long).alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast(long).alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast(long).alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    at = F.when(F.size("hashes") > 2, F.sequence(F.lit(0), F.size("hashes") - 3)).otherwise(F.array().cast("array<int>"))
    kept = ("doc_id", "host", "n_lines", "n_words", "word_chars", "n_symbols", "n_dup_lines")
    window = lambda i: F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2))
    windows = hashed.select(*kept, F.transform(at, window).alias("windows"))
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    in_order = windows.select(*kept, F.when(repeats, placed).alias("placed"))
    same = lambda x, k: (F.get("placed", k - 1)["h"] == x["h"]) | (F.get("placed", k + 1)["h"] == x["h"])
    twice = F.filter("placed", lambda x, k: F.coalesce(same(x, k), F.lit(False)))
    found = in_order.select(*kept, F.array_sort(F.transform(twice, lambda x: x["i"])).alias("starts"))
    reach = F.transform("starts", lambda x, k: F.least(F.coalesce(F.get("starts", k + 1) - x, F.lit(3)), F.lit(3)))
    covered = F.aggregate(reach, F.lit(0).cast(long), lambda a, b: a + b)
    return found.select(*kept, F.coalesce(covered, F.lit(0).cast(long)).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def any_failed() -> Column:
    """Whether a text fails a rule: the base rules, many symbols, repeated lines, odd word lengths."""
    return (
        base_failed()
        | (10 * F.col("n_symbols") > F.col("n_words"))
        | (2 * F.col("n_dup_lines") > F.col("n_lines"))
        | (F.col("word_chars") > 15 * F.col("n_words"))
        | (F.col("word_chars") < 2 * F.col("n_words"))
    )


def host_rates(counts: DataFrame) -> DataFrame:
    """host, n_docs, n_failed and rate, the shrunken share of failing documents.

    The prior's mean is the share over all documents, its strength follows from
    the hosts' spread: a + b = m (1 - m) / v - 1, held between 1 and 10,000.
    Where all hosts agree (v = 0) the strength is the largest.
    """
    failed = F.when(any_failed(), 1).otherwise(0)
    hosts = write_once(counts.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(failed).cast("bigint").alias("n_failed")), "hosts")
    mean = F.sum("n_failed") / F.sum("n_docs")
    share = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(
        mean.alias("m"),
        (F.sum(share * share * F.col("n_docs")) / F.sum("n_docs")).alias("square"),
        F.count("*").alias("hosts"),
    ).first()
    m = moments.m or 0.0
    spread = max(0.0, (moments.square or 0.0) - m * m)
    strength = min(10_000.0, max(1.0, m * (1 - m) / spread - 1)) if spread > 0 else 10_000.0
    rate = (F.col("n_failed") + F.lit(m * strength)) / (F.col("n_docs") + F.lit(strength))
    rated = hosts.withColumn("rate", rate)
    return F.broadcast(rated) if moments.hosts <= BROADCAST_HOSTS else rated


def host_rules(docs: DataFrame, host: str = "source", most: float = MOST_HOST_RATE) -> DataFrame:
    """doc_id, the five counts, base_failed, kept, host and the host's rate.

    One row for each input row, repeated and missing ids included; a missing
    text has no words, a missing host is the host ''.  Other columns are
    ignored.  ``kept`` is false for texts that fail a base rule and for texts of
    hosts whose shrunken failure rate is above ``most``.
    """
    counts = write_once(text_counts(docs, host), "text-counts")
    judged = counts.join(host_rates(counts), "host")
    return judged.select(
        "doc_id",
        *COUNTS,
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("rate") <= most)).alias("kept"),
        "host",
        "rate",
    )
