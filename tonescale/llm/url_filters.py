"""URL verdicts: rules first, then words in concatenated names.

1. Words of all pages and of hyphenated host names are counted.
2. A unigram Viterbi search splits each distinct run of letters in hosts and paths
   into its likeliest words.  The word counts reach the runs by joining them with
   the substrings of the runs.
3. Pages whose host holds a seed word train a multinomial naive Bayes model over
   host and path words, smoothed by the words that occur; it scores every run, and
   a page by its runs.

All counts are complete tables joined by shuffle.  Keys that hold more than a fixed
part of all rows, of which there are fewer than that number, are joined by broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescale.llm.batches import bound_batches, pairs
from tonescale.runtime import write_once

#: Letters of the longest word of the unigram model.
LONGEST = 24
#: A key with more than this part of all rows is hot, so fewer than its inverse are.
HOT = 1 / 4096
FLUSH = 200_000

# Rules as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Words that tell of unwanted sites.
SEEDS = frozenset(
    "adult ads bet bets bingo casino cheap dating jackpot loan loans nude pharmacy pills poker porn sex slots spam viagra warez xxx".split()
)

LETTERS = re.compile("[a-z]+")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a missing url and one without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), upper, upper.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host/path, and its verdict; else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def plain_text(html: str) -> str:
    """The text outside of tags, scripts and styles, in one pass.

    What is not closed anywhere is text; that it is not is looked up once.
    """
    pieces, at, missing = [], 0, set()
    while (start := html.find("<", at)) >= 0:
        end = -1
        for opening, closing in (("<script", "</script>"), ("<style", "</style>"), ("<", ">")):
            if closing not in missing and html.startswith(opening, start):
                end = html.find(closing, start)
                if end >= 0:
                    end += len(closing)
                    break
                missing.add(closing)
        if end < 0:  # no tag ends after this place
            break
        pieces.append(html[at:start])
        at = end
    return " ".join([*pieces, html[at:]])


def page_words(pages: DataFrame, html: str = "html") -> DataFrame:
    """word, n: words of all page texts and parts of hyphenated host labels."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for host, text in pairs(batch):
                counts.update(w for w in LETTERS.findall(plain_text(text).lower()) if len(w) <= LONGEST)
                counts.update(w for label in host.split(".") if "-" in label for w in LETTERS.findall(label) if len(w) <= LONGEST)
                if len(counts) > FLUSH:
                    yield rows()
        yield rows()

    text = F.coalesce(F.col(html).cast("string"), F.lit(""))
    counted = pages.select(host_and_path(F.col("url"))[0].alias("host"), text.alias("text")).mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def split(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest words of a run of letters; an unknown word costs more with each letter."""
    whole = math.log(total)
    best = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        found = []
        for start in range(max(0, end - LONGEST), end):
            n = counts.get(name[start:end])
            found.append((best[start][0] + (whole + 2.5 * (end - start) if n is None else whole - math.log(n)), start))
        best.append(min(found))
    words, end = [], len(name)
    while end:
        start = best[end][1]
        words.append(name[start:end])
        end = start
    return words[::-1]


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of a written table of rows with one of unique keys, whatever the keys' frequencies.

    The keys of more than ``HOT`` of all rows, at most ``1 / HOT``, are joined by broadcast.
    """
    common = rows.groupBy(*keys).count().filter(F.col("count") > F.lit(HOT) * rows.count()).select(*keys)
    hot = F.broadcast(common)
    near = rows.join(F.broadcast(table.join(hot, keys, "left_semi")), keys)
    far = rows.join(hot, keys, "left_anti").join(table, keys)
    return near.unionByName(far)


def segmented(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """run and its words, of every distinct run."""
    numbered = write_once(runs.select("run").distinct().withColumn("number", F.monotonically_increasing_id()), "runs")
    total = (counts.agg(F.sum("n")).first()[0] or 0) + 1

    def substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, number in pairs(batch):
                found = {run[i : i + k] for i in range(len(run)) for k in range(1, min(LONGEST, len(run) - i) + 1)}
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(found), pa.int64()), pa.array(found, pa.string())], names=["number", "word"])

    def viterbi(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for run, known in zip(batch.column("run").to_pylist(), batch.column("known")):
                words.append(split(run, {k["word"]: k["n"] for k in known.as_py() or ()}, total))
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(words, pa.list_(pa.string()))], names=["run", "words"])

    parts = write_once(numbered.mapInArrow(substrings, "number bigint, word string"), "substrings")
    known = looked_up(parts, counts, ["word"]).groupBy("number").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    return write_once(numbered.join(known, "number", "left").select("run", "known").mapInArrow(viterbi, "run string, words array<string>"), "words")


def trained(runs: DataFrame, places: DataFrame, seeds: frozenset[str]) -> tuple[float, DataFrame]:
    """The prior log odds of block, and part, run, words and score of every run.

    A page is a block example if its host holds a seed word, else an allow example.
    A word of class counts x, y has the log odds of (x + 1) / (X + V) to (y + 1) / (Y + V),
    where X and Y are the classes' numbers of words and V is that of distinct words.
    """
    marked = runs.withColumn("marked", F.arrays_overlap("words", F.array(*map(F.lit, sorted(seeds)))))
    hosts = looked_up(places.filter("part = 0").select("row", "run"), marked.filter("marked").select("run"), ["run"])
    blocked = write_once(hosts.select("row").distinct().withColumn("block", F.lit(1)), "block-pages")
    by_run = places.join(blocked, "row", "left").groupBy("part", "run").agg(
        F.count("block").alias("x"), (F.count(F.lit(1)) - F.count("block")).alias("y")
    )
    # The two parts of a url are told apart: each has words of its own.
    worded = write_once(by_run.join(runs, "run"), "run-classes")
    counts = worded.select("part", F.explode("words").alias("word"), "x", "y").groupBy("part", "word")
    counts = write_once(counts.agg(F.sum("x").alias("x"), F.sum("y").alias("y")), "class-counts")
    sums = counts.agg(F.coalesce(F.sum("x"), F.lit(0)).alias("x"), F.coalesce(F.sum("y"), F.lit(0)).alias("y"), F.count(F.lit(1)).alias("v")).first()
    rest = math.log((sums.y + sums.v) / (sums.x + sums.v)) if sums.v else 0.0
    odds = counts.select("part", "word", (F.log((F.col("x") + 1) / (F.col("y") + 1)) + F.lit(rest)).cast("decimal(20,9)").alias("odds"))
    words = write_once(worded.select("part", "run", F.explode("words").alias("word")), "run-words")
    scores = looked_up(words, odds, ["part", "word"]).groupBy("part", "run").agg(F.sum("odds").cast("decimal(30,9)").alias("score"))
    return blocked.count(), write_once(worded.select("part", "run", "words").join(scores, ["part", "run"]), "run-scores")


def url_verdicts(pages: DataFrame, rules: tuple = RULES, seeds: frozenset[str] = SEEDS) -> DataFrame:
    """page_id, host, path, rule, verdict, words, score of every page.

    One row for each input row, repeated and missing ids included; a missing url
    has an empty host and path, no rule, and the model's verdict.  ``verdict``
    is the rule's, else ``block`` where the model's log odds are above 0.
    ``words`` are those of the host, then those of the path with a ``/`` before each.
    Other columns but ``html`` are ignored.
    """
    bound_batches(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    keys = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = write_once(keys.withColumn("row", F.monotonically_increasing_id()), "pages")
    places = [
        rows.select("row", F.lit(part).alias("part"), F.posexplode(F.regexp_extract_all(F.lower(name), F.lit("([a-z]+)"))).alias("at", "run"))
        for part, name in enumerate(("host", "path"))
    ]
    found = write_once(places[0].union(places[1]), "places")
    runs = segmented(found, write_once(page_words(pages), "page-words"))
    blocked, scored = trained(runs, found, seeds)
    prior = math.log((blocked + 1) / (rows.count() - blocked + 1))

    joined = looked_up(found, scored, ["part", "run"])
    listed = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "at", "words"))), lambda p: F.transform(p["words"], lambda w: F.when(p["part"] == 1, F.concat(F.lit("/"), w)).otherwise(w))))
    sums = joined.groupBy("row").agg(F.sum("score").alias("sum"), listed.alias("list"))
    rule, decision = fitting_rule(F.col("host"), F.col("path"), rules)
    score = F.coalesce(F.col("sum").cast("double"), F.lit(0.0)) + F.lit(prior)
    judged = rows.join(sums, "row", "left").withColumn("score", score)
    verdict = F.coalesce(decision, F.when(F.col("score") > 0, "block").otherwise("allow"))
    words = F.coalesce(F.array_join("list", " "), F.lit(""))
    return judged.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), words.alias("words"), "score")
