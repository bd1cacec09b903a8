"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every text.  Expectation
maximisation over the counts of vote patterns (all documents) estimates how often
each labeller is right where it votes.  The posterior of each pattern
labels a bounded sample, on which a linear model over hashed word features is
trained; that model scores every whole text.
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

from tonescale.llm.batches import texts_of

#: At most about so many documents train the scorer.
SAMPLE = 16384
BUCKETS = 1 << 15
KNOWN_WORDS = 300_000
GOOD, BAD, NONE = 1, 0, 2
LABELLERS = 12
#: A heuristic is right in this share of its votes at most; a given label outweighs three of them.
MOST_TRUST, LABEL_ODDS = 0.95, 12.0

# Insults, and frequent short words of the corpus languages.
INSULTS = frozenset("clown disgusting idiot loser moron pathetic scum stupid trash worthless".split())
COMMON = frozenset(
    """a an and are as at be by for from have in is it not of on or that the this to was which with
    au avec dans de des du elle en est et la le les par pas pour que qui sur un une
    aus das dem den der die ein eine für ist mit nicht sich sind und von zu
    al con del el las los no para por se su y""".split()
)
SYMBOLS = re.compile(r"[#$%&*!|]")
EDGES = "\"'()[]{}.,;:!?#$%&*|-"


def votes(text: str) -> list[int]:
    """One vote of each labeller on a text; a text without words gets none.

    Labellers of a flaw vote bad or nothing, labellers of good texts good or
    nothing: that one flaw is absent says little.
    """
    words = text.split()
    if not words:
        return [NONE] * LABELLERS
    count, lower = len(words), [w.strip(EDGES) for w in text.lower().split()]
    letters = max(1, sum(map(str.isalpha, text)))
    insults = Counter(w for w in lower if w in INSULTS)
    lines = [line for line in text.split("\n") if line.strip()]
    symbols, capitals = len(SYMBOLS.findall(text)) / count, sum(map(str.isupper, text)) / letters
    distinct, common = len(set(words)) / count, sum(w in COMMON for w in lower) / count
    stutter = sum(a == b for a, b in zip(words, words[1:])) / count
    plain = symbols < 0.05 and capitals < 0.2 and distinct > 0.4 and stutter < 0.2 and not insults
    flaws = (
        symbols > 0.2,
        capitals > 0.4 and letters > 20,
        distinct < 0.4 and count > 30,
        stutter > 0.2 and count > 10,
        words.count("|") > 0.1 * count,
        len(set(lines)) < 0.6 * len(lines),
        bool(insults),
        len(insults) > 1 or sum(insults.values()) > 0.01 * count,
        letters < 2 * count,
    )
    merits = (
        plain and common > 0.1,
        plain and distinct > 0.5,
        plain and stutter < 0.1 and len(set(lines)) == len(lines) and 3 * count < letters < 9 * count,
    )
    return [BAD if f else NONE for f in flaws] + [GOOD if m else NONE for m in merits]


def pattern(text: str) -> str:
    return "".join(map(str, votes(text)))


def pattern_counts(texts: DataFrame) -> DataFrame:
    """pattern, n over all documents; at most 2^12 rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            counts.update(pattern(t.as_py()) for t in batch.column("text"))
        yield pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())], names=["pattern", "n"])

    return texts.mapInArrow(count, "pattern string, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))


class Labellers:
    """How often each labeller is right where it votes.

    Both classes are equally likely beforehand: a share estimated along with the
    accuracies would outvote the single flaws that most bad texts have.
    """

    def __init__(self, counts: list[tuple[str, int]], rounds: int = 100):
        codes = np.array([[int(c) for c in p] for p, _ in counts], np.int64).reshape(-1, LABELLERS)
        weight = np.array([n for _, n in counts], float)
        self.accuracy = np.full(LABELLERS, 0.9)
        for _ in range(rounds if len(weight) else 0):
            belief = self.posterior(codes)
            right = np.where(codes == GOOD, belief[:, None], 1 - belief[:, None])
            cast = (codes != NONE) * weight[:, None]
            # one right vote in ten against, as if seen before; no labeller is trusted wholly
            self.accuracy = np.clip(((right * cast).sum(axis=0) + 9) / (cast.sum(axis=0) + 10), 0.55, MOST_TRUST)

    def posterior(self, codes: np.ndarray, given: np.ndarray | None = None) -> np.ndarray:
        """Probability of a good text for each row of votes; without votes, one half.

        ``given`` holds the votes of one more labeller, the label table.
        """
        trust = np.log(self.accuracy / (1 - self.accuracy))
        odds = ((codes == GOOD) * trust).sum(axis=1) - ((codes == BAD) * trust).sum(axis=1)
        if given is not None:
            odds = odds + LABEL_ODDS * ((given == GOOD) * 1 - (given == BAD) * 1)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def word_buckets(word: str) -> tuple[int, int]:
    """Buckets of a word's first letters, without its edges, and of its form."""
    bare = word.lower().strip(EDGES)
    letters = [c for c in word if c.isalpha()]
    capitals = "C" if len(letters) > 1 and all(map(str.isupper, letters)) else "c"
    symbols = "".join(sorted(set(SYMBOLS.findall(word))))
    size = min(12, len(bare))
    return zlib.crc32(b"w " + bare[:4].encode()) % BUCKETS, zlib.crc32(f"f {capitals}{symbols}{size // 4}".encode()) % BUCKETS


class Buckets(dict):
    """Both buckets of a word in one number, kept for words seen lately."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        first, second = word_buckets(word)
        self[word] = both = first * BUCKETS + second
        return both


KNOWN = Buckets()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: square roots of the shares of words, forms, repeats and stutters; insults."""
    words = text.split()
    count = len(words)
    if not count:
        return np.empty(0, np.int64), np.empty(0)
    both = np.fromiter(map(KNOWN.__getitem__, words), np.int64, count)
    found, n = np.unique(np.concatenate([both // BUCKETS, both % BUCKETS]), return_counts=True)
    stutters = int((both[1:] == both[:-1]).sum())
    insults = sum(w.strip(EDGES) in INSULTS for w in set(text.lower().split()))
    extra = [zlib.crc32(name) % BUCKETS for name in (b"x repeats", b"x stutters", b"x insults")]
    values = np.sqrt(np.concatenate([n, [count - len(set(words)), stutters]]) / count)
    return np.concatenate([found, extra]), np.append(values, min(1.0, insults / 2))


class Scorer:
    """A linear model over hashed features, trained on soft labels by gradient steps."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, float]], steps: int = 250, rate: float = 0.6, decay: float = 1e-5):
        self.weights, self.bias = np.zeros(BUCKETS), 0.0
        if not rows:
            return
        size = np.array([len(r[0]) for r in rows])
        row = np.repeat(np.arange(len(rows)), size)
        at, value = np.concatenate([r[0] for r in rows]).astype(np.int64), np.concatenate([r[1] for r in rows])
        label = np.array([r[2] for r in rows])
        good = label.mean()
        share = np.where(label > 0.5, 0.5 / max(good, 0.05), 0.5 / max(1 - good, 0.05)) / len(rows)
        square, square_bias = np.full(BUCKETS, 1e-8), 1e-8
        for _ in range(steps):
            scores = np.bincount(row, self.weights[at] * value, len(rows)) + self.bias
            error = (1 / (1 + np.exp(-np.clip(scores, -30, 30))) - label) * share
            slope = np.bincount(at, error[row] * value, BUCKETS) + decay * self.weights
            square += slope * slope
            square_bias += error.sum() ** 2
            self.weights -= rate * slope / np.sqrt(square)
            self.bias -= rate * error.sum() / np.sqrt(square_bias)

    def score(self, text: str) -> float:
        """Probability that the text is good."""
        at, value = features(text)
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ value + self.bias, -30, 30))))


def chosen_rows(frame: DataFrame, total: int, sample: int, *key: str) -> DataFrame:
    """About ``sample`` rows by a hash of the key, the same on every run."""
    share = min(1.0, sample / max(1, total))
    return frame.filter(F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < int(share * (1 << 30)))


def train(docs: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE) -> tuple[Labellers, Scorer]:
    """The labellers' accuracies from all documents, the scorer from about ``sample`` of them.

    ``labels`` (doc_id, good) is one more labeller, trusted above the others.
    Where it names documents, the sample is drawn from them.
    """
    texts = texts_of(docs)
    counts = sorted(map(tuple, pattern_counts(texts).collect()))
    labellers = Labellers(counts)
    given = F.lit(NONE).alias("given")
    chosen = None
    if labels is not None:
        known = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min(F.col("good").cast("int")).alias("given"))
        known = known.filter("doc_id IS NOT NULL AND given IS NOT NULL")
        named = chosen_rows(known, known.count(), sample, "doc_id")
        chosen = texts.join(F.broadcast(named), "doc_id").select("text", "given")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(pattern(t), *features(t)) for t in (x.as_py() for x in batch.column("text"))]
            columns = [
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1].astype(np.int32).tobytes() for r in rows], pa.binary()),
                pa.array([r[2].astype(np.float32).tobytes() for r in rows], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("given")], names=["pattern", "at", "value", "given"])

    def rows_of(frame: DataFrame) -> list[tuple]:
        return sorted(map(tuple, frame.mapInArrow(describe, "pattern string, at binary, value binary, given int").collect()))

    found = rows_of(chosen) if chosen is not None else []
    if not found:
        found = rows_of(chosen_rows(texts, sum(n for _, n in counts), sample, "doc_id", "text").select("text", given))
    codes = np.array([[int(c) for c in r[0]] for r in found], np.int64).reshape(-1, LABELLERS)
    beliefs = labellers.posterior(codes, np.array([r[3] for r in found], np.int64))
    rows = [(np.frombuffer(a, np.int32), np.frombuffer(v, np.float32), y) for (_, a, v, _), y in zip(found, beliefs)]
    return labellers, Scorer(rows)


def classified(docs: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE, least: float = 0.4) -> DataFrame:
    """The documents with ``quality_score`` and ``accepted``.

    One row for each input row, repeated and missing ids included; all columns
    stay, except earlier ones of these two names.  A missing or empty text
    scores as the model's bias.  A document is accepted at ``least`` or above.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample)[1])

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(lambda t: shared.value.score(t or "")).astype("float64")

    scored = docs.drop("quality_score", "accepted").withColumn("quality_score", score(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return scored.withColumn("accepted", F.col("quality_score") >= least)


def good_labels(labels: DataFrame) -> DataFrame:
    """doc_id, good: of high quality and not toxic."""
    return labels.select("doc_id", ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"))
