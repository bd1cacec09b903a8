"""Lexicon scores of documents.

Four ways to look tokens up, chosen by the size of the lexicon:

* literal - a small lexicon becomes part of the expression.  No join, no
  shuffle, runs on streams.  A word costs one hash-set test.
* bucketed - a lexicon of checked size becomes one row, an array of small maps
  indexed by the token's hash.  The cost of a token does not depend on the
  number of terms; no explode, no shuffle, runs on streams.
* broadcast - on request: such a lexicon is joined to the exploded tokens.
* shuffled - of a larger lexicon every block of documents gets the buckets of
  the terms that it holds.  Only the distinct tokens of the blocks meet the
  lexicon by shuffle; those so frequent that they would burden one task are
  resolved by a bounded broadcast first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescale.functions.labels import normalize_label, score_to_label
from tonescale.functions.text import has_token, text_key, text_tokens
from tonescale.operators.documents import fill_missing_text, first_copies, keyed_copies
from tonescale.runtime import write_once
from tonescale.schemas import LEXICON

# Above this many terms the per-weight hit counts of the literal form cost
# more than the join (measured in README, "Choosing the scoring form").
LITERAL_TERMS = 128
# The literal form on request (a stream has no other) takes more, at that cost.
LITERAL_TERMS_ON_REQUEST = 10_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Rough cost of one term in a broadcast hash table besides its characters.
TERM_OVERHEAD = 64
# A token with more than 1/HOT_PARTS of all distinct tokens of blocks is hot;
# there are fewer than HOT_PARTS of them.
HOT_PARTS = 4096
# Bytes of a block's tokens (a longer document is a block by itself), the size
# up to which documents count alike, the buckets of a block's terms, and bytes
# of the blocks of one partition.
BLOCK_BYTES = 32 * 1024 * 1024
SMALL = 8192
BLOCK_BUCKETS = 4096
PARTITION_BYTES = 64 * 1024 * 1024
# Tokens are written and shuffled as one string, much shorter than a list.
BREAK = "\n"

SCORE_COLUMNS = ("score", "positive_hits", "negative_hits")


def lexicon_table(spark: SparkSession, weights: dict[str, int]) -> DataFrame:
    """A lexicon table from a small mapping, keys folded to lower case."""
    folded = {word.lower(): weight for word, weight in weights.items()}
    columns = pa.table(
        {
            "token": pa.array(list(folded), pa.string()),
            "weight": pa.array(list(folded.values()), pa.int64()),
        }
    )
    # An Arrow table becomes a local relation: reading it needs no job.
    return spark.createDataFrame(columns, LEXICON)


def as_lexicon(lexicon: DataFrame) -> DataFrame:
    """Token and weight with folded, unique terms and no missing values.

    A table may hold a term twice, or in two spellings, only with one weight.
    """
    token = F.lower("token").alias("token")
    weights = lexicon.select(token, F.col("weight").cast("bigint").alias("weight")).groupBy("token")
    least, most = F.min("weight"), F.max("weight")
    known = F.col("token").isNotNull() & (F.count("weight") == F.count(F.lit(1)))
    message = F.concat(F.lit("lexicon term without one weight: "), F.coalesce(F.col("token"), F.lit("NULL")))
    checked = F.when(known & (least == most), least).otherwise(F.raise_error(message).cast("bigint"))
    return weights.agg(checked.alias("weight"))


def small_lexicon(lexicon: DataFrame, limit: int = LITERAL_TERMS) -> dict[str, int] | None:
    """The lexicon as a mapping when it has at most ``limit`` terms."""
    rows = lexicon.select("token", "weight").limit(limit + 1).collect()
    return {row.token: row.weight for row in rows} if len(rows) <= limit else None


def lexicon_bytes(lexicon: DataFrame) -> int:
    """Estimated size of the lexicon as a broadcast table; every weight is computed, and so checked."""
    size = F.sum(F.octet_length("token") + TERM_OVERHEAD).alias("size")
    return lexicon.agg(size, F.sum("weight").alias("total")).first().size or 0


def lexicon_size(lexicon: DataFrame) -> int:
    weights = small_lexicon(lexicon)
    return lexicon.count() if weights is None else len(weights)


def choose_form(lexicon: DataFrame, form: str = "auto") -> tuple[str, dict[str, int] | None]:
    """The form to use and, for the literal one, the lexicon as a mapping.

    All forms give the same scores; the choice is one of cost.
    """
    if form in ("auto", "literal"):
        limit = LITERAL_TERMS if form == "auto" else LITERAL_TERMS_ON_REQUEST
        weights = small_lexicon(lexicon, limit)
        if weights is not None:
            return "literal", weights
        if form == "literal":
            raise ValueError(f"the literal form takes at most {limit} terms")
        return ("bucketed" if lexicon_bytes(lexicon) <= BROADCAST_BYTES else "shuffled"), None
    if form not in ("bucketed", "broadcast", "shuffled"):
        raise ValueError(f"unknown scoring form: {form}")
    if lexicon_bytes(lexicon) > BROADCAST_BYTES and form != "shuffled":
        raise ValueError(f"the {form} form takes a lexicon of at most {BROADCAST_BYTES} bytes")
    return form, None


def checked_lexicon(lexicon: DataFrame, form: str) -> tuple[DataFrame, str, dict[str, int] | None]:
    """The folded lexicon, the form to use, and the mapping of the literal form.

    For a join the lexicon becomes a local relation or, with many terms, a
    written table, so no plan of documents repeats its check.  Buckets beyond
    the bound of one row are made by blocks of documents, in the shuffled form.
    """
    terms = as_lexicon(lexicon)
    if form == "bucketed" and lexicon_bytes(terms) > BROADCAST_BYTES:
        form = "shuffled"
    chosen, weights = choose_form(terms, form)
    if weights is None:
        local = small_lexicon(terms, LITERAL_TERMS_ON_REQUEST)
        terms = write_once(terms, "lexicon") if local is None else lexicon_table(lexicon.sparkSession, local)
    return terms, chosen, weights


# --- literal form -----------------------------------------------------------


def _occurrences(hits: Column, words: list[str]) -> Column:
    return F.size(F.filter(hits, lambda token: token.isin(words))).cast("bigint")


def literal_scores(docs: DataFrame, weights: dict[str, int], fold: bool = True) -> DataFrame:
    """Add the score columns to documents with ``tokens``.

    The projections stay apart in the plan because each column is used more
    than once by the next: tokens are reduced to lexicon hits once, and only
    the hits are counted by weight.
    """
    by_weight: dict[int, list[str]] = {}
    for word, weight in weights.items():
        if weight != 0:
            by_weight.setdefault(weight, []).append(word)
    words = [word for group in by_weight.values() for word in group]
    counters = {weight: f"_hits_{i}" for i, weight in enumerate(sorted(by_weight))}

    tokens = F.coalesce(F.col("tokens"), F.array().cast("array<string>"))
    if fold:
        tokens = F.transform(tokens, F.lower)
    hits = F.filter(tokens, lambda token: token.isin(words)) if words else F.array().cast("array<string>")
    counted = docs.withColumn("_hits", hits).withColumns(
        {name: _occurrences(F.col("_hits"), by_weight[weight]) for weight, name in counters.items()}
    )

    def total(terms: Iterable[Column]) -> Column:
        result = F.lit(0).cast("bigint")
        for term in terms:
            result = result + term
        return result

    return counted.withColumns(
        {
            "score": total(F.col(name) * F.lit(weight).cast("bigint") for weight, name in counters.items()),
            "positive_hits": total(F.col(name) for weight, name in counters.items() if weight > 0),
            "negative_hits": total(F.col(name) for weight, name in counters.items() if weight < 0),
        }
    ).drop("_hits", *counters.values())


# --- bucketed form ----------------------------------------------------------


def lexicon_buckets(lexicon: DataFrame, buckets: int) -> DataFrame:
    """One row, one column: an array of ``buckets`` maps; a term is in the map of its hash."""
    at = F.pmod(F.xxhash64("token"), F.lit(buckets)).alias("id")
    filled = lexicon.groupBy(at).agg(F.collect_list(F.struct("token", "weight")).alias("terms"))
    every = lexicon.sparkSession.range(buckets).join(filled, "id", "left")
    listed = F.array_sort(F.collect_list(F.struct("id", F.coalesce("terms", F.array()).alias("terms"))))
    return every.agg(F.transform(listed, lambda b: F.map_from_entries(b["terms"])).alias("buckets"))


def _weight_in(buckets: Column, word: Column, count: int) -> Column:
    return F.try_element_at(F.get(buckets, F.pmod(F.xxhash64(word), F.lit(count)).cast("int")), word)


def _weight_sums(weights: Column) -> list[Column]:
    """The score columns from a list of weights."""
    return [
        F.aggregate(weights, F.lit(0).cast("bigint"), lambda total, w: total + w).alias("score"),
        F.size(F.filter(weights, lambda w: w > 0)).cast("bigint").alias("positive_hits"),
        F.size(F.filter(weights, lambda w: w < 0)).cast("bigint").alias("negative_hits"),
    ]


def bucketed_scores(docs: DataFrame, lexicon: DataFrame, fold: bool = True) -> DataFrame:
    """Add the score columns to documents with ``tokens``.

    The row of buckets is a scalar subquery, so it is computed once a query (once a
    micro-batch on streams).  Catalyst puts it where it is used, inside the lambda, so
    that no document carries it as a column.  It does so if no column below is used
    twice; hence tokens and their weights come from one expression, with the tokens
    as the only member of a list bound to the lambda's variable.
    """
    buckets = 1 << max(0, (lexicon.count() // 2).bit_length())
    known = docs.select("*", lexicon_buckets(lexicon, buckets).scalar().alias("_buckets"))

    def weight(token: Column) -> Column:
        return _weight_in(F.col("_buckets"), F.lower(token) if fold else token, buckets)

    def weighed(tokens: Column) -> Column:
        weights = F.filter(F.transform(tokens, weight), lambda w: w != 0)
        return F.struct(tokens.alias("tokens"), weights.alias("weights"))

    tokens = F.coalesce(F.col("tokens"), F.array().cast("array<string>"))
    pair = F.transform(F.array(tokens), weighed)[0].alias("_pair")
    paired = known.select(*[name for name in docs.columns if name != "tokens"], pair)
    return paired.select(
        *[F.col("_pair.tokens").alias(name) if name == "tokens" else name for name in docs.columns],
        *_weight_sums(F.col("_pair.weights")),
    )


# --- join forms -------------------------------------------------------------


def _exploded(docs: DataFrame, fold: bool, carry: Iterable[str] = ()) -> DataFrame:
    """One row per token; a document without tokens gives one NULL token.

    ``starts`` marks one row per document, to notice repeated ids.
    """
    rows = docs.select("doc_id", *carry, F.posexplode_outer("tokens").alias("pos", "token"))
    token = F.lower("token") if fold else F.col("token")
    starts = F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, 1).otherwise(0).cast("bigint")
    return rows.select("doc_id", *carry, token.alias("token"), starts.alias("starts"))


def _sum_hits(weighted: DataFrame, carry: Iterable[str] = (), copies: bool = False) -> DataFrame:
    """Scores per document from rows of ``weight``, ``n`` tokens and ``starts``.

    ``carry`` columns depend on the id, so they join the grouping key.  With
    ``copies`` the key holds the text's digest: rows of one key are copies, so
    their sums are exact multiples of one document's numbers.
    """
    zero, n = F.lit(0).cast("bigint"), F.col("n")
    weight = F.coalesce(F.col("weight"), zero)
    key = ["doc_id", *carry]
    sums = {
        "score": F.sum(weight * n),
        "positive_hits": F.sum(F.when(weight > 0, n).otherwise(zero)),
        "negative_hits": F.sum(F.when(weight < 0, n).otherwise(zero)),
        "token_count": F.sum(n),
    }
    if copies:
        summed = weighted.groupBy(*key).agg(*[v.alias(k) for k, v in sums.items()], F.sum("starts").alias("starts"))
        return summed.select(*key, *[F.expr(f"{name} div starts").alias(name) for name in sums])
    message = F.concat(F.lit("doc_id is not unique: "), F.col("doc_id").cast("string"))
    sums["score"] = F.when(F.sum("starts") > 1, F.raise_error(message).cast("bigint")).otherwise(sums["score"])
    return weighted.groupBy(*key).agg(*[v.alias(k) for k, v in sums.items()])


def broadcast_scores(
    docs: DataFrame, lexicon: DataFrame, fold: bool = True, carry: Iterable[str] = (), copies: bool = False
) -> DataFrame:
    """``doc_id``, ``carry``, score columns and ``token_count``.

    Ids must be unique, or with ``copies`` rows equal in id and ``carry`` have
    equal tokens and give one row.  A left join keeps documents without hits, so nothing is joined back.
    """
    carry = list(carry)
    weighted = _exploded(docs, fold, carry).join(
        F.broadcast(lexicon.select("token", "weight")), "token", "left"
    )
    n = F.when(F.col("token").isNotNull(), 1).otherwise(0).cast("bigint")
    return _sum_hits(weighted.withColumn("n", n), carry, copies)


def _blocks(docs: DataFrame, fold: bool, key: list[str]) -> DataFrame:
    """``key``, the tokens, ``_size`` and ``_block`` of every document, written once.

    A block takes rows that follow each other in an input partition and whose
    sizes round up to the same power of two, as many as fit.  The tokens are
    ``joined``, or ``listed`` where there are none or one holds the break itself.
    """
    tokens = F.array_compact(F.coalesce(F.col("tokens"), F.array().cast("array<string>")))
    if fold:
        tokens = F.transform(tokens, F.lower)
    rows = docs.select(*key, tokens.alias("listed"), F.monotonically_increasing_id().alias("_row"))
    joined = rows.withColumn("joined", F.array_join("listed", BREAK))
    size = F.octet_length("joined").cast("bigint")
    breaks = size - F.octet_length(F.replace(F.col("joined"), F.lit(BREAK)))
    sized = joined.select("*", size.alias("_size"), (breaks == F.size("listed") - 1).alias("_plain"))
    power = sized.withColumn("_power", F.ceil(F.log2(F.greatest("_size", F.lit(SMALL).cast("bigint")))).cast("int"))
    fitting = power.withColumn("_fit", F.expr(f"greatest(1, {BLOCK_BYTES} div shiftleft(1L, _power))"))
    # The low 33 bits of a row number count within its partition.
    block = F.expr(f"shiftleft(_row - (_row & {(1 << 33) - 1}) % _fit, 6) | _power").alias("_block")
    lists = [F.when(F.col("_plain"), F.col("joined")).alias("joined"), F.when(~F.col("_plain"), F.col("listed")).alias("listed")]
    return write_once(fitting.select(*key, *lists, "_size", block), "blocks")


def _listed(joined: Column, listed: Column) -> Column:
    return F.coalesce(F.split(joined, BREAK), listed)


def _block_terms(blocks: DataFrame, lexicon: DataFrame, hot_parts: int) -> DataFrame:
    """``_block``, token and weight of the lexicon terms that each block holds; no zero weights."""
    tokens = _listed(F.col("joined"), F.col("listed"))
    held = write_once(blocks.select("_block", F.explode(tokens).alias("token")).distinct(), "block-tokens")
    terms = lexicon.select("token", "weight")

    frequencies = held.groupBy("token").agg(F.count(F.lit(1)).alias("frequency"))
    hot = frequencies.filter(F.col("frequency") * hot_parts > held.count()).select("token")
    hot_terms = F.broadcast(hot.join(terms, "token", "left").withColumn("hot", F.lit(True)))

    marked = held.join(hot_terms, "token", "left")
    here = F.coalesce(F.col("hot"), F.lit(False))
    columns = ["_block", "token", "weight"]
    resolved = marked.filter(here).select(columns)
    looked_up = marked.filter(~here).drop("weight", "hot").join(terms, "token").select(columns)
    return resolved.unionByName(looked_up).filter(F.col("weight") != 0)


def _block_buckets(blocks: DataFrame, terms: DataFrame, parts: int) -> DataFrame:
    """``_block`` and its ``buckets``, an array of small maps; a term is in the map of its hash.

    A row per block that names every bucket makes the arrays dense.
    """
    every = blocks.select("_block").distinct()
    rows = terms.unionByName(every, allowMissingColumns=True).repartition(parts, "_block")
    known = F.col("token").isNotNull()
    at = F.array(F.pmod(F.xxhash64("token"), F.lit(BLOCK_BUCKETS)).cast("int"))
    ids = F.when(known, at).otherwise(F.sequence(F.lit(0), F.lit(BLOCK_BUCKETS - 1)))
    term = F.when(known, F.struct("token", "weight")).alias("term")
    lists = rows.select("_block", F.explode(ids).alias("id"), term).groupBy("_block", "id").agg(
        F.collect_list("term").alias("terms")
    )
    listed = F.array_sort(F.collect_list(F.struct("id", "terms")))
    return lists.groupBy("_block").agg(F.transform(listed, lambda b: F.map_from_entries(b["terms"])).alias("buckets"))


def shuffled_scores(
    docs: DataFrame,
    lexicon: DataFrame,
    fold: bool = True,
    carry: Iterable[str] = (),
    hot_parts: int = HOT_PARTS,
    copies: bool = False,
) -> DataFrame:
    """As ``broadcast_scores`` for a lexicon too large to broadcast.

    No token is shuffled by itself.  The documents are written once, in blocks
    of bounded size, and the distinct tokens of every block get their weights:
    the fewer than ``hot_parts`` hot ones (by rows of that table) by broadcast,
    the others by a shuffled join in which no key is hot.  Blocks and their
    buckets then meet by the number of the block, and each document's tokens
    are looked up there as in the bucketed form.
    """
    key = ["doc_id", *carry]
    blocks = _blocks(docs, fold, key)
    size = blocks.agg(F.sum("_size")).first()[0] or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // PARTITION_BYTES))

    buckets = _block_buckets(blocks, _block_terms(blocks, lexicon, hot_parts), parts)
    listed = blocks.select("_block", F.struct(*key, "joined", "listed").alias("doc")).repartition(parts, "_block")
    together = listed.groupBy("_block").agg(F.collect_list("doc").alias("docs")).join(buckets.hint("shuffle_hash"), "_block")

    def weighed(doc: Column) -> Column:
        tokens = _listed(doc["joined"], doc["listed"])
        weights = F.transform(tokens, lambda token: _weight_in(F.col("buckets"), token, BLOCK_BUCKETS))
        return F.struct(*[doc[name].alias(name) for name in key], weights.alias("weights"))

    scored = together.select(F.explode(F.transform("docs", weighed)).alias("doc")).select(
        *[F.col("doc")[name].alias(name) for name in key],
        *_weight_sums(F.filter("doc.weights", lambda w: w != 0)),
        F.size("doc.weights").cast("bigint").alias("token_count"),
    )
    merged = {name: F.max(name) for name in (*SCORE_COLUMNS, "token_count")}
    if not copies:
        message = F.concat(F.lit("doc_id is not unique: "), F.col("doc_id").cast("string"))
        merged["score"] = F.when(F.count(F.lit(1)) > 1, F.raise_error(message).cast("bigint")).otherwise(merged["score"])
    return scored.groupBy(*key).agg(*[value.alias(name) for name, value in merged.items()])


# --- public transforms ------------------------------------------------------


def score_documents(
    lexicon: DataFrame, form: str = "auto", fold: bool = True
) -> Callable[[DataFrame], DataFrame]:
    """Transform adding score, hit counts and ``predicted_sentiment``.

    A ``label``, where there is one, is added normalized as ``true_label``.
    Use as ``docs.transform(score_documents(lexicon))`` on a frame with
    ``doc_id`` and ``tokens``.  The literal and the bucketed form are stateless
    and also take streams.  Repeated and missing ids are fine in every form: the
    join forms score each distinct list of tokens once and join the scores back on
    it.  The lexicon is checked at the first use.
    """
    checked: list[tuple] = []

    def apply(docs: DataFrame) -> DataFrame:
        if not checked:
            checked.append(checked_lexicon(lexicon, form))
        terms, chosen, weights = checked[0]
        if docs.isStreaming and chosen == "shuffled":
            raise ValueError(f"a stream takes a lexicon of at most {BROADCAST_BYTES} bytes")
        docs = docs.withColumns(
            {
                "doc_id": F.coalesce(F.col("doc_id"), F.lit(-1).cast("bigint")),
                "tokens": F.coalesce(F.col("tokens"), F.array().cast("array<string>")),
            }
        )
        if chosen == "literal":
            scored = literal_scores(docs, weights, fold)
        elif chosen == "bucketed":
            scored = bucketed_scores(docs, terms, fold)
        else:
            scorer = broadcast_scores if chosen == "broadcast" else shuffled_scores
            keyed = docs.withColumn("_key", F.sha2(F.to_json(F.struct("tokens")), 256))
            distinct = keyed.select(F.col("_key").alias("doc_id"), "tokens").dropDuplicates(["doc_id"])
            scores = scorer(distinct, terms, fold).drop("token_count").withColumnRenamed("doc_id", "_key")
            scored = keyed.join(scores, "_key").drop("_key")
        scored = scored.withColumn("predicted_sentiment", score_to_label(F.col("score")))
        if "label" in docs.columns:
            scored = scored.withColumn("true_label", normalize_label(F.col("label").cast("string")))
        return scored

    return apply


def score_corpus(
    docs: DataFrame,
    lexicon: DataFrame,
    form: str = "auto",
    carry: Iterable[str] = (),
    null_policy: str = "nan",
) -> DataFrame:
    """Scores of the unique documents of a raw corpus, as narrow rows.

    The texts are read once and, up to broadcast lexicons, never shuffled: a
    score depends on the text alone, so documents are scored where they are
    read and the copies are merged afterwards on digest, id and numbers.
    ``carry`` names further columns to take from the kept row.

    One row per distinct text in every form, with the lowest id of its copies;
    ids may repeat, and a text without any gets -1.
    """
    carry = list(carry)
    filled = fill_missing_text(docs, null_policy).filter(has_token(F.col("text")))
    lexicon, chosen, weights = checked_lexicon(lexicon, form)
    numbers = [*SCORE_COLUMNS, "token_count"]
    key, tokens = text_key(F.col("text")), text_tokens(F.col("text")).alias("tokens")
    read = filled.select("doc_id", *carry, key.alias("text_key"), tokens)
    if chosen == "shuffled":
        # Copies are scored where they are read; their numbers merge before the join.
        texts = filled.select(key.alias("doc_id"), tokens)
        scores = shuffled_scores(texts, lexicon, fold=False, copies=True).withColumnRenamed("doc_id", "text_key")
        rows = filled.select("doc_id", *carry, key.alias("text_key"))
        unique = keyed_copies(rows, of_first=carry).join(scores, "text_key")
    else:
        sized = read.withColumn("token_count", F.size("tokens").cast("bigint"))
        if chosen == "literal":
            scored = literal_scores(sized, weights, fold=False)
        elif chosen == "bucketed":
            scored = bucketed_scores(sized, lexicon, fold=False)
        else:
            scored = broadcast_scores(read, lexicon, fold=False, carry=["text_key", *carry], copies=True)
        narrow = scored.select("doc_id", "text_key", *numbers, *carry)
        unique = first_copies(narrow, numbers, carry)
    return unique.select(
        F.coalesce("doc_id", F.lit(-1).cast("bigint")).alias("doc_id"),
        *carry,
        *numbers,
        score_to_label(F.col("score")).alias("predicted_sentiment"),
    )


def lexicon_hits(prepared: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Occurrences and documents of every lexicon term found in the corpus.

    A broadcast lexicon filters the tokens where they are; a larger one meets
    the complete counts, one row per token, so that no key is hot.
    """
    terms = lexicon.select("token", "weight")
    # Every token counts as a hit, and once more as a document where it is distinct.
    hits, documents = (
        F.transform(tokens, lambda t: F.struct(t.alias("token"), F.lit(h).alias("hit"), F.lit(d).alias("document")))
        for tokens, h, d in ((F.col("tokens"), 1, 0), (F.array_distinct("tokens"), 0, 1))
    )
    tokens = prepared.select(F.explode_outer(F.concat(hits, documents)).alias("t")).select("t.*")
    small = lexicon_bytes(lexicon) <= BROADCAST_BYTES
    if small:
        tokens = tokens.join(F.broadcast(terms.select("token")), "token", "left_semi")
    counts = tokens.groupBy("token").agg(F.sum("hit").alias("hits"), F.sum("document").alias("documents"))
    counted = counts.join(F.broadcast(terms) if small else terms, "token")
    return counted.select("token", "weight", "hits", "documents")
