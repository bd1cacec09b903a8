"""SQL statements of the registered queries, written independently of Spark."""

from __future__ import annotations

from tonescale.plans.inputs import REVISED_LEXICON, TEST_LEXICON
from tonescale.plans.queries import CHUNK_SIZE
from tonescale.schemas import CLASSES

_WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def _strip(text: str) -> str:
    return rf"regexp_replace({text}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def _values(lexicon: dict[str, int]) -> str:
    return ", ".join(f"('{word}', {weight})" for word, weight in lexicon.items())


_DOCS = r"docs AS (SELECT doc_id, coalesce(text, 'nan') AS text, lang FROM documents)"
_TURNS = (
    "docs AS (SELECT row_number() OVER (ORDER BY conv_id, turn) AS doc_id, "
    "coalesce(text, 'nan') AS text, role FROM conversations)"
)
_KEPT = rf"""
kept AS (
  SELECT * FROM docs WHERE regexp_matches(text, '[^{_WS}]')
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1)"""


def _cleaned(source: str) -> str:
    return rf"""
cleaned AS (
  SELECT *, trim(regexp_replace(regexp_replace(lower(text), '[[:punct:]]', ' ', 'g'),
                                '[{_WS}]+', ' ', 'g')) AS cleaned_text
  FROM {source}),
prepared AS (
  SELECT *, string_split(cleaned_text, ' ') AS tokens FROM cleaned WHERE cleaned_text <> ''),
words AS (
  SELECT doc_id, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos FROM prepared)"""


def _scored(name: str, lexicon: str) -> str:
    return rf"""
{name}_lexicon AS ({lexicon}),
{name}_sums AS (
  SELECT w.doc_id, sum(l.weight)::BIGINT AS score,
         count(*) FILTER (l.weight > 0) AS positive_hits,
         count(*) FILTER (l.weight < 0) AS negative_hits
  FROM words w JOIN {name}_lexicon l ON w.token = l.token GROUP BY w.doc_id),
{name} AS (
  SELECT p.* EXCLUDE (text, cleaned_text, tokens), len(p.tokens) AS token_count,
         coalesce(s.score, 0) AS score,
         coalesce(s.positive_hits, 0) AS positive_hits,
         coalesce(s.negative_hits, 0) AS negative_hits,
         CASE WHEN s.score > 0 THEN 'positive' WHEN s.score < 0 THEN 'negative'
              ELSE 'neutral' END AS predicted_sentiment
  FROM prepared p LEFT JOIN {name}_sums s ON p.doc_id = s.doc_id)"""


def _lexicon(weights: dict[str, int]) -> str:
    return f"SELECT * FROM (VALUES {_values(weights)}) AS t(token, weight)"


_PREPARED = f"WITH {_DOCS}, {_KEPT}, {_cleaned('kept')}"
_TRUTH = """
truth AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
                      WHEN quality = 0 THEN 'neutral' END AS label
  FROM labels)"""
_JUDGED = f"""{_PREPARED}, {_scored('scored', _lexicon(TEST_LEXICON))}, {_TRUTH},
judged AS (
  SELECT s.*, t.label, t.label = s.predicted_sentiment AS is_correct
  FROM scored s LEFT JOIN truth t ON s.doc_id = t.doc_id)"""
_CHUNKED = f"""{_JUDGED},
chunked AS (
  SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // {CHUNK_SIZE} AS chunk_id FROM judged)"""
_MATRIX = f"""{_JUDGED},
classes AS (SELECT unnest(['positive', 'negative', 'neutral']) AS label),
matrix AS (
  SELECT t.label AS true_label, p.label AS predicted_sentiment, count(j.doc_id) AS n
  FROM classes t CROSS JOIN classes p
  LEFT JOIN judged j ON j.label = t.label AND j.predicted_sentiment = p.label
  GROUP BY ALL)"""

_CLASS_COUNTS = """
  count(*) FILTER (predicted_sentiment = 'positive') AS positive{0},
  count(*) FILTER (predicted_sentiment = 'negative') AS negative{0},
  count(*) FILTER (predicted_sentiment = 'neutral') AS neutral{0}"""
_BATCH = "count(*) AS documents," + _CLASS_COUNTS.format("")
_TOTAL = "count(*) AS documents_count," + _CLASS_COUNTS.format("_documents")
_ACCURACY = """round(count(*) FILTER (is_correct)::DOUBLE / nullif(count(label), 0), 4) AS accuracy"""
_SCORES = "doc_id, score, positive_hits, negative_hits, predicted_sentiment"
_LABELED = f"WITH {_TRUTH} SELECT d.doc_id, t.label, d.text FROM documents d LEFT JOIN truth t ON d.doc_id = t.doc_id"
_SUMMARY = f"{_JUDGED} SELECT {_TOTAL}, count(label) AS evaluated_documents, {_ACCURACY}"
_RANKED = """
  SELECT token, count(*) AS frequency, min(row(doc_id, pos)) AS first_seen FROM words GROUP BY token"""

_RATES = f"""{_MATRIX},
totals AS (
  SELECT c.label,
         sum(n) FILTER (true_label = c.label AND predicted_sentiment = c.label) AS hits,
         sum(n) FILTER (predicted_sentiment = c.label) AS predicted,
         sum(n) FILTER (true_label = c.label) AS actual
  FROM classes c CROSS JOIN matrix GROUP BY c.label),
rates AS (
  SELECT label, round(hits::DOUBLE / nullif(predicted, 0), 4) AS precision,
         round(hits::DOUBLE / nullif(actual, 0), 4) AS recall, actual::BIGINT AS support
  FROM totals),
metrics AS (
  SELECT label, precision, recall,
         round(2 * precision * recall / nullif(precision + recall, 0), 4) AS f1, support
  FROM rates)"""
_METRICS = f"""{_SUMMARY}, count(*) FILTER (is_correct) AS correct_predictions,
  round(sum(token_count)::DOUBLE / count(*), 2) AS avg_tokens_per_document,
  round(sum(score)::DOUBLE / count(*), 4) AS avg_score
FROM judged"""
_TOTALS = """
  count(*) AS documents_count,
  sum(len(tokens))::BIGINT AS total_tokens,
  (SELECT count(DISTINCT token) FROM words) AS unique_tokens,
  coalesce(round(sum(len(tokens))::DOUBLE / nullif(count(*), 0), 2), 0.0) AS avg_tokens_per_document"""
_NESTED = ", ".join(
    [
        f"(SELECT {measure} FROM metrics WHERE label = '{name}') AS {name}_{measure}"
        for name in CLASSES
        for measure in ("precision", "recall", "f1", "support")
    ]
    + [
        f"(SELECT n FROM matrix WHERE true_label = '{true}' AND predicted_sentiment = '{predicted}') "
        f"AS {true}_as_{predicted}"
        for true in CLASSES
        for predicted in CLASSES
    ]
)

_GAPPY = r"""docs AS (
  SELECT doc_id, lang, {0} AS text
  FROM (SELECT doc_id, lang, CASE WHEN doc_id % 5 = 0 THEN NULL
                                  WHEN doc_id % 10 = 1 THEN regexp_extract(text, '[ \t\r\n]+')
                                  WHEN doc_id % 10 = 6 THEN regexp_extract(text, '[!-/:-@]+')
                                  ELSE text END AS gap FROM documents) {1})"""
_FILLED = _GAPPY.format("coalesce(gap, 'nan')", "")
_DROPPED = _GAPPY.format("gap", "WHERE gap IS NOT NULL")
_COUNTERS = rf"""
        SELECT (SELECT count(*) FROM docs) AS rows_in,
               (SELECT count(*) FROM docs WHERE NOT regexp_matches(text, '[^{_WS}]')) AS blank_removed,
               (SELECT count(*) FROM docs WHERE regexp_matches(text, '[^{_WS}]'))
                 - (SELECT count(*) FROM kept) AS duplicates_removed,
               (SELECT count(*) FROM kept) - (SELECT count(*) FROM prepared) AS empty_removed,
               (SELECT count(*) FROM prepared) AS rows_out"""
# Stored records: ids of every seventh and tokens of every eleventh are missing.
_STORED = f"""{_JUDGED},
stored AS (
  SELECT CASE WHEN doc_id % 7 = 0 THEN -1 ELSE doc_id END AS doc_id,
         CASE WHEN doc_id % 11 = 0 THEN 0 ELSE score END AS score,
         CASE WHEN doc_id % 11 = 0 THEN 0 ELSE positive_hits END AS positive_hits,
         CASE WHEN doc_id % 11 = 0 THEN 0 ELSE negative_hits END AS negative_hits,
         CASE WHEN doc_id % 11 = 0 THEN 'neutral' ELSE predicted_sentiment END AS predicted_sentiment,
         CASE WHEN doc_id % 11 = 0 THEN 0 ELSE token_count END AS token_count
  FROM scored)"""

ORACLES: dict[str, str] = {
    "sentiment_summary": f"{_SUMMARY}, {len(TEST_LEXICON)}::BIGINT AS lexicon_terms FROM judged",
    "dedup_documents": f"WITH {_DOCS}, {_KEPT} SELECT doc_id, length(text) AS n_chars FROM kept",
    "clean_documents": f"{_PREPARED} SELECT doc_id, cleaned_text FROM prepared",
    "tokenize_documents": f"""{_PREPARED}
        SELECT doc_id, len(tokens) AS token_count, array_to_string(tokens, ' ') AS tokens_joined
        FROM prepared""",
    "preprocess_counters": f"""{_PREPARED}
        SELECT (SELECT count(*) FROM docs) AS rows_in,
               (SELECT count(*) FROM docs WHERE NOT regexp_matches(text, '[^{_WS}]')) AS blank_removed,
               (SELECT count(*) FROM docs WHERE regexp_matches(text, '[^{_WS}]'))
                 - (SELECT count(*) FROM kept) AS duplicates_removed,
               (SELECT count(*) FROM kept) - (SELECT count(*) FROM prepared) AS empty_removed,
               (SELECT count(*) FROM prepared) AS rows_out""",
    "preview_documents": f"{_PREPARED} SELECT doc_id, cleaned_text FROM prepared ORDER BY doc_id LIMIT 5",
    "numbered_turns": """
        SELECT conv_id, turn, role, row_number() OVER (ORDER BY conv_id, turn) AS doc_id
        FROM conversations""",
    "vocabulary": f"{_PREPARED} SELECT token, count(*) AS frequency FROM words GROUP BY token",
    "ranked_vocabulary": f"""{_PREPARED}, ranked AS ({_RANKED}),
        named AS (SELECT token, frequency, first_seen[1] AS first_doc, first_seen[2] AS first_pos FROM ranked)
        SELECT * FROM named""",
    "top_words": f"""{_PREPARED}, ranked AS ({_RANKED})
        SELECT row_number() OVER (ORDER BY frequency DESC, first_seen) AS rank, token, frequency
        FROM ranked QUALIFY rank <= 20""",
    "corpus_summary": f"{_PREPARED} SELECT {_TOTALS} FROM prepared",
    "lexicon_terms": f"""{_PREPARED}, lexicon AS ({_lexicon(TEST_LEXICON)})
        SELECT l.token, l.weight::BIGINT AS weight, count(w.doc_id) AS frequency
        FROM lexicon l LEFT JOIN words w ON l.token = w.token GROUP BY ALL""",
    "lexicon_hits": f"""{_PREPARED}, lexicon AS ({_lexicon(TEST_LEXICON)})
        SELECT l.token, l.weight::BIGINT AS weight, count(*) AS hits,
               count(DISTINCT w.doc_id) AS documents
        FROM lexicon l JOIN words w ON l.token = w.token GROUP BY ALL""",
    "scored_documents": f"{_JUDGED} SELECT {_SCORES} FROM scored",
    "scored_documents_join": f"{_JUDGED} SELECT {_SCORES} FROM scored",
    **dict.fromkeys(
        ("scored_documents_bucketed", "scored_documents_shuffled"),
        f"""{_PREPARED},
        {_scored('scored', 'SELECT DISTINCT token, length(token) % 5 - 2 AS weight FROM words')}
        SELECT {_SCORES} FROM scored""",
    ),
    "mapper_results": f"""{_JUDGED}
        SELECT doc_id, token_count, score, predicted_sentiment, label AS true_label FROM judged""",
    "reducer_summary": f"{_JUDGED} SELECT {_TOTAL}, {_ACCURACY} FROM judged",
    "reducer_summary_any_label": f"""{_JUDGED}
        SELECT {_TOTAL}, round(count(*) FILTER (is_correct)::DOUBLE / count(*), 4) AS accuracy
        FROM judged""",
    "chunk_summary": f"{_CHUNKED} SELECT chunk_id, {_BATCH} FROM chunked GROUP BY chunk_id",
    "merged_summary": f"{_SUMMARY} FROM judged",
    "sentiment_by_lang": f"{_JUDGED} SELECT lang, {_BATCH} FROM scored GROUP BY lang",
    "sentiment_by_role": f"""WITH {_TURNS}, {_KEPT}, {_cleaned('kept')},
        {_scored('scored', _lexicon(TEST_LEXICON))}
        SELECT role, {_BATCH} FROM scored GROUP BY role""",
    "streamed_summary": f"""WITH {_DOCS}, {_cleaned('docs')},
        {_scored('scored', _lexicon(TEST_LEXICON))}
        SELECT {_TOTAL}, 0::BIGINT AS evaluated_documents, NULL::DOUBLE AS accuracy FROM scored""",
    "reconcile_scores": f"""{_PREPARED}, {_scored('l', _lexicon(TEST_LEXICON))},
        {_scored('r', _lexicon(REVISED_LEXICON))}
        SELECT coalesce(l.doc_id, r.doc_id) AS doc_id, l.score AS left_score, r.score AS right_score,
               l.predicted_sentiment AS left_label, r.predicted_sentiment AS right_label
        FROM l FULL JOIN r ON l.doc_id = r.doc_id
        WHERE l.score IS DISTINCT FROM r.score
           OR l.predicted_sentiment IS DISTINCT FROM r.predicted_sentiment""",
    "reconcile_forms": f"""{_JUDGED}
        SELECT l.doc_id, l.score AS left_score, r.score AS right_score,
               l.predicted_sentiment AS left_label, r.predicted_sentiment AS right_label
        FROM scored l JOIN scored r ON l.doc_id = r.doc_id WHERE l.score <> r.score""",
    "validated_predictions": f"""{_JUDGED}
        SELECT doc_id, predicted_sentiment, score, token_count, label AS true_label, is_correct
        FROM judged""",
    "confusion_matrix": f"{_MATRIX} SELECT true_label, predicted_sentiment, n FROM matrix",
    "class_metrics": f"{_RATES} SELECT * FROM metrics",
    "metrics_summary": _METRICS,
    "csv_documents": f"""WITH labeled AS ({_LABELED})
        SELECT row_number() OVER (ORDER BY doc_id) AS doc_id, label, text FROM labeled""",
    "json_documents": _LABELED,
    "jsonl_documents": _LABELED,
    "text_documents": rf"""
        WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
        stripped AS (SELECT {_strip('line')} AS text FROM lines)
        SELECT text, count(*) AS lines FROM stripped WHERE text <> '' GROUP BY text""",
    "token_records": rf"""{_PREPARED}, {_TRUTH}
        SELECT p.doc_id, {_strip('p.text')} AS stripped_text, p.cleaned_text,
               array_to_string(p.tokens, ' ') AS tokens_joined, t.label
        FROM prepared p LEFT JOIN truth t ON p.doc_id = t.doc_id""",
    "cleaned_dataset": f"""{_PREPARED}
        SELECT doc_id, text, array_to_string(tokens, ' ') AS tokens_joined, len(tokens) AS token_count
        FROM prepared""",
    "top_words_csv": f"""{_PREPARED}, ranked AS ({_RANKED})
        SELECT row_number() OVER (ORDER BY frequency DESC, first_seen) AS rank, token, frequency
        FROM ranked""",
    "corpus_report": f"""{_PREPARED}, ranked AS ({_RANKED}),
        top AS (SELECT *, row_number() OVER (ORDER BY frequency DESC, first_seen) AS rank FROM ranked)
        SELECT 'text' AS text_column, {_TOTALS},
               (SELECT string_agg(token || ':' || frequency, ' ' ORDER BY rank)
                FROM top WHERE rank <= 20) AS top_20_words
        FROM prepared""",
    "metrics_report": f"""{_RATES}
        SELECT count(*) AS documents_count, {_ACCURACY},
               round(sum(score)::DOUBLE / count(*), 4) AS avg_score, {_NESTED}
        FROM judged""",
    "scored_records": f"""{_JUDGED}
        SELECT s.* EXCLUDE (lang, token_count), array_to_string(p.tokens, ' ') AS tokens_joined
        FROM scored s JOIN prepared p ON s.doc_id = p.doc_id""",
    "validated_records": _METRICS,
    "json_column_documents": _LABELED,
    "parquet_documents": _LABELED,
    "gappy_counters": f"WITH {_FILLED}, {_KEPT}, {_cleaned('kept')} {_COUNTERS}",
    "gappy_documents": f"""WITH {_FILLED}, {_KEPT}, {_cleaned('kept')}
        SELECT doc_id, cleaned_text, len(tokens) AS token_count FROM prepared""",
    "gappy_documents_dropped": f"""WITH {_DROPPED}, {_KEPT}, {_cleaned('kept')},
        {_scored('scored', _lexicon(TEST_LEXICON))} SELECT {_SCORES} FROM scored""",
    "stored_record_scores": f"{_STORED} SELECT {_SCORES}, token_count FROM stored",
    "listed_record_summary": f"""{_STORED}
        SELECT {_TOTAL}, 0::BIGINT AS evaluated_documents, NULL::DOUBLE AS accuracy FROM stored""",
    "listed_predictions": f"""{_JUDGED}
        SELECT doc_id, predicted_sentiment, score, token_count, label AS true_label, is_correct
        FROM judged""",
    "lexicon_file_summary": f"{_SUMMARY}, {len(TEST_LEXICON)}::BIGINT AS lexicon_terms FROM judged",
    "suffix_documents": "SELECT doc_id, text FROM documents",
    "vocabulary_file": f"""{_PREPARED}, ranked AS ({_RANKED})
        SELECT row_number() OVER (ORDER BY frequency DESC, first_seen) AS rank, token, frequency
        FROM ranked""",
    "reducer_reports": f"""{_JUDGED}
        SELECT 'labeled' AS kind, {_TOTAL}, {_ACCURACY}, 1::BIGINT AS accuracies FROM judged
        UNION ALL
        SELECT 'unlabeled' AS kind, {_TOTAL}, NULL::DOUBLE AS accuracy, 0::BIGINT AS accuracies FROM scored""",
    "chunk_documents": f"""{_CHUNKED} SELECT chunk_id, {_SCORES} FROM chunked""",
}
# Stored state and stored scorings give what a full run gives.
ORACLES |= {
    "batched_vocabulary": ORACLES["ranked_vocabulary"],
    "batched_summary": ORACLES["corpus_summary"],
    "batched_sentiment": ORACLES["merged_summary"],
    "reconcile_stored": ORACLES["reconcile_scores"],
}
