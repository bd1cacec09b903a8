"""Record layouts, as DDL, of the tables that the stages hand to each other."""

# The closed set of sentiment classes, in reporting order.
CLASSES = ("positive", "negative", "neutral")


RAW_DOCUMENT = "label string, text string"

TOKEN_RECORD = (
    "doc_id bigint, original_text string, cleaned_text string, "
    "tokens array<string>, label string"
)

LEXICON = "token string, weight bigint"

# Predictions as written by any scoring stage: columns that a stage leaves out
# (hit counts, token counts, labels) read as NULL.
PREDICTION = (
    "doc_id bigint, tokens array<string>, score bigint, positive_hits bigint, "
    "negative_hits bigint, predicted_sentiment string, predicted string, "
    "token_count bigint, true_label string, label string"
)

CHUNK_PARTIAL = (
    "chunk_id bigint, documents bigint, positive bigint, negative bigint, "
    "neutral bigint, evaluated bigint, correct bigint"
)
