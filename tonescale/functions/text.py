"""Cleaning and tokenizing as JVM-side column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separators.  Whitespace is Unicode whitespace plus the four
# information separators U+001C-U+001F; punctuation is ASCII only, so
# typographic quotes and dashes stay inside tokens.
_PUNCTUATION = "".join("\\" + mark for mark in string.punctuation)
_LATIN_SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
_WIDE_SPACE = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

# Java keeps single Latin-1 characters of a class in one bit set but tests
# ranges one after another.  Guarding the wide characters by one range test
# spares Latin text all of them (about 3x faster over a corpus).
_WIDE_GUARDED = rf"[\x{{100}}-\x{{ffff}}&&[{_WIDE_SPACE}]]"
SPACE_CLASS = f"{_LATIN_SPACE}{_WIDE_GUARDED}"
GAP_CLASS = f"{_PUNCTUATION}{SPACE_CLASS}"

_SPACE_RUN = f"[{SPACE_CLASS}]+"
_GAP_RUN = f"[{GAP_CLASS}]+"
# Entered at the start of a run only and never re-split: linear on long runs.
_LAST_SPACE_RUN = f"(?<![{SPACE_CLASS}])[{SPACE_CLASS}]++"

MISSING_TEXT = "nan"


def text_or_missing(text: Column) -> Column:
    """Text as a string; a missing text counts as the word ``nan``."""
    return F.coalesce(text.cast("string"), F.lit(MISSING_TEXT))


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(text, f"^{_SPACE_RUN}|{_LAST_SPACE_RUN}$", "")


def is_blank(text: Column) -> Column:
    """True for texts of whitespace only."""
    return ~text.rlike(f"[^{SPACE_CLASS}]")


def has_token(text: Column) -> Column:
    """True when the text holds a token.

    Equals "the cleaned text is not empty", but stops at the first token
    character, so filtering by it costs no cleaning wherever Catalyst puts it.
    """
    return text.rlike(f"[^{GAP_CLASS}]")


def clean_text(text: Column) -> Column:
    """Lower-case, with every run of punctuation and whitespace as one space."""
    return F.trim(F.regexp_replace(F.lower(text), _GAP_RUN, " "))


def tokenize(cleaned: Column) -> Column:
    """Words of a cleaned text; an empty text has none."""
    return F.array_remove(F.split(cleaned, " "), "")


def text_tokens(text: Column) -> Column:
    """``tokenize(clean_text(text))`` in one regex pass."""
    return F.array_remove(F.split(F.lower(text), _GAP_RUN), "")


def text_key(text: Column) -> Column:
    """32-byte digest standing for a text of any length in shuffles."""
    return F.unhex(F.sha2(text, 256))
