"""Personal data in texts: patterns propose, checksums confirm, context scores.

Base kinds are ``email``, ``ip``, ``card`` (Luhn) and ``phone``.  Further kinds
are reported when their score reaches ``LEAST_SCORE``:

* ``iban``: country and check digits pass mod 97.
* ``short_card``: 12 or 13 digits that pass Luhn, near a word about cards.
* ``id_number``: three, two and four digits joined by hyphens, near a word
  about identity numbers.

A score starts at the kind's base and rises with each word of the kind's context
list within ``NEAR`` characters on either side, and falls with words that tell
of other numbers.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from tonescale.llm.spans import find_spans, in_order

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "short_card", "id_number")
NEAR, LEAST_SCORE, STEP = 60, 0.5, 0.25

# The base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SHORT_CARD = re.compile(r"(?<![0-9])[0-9]{12,13}(?![0-9])")
ID_NUMBER = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# Base scores and context words.
SCORES = {"email": 0.75, "ip": 0.5, "card": 0.75, "phone": 0.5, "iban": 0.75, "short_card": 0.3, "id_number": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "debit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "short_card": ("card", "maestro", "credit", "debit", "payment"),
    "id_number": ("ssn", "social", "security", "identity", "tax"),
}
OTHER_NUMBERS = ("order", "invoice", "isbn", "version", "tracking")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of account numbers: country and check digits moved to the end."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def account(found: re.Match) -> tuple[int, int] | None:
    """The longest part of a match, up to a space or its end, that is an account number."""
    text = found[0]
    for end in [len(text), *(i for i in range(len(text) - 1, 14, -1) if text[i] == " ")]:
        code = text[:end].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            return found.start(), found.start() + end
    return None


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: from each @ back to the start of the name, on to the end of the domain."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, free))
        at = text.find("@", max(at + 1, free))
    return found


def score(kind: str, text: str, start: int, end: int) -> float:
    near = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
    words = set(re.findall(r"[^\W\d_]+", near))
    hits = sum(word in words for word in CONTEXT[kind])
    against = sum(word in words for word in OTHER_NUMBERS)
    return round(min(1.0, max(0.0, SCORES[kind] + STEP * hits - STEP * against)), 2)


def pii_spans(text: str) -> list[tuple]:
    """Every (kind, start, end, score) of one text."""
    base = [("email", *span) for span in emails(text)]
    base += [("ip", *m.span()) for m in IP.finditer(text) if all(_octet(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := digits_of(m[0])) <= 19 and luhn(digits):
            base.append(("card", *m.span()))
    base += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    added = [("iban", *span) for m in IBAN.finditer(text) if (span := account(m))]
    added += [("short_card", *m.span()) for m in SHORT_CARD.finditer(text) if luhn(m[0])]
    added += [("id_number", *m.span()) for m in ID_NUMBER.finditer(text) if m[0][:3] not in ("000", "666") and m[0][0] != "9"]
    spans = [(*s, score(s[0], text, s[1], s[2])) for s in base]
    spans += [s for s in ((*a, score(a[0], text, a[1], a[2])) for a in added) if s[3] >= LEAST_SCORE]
    return in_order(spans, KINDS)


def _octet(part: str) -> bool:
    """At most 255, whatever the number of leading zeros."""
    rest = part.lstrip("0")
    return len(rest) < 3 or len(rest) == 3 and int(rest) <= 255


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end, score) of personal data in every whole text.

    One row for each input row, repeated and missing ids included; a missing or
    empty text has no spans.  Base spans always stay; the score ranks them.
    Other columns are ignored.
    """
    return find_spans(docs, pii_spans)
