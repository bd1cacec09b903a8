"""Secrets in texts: patterns propose, structure confirms.

Base kinds (``assign``, ``access``, ``hex``) are patterns with a least length.
Further kinds are reported only when a decoded candidate has the structure of a
key or a token:

* ``signed_token``: three dotted base64url parts, the first a JSON object
  that names an algorithm, the second a JSON object.
* ``private_key``: a base64 block between BEGIN and END lines, or a bare
  base64 run, that decodes to a private key.
* ``hex_key``: a hex run that decodes to a private key.

A private key is a DER sequence whose nested lengths add up to the whole and
that starts with a version and a key's fields, or the length-prefixed fields of
an SSH key file.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

from pyspark.sql import DataFrame

from tonescale.llm.spans import find_spans, in_order

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "signed_token", "private_key", "hex_key")

# The base patterns with their least lengths.
NAMES = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = re.compile(
    "(" + "|".join(re.sub("[a-z]", lambda c: f"[{c[0]}{c[0].upper()}]", n) for n in NAMES) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")  # whole runs, as greedy matching gives them
LEAST_VALUE, LEAST_ACCESS = 12, 18

TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++")
BLOCK = re.compile(r"-----BEGIN ([A-Z ]{0,40}PRIVATE KEY)-----([A-Za-z0-9+/=\s]{1,100000})-----END \1-----")
RUN64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}+={0,2}+")
RUN16 = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9a-f]{64,}+|[0-9A-F]{64,}+)(?![0-9A-Fa-f])")

SEQUENCE, INTEGER, OCTETS = 0x30, 0x02, 0x04
OPENSSH = b"openssh-key-v1\x00"


def base64_bytes(text: str, url: bool = False) -> bytes | None:
    text = re.sub(r"\s+", "", text).rstrip("=")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def der_fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of DER values that fill ``data`` exactly."""
    at, fields = 0, []
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at : at + width])
            at += width
        if at + size > len(data):
            return None
        fields.append((tag, data[at : at + size]))
        at += size
    return fields


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are one sequence of a version and private key fields."""
    outer = der_fields(data)
    if outer is None or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    inner = der_fields(outer[0][1]) or []
    tags = [tag for tag, _ in inner]
    if len(inner) < 2 or tags[0] != INTEGER or len(inner[0][1]) != 1:
        return False
    if tags.count(INTEGER) >= 5 and set(tags) == {INTEGER}:  # version and the numbers of an RSA or DSA key
        return True
    if tags[1] == OCTETS:  # version and an elliptic curve's secret
        return 16 <= len(inner[1][1]) <= 80
    # version, algorithm, key
    return tags[:3] == [INTEGER, SEQUENCE, OCTETS] and der_fields(inner[1][1]) is not None


def is_ssh_key(data: bytes) -> bool:
    """Whether the bytes are an SSH key file: cipher, derivation, options, count, public and private part."""
    if not data.startswith(OPENSSH):
        return False
    rest = data[len(OPENSSH) :]
    for _ in range(3):
        if len(rest) < 4 or len(rest) < 4 + (size := int.from_bytes(rest[:4])):
            return False
        rest = rest[4 + size :]
    return len(rest) >= 8 and 1 <= int.from_bytes(rest[:4]) <= 16 and int.from_bytes(rest[4:8]) <= len(rest) - 8


def is_key(data: bytes | None) -> bool:
    return data is not None and (is_der_key(data) or is_ssh_key(data))


def json_object(part: str) -> dict | None:
    data = base64_bytes(part, url=True)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: str) -> bool:
    head, body, signature = text.split(".")
    named = json_object(head)
    return bool(named) and isinstance(named.get("alg"), str) and json_object(body) is not None and len(signature) >= 16


def secret_spans(text: str) -> list[tuple]:
    """Every (kind, start, end, score) of one text."""
    spans = [("assign", *m.span(), 0.5) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [("access", *m.span(), 0.9) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [("hex", *m.span(), 0.5) for m in HEX.finditer(text)]
    spans += [("signed_token", *m.span(), 1.0) for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    blocks = [m.span() for m in BLOCK.finditer(text) if is_key(base64_bytes(m[2]))] if "PRIVATE KEY-----" in text else []
    spans += [("private_key", *span, 1.0) for span in blocks]
    for m in RUN64.finditer(text):
        inside = any(a <= m.start() < b for a, b in blocks)
        if not inside and m[0][0] in "Mb" and is_key(base64_bytes(m[0])):  # a sequence tag or an SSH file's first byte
            spans.append(("private_key", *m.span(), 1.0))
    for m in RUN16.finditer(text):
        if len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            spans.append(("hex_key", *m.span(), 1.0))
    return in_order(spans, KINDS)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end, score) of the secrets in every whole text.

    One row for each input row, repeated and missing ids included; a missing or
    empty text has no spans.  Other columns are ignored.
    """
    return find_spans(docs, secret_spans)
