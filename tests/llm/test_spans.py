"""Secrets and personal data: base spans against plain patterns, added spans by construction."""

import base64
import hashlib
import json
import random
import re

import pytest

from tonescale.llm import pii, secrets
from tonescale.llm.spans import digest_columns


def plain_secrets(text):
    assign = r"""(?:(?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [("assign", *m.span()) for m in re.finditer(assign, text) if len(m[1]) >= 12]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(spans + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16], key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def plain_pii(text):
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def random_text(letters):
    return "".join(random.choices(letters, k=random.randint(0, 40)))


def test_base_spans_equal_plain_patterns():
    random.seed(3)
    words = ["token", "secret", "PassWord", "api_key", "apikey", "AKIA", "=", ":", '"', " ", "abcdef0123456789", "Q", "Zz9+/", "-", ".", "_", "é🙂", "ſecret"]
    for _ in range(3000):
        text = random_text(words)
        assert [s[:3] for s in secrets.secret_spans(text) if s[0] in secrets.BASE] == plain_secrets(text)
    parts = ["a", "@", ".", "b-", "12", "4111111111111111", "255", "256", "+1", "(", ") ", "-", " ", "é", "%", "0001", "7"]
    for _ in range(5000):
        text = random_text(parts)
        assert [s[:3] for s in pii.pii_spans(text) if s[0] in pii.BASE] == plain_pii(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1 " * 100_000, "token=" * 50_000, "A" * 200_000):
        secrets.secret_spans(text)
        pii.pii_spans(text)


def der(tag, data):
    size = len(data)
    head = bytes([size]) if size < 128 else bytes([0x82]) + size.to_bytes(2)
    return bytes([tag]) + head + data


KEY = der(0x30, der(2, b"\x00") + b"".join(der(2, bytes(range(1, 65))) for _ in range(8)))


@pytest.mark.parametrize("data, good", [(KEY, True), (KEY[:-1], False), (KEY + b"x", False), (der(0x30, der(4, b"x" * 90)), False)])
def test_keys_need_nested_lengths(data, good):
    text = "see " + base64.b64encode(data).decode() + " end"
    assert ("private_key" in {s[0] for s in secrets.secret_spans(text)}) is good
    assert ("hex_key" in {s[0] for s in secrets.secret_spans("x " + data.hex() + " y")}) is good
    block = "-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(data).decode() + "-----END RSA PRIVATE KEY-----"
    assert [s[1:3] for s in secrets.secret_spans("é" + block) if s[0] == "private_key"] == ([(1, 1 + len(block))] if good else [])


def test_signed_tokens_need_a_header():
    part = lambda v: base64.urlsafe_b64encode(json.dumps(v).encode()).decode().rstrip("=")
    good = f"{part({'alg': 'HS256'})}.{part({'sub': 1})}.{'s' * 43}"
    bad = f"{part({'typ': 'x'})}.{part({'sub': 1})}.{'s' * 43}"
    assert [s[1:3] for s in secrets.secret_spans("a " + good) if s[0] == "signed_token"] == [(2, 2 + len(good))]
    assert not [s for s in secrets.secret_spans("a " + bad) if s[0] == "signed_token"]


def test_checksums_and_context():
    kinds = lambda t: {s[0] for s in pii.pii_spans(t)}
    assert "iban" in kinds("pay to DE89 3704 0044 0532 0130 00 NOW")
    assert "iban" not in kinds("pay to DE88 3704 0044 0532 0130 00")
    assert "id_number" in kinds("my social security no 123-45-6789") and "id_number" not in kinds("part 123-45-6789")
    assert "short_card" in kinds("credit card 4222222222222") and "short_card" not in kinds("nr 4222222222222")
    near = {s[0]: s[3] for s in pii.pii_spans("credit card 4111 1111 1111 1111")}
    far = {s[0]: s[3] for s in pii.pii_spans("order 4111 1111 1111 1111")}
    assert near["card"] > far["card"]


@pytest.mark.parametrize("find, base", [(secrets.find_secrets, secrets.BASE), (pii.find_pii, pii.BASE)])
def test_rows(spark, find, base):
    text = "é token = abcdef0123456789 mail a.b@c.de +1 (743) 555-3824"
    data = [(1, text, 1), (1, text, 1), (None, text, None), (2, None, 2), (3, "", 3), (4, "w " * 100_000 + text, 4)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, spans int")
    found = digest_columns(find(docs), base).collect()
    plain = plain_secrets if base == secrets.BASE else plain_pii
    for row in found:
        source = next((t or "") for i, t, _ in data if i == row.doc_id)
        spans = plain(source)
        assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in base] == [sum(s[0] == k for s in spans) for k in base]
    assert sorted(map(repr, (r.doc_id for r in found))) == sorted(repr(i) for i, _, _ in data)
    assert digest_columns(find(docs.limit(0)), base).count() == 0
