"""Cleaning against a plain statement of its rules in Python."""

import re
import string

from pyspark.sql import functions as F

from tonescale.functions import text as T


def plain_clean(text):
    text = "".join(" " if c in string.punctuation else c for c in text.lower())
    return " ".join(re.split(r"\s+", text)).strip()


def test_every_character_between_two_letters(spark):
    # Final sigma and dotted capital I have context-dependent lower case.
    points = [p for p in range(1, 0x3100) if p not in (0x3A3, 0x130, 0x1C89)]
    data = [(p, f"a{chr(p)}b{chr(p)}") for p in points]
    frame = spark.createDataFrame(data, "p int, text string").select(
        "p",
        "text",
        T.clean_text(F.col("text")).alias("cleaned"),
        T.tokenize(T.clean_text(F.col("text"))).alias("tokens"),
        T.text_tokens(F.col("text")).alias("direct"),
    )
    wrong = [
        hex(row.p)
        for row in frame.collect()
        if row.cleaned != plain_clean(row.text)
        or row.tokens != plain_clean(row.text).split()
        or row.direct != row.tokens
    ]
    assert wrong == []


def test_single_characters_blank_or_without_token(spark):
    points = [p for p in range(1, 0x3100)]
    frame = spark.createDataFrame([(p, chr(p)) for p in points], "p int, text string").select(
        "p",
        T.is_blank(F.col("text")).alias("blank"),
        T.has_token(F.col("text")).alias("token"),
        (T.strip(F.col("text")) == "").alias("stripped"),
    )
    for row in frame.collect():
        c = chr(row.p)
        assert row.blank == (c.strip() == ""), hex(row.p)
        assert row.stripped == row.blank
        assert row.token == (plain_clean(c) != ""), hex(row.p)


def test_empty_and_surrounded_texts(spark):
    data = [("",), ("  a  ",), ("...a...",), ("!!!",), ("\n\t",)]
    frame = spark.createDataFrame(data, "text string").select(
        T.clean_text(F.col("text")).alias("cleaned"),
        T.tokenize(T.clean_text(F.col("text"))).alias("tokens"),
        T.text_tokens(F.col("text")).alias("direct"),
    )
    assert [tuple(row) for row in frame.collect()] == [
        ("", [], []),
        ("a", ["a"], ["a"]),
        ("a", ["a"], ["a"]),
        ("", [], []),
        ("", [], []),
    ]


def test_strip_is_linear_on_long_runs_of_spaces(spark):
    inner = "a" + " " * 200_000 + "b"
    frame = spark.createDataFrame([(f"\t {inner} \n",)], "text string")
    assert frame.select(T.strip(F.col("text"))).first()[0] == inner


def test_text_key_is_distinct_and_short(spark):
    frame = spark.createDataFrame([("a",), ("b",), ("a",)], "text string")
    keys = [bytes(r[0]) for r in frame.select(T.text_key(F.col("text"))).collect()]
    assert keys[0] == keys[2] != keys[1] and len(keys[0]) == 32
