"""Brute-force versions and hard small tables for the operators' tests."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: doc_id, text, lang, source: nulls, empty and blank texts, repeated rows, ties, controls, long words.
HARD = [
    (1, "the quick brown fox jumps over the lazy dog again", "en", "a"),
    (2, "The Quick brown fox jumps over the lazy dog again", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \t\r\n ", "en", None),
    (6, "one two", "de", "b"),
    (7, "one  two", "de", "b"),
    (8, "é日本\U0001f44d ▁ \x00 x" * 3, "fr", "c"),
    (9, "w" * 5000, "en", "a"),
    (9, "w" * 5000, "en", "a"),
    (10, "a b c d e\n" * 40 + "tail", "en", "a"),
    (11, "\n\nline\nline\n line\nline", None, "d"),
]


def frame(spark, rows=HARD, extra: bool = True):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    if extra:  # names that operators use inside
        df = df.selectExpr("*", "doc_id AS node", "'x' AS digest", "1 AS uid", "2 AS size", "'k' AS salt", "'y' AS kept")
    return df


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})
