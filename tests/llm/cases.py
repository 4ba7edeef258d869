"""Shared small inputs: every column nullable, ties, repeats, long and empty texts."""

import re

LONG = " ".join(f"word{i % 977} and" for i in range(60_000))

ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 5),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 5),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 5),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \t\n\x0b ", "en", "b", 0),
    (6, "one", "de", "b", 0),
    (None, "a row that has no id at all but a text of some words", None, "c", 1),
    (7, LONG, "en", "c", 9),
    (8, "Ünïcödé ÄÖÜ straße 東京 é \U0001f600 end", "de", "d", 3),
    (9, "nul \x00 inside, tabs\tand\r\nlines", None, "d", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def odd_docs(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def white_words(text):
    """Words between ASCII blanks, A-Z in lower case, by a path of its own."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)
