"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing column names."""

import re

from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet " * 4000
PASSAGE = " ".join(f"word{i} and some more text number {i * 7 % 13}" for i in range(30))
ODD = [
    None,
    "",
    "   ",
    " a",
    "b ",
    "two  blanks   and\n\n\nlines\t\ttabs ",
    "it's we're THEY'LL 'tis",
    "naïve Übergröße ΣΊΣΥΦΟΣ ΟΔΟΣ İstanbul ﬁn é é",
    "emoji 😀👩‍👩‍👧 中文字符 日本語テキスト 한국어",
    "a<|endoftext|>b <|startoftext|> <|endoftext|>",
    "12345 3.14 1,000,000 x1y2z3",
    "!!! ??? --- ... ,,, word, word. word.\nNext line. next",
    " non breaking spaces\r\nwindows\u0001\u0000nul",
    "x" * 3000,
    LONG,
    PASSAGE,
    PASSAGE,
    "other words first. " + PASSAGE + " and others after.",
    "call +1 (988) 555-2485 or mail a.b@c.de, 10.0.0.1 card 4041894974608795",
]
NAMES = "id n key mark value sketch component found packed counts gold q cell vector ids words items span row pii t m_ip at host".split()


def table(spark, texts=ODD, repeated=True):
    """doc_id and text of ``texts``, a row without id, a repeated row, and columns named like internal ones."""
    rows = list(enumerate(texts)) + [(None, "row without id")] + ([(3, texts[3])] if repeated and len(texts) > 3 else [])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, F.xxhash64("text"))
    return df.select("*", *(F.lit(None if i % 2 else "x").cast("string").alias(name) for i, name in enumerate(NAMES)))


def empty(spark):
    return table(spark).where("false")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
