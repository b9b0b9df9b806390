"""Spelling variants against the comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import spelling
from tests.llm.cases import empty, lower, table

LETTERS = "abcdeéÿÀ"


def words_of(rows, noise):
    seen = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", lower(text)):
            crc = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and crc % noise == 0:
                run = run[: crc % len(run)] + run[crc % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(seen, times=10):
    out, forms = [], {}
    near = {w: [v for v in seen if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in seen}
    for w, others in near.items():
        best = min(others, key=lambda v: (-seen[v], v), default=None)
        forms[w] = best if best and seen[best] >= times * seen[w] else None
    for w, form in forms.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, form, root, seen[w], len(near[w]), form and seen[form]))
    return sorted(out)


def got(df, **options):
    return sorted(tuple(r) for r in spelling.spelling_groups(df, **options).collect())


def some_words(count, letters=LETTERS, lengths=(6, 7, 8, 9), seed=1):
    """Words close to each other: every one is an earlier one with a few letters changed."""
    draw = random.Random(seed)
    words = ["".join(draw.choice(letters) for _ in range(8))]
    while len(words) < count:
        word = list(draw.choice(words[-40:]))
        for _ in range(draw.randrange(1, 3)):
            at = draw.randrange(len(word))
            word[at : at + draw.randrange(2)] = draw.choices(letters, k=draw.randrange(2))
        words.append("".join(word) if len(word) in lengths else "".join(draw.choice(letters) for _ in range(8)))
    return words


def documents(words, seed=2):
    draw = random.Random(seed)
    rows = [(i % 50, w) for i, w in enumerate(words) for _ in range(draw.choice([1, 2, 2, 3, 30, 400]))]
    draw.shuffle(rows)
    texts = {}
    for doc, w in rows:
        texts.setdefault(doc, []).append(draw.choice([w, w, lower(w).upper() if lower(w).upper().lower() == w else w]))
    return [(doc, draw.choice([" ", "-", "7", "字", "\n"]).join(ws)) for doc, ws in texts.items()]


@pytest.mark.parametrize(("group", "zone"), [(3, 64), (50, 2)])
def test_all_words(spark, monkeypatch, group, zone):
    """Also with groups so small and zones so short that they are cut again and again."""
    monkeypatch.setattr(spelling, "GROUP", group)
    monkeypatch.setattr(spelling, "ZONE", zone)
    rows = documents(some_words(500))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = brute(words_of(rows, 31))
    assert got(df, noise=31) == expected
    assert sum(r[4] for r in expected) > 300 and sum(r[1] is not None for r in expected) > 20


def test_pairs_come_once(spark):
    words = sorted({w for w in some_words(400, "ab", range(7, 12)) if len(w) >= 7})
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    found = [(r["a"], r["b"]) for r in spelling.near_pairs(df).collect()]
    assert sorted(found) == sorted((a, b) for a in words for b in words if a != b and one_edit(a, b))


def test_odd_rows(spark):
    rows = [tuple(r) for r in table(spark).select("doc_id", "text").collect()]
    for noise in (0, 3):
        assert got(table(spark), noise=noise) == brute(words_of(rows, noise))
    assert got(empty(spark)) == []
    assert got(table(spark, [None, "", "short words", "singleton"], repeated=False)) == []


def test_ties_and_chains(spark):
    texts = {"abcdefg": 2, "abcdefgh": 20, "abcdefgz": 20, "abcdefghi": 300, "xbcdefghi": 2999, "xbcdefghij": 29990}
    df = spark.createDataFrame([(1, " ".join([w] * n)) for w, n in texts.items()], "doc_id long, text string")
    assert got(df) == brute(texts) == [
        ("abcdefg", "abcdefgh", "abcdefghi", 2, 2, 20),
        ("abcdefgh", "abcdefghi", "abcdefghi", 20, 3, 300),
        ("abcdefghi", None, "abcdefghi", 300, 2, None),
        ("abcdefgz", None, "abcdefgz", 20, 2, None),
        ("xbcdefghi", "xbcdefghij", "xbcdefghij", 2999, 2, 29990),
        ("xbcdefghij", None, "xbcdefghij", 29990, 1, None),
    ]


def test_very_long_words(spark):
    base = "".join(random.Random(3).choice("abcdefé") for _ in range(5000))
    words = [base, base[:2500] + "x" + base[2501:], base[:10] + base[11:], base + "z", base[:100] + "yy" + base[102:]]
    rows = [(i, f"{w} {w}") for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, noise=2) == brute(words_of(rows, 2))


def test_sums_of_runs():
    raw = np.frombuffer("abcé".encode() * 40, dtype=np.uint8)
    starts, ends = np.array([0, 3, 7, 50, 9]), np.array([3, 3, 150, 51, 74])
    sums = spelling._crcs(raw, starts, ends, np.array([zlib.crc32(b"7:")] * 5, dtype=np.uint32))
    assert sums.tolist() == [zlib.crc32(b"7:" + raw[s:e].tobytes()) for s, e in zip(starts, ends)]
    assert spelling._crcs(raw, starts[:0], ends[:0], np.zeros(0, np.uint32)).tolist() == []


def test_no_key_is_computed_per_pair(spark):
    words = spark.createDataFrame([("abcdefgh", 2)], "word string, n long")
    assert spelling.groups(words).count() == 0
    assert spelling.near_pairs(words).select(F.count("*")).first()[0] == 0
