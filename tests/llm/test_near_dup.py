"""Near duplicates against the comparison of all pairs."""

import random
import re

import numpy as np
import pytest

import __spark_entry__ as entry
from ledgerline.llm import components as component_rounds
from ledgerline.llm import linking, near_dup
from ledgerline.llm.components import components
from ledgerline.llm.queries import documents
from tests.conftest import SF
from tests.llm.cases import empty, lower, table


def brute(rows, size, percent):
    """(number of shingles, smallest id reachable) by row index; rows of one id belong together."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set())
    up = {i: i for i, _ in rows if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and None not in (rows[i][0], rows[j][0]):
                both = len(a & sets[j])
                if 100 * both >= percent * (len(a) + len(sets[j]) - both):
                    x, y = sorted((top(rows[i][0]), top(rows[j][0])))
                    up[y] = x
    return sorted((i, len(s), None if i is None else top(i), i is None or top(i) == i) for (i, _), s in zip(rows, sets) if i is not None)


def same(df, rows, size=2, percent=80):
    got = [tuple(r) for r in near_dup.near_duplicates(df, size=size, percent=percent).collect()]
    assert sorted(r for r in got if r[0] is not None) == brute(rows, size, percent)
    return got


def test_odd_rows(spark):
    df = table(spark)
    got = same(df, [tuple(r) for r in df.select("doc_id", "text").collect()])
    assert (None, 2, None, True) in got
    assert near_dup.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("size", [2, 5])
def test_chains_and_groups(spark, size):
    random_ = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(8):
        text = [random_.choice(vocabulary) for _ in range(random_.choice([3, 5, 6, 12, 60, 150]))]
        for _ in range(random_.randrange(1, 30)):  # every copy changes the last one a little
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            for _ in range(random_.randrange(0, 1 + len(text) // 14)):
                text[random_.randrange(len(text))] = random_.choice(vocabulary)
    same(spark.createDataFrame(rows, "doc_id long, text string"), rows, size)


def test_star_whose_leader_is_far_from_most(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join([*base[:-9], *(f"x{i}" for i in range(9))]))]
    for i in range(1, 60):
        rows.append((i, " ".join([f"v{i}a", f"v{i}b", f"v{i}c", *base[3 + i % 4 :]])))
    same(spark.createDataFrame(rows, "doc_id long, text string"), rows, 2)


def test_many_documents_share_a_passage_without_links(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, " ".join(f"d{i}_{j}" for j in range(60)) + " " + passage) for i in range(80)]
    same(spark.createDataFrame(rows, "doc_id long, text string"), rows, 2)


def test_similar_sets_share_a_listed_value():
    """Sets retained whole always do; sketches of larger sets hardly ever lack one: least common values of drawn pairs at the limit."""
    for n in range(1, 52):
        for m in range(n, int(n / 0.8 + 1e-9) + 1):
            both = -(-8 * (n + m) // 18)
            # either set may miss all common values but one less than it lists
            assert near_dup.listed(n, 0.8) + near_dup.listed(m, 0.8) > 0 and both + near_dup.listed(min(n, 51), 0.8) > n
    draw = np.random.default_rng(1)
    common = near_dup.least_common(0.8, 64)
    for n in (52, 60, 64, 65, 70, 80, 100, 400, 3000):
        fewest, lowest = 64, 1.0
        for _ in range(400):
            union = np.sort(draw.integers(-(2**62), 2**62, n))
            own = draw.permutation(n)[: n // 5]
            a, b = np.delete(union, own[::2])[:64], np.delete(union, own[1::2])[:64]
            fewest = min(fewest, len(np.intersect1d(a, b)))
            lowest = min(lowest, linking._estimate(a, b))
        assert fewest >= common + 4 and lowest > 0.8 - near_dup.slack(0.8, 64) + 0.05
    assert near_dup.listed(52, 0.8) + near_dup.least_common(0.8, 64) == 53


def test_long_lists_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(linking, "CELL", 6)
    monkeypatch.setattr(linking, "PIVOTS", 2)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[: 60 + i % 3] + [f"x{i}"] + base[61 + i % 3 :])) for i in range(40)]
    rows += [(40 + i, " ".join(base[:80] + [f"y{i}"])) for i in range(10)]
    same(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    found = components(spark.createDataFrame([*path, *star, (500, 500)], "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 50)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_stars_end_after_one_round(spark, monkeypatch):
    """op4: a round is many small stages; links that are stars, or cells of one group with common pivots, need no second one."""
    seen, real = [], component_rounds._large
    monkeypatch.setattr(component_rounds, "_large", lambda links: seen.append(1) or real(links))
    stars = [(100 * i, 100 * i + j) for i in range(5) for j in range(1, 30)]
    cells = [(1000 + i, 2000 + 10 * j + i) for i in range(6) for j in range(20)] + [(1000 + i, 3000 + p) for i in range(6) for p in range(4)]
    found = components(spark.createDataFrame([*stars, *cells, *cells], "a long, b long")).collect()
    expected = {b: a for a, b in stars} | {n: 1000 for link in cells for n in link if n != 1000}
    assert {r["node"]: r["component"] for r in found} == expected and len(found) == len(expected)
    assert len(seen) == 1


def test_op4(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    got = entry.queries()["op4_near_duplicates"](spark, SF).collect()
    assert sorted(map(tuple, got)) == brute(rows, 2, 80)


def test_codes_keep_order_and_overlaps():
    """op4: lists carry two bytes of a value, equal ones numbered, and lose nothing in common."""
    draw = np.random.default_rng(2)
    sample = draw.integers(-(2**63), 2**63 - 1, 50_000)
    shift = np.concatenate([sample, (sample.view(np.uint64) >> draw.integers(0, 64, 50_000).astype(np.uint64)).view(np.int64) ^ np.int64(-(2**63))])
    values = np.unique(np.concatenate([shift, [-(2**63), 2**63 - 1, -(2**63) + (1 << 49), -(2**63) + (1 << 49) - 1]]))
    coded = linking.codes(values)
    assert coded.dtype.itemsize == 2 and (np.diff(coded.astype(int)) >= 0).all() and coded[0] == 0 and coded[-1] == 2**16 - 1
    for n in (3, 40, 64, 300, 100_000, 20_000_000):
        for _ in range(60):
            union = np.sort(draw.integers(-(2**63), -(2**63) + 2**64 // n * 80 if n > 80 else 2**63 - 1, min(n, 80)))
            a, b = union[draw.random(len(union)) < 0.9][:64], union[draw.random(len(union)) < 0.9][:64]
            x, y = np.split(linking.ranked(np.concatenate([linking.codes(a), linking.codes(b)]), np.array([len(a), len(b)])), [len(a)])
            assert len(np.unique(x)) == len(a) and (np.diff(x) > 0).all()
            assert len(np.intersect1d(x, y)) >= len(np.intersect1d(a, b))
            assert len(a) == 0 or len(b) == 0 or linking._estimate(x, y) > linking._estimate(a, b) - 0.05


def test_lists_carry_two_bytes_a_value(spark):
    """op4: rows of lists held sketches of 512 bytes, several for each document."""
    carried = near_dup._coded(near_dup.sketches(table(spark).selectExpr("doc_id id", "text"), 2))
    assert all(len(r["codes"]) == 2 * min(r["n"], near_dup.SKETCH) for r in carried.collect())
