"""The similarity join against the comparison of all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from ledgerline.llm import linking, signature_join as sj
from ledgerline.llm.queries import documents
from tests.conftest import SF
from tests.llm.cases import empty, table
from tests.llm.test_near_dup import brute


def same(df, rows, size=5, percent=80):
    got = sorted(tuple(r) for r in sj.similar_sets(df, size=size, percent=percent).collect() if r["doc_id"] is not None)
    assert got == [r[:3] for r in brute(rows, size, percent)]
    return got


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def families(seed, count=8, lengths=(3, 5, 6, 12, 60, 150, 700)):
    """Chains: every copy changes the last one a little."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(count):
        text = [draw.choice(vocabulary) for _ in range(draw.choice(lengths))]
        for _ in range(draw.randrange(1, 30)):
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            for _ in range(draw.randrange(0, 1 + len(text) // 30)):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
    return rows


def test_odd_rows(spark):
    df = table(spark)
    same(df, [tuple(r) for r in df.select("doc_id", "text").collect()])
    assert [r["component_id"] for r in sj.similar_sets(df).where("doc_id is null").collect()] == [None]
    assert sj.similar_sets(empty(spark)).count() == 0
    assert same(frame(spark, [(1, None), (2, ""), (3, " \n")]), [(1, None), (2, ""), (3, " \n")]) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


@pytest.mark.parametrize("size", [2, 5])
def test_chains(spark, size):
    rows = families(size)
    same(frame(spark, rows), rows, size)


def test_lists_and_clusters_of_many_cells(spark, monkeypatch):
    """Cells of six, so that groups of copies are dealt to many and stray ones meet all of them."""
    monkeypatch.setattr(linking, "CELL", 6)
    monkeypatch.setattr(linking, "PIVOTS", 2)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[: 60 + i % 3] + [f"x{i}"] + base[61 + i % 3 :])) for i in range(40)]
    # in the same lists, but too short, and only linked with each other
    rows += [(40 + i, " ".join(base[:80] + [f"y{i}"])) for i in range(10)]
    rows += [(60 + i, t) for i, (_, t) in enumerate(families(3, 3, (60,)))]
    same(frame(spark, rows), rows)


def test_rows_that_share_an_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(5, a), (5, b), (3, a + " more"), (9, b), (7, c), (8, c + " end"), (7, "short")]
    got = sj.similar_sets(frame(spark, rows)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(5, 3), (3, 3), (9, 3), (7, 7), (8, 7)}


def test_many_documents_share_a_passage_without_links(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, " ".join(f"d{i}_{j}" for j in range(60)) + " " + passage) for i in range(80)]
    same(frame(spark, rows), rows)


@pytest.mark.parametrize("exact", [False, True])
def test_trees_prune_nothing_similar(exact):
    """Components of sets in one cell, bitmaps of several widths, against all pairs."""
    draw = np.random.default_rng(4)
    sets = []
    for _ in range(40):
        n = int(draw.choice([1, 2, 5, 30, 250, 257, 300, 520, 700]))
        core = draw.integers(-(2**62), 2**62, n)
        for _ in range(int(draw.integers(1, 9))):
            kept = core[draw.random(n) > 0.08]
            sets.append(np.unique(np.concatenate([kept, draw.integers(-(2**62), 2**62, len(core) // 20), core[:1]])))
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    bits = [linking.bitmap(s, w).tobytes() for s, w in zip(sets, linking.width_class(n).tolist())]
    columns = {"cell": np.zeros(len(n), np.int64), "id": np.arange(len(n)), "n": n, "component": np.arange(len(n))}
    columns |= {"whole": pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))} if exact else {"bits": bits}
    a, b = linking._links_in(pa.table(columns).combine_chunks(), 80)
    labels = linking.Labels(np.arange(len(n)))
    labels.link(a, b)
    true = linking.Labels(np.arange(len(n)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                assert labels.up[i] == labels.up[j]
                true.link(np.array([i]), np.array([j]))
    assert len(np.unique(true.up)) < len(sets) - 50
    if exact:
        assert (labels.up == true.up).all()
        assert len(a) == len(sets) - len(np.unique(true.up)) and (labels.up[b] == a).all()


def test_a_group_of_copies_costs_few_comparisons():
    draw = np.random.default_rng(5)
    core = draw.integers(-(2**62), 2**62, 250)
    sets = [np.unique(np.append(core, i)) for i in range(3000)]
    asked = []
    bits = np.stack([linking.bitmap(s, 0).view(np.uint64) for s in sets])
    trees = linking.Trees(np.zeros(3000, np.int64), np.full(3000, 251), bits, np.arange(3000), 80, lambda x, y: asked.append((x, y)) or True)
    a, _ = trees.links()
    assert len(a) == len(asked) == 2999 and len(np.unique(trees.labels.up)) == 1


def test_op13(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    got = entry.queries()["op13_signature_join"](spark, SF).collect()
    assert sorted(map(tuple, got)) == [r[:3] for r in brute(rows, 5, 80)]
