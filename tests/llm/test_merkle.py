"""The manifest against trees built from plain lists."""

import hashlib
import random

from pyspark.sql import functions as F

from ledgerline.llm import merkle
from tests.llm.cases import ODD, empty, table


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def proof(tree, at):
    out = []
    for nodes in tree[:-1]:
        run = at // 3 * 3
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 3])))
        at //= 3
    return out


def brute(rows, tampered=lambda text: text):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], digest("".join(map(framed, row))), digest("".join(map(framed, (*row[:4], tampered(row[4])))))))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        groups[source].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[source] = levels([leaf for _, leaf, _ in groups[source]])
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for place, source in enumerate(sources):
        for at, (doc, leaf, other) in enumerate(groups[source]):
            path = proof(trees[source], at) + proof(top, place)
            folded = other
            for left, right in path:
                folded = digest(left + folded + right)
            out.append((doc, leaf, trees[source][-1][0], top[-1][0], digest("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def got(df, tampered=None):
    found = merkle.manifest(df, tampered).withColumn("proof", F.sha2(merkle.proof_text(F.col("siblings")), 256))
    return sorted((tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()), key=str)


def test_odd_rows(spark):
    source = F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 3 == 1, "ü").otherwise("")
    # texts repeated per id: ties by id, and rows that are equal in every field
    df = table(spark).withColumns(
        {"source": source, "lang": F.when(F.length("text") > 20, "x"), "n_chars": F.length("text"), "leaf": F.lit(1), "rank": F.lit(2), "_draw": F.lit(3)}
    )
    df = df.unionByName(df.where("doc_id < 4").withColumn("text", F.concat("text", F.lit("+"))))
    rows = [tuple(r) for r in df.select(*merkle.FIELDS).collect()]
    cut = F.replace("text", F.lit("\n"), F.lit(""))
    found = got(df, cut)
    assert found == brute(rows, lambda t: t if t is None else t.replace("\n", ""))
    changed = {r[0] for r in rows if r[4] and "\n" in r[4]}
    assert changed and {r[0] for r in found if not r[6]} == changed
    assert all(r[6] for r in got(df))


def test_empty_and_single(spark):
    columns = {"source": F.lit("s"), "lang": F.lit(None).cast("string"), "n_chars": F.lit(0)}
    assert merkle.manifest(empty(spark).withColumns(columns)).count() == 0
    one = table(spark, ODD[:1]).where("doc_id = 0").withColumns(columns)
    ((doc, leaf, subroot, root, none, folded, verified),) = got(one)
    assert (doc, leaf, subroot, folded, verified, none) == (0, root, root, root, True, digest(""))


def test_many_tiers(spark, monkeypatch):
    """Blocks of nine leaves: a hot source, sources of one row, and more sources than a block holds."""
    monkeypatch.setattr(merkle, "DIGITS", 2)
    draw = random.Random(1)
    rows = [(i, "hot" if draw.random() < 0.4 else f"s{draw.randrange(25)}", None, i, f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert got(df) == brute(rows)


def test_incomplete_runs(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 1)
    rows = [(i, f"s{n}", "en", 1, "t") for n in (2, 3, 4, 9, 10, 28) for i in range(n)]
    assert got(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")) == brute(rows)


def test_equal_rows_are_ranked_in_many_tasks(spark):
    df = spark.range(4000).select(F.lit("k").alias("key"), F.lit(1).alias("id"))
    found = merkle.ranked(df, "key", ["id"])
    assert found.select("rank").distinct().count() == 4000 and found.agg(F.min("n"), F.max("rank")).first() == (4000, 3999)
