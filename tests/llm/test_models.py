"""Toxicity, nearest neighbours, repeated passages and the pipeline."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from ledgerline.llm import ann, repeats, toxicity
from ledgerline.llm.queries import BYTE_BPE, documents
from tests.conftest import SF
from tests.llm.cases import LONG, ODD, PASSAGE, empty, lower, table
from tests.llm.test_filters import base_spans, contaminated
from tests.llm.test_near_dup import brute as near_pairs


# toxicity


def corpus(n=1500, seed=1):
    random_ = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nprst"]
    insults = ["vilest", "rotter", "dunce", "scoundrel"]
    rows = []
    for i in range(n):
        words = [random_.choice(vocabulary) for _ in range(random_.randrange(20, 200))]
        toxic = int(random_.random() < 0.15)
        for _ in range(random_.randrange(1, 6) if toxic else 0):
            words.insert(random_.randrange(len(words)), random_.choice(insults))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.selectExpr("doc_id", "if(doc_id % 3 = 0, null, toxic) as toxic").where("doc_id % 5 <> 0")
    got = {r["doc_id"]: r for r in toxicity.score(df.drop("toxic"), labels).collect()}
    truth = {i: t for i, _, t in rows}
    out = [r for r in got.values() if r["held_out"]]
    hits = sum(r["predicted"] and truth[r["doc_id"]] for r in out)
    assert hits >= 0.95 * sum(truth[r["doc_id"]] for r in out) and hits >= 0.95 * sum(r["predicted"] for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())


def test_held_out_labels_are_not_read(spark):
    df = spark.createDataFrame([r[:2] for r in corpus(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in corpus(400)], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.score(df, x).collect()} for x in (labels, turned))
    assert a == b


def test_odd_rows_and_labels(spark):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (4, 1), (5, 0)], "doc_id long, toxic int")
    got = toxicity.score(table(spark), labels).collect()
    assert len(got) == len(ODD) + 2 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] == 0 for r in toxicity.score(table(spark), labels.where("false")).collect())
    assert toxicity.score(empty(spark), labels).count() == 0


def test_label_model_weighs_down_copies_of_a_voter():
    random_ = np.random.default_rng(0)
    truth = random_.random(4000) < 0.3
    votes = np.column_stack([np.where(random_.random(4000) < 0.85, truth, ~truth) for _ in range(4)])
    votes = np.column_stack([votes[:, :LX] if (LX := toxicity.LEXICONS) < 4 else votes, votes[:, 3], votes[:, 3]]).astype(float)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    model = toxicity.fit_label_model(patterns, np.full(len(n), -1), n.astype(float))
    assert model.weight[:3].min() > model.weight[3:].max()
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.85


def test_op5(spark):
    got = entry.queries()["op5_toxicity"](spark, SF).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in documents(spark, SF).collect())


# nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as vector", "1 as cell", "2 as q")


def brute(rows, queries, top):
    usable = {}
    for i, v in rows:
        if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v):
            usable[i] = np.array(v, dtype=float) / max(map(abs, v))
    out = {}
    for q in queries:
        if q in usable:
            a = usable[q]
            near = [(-float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), i) for i, b in usable.items() if i != q]
            out[q] = sorted((round(s, 9), i) for s, i in near)[:top]
    return out


def test_ties_copies_and_unusable_vectors(spark):
    random_ = np.random.default_rng(2)
    rows = [(i, random_.normal(size=6).tolist()) for i in range(120)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 1.0]) for i in range(40)]
    rows += [(2000, None), (2001, [0.0] * 6), (2002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2003, [float("nan")] * 6),
             (2004, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 6), (2005, []), (2006, [1e-200] * 6), (5, rows[5][1])]
    df = vectors(spark, rows)
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 5 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((round(-r["score"], 9), r["vec_id"]))
    assert got == brute(rows, [i for i, _ in rows if i is not None and i % 5 == 0], 5)


def test_few_and_no_vectors(spark):
    df = vectors(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [3.0])])
    got = ann.nearest(df, df).orderBy("query_id").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (1, 1, 0)]
    assert ann.nearest(df.where("false"), df).count() == 0 and ann.nearest(df, df.where("false")).count() == 0


def test_recall_and_cut_cells(spark, monkeypatch):
    monkeypatch.setattr(ann, "ENTRIES", 16)
    monkeypatch.setattr(ann, "QUERIES", 8)
    monkeypatch.setattr(ann, "VISIT", 50)
    random_ = np.random.default_rng(3)
    centres = random_.normal(size=(20, 16)) * 3
    rows = [(i, (centres[i % 20] + random_.normal(size=16)).tolist()) for i in range(1500)]
    df = vectors(spark, rows)
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 10 = 0")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    expected = brute(rows, list(got), 5)
    hits = sum(len(got[q] & {i for _, i in near}) for q, near in expected.items())
    assert len(got) == 150 and hits >= 0.9 * 5 * len(got)


def test_cells_are_visited_in_order_of_summed_distance():
    random_ = np.random.default_rng(4)
    book = ann.Codebook(random_.normal(size=(5, 3)), random_.normal(size=(6, 3)))
    query = random_.normal(size=6)
    sums = {
        a * 6 + b: ((query[:3] - book.left[a]) ** 2).sum() + ((query[3:] - book.right[b]) ** 2).sum()
        for a in range(5) for b in range(6)
    }
    assert ann.visited(query, book, np.ones(30, dtype=int), 30) == sorted(sums, key=sums.get)
    assert len(ann.visited(query, book, np.ones(30, dtype=int), 7)) == 7


def test_op8(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = entry.queries()["op8_nearest_neighbours"](spark, SF).collect()
    expected = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    hits = sum((r["vec_id"] in {i for _, i in expected[r["query_id"]]}) for r in got)
    assert len(got) == 5 * len(expected) and hits >= 0.9 * len(got)


# repeated passages


def without(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, dtype=int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) > 0).sum()), kept))
    return out


def passages():
    random_ = random.Random(9)
    word = lambda: "".join(random_.choice("abcdéf") for _ in range(random_.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(n) for n in (15, 16, 20, 40, 200)]
    texts = []
    for _ in range(60):
        parts = [text(random_.randrange(0, 30)) for _ in range(4)]
        for i in range(3):
            parts.insert(2 * i + 1, random_.choice(shared)[random_.randrange(40) :][: random_.randrange(60, 900)])
        texts.append(" ".join(parts))
    return [*texts, *texts[:3], "ab" * 300, "ab" * 150, "z" * 250, "z" * 199, shared[4] + shared[4]]


@pytest.mark.parametrize("hot", [repeats.HOT, 2])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SORTED_BYTES", 5_000)
    texts = [*passages(), *(t for t in ODD if t != LONG)]
    df = table(spark, texts, repeated=False)
    got = {r["doc_id"]: tuple(r[1:]) for r in repeats.remove_repeats(df, length=200).collect()}
    expected = without(texts, 200)
    for i, row in enumerate(expected):
        assert (*got[i][:3], bytes(got[i][3])) == row, i
    assert len(got) == len(texts) + 1


def test_repeats_of_a_long_text_and_of_rows(spark):
    df = table(spark, [LONG, None, "", PASSAGE], repeated=True)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    expected = Counter((i, *row) for (i, _), row in zip(rows, without([t for _, t in rows], 200)))
    got = repeats.remove_repeats(df).collect()
    assert Counter((*r[:4], bytes(r[4])) for r in got) == expected
    assert repeats.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [repeats.HOT, 2])
def test_a_text_that_repeats_a_phrase_compares_one_copy(spark, monkeypatch, hot):
    seen = []

    def kept(solve):
        def matches(contexts, length):
            seen.extend(contexts.select("gram", "body").collect())
            return solve(contexts, length)

        return matches

    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "HELD_BYTES", 500)
    for name in ("_sorted_matches", "_hashed_matches"):
        monkeypatch.setattr(repeats, name, kept(getattr(repeats, name)))
    phrase = "seven words of one phrase. "
    texts = ["before " + phrase * 120 + "behind", "others " + phrase * 12 + "as well", PASSAGE]
    got = {r["doc_id"]: (*r[1:4], bytes(r[4])) for r in repeats.remove_repeats(table(spark, texts, repeated=False)).collect()}
    assert [got[i] for i in range(3)] == without(texts, 200)
    assert seen and max(Counter(seen).values()) == 1


def test_factors_against_all_pairs():
    random_ = random.Random(11)
    for length in (8, 13, 16, 37):
        for _ in range(12):
            data = "".join(random_.choice("ab") * random_.randrange(1, 9) for _ in range(40)).encode()
            raw = np.frombuffer(data, dtype=np.uint8)
            starts = np.array(sorted(random_.sample(range(len(data) - length + 1), 30)))
            best, source = repeats.previous_factors(raw, starts, length)

            def common(i, j):
                return next((n for n in range(length) if data[i + n] != data[j + n]), length)

            for at, n, from_ in zip(starts, best, source):
                assert n == max((common(at, j) for j in starts if j < at), default=0)
                assert n == 0 or (from_ < at and common(at, from_) == n)


def test_op9(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    got = {r["doc_id"]: tuple(r[1:]) for r in entry.queries()["op9_repeated_passages"](spark, SF).collect()}
    for (i, _), (n, removed, spans, kept) in zip(rows, without([t for _, t in rows], 200)):
        assert got[i] == (n, removed, spans, hashlib.sha256(kept).hexdigest())


# pipeline


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = table(spark).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.where("false")):
            out = stage(spark, rows, SF)
            if name != "bpe":
                assert out.columns == docs.columns
            if name == "near_duplicates" and rows is docs:
                ids = [r["doc_id"] for r in out.collect()]
                assert ids.count(3) == 1 and ids.count(None) == 1 and ids.count(15) == 1 and ids.count(16) == 0
            else:
                out.collect()


def spans_of(text):
    """Base spans, and the two kinds that the method adds, with plain regular expressions."""
    yield from ((a, b, kind) for kind, a, b in base_spans(text))
    for m in re.finditer(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            yield m.start(), m.end(), "iban"
    for m in re.finditer(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", text):
        near = lower(text[max(0, m.start() - 40) : m.start()])
        fine = m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000"
        if fine and re.search("(^|[^a-z])(ssn|social security|tax id|taxpayer)([^a-z]|$)", near):
            yield m.start(), m.end(), "ssn"


def hidden(text):
    out, at = [], 0
    for start, end, kind in sorted(spans_of(text), key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
            at = end
    return "".join(out) + text[at:]


def test_pipeline_against_plain_python(spark):
    """All pairs of shingle sets, all windows of items, plain patterns, the library's ids; toxic documents are those of the operator."""
    docs, library = documents(spark, SF), Tokenizer.from_file(BYTE_BPE)
    toxic = {r["doc_id"] for r in toxicity.score(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r["predicted"]}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in toxic]
    kept = {i for i, _, _, keep in near_pairs(rows, 5, 80) if keep}
    rows = [r for r in rows if r[0] in kept]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r, (words, hit, _) in zip(rows, contaminated(rows, items)) if not (hit and 20 * hit >= words)]
    expected = {i: hidden(text or "") for i, text in rows}
    assert 0 < len(expected) < 200 and sum(t != hidden(t) for t in (x or "" for _, x in rows)) > 5
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["text"] for r in got} == expected and len(got) == len(expected)
    for r in got:
        ids = library.encode(expected[r["doc_id"]], add_special_tokens=False).ids
        assert (r["ids"], r["n_tokens"]) == (ids, len(ids))


def test_a_task_hashes_a_megabyte_at_a_time(spark):
    """op9: windows take over a hundred bytes of numbers each while they are hashed, so few texts are taken together."""
    rng = random.Random(5)
    body = "".join(rng.choices("abcdefgh ", k=repeats.HASHED_BYTES // 2))
    df = spark.createDataFrame([(body,)] * 6, "text string").coalesce(1)
    counted = repeats._counted(df, 200).groupBy("gram", "span").agg(F.count("*").alias("parts"), F.sum("n").alias("n")).collect()
    assert {row["n"] for row in counted if row["n"] % 6} == set()
    assert min(row["parts"] for row in counted) >= 3
