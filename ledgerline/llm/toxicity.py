"""Toxicity by weak supervision.

1. Voters. Words and word beginnings that are much more frequent in texts marked
   toxic are found on a bounded sample of labelled rows and dealt over several
   lexicon voters; pattern voters look for shouting and for piled-up marks. A voter
   fires or does not.
2. Label model. Votes of all rows are counted by pattern, at most ``2 ** voters`` of
   them. Expectation maximisation estimates the share of toxic rows and, for each
   voter, how often it fires in either class. Voters that agree beyond what the class
   explains are correlated and share their weight. Given marks of the sample are one
   more voter, of known accuracy.
3. Classifier. A logistic regression on a bounded sample of rows learns the posterior
   labels from counts of what the voters found; every row is scored with it.

Texts are read twice, for the lexicon and for the counts; scores come from the counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.chunks import ChunkMemory
from ledgerline.llm.tables import id_and_text, slices
from ledgerline.session import settle

#: Labelled rows that lexicons are learned on, rows that the classifier is fitted on, entries of the lexicons.
LABELLED, FITTED, ENTRIES = 40_000, 60_000, 5_000
#: Letters of word beginnings.
STEMS = (4, 5, 6)
#: Lexicon voters for words and for each length of beginnings.
DEALT = 2
#: Toxic texts that must hold an entry. An entry tells how much more frequent it is in toxic texts: the logarithm
#: of the ratio less so many standard errors; it must tell this share of what the best one tells.
SUPPORT, ERRORS, SHARE = 4, 2.0, 0.5
#: Accuracy of given marks.
GOLD = 0.98
#: Entries that a task counts before it hands them on; distinct chunks that a worker remembers; bytes of text that it
#: turns into words together.
COUNTED, DISTINCT, READ_BYTES = 100_000, 100_000, 1 << 20
WORD = re.compile(r"[^\W\d_]+")
LEXICONS = DEALT * (1 + len(STEMS))
#: The lexicon voters, then shouting and piled-up marks.
VOTERS = LEXICONS + 2


def entries_of(word: str) -> list[str]:
    """A word and its beginnings, marked by their length."""
    return [f"0{word}", *(f"{n}{word[:n]}" for n in STEMS if len(word) > n)]


def voter_of(entry: str) -> int:
    kind = 0 if entry[0] == "0" else 1 + STEMS.index(int(entry[0]))
    return kind * DEALT + sum(map(ord, entry)) % DEALT


def _words_in(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass(frozen=True)
class Lexicon:
    """Entries and how much they speak for toxicity."""

    weight: dict[str, float]

    def find(self, chunk: str) -> tuple | None:
        """(words, loud words, marks, [(voter, weight), ...]) of a chunk of text; None for (1, 0, 0, [])."""
        found = []
        words = _words_in(chunk)
        for word in words:
            for entry in entries_of(word):
                weight = self.weight.get(entry)
                if weight is not None:
                    found.append((voter_of(entry), weight))
        marks = chunk.count("!") + chunk.count("?") + chunk.count("#") + chunk.count("*")
        loud = sum(len(word) > 1 and word.isupper() for word in WORD.findall(chunk))
        return (len(words), loud, marks, found) if found or loud or marks or len(words) != 1 else None


def counts_of(memory: ChunkMemory, texts: list[str]) -> np.ndarray:
    """For each text: words, loud words, marks, and for each lexicon voter hits and the sum of their weights."""
    out = np.zeros((len(texts), 3 + 2 * LEXICONS))
    for row, values in enumerate(memory.values(texts)):
        telling = [value for value in values if value is not None]
        out[row, 0] = len(values) - len(telling) + sum(value[0] for value in telling)
        out[row, 1] = sum(value[1] for value in telling)
        out[row, 2] = sum(value[2] for value in telling)
        for value in telling:
            for voter, weight in value[3]:
                out[row, 3 + voter] += 1
                out[row, 3 + LEXICONS + voter] += weight
    return out


def votes_of(counts: np.ndarray) -> np.ndarray:
    words = np.maximum(counts[:, 0], 1)
    lexicons = counts[:, 3 : 3 + LEXICONS] > 0
    return np.column_stack([lexicons, counts[:, 1] / words > 0.3, counts[:, 2] / words > 0.2])


def features_of(counts: np.ndarray) -> np.ndarray:
    """Bounded numbers for the classifier: what each voter found, in all and per word."""
    words = np.maximum(counts[:, :1], 1)
    hits, weights = counts[:, 3 : 3 + LEXICONS], counts[:, 3 + LEXICONS :]
    return np.column_stack(
        [
            np.minimum(hits, 5) / 5, np.log1p(weights) / 3, np.log1p(100 * hits / words) / 3, votes_of(counts),
            np.log1p(words[:, 0]) / 8, np.minimum(counts[:, 1] / words[:, 0], 1), np.minimum(counts[:, 2] / words[:, 0], 1),
        ]
    ).astype(float)


def _lexicon(marked: DataFrame) -> Lexicon:
    """Entries of the labelled texts (text, toxic) that are most telling, by frequency of texts in both classes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bool, Counter] = {True: Counter(), False: Counter()}

        def out() -> pa.RecordBatch:
            entry = pa.array((entry for counter in counts.values() for entry in counter), pa.string())
            toxic = pa.array((toxic for toxic, counter in counts.items() for _ in counter), pa.bool_())
            n = pa.array((n for counter in counts.values() for n in counter.values()), pa.int64())
            for counter in counts.values():
                counter.clear()
            return pa.RecordBatch.from_arrays([entry, toxic, n], names=["entry", "toxic", "n"])

        for batch in batches:
            for part in slices(batch, limit=READ_BYTES):
                for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    counts[toxic].update({entry for word in set(_words_in(text or "")) for entry in entries_of(word)})
                if sum(map(len, counts.values())) > COUNTED:
                    yield out()
        yield out()

    totals = {row["toxic"]: row["count"] for row in marked.groupBy("toxic").count().collect()}
    yes, no = totals.get(True, 0), totals.get(False, 0)
    if not yes or not no:
        return Lexicon({})
    pos, neg = (F.sum(F.when(F.col("toxic") == toxic, F.col("n")).otherwise(0)) for toxic in (True, False))
    told = marked.mapInArrow(rows, "entry string, toxic boolean, n long").groupBy("entry").agg(pos.alias("pos"), neg.alias("neg"))
    told = settle(told.where(f"pos >= {SUPPORT}"))
    ratio = F.log((F.col("pos") + 0.5) / (yes + 1)) - F.log((F.col("neg") + 0.5) / (no + 1))
    error = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    told = told.withColumn("tells", ratio - ERRORS * error).where("tells > 0")
    best = told.orderBy(F.desc("tells"), "entry").limit(ENTRIES).collect()  # bounded
    best = [row for row in best if row["tells"] >= SHARE * best[0]["tells"]]
    return Lexicon({row["entry"]: float(row["tells"]) for row in best})


@dataclass(frozen=True)
class LabelModel:
    """Share of toxic rows; how often each voter fires in both classes; weights of correlated voters."""

    prior: float
    fires: np.ndarray  # voters x (clean, toxic)
    weight: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        clean, toxic = self.fires.T
        ratio = votes * np.log(toxic / clean) + (1 - votes) * np.log((1 - toxic) / (1 - clean))
        return np.log(self.prior / (1 - self.prior)) + ratio @ self.weight

    def posterior(self, votes: np.ndarray, gold: np.ndarray | None = None) -> np.ndarray:
        """``gold``: 1 toxic, 0 clean, -1 unknown."""
        odds = self.log_odds(votes)
        if gold is not None:
            odds = odds + np.where(gold < 0, 0, np.where(gold > 0, 1, -1) * np.log(GOLD / (1 - GOLD)))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_label_model(votes: np.ndarray, gold: np.ndarray, n: np.ndarray, rounds: int = 50) -> LabelModel:
    """``votes``: patterns; ``gold``: the given mark of the pattern's rows or -1; ``n``: how many rows have both."""
    votes = votes.astype(float)
    start = np.where(gold >= 0, np.clip(gold, 0.02, 0.98), np.clip(votes[:, :LEXICONS].mean(axis=1) * 2, 0.02, 0.98))
    q, weight = start.astype(float), np.ones(votes.shape[1])
    model = None
    for _ in range(rounds):
        toxic, clean = n * q, n * (1 - q)
        fires = np.column_stack(
            [(clean @ votes + 0.5) / (clean.sum() + 1), (toxic @ votes + 0.5) / (toxic.sum() + 1)]
        )
        model = LabelModel(float((toxic.sum() + 1) / (n.sum() + 2)), np.clip(fires, 1e-4, 1 - 1e-4), weight)
        q = model.posterior(votes, gold)
        weight = 1 / (1 + _agreement(votes, n, q, model.fires))
    return LabelModel(model.prior, model.fires, weight)


def _agreement(votes: np.ndarray, n: np.ndarray, q: np.ndarray, fires: np.ndarray) -> np.ndarray:
    """For each voter the sum of its correlations with the others inside the classes."""
    total = np.zeros(votes.shape[1])
    for kind, rows in enumerate((n * (1 - q), n * q)):
        if rows.sum() < 1:
            continue
        off = votes - fires[:, kind]
        joint = (off * rows[:, None]).T @ off / rows.sum()
        scale = np.sqrt(np.maximum(np.diag(joint), 1e-9))
        related = np.abs(joint / scale[:, None] / scale[None, :])
        np.fill_diagonal(related, 0)
        total += related.sum(axis=1) * rows.sum() / n.sum()
    return total


def fit_linear(features: np.ndarray, target: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Logistic regression on soft labels by Newton's steps; the last weight is the constant."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * max(1, len(x)))
    penalty[-1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + penalty * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        size = np.abs(step).max()
        w -= step * min(1, 5 / max(size, 1e-12))
        if size < 1e-6:
            break
    return w


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _counted(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """id and counts (array) of each row."""
    spread = texts.sparkSession.sparkContext.broadcast(lexicon)  # bounded by ENTRIES

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = spread.value.find
        memory = ChunkMemory(lambda chunks: [find(chunk) for chunk in chunks], DISTINCT).alone()
        for batch in batches:
            for part in slices(batch, limit=READ_BYTES):
                counts = counts_of(memory, [text or "" for text in part.column("text").to_pylist()])
                flat = pa.array(counts.reshape(-1))
                ends = pa.array(np.arange(len(counts) + 1, dtype=np.int32) * counts.shape[1])
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(ends, flat)], names=["id", "counts"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"id {kind}, counts array<double>")


def _matrix(rows: list) -> np.ndarray:
    return np.array(rows, dtype=float).reshape(len(rows), 3 + 2 * LEXICONS)


def _pattern_counts(counted: DataFrame) -> DataFrame:
    """pattern (bits of the votes), gold, n."""
    words = F.greatest(F.col("counts")[0], F.lit(1.0))
    fired = [F.col("counts")[3 + i] > 0 for i in range(LEXICONS)]
    fired += [F.col("counts")[1] / words > 0.3, F.col("counts")[2] / words > 0.2]
    bits = sum((F.when(vote, 1 << i).otherwise(0) for i, vote in enumerate(fired)), F.lit(0))
    return counted.groupBy(bits.alias("pattern"), "gold").agg(F.count("*").alias("n"))


def score(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    limit: float = 0.3,
) -> DataFrame:
    """One row per input row: id, held_out, score (0 to 1, higher: toxic likelier), predicted (1 from ``limit`` on).

    Only labels of rows that are not ``held_out`` are read. A null text is an empty one and
    gets the score of a text without words. An id with several labels counts as toxic from
    half of them on; null ids and null labels are no labels. Without labels of both kinds
    nothing is toxic. Equal texts have equal scores. Other columns are not read.
    """
    texts = id_and_text(df, id_col, text_col)
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("toxic"))
    known = known.where(~held_out("id")).dropna().groupBy("id").agg((F.avg("toxic") >= 0.5).alias("toxic"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(LABELLED)
    # at most LABELLED rows of two small columns
    marked = texts.join(F.broadcast(settle(sample)), "id").select("text", "toxic")
    lexicon = _lexicon(marked)
    counted = settle(_counted(texts, lexicon))
    gold = F.coalesce(F.col("toxic").cast("int"), F.lit(-1)).alias("gold")
    voted = counted.join(known, "id", "left").select("id", "counts", gold)
    patterns = _pattern_counts(voted).collect()  # at most 3 * 2 ** VOTERS
    weights = None
    if lexicon.weight and patterns:
        pattern = np.array([row["pattern"] for row in patterns])
        votes = (pattern[:, None] >> np.arange(VOTERS)) & 1
        n = np.array([row["n"] for row in patterns], dtype=float)
        model = fit_label_model(votes, np.array([row["gold"] for row in patterns]), n)
        rows = voted.orderBy(F.xxhash64("id", "counts")).limit(FITTED).collect()  # bounded
        counts = _matrix([row["counts"] for row in rows])
        target = model.posterior(votes_of(counts).astype(float), np.array([row["gold"] for row in rows]))
        weights = fit_linear(features_of(counts), target)
    scored = _scored(counted, weights)
    return scored.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted")
    )


def _scored(counted: DataFrame, weights: np.ndarray | None) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _matrix(batch.column("counts").to_pylist())
            if weights is None:
                values = np.zeros(len(counts))
            else:
                values = 1 / (1 + np.exp(-np.clip(features_of(counts) @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(values)], names=["id", "score"])

    kind = counted.schema["id"].dataType.simpleString()
    return counted.mapInArrow(rows, f"id {kind}, score double")
