"""Near duplicates by bottom-k sketches.

A document's set holds its distinct word shingles, as hashes of one function. Its
sketch holds the k smallest of them. Inverted lists of retained values bring documents
together and give the overlaps of their sketches, the sketch of the union estimates
their similarity, and the full sets decide.

How it stays small where many documents agree:

* Equal sets are one class; only the class's smallest document goes on.
* Similar sets share most of their retained values, so that only a document's rarest
  ones need lists, in one order of all values (``listed``). Values that the same
  documents hold are one list. Lists carry two bytes of a value, which keep its order (``codes``).
* A list is one cell of a signature tree, or several with common pivots if it is long.
  Documents that are connected already are not compared again: the pairs of a group of
  copies are never made, and no link between different components is left out.
* What the estimate leaves gives clusters. The full sets of a cluster are cells once
  more; only they make a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.linking import clustered, codes, joined, linked_classes
from ledgerline.llm.shingles import fingerprints, lists, shingle_sets, whole_sets
from ledgerline.llm.tables import id_and_text, slices
from ledgerline.session import settle

#: Retained values.
SKETCH = 64
#: Standard deviations that an estimate may be off; further off in fewer than one of ten million cases.
SIGMAS = 5.3
#: Counters that order the values by frequency; their number is fixed at any scale.
COUNTERS = 1 << 20


def slack(threshold: float, k: int) -> float:
    """How far the share of common values in a sketch of the union may be below the similarity."""
    return SIGMAS * float(np.sqrt(threshold * (1 - threshold) / k))


def least_common(threshold: float, k: int) -> int:
    """Retained values that the full sketches of similar sets have in common, by the same bound."""
    return max(1, int(np.ceil(k * (threshold - slack(threshold, k)))))


def listed(n: int, threshold: float, k: int = SKETCH) -> int:
    """How many of its rarest retained values put a set of ``n`` values into lists.

    A set whose similar sets are all retained whole (``n <= threshold * k``) shares at least
    ``threshold * n`` values with them, others at least ``least_common``; one value more than can be
    missing is a common one.
    """
    if n <= threshold * k:
        return n - int(np.ceil(threshold * n - 1e-9)) + 1
    return min(n, k) - least_common(threshold, k) + 1


def sketches(texts: DataFrame, size: int, k: int = SKETCH) -> DataFrame:
    """id, n (set size), f1 and f2 (fingerprint of the set), sketch (the k smallest values)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = list(shingle_sets(part.column("text"), size))
                n = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), n, *fingerprints(sets), lists([s[:k] for s in sets])],
                    names=["id", "n", "f1", "f2", "sketch"],
                )

    return texts.mapInArrow(rows, "id long, n long, f1 long, f2 long, sketch array<long>")


def _counted(reps: DataFrame) -> np.ndarray:
    """How often the retained values of each counter occur."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            values = batch.column("sketch").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            counts += np.bincount((values % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["counter", "n"])

    found = reps.select("sketch").mapInArrow(rows, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(COUNTERS, dtype=np.int64)
    table[found.column("counter").to_numpy()] = found.column("n").to_numpy()
    return table


def _index(reps: DataFrame, threshold: float, k: int) -> DataFrame:
    """token, id: each document under its rarest retained values."""
    often = reps.sparkSession.sparkContext.broadcast(_counted(reps))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = often.value
        for batch in batches:
            held = batch.column("sketch")
            sizes = held.value_lengths().to_numpy()
            values = held.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((values, counts[values.view(np.uint64) % np.uint64(COUNTERS)], row))
            place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            wanted = np.array([listed(n, threshold, k) for n in batch.column("n").to_pylist()], dtype=np.int64)
            kept = place < wanted[row]
            ids = batch.column("id").to_numpy()[row[kept]]
            yield pa.RecordBatch.from_arrays([pa.array(values[order[kept]]), pa.array(ids)], names=["token", "id"])

    return reps.select("id", "n", "sketch").mapInArrow(rows, "token long, id long")


def _coded(reps: DataFrame) -> DataFrame:
    """id, n, codes: what the lists carry of a sketch, two bytes a value."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("sketch")
            data = codes(held.flatten().to_numpy(zero_copy_only=False)).tobytes()
            ends = (2 * np.cumsum(held.value_lengths().to_numpy())).tolist()
            coded = pa.array([data[a:b] for a, b in zip([0, *ends], ends)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), coded], names=["id", "n", "codes"])

    return reps.select("id", "n", "sketch").mapInArrow(rows, "id long, n long, codes binary")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, k: int = SKETCH
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Two documents are linked if 100 times the intersection of their sets of
    ``size``-word shingles is at least ``percent`` times the union; the component is
    the smallest id reachable. A text without words, or null, has an empty set, is
    linked with nothing and kept. Rows that share an id are one document whose texts
    link together. A row without id has no component and is kept. Ids are whole
    numbers; other columns are not read. An empty table gives an empty result.
    """
    threshold = percent / 100
    texts = id_and_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    every = settle(sketches(texts, size, k))

    def links(reps: DataFrame) -> tuple[DataFrame, bool]:
        index = settle(_index(reps, threshold, k))
        common = least_common(threshold, k)
        # the share of common retained values that the trees have to leave open, also between sketches of k values
        clusters = clustered(index, _coded(reps), int(100 * common / (2 * k - common)), threshold - slack(threshold, k))
        sets = settle(whole_sets(texts.join(clusters.select("id"), "id", "left_semi"), size))
        return joined(clusters, sets, percent)

    found = linked_classes(every, ["sketch"], links)
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"),
    )
