"""Similarity join of shingle sets by signature trees.

A set is a signature: its size and a bitmap of its tokens. Trees of signatures, whose
nodes hold the OR of the bitmaps below them and the range of their sizes, prune pairs of
nodes by the largest overlap that is possible (``linking``).

* Equal sets are one class; only its smallest document goes on.
* Similar sets share one of their rarest tokens (the first ``n - least + 1`` of ``n`` in
  one order of all tokens, ``least`` the smallest overlap). Tokens held by the same sets
  are one list. The trees of the lists run over bitmaps alone and give clusters: sets
  that a chain of possible overlaps connects.
* A cluster is a list once more, now with whole sets. What its tree cannot prune is
  compared token by token; that alone makes a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.linking import bitmap, clustered, joined, linked_classes, width_class
from ledgerline.llm.shingles import WORD_BYTES, fingerprints, lists, shingle_sets, whole_sets
from ledgerline.llm.tables import id_and_text, slices
from ledgerline.llm.words import grams, hashed_words
from ledgerline.session import settle

#: Counters that order the tokens by frequency; their number is fixed at any scale.
COUNTERS = 1 << 18


def least_overlap(n: int, percent: int) -> int:
    """The smallest overlap with which a set of ``n`` tokens is similar to another one."""
    return -(-percent * n // 100)


def _counted(texts: DataFrame, size: int) -> np.ndarray:
    """How often the tokens of each counter occur in all texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                words, _ = hashed_words(part.column("text"), WORD_BYTES)
                # shingles across two texts are counted too; the counts only order tokens
                counts += np.bincount((grams(words, size) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["counter", "n"])

    found = texts.select("text").mapInArrow(rows, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(COUNTERS, dtype=np.int64)
    table[found.column("counter").to_numpy()] = found.column("n").to_numpy()
    return table


def signatures(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """id, n, f1 and f2 (fingerprint of the set), bits (bitmap), rarest (tokens of which similar sets share one)."""
    often = texts.sparkSession.sparkContext.broadcast(_counted(texts, size))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = often.value
        for batch in batches:
            for part in slices(batch):
                sets = list(shingle_sets(part.column("text"), size))
                n = np.array([len(s) for s in sets], dtype=np.int64)
                rarest = []
                for s in sets:
                    upto = len(s) - least_overlap(len(s), percent) + 1 if len(s) else 0
                    rarest.append(s[np.argsort(counts[s.view(np.uint64) % np.uint64(COUNTERS)], kind="stable")[:upto]])
                bits = [bitmap(s, w).tobytes() for s, w in zip(sets, width_class(n).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), *fingerprints(sets), pa.array(bits, pa.binary()), lists(rarest)],
                    names=["id", "n", "f1", "f2", "bits", "rarest"],
                )

    return texts.mapInArrow(rows, "id long, n long, f1 long, f2 long, bits binary, rarest array<long>")


def similar_sets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Two documents are linked if
    100 times the overlap of their sets of ``size``-word shingles is at least ``percent`` times the
    union; a text with fewer words has its whole sequence as its only shingle. The component is the
    smallest id reachable. A text without words, or null, has an empty set and is linked with
    nothing. Rows that share an id are one document whose texts link together. A row without id has
    no component. Ids are whole numbers; other columns are not read. An empty table gives an empty
    result.
    """
    texts = id_and_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    every = settle(signatures(texts, size, percent))

    def links(reps: DataFrame) -> tuple[DataFrame, bool]:
        tokens = reps.select(F.explode("rarest").alias("token"), "id")
        clusters = clustered(tokens, reps.select("id", "n", "bits"), percent)
        sets = settle(whole_sets(texts.join(clusters.select("id"), "id", "left_semi"), size))
        return joined(clusters, sets, percent)

    found = linked_classes(every, ["bits", "rarest"], links)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
