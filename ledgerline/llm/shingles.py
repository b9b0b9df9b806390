"""Sets of word shingles, as hashes of one function."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.tables import slices
from ledgerline.llm.words import byte_class, grams, hashed_words, mixed

#: Words are runs of anything but ASCII white space.
WORD_BYTES = byte_class((0x20, 0x20), (0x09, 0x0D))


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The set of each text, ascending: distinct shingles, with fewer words the whole sequence as one, without words none."""
    words, bounds = hashed_words(texts, WORD_BYTES)
    hashes = grams(words, size).view(np.int64)
    for low, high in zip(bounds, bounds[1:]):
        if high - low >= size:
            yield np.unique(hashes[low : high - size + 1])
        elif high > low:
            yield grams(words[low:high], high - low).view(np.int64)
        else:
            yield np.zeros(0, dtype=np.int64)


def lists(arrays: list[np.ndarray]) -> pa.Array:
    """A list column of 64-bit numbers."""
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else [], pa.int64()))


def fingerprints(sets: list[np.ndarray]) -> list[pa.Array]:
    """Two 64-bit sums over each set, which equal sets share."""
    with np.errstate(over="ignore"):
        return [
            pa.array(np.array([mixed(s.view(np.uint64) ^ np.uint64(salt)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64))
            for salt in (0x1B873593, 0x9E3779B1)
        ]


def whole_sets(texts: DataFrame, size: int) -> DataFrame:
    """id, n, whole: the sets of (id, text) that are not empty."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = list(shingle_sets(part.column("text"), size))
                n = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), n, lists(sets)], names=["id", "n", "whole"])

    return texts.mapInArrow(rows, "id long, n long, whole array<long>").where("n > 0")
