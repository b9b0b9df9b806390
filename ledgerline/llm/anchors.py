"""Anchors: places chosen by content, so that equal strings choose equal places.

Every window of ``length`` bytes has one anchor, its gram of ``gram`` bytes with the
smallest hash, the first of equals. Equal windows have their anchor at the same
offset, wherever they are; neighbouring windows mostly share one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ledgerline.llm.words import BYTE_CODES, prefix_hashes, rolling_hashes

GRAM = 64


@dataclass(frozen=True)
class Anchors:
    """Of the texts of a batch: the anchor's place, the first and last start of the windows it stands for."""

    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    text: np.ndarray  # number of the text
    gram: np.ndarray  # hash
    sums: np.ndarray  # prefix hashes of all bytes


def _sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each run of ``width`` keys: runs of doubled widths, the last two overlap."""
    count, size = len(keys) - width + 1, 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[:count], keys[width - size : width - size + count])


def find_anchors(raw: np.ndarray, bounds: np.ndarray, length: int, gram: int = GRAM) -> Anchors:
    """``raw``: all bytes; text ``i`` is between ``bounds[i]`` and ``bounds[i + 1]``."""
    sums = prefix_hashes(BYTE_CODES[raw])
    none = np.zeros(0, dtype=np.int64)
    if len(raw) < length:
        return Anchors(none, none, none, none, none.view(np.uint64), sums)
    hashes = rolling_hashes(sums, gram)
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    owner = (_sliding_minimum(keys, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # runs of windows with one anchor; they also end where a text begins or its last window has passed
    new = np.ones(len(owner) + 1, dtype=bool)
    np.not_equal(owner[1:], owner[:-1], out=new[1:-1])
    edges = np.concatenate([bounds, np.maximum(bounds[1:] - length + 1, bounds[:-1])])
    new[edges[edges < len(owner)]] = True
    ends = np.flatnonzero(new)
    text = np.searchsorted(bounds, ends[:-1], side="right") - 1
    inside = ends[:-1] + length <= bounds[text + 1]  # windows that lie in one text
    first, last = ends[:-1][inside], ends[1:][inside] - 1
    at = owner[first]
    return Anchors(at, first, last, text[inside], hashes[at], sums)
