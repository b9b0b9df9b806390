"""Words of whole batches as arrays of 64-bit hashes, without a Python object per word.

Letters A-Z are lower-cased; a word is then a maximal run of bytes of a given class.
Hashes depend on the word alone, so they agree between tasks and machines.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

_U = np.uint64
#: Bytes whose words are hashed together, at dozens of bytes of numbers each; the powers that a worker keeps follow them.
HASHED_BYTES = 1 << 18


def mixed(x: np.ndarray | int) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits depend on all bits."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


with np.errstate(over="ignore"):
    #: A number for every byte and the factor from place to place, by a rule.
    BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
    FACTOR = mixed(_U(0x51ED270B)) | _U(1)
BACK = _U(pow(int(FACTOR), -1, 1 << 64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[_U(1)], np.full(size, FACTOR, dtype=np.uint64)]), dtype=np.uint64)
        down = np.cumprod(np.concatenate([[_U(1)], np.full(size, BACK, dtype=np.uint64)]), dtype=np.uint64)
    return up, down


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, in a few sizes so that they are made rarely."""
    return _powers(1 << max(16, int(size).bit_length()))


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 truth values: bytes outside all ranges."""
    inside = np.ones(256, dtype=bool)
    for low, high in ranges:
        inside[low : high + 1] = False
    return inside


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the places where its texts start and end; null texts are empty."""
    large = pa.large_string() if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else pa.large_binary()
    texts = texts.cast(large) if texts.type != large else texts
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64, count=len(texts) + 1, offset=texts.offset * 8)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Sums over all prefixes, from which ``span_hashes`` takes the hash of any span."""
    up, _ = powers(len(codes))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * up[: len(codes)], dtype=np.uint64, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums) - 1)
    with np.errstate(over="ignore"):
        return mixed((sums[ends] - sums[starts]) * down[starts])


def rolling_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """``span_hashes`` of all spans of ``width``, one from each place."""
    count = max(0, len(sums) - width)
    _, down = powers(len(sums) - 1)
    with np.errstate(over="ignore"):
        return mixed((sums[width:] - sums[:count]) * down[:count])


def hashed_words(texts: pa.Array, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts, one after the other, and the places in them where each text starts and ends."""
    raw, bounds = text_bytes(texts)
    if not len(raw):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(bounds), dtype=np.int64)
    raw = LOWER[raw]
    member = inside[raw]
    first = member.copy()
    first[1:] &= ~member[:-1]
    last = member.copy()  # the place is the last byte of a word
    last[:-1] &= ~member[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    first[edges] = member[edges]
    last[edges - 1] = member[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = np.zeros(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):  # a hash does not depend on the place, so it is the same in any part
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + HASHED_BYTES, side="right")))
        sums = prefix_hashes(BYTE_CODES[raw[low : ends[j - 1]]])
        words[i:j] = span_hashes(sums, starts[i:j] - low, ends[i:j] - low)
        i = j
    return words, np.searchsorted(starts, bounds)


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on; the last places have none."""
    count = max(0, len(words) - size + 1)
    out = np.full(count, size, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = mixed(out * FACTOR + words[i : i + count])
    return out
