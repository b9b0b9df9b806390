"""Benchmark decontamination with suffix arrays over the training text.

Every task is a shard: it sorts the suffixes of its documents, word by word to the
depth of a window, and looks up every suffix of every benchmark item by binary
search. The neighbours in suffix order give the longest verbatim match and the
range of equal windows gives all places. Suffixes that start no match are left out
before sorting: a table of the items' first words (up to three) shows them.

Texts are not shuffled: a document meets the items where it is read. Items travel
to the tasks in blocks of bounded size, so a benchmark of any size needs the memory
of a few blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import id_and_text, slices
from ledgerline.llm.words import byte_class, grams, hashed_words

#: Words are runs of ASCII digits and letters and of all bytes beyond ASCII.
WORD_BYTES = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: Characters of benchmark text in a block.
BLOCK_CHARS = 4_000_000
#: Words that a suffix must share with the start of some suffix of an item to be sorted.
LEAD = 3


@dataclass(frozen=True)
class Items:
    """The suffixes of a block of items. ``need``: words that a match must have, a window or the whole short item."""

    ids: list
    item: np.ndarray  # of each suffix
    place: np.ndarray
    need: np.ndarray
    keys: np.ndarray  # the first words, as bytes that sort like the words
    ends: np.ndarray  # the key that follows all keys with the needed words
    leads: dict[int, np.ndarray]  # number of words -> their hashes, sorted
    window: int


def _keys(words: np.ndarray, starts: np.ndarray, stops: np.ndarray, depth: int) -> np.ndarray:
    """Rows of ``depth`` words from each start, zero behind the end of the text."""
    at = starts[:, None] + np.arange(depth)
    taken = np.where(at < stops[:, None], words[np.minimum(at, max(0, len(words) - 1))], np.uint64(0))
    return np.ascontiguousarray(taken.astype(">u8"))


def _as_bytes(rows: np.ndarray) -> np.ndarray:
    return rows.view(f"S{rows.shape[1] * 8}").reshape(-1)


def prepare(ids: list, texts: list[str], window: int) -> Items:
    words, bounds = hashed_words(pa.array(texts, pa.large_string()), WORD_BYTES)
    sizes = np.diff(bounds)
    need_of = np.minimum(sizes, window)
    item = np.repeat(np.arange(len(ids)), sizes)
    place = np.arange(len(words)) - bounds[item]
    stop = bounds[item + 1]
    full = place + need_of[item] <= sizes[item]  # a suffix shorter than the window is no match of its own
    item, place, stop = item[full], place[full], stop[full]
    need = need_of[item]
    rows = _keys(words, bounds[item] + place, np.minimum(stop, bounds[item] + place + need), window)
    ends = rows.copy()
    ends[np.arange(window) >= need[:, None]] = np.uint64(0xFFFFFFFFFFFFFFFF)
    leads = {}
    for size in range(1, LEAD + 1):
        mine = np.minimum(need, LEAD) == size
        if mine.any():
            hashes = grams(words, size)
            leads[size] = np.unique(hashes[(bounds[item] + place)[mine]])
    return Items(ids, item, place, need, _as_bytes(rows), _as_bytes(ends), leads, window)


def _candidates(words: np.ndarray, items: Items) -> np.ndarray:
    """Places whose first words start some item's suffix."""
    found = np.zeros(len(words), dtype=bool)
    for size, hashes in items.leads.items():
        mine = grams(words, size)
        coarse = np.zeros(1 << 20, dtype=bool)
        coarse[hashes >> np.uint64(44)] = True
        maybe = np.flatnonzero(coarse[mine >> np.uint64(44)])
        at = np.minimum(np.searchsorted(hashes, mine[maybe]), len(hashes) - 1)
        found[maybe[hashes[at] == mine[maybe]]] = True
    return np.flatnonzero(found)


def search(words: np.ndarray, bounds: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Matches (word place, suffix) of the items' suffixes in the shard's suffix array."""
    none = np.zeros(0, dtype=np.int64)
    if not len(words) or not len(items.keys):
        return none, none
    starts = _candidates(words, items)
    if not len(starts):
        return none, none
    stops = bounds[np.searchsorted(bounds, starts, side="right")]
    keys = _as_bytes(_keys(words, starts, stops, items.window))
    order = np.argsort(keys, kind="stable")
    suffixes, starts = keys[order], starts[order]
    low = np.searchsorted(suffixes, items.keys, side="left")
    high = np.searchsorted(suffixes, items.ends, side="right")
    count = np.maximum(high - low, 0)
    hit = np.flatnonzero(count)
    count = count[hit]
    rank = np.repeat(low[hit], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return starts[rank], np.repeat(hit, count)


def _runs(at: np.ndarray, suffix: np.ndarray, items: Items) -> tuple[np.ndarray, ...]:
    """Matches that continue each other as one: item, place in the item, place in the text, words."""
    item, place = items.item[suffix], items.place[suffix]
    order = np.lexsort((at, at - place, item))
    at, item, place, need = at[order], item[order], place[order], items.need[suffix][order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(item) != 0) | (np.diff(at - place) != 0) | (np.diff(at) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return item[first], place[first], at[first], at[last] + need[last] - at[first]


@lru_cache(maxsize=4)
def _prepared(block: Broadcast, window: int) -> Items:
    return prepare(*block.value, window)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[Broadcast]:
    """The items, block by block, each of bounded size."""
    context = benchmark.sparkSession.sparkContext
    blocks, ids, texts, filled = [], [], [], 0
    rows = id_and_text(benchmark, id_col, text_col).where("text is not null").orderBy(F.xxhash64("text"), "id")
    for row in rows.toLocalIterator():
        ids.append(row["id"])
        texts.append(row["text"])
        filled += len(row["text"])
        if filled >= BLOCK_CHARS:
            blocks.append(context.broadcast((ids, texts)))
            ids, texts, filled = [], [], 0
    if ids:
        blocks.append(context.broadcast((ids, texts)))
    return blocks


FOUND = "array<struct<item_id: string, item_word: long, word: long, words: long>>"


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
) -> DataFrame:
    """``docs`` rows as: id, n_words, n_hit, items (ids of items with an occurring window, as strings, sorted),
    matches (longest verbatim runs: item, its first word, the document's first word, words).

    A window is ``window`` consecutive words of an item, or all words of a shorter one.
    Null texts and texts without words have no words and no windows; rows of an item that
    share an id count as one item; an item without id hits words but is not listed.
    Repeated documents are repeated rows. Other columns are not read. An empty benchmark
    hits nothing.
    """
    texts = id_and_text(docs, id_col, text_col)
    blocks = _blocks(benchmark, item_col, item_text_col)
    kind = texts.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _shard(part, blocks, window)

    found = texts.mapInArrow(rows, f"id {kind}, n_words long, n_hit long, items array<string>, matches {FOUND}")
    return found.withColumnRenamed("id", id_col)


def _shard(part: pa.RecordBatch, blocks: list[Broadcast], window: int) -> pa.RecordBatch:
    words, bounds = hashed_words(part.column("text"), WORD_BYTES)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    of: list[dict] = [{} for _ in range(part.num_rows)]
    for block in blocks:
        items = _prepared(block, window)
        at, suffix = search(words, bounds, items)
        if not len(at):
            continue
        need = items.need[suffix]
        np.add.at(edges, at, 1)
        np.add.at(edges, at + need, -1)
        for item, place, start, size in zip(*(x.tolist() for x in _runs(at, suffix, items))):
            doc = int(np.searchsorted(bounds, start, side="right")) - 1
            of[doc].setdefault(items.ids[item], []).append((place, start - int(bounds[doc]), size))
    hit = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
    n_hit = hit[bounds[1:]] - hit[bounds[:-1]]
    items_of = [sorted(str(item) for item in found if item is not None) for found in of]
    matches = [
        [
            {"item_id": None if item is None else str(item), "item_word": a, "word": b, "words": c}
            for item, runs in found.items()
            for a, b, c in runs
        ]
        for found in of
    ]
    found_type = pa.list_(
        pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("word", pa.int64()), ("words", pa.int64())])
    )
    return pa.RecordBatch.from_arrays(
        [
            part.column("id"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(n_hit.astype(np.int64)),
            pa.array(items_of, pa.list_(pa.string())), pa.array(matches, found_type),
        ],
        names=["id", "n_words", "n_hit", "items", "matches"],
    )


def is_contaminated(percent: int = 5):
    """At least so many percent of the words are inside a window's occurrence, and one at least."""
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))

