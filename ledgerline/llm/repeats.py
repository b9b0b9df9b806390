"""Repeated passages by suffix order and longest-previous-factor arrays.

A byte goes if a string of ``length`` bytes that covers it also starts elsewhere.

1. Every window has an anchor (``anchors``), and neighbouring windows with the same
   anchor form a span. Equal windows have equal anchors, so only spans whose anchor
   occurs twice matter. Spans that are equal as a whole are counted: each of their
   windows repeats. This settles the inside of all copies, of any number.
2. What is left are spans at the borders of copies. Their bytes, and those of one
   copy of each repeated span with the same anchor, meet by anchor. Each task builds
   the suffix array of its spans, the nearest smaller positions in suffix order and the
   common prefixes with them: the longest previous factor of every window. A window
   whose factor reaches ``length`` repeats, and so does the place of the factor.
3. Anchors with very many different borders (``HOT``, ``HOT_BYTES``) would make one task large.
   Their windows are counted by hash instead, which any number of tasks share.

Texts are cut again in each pass instead of being kept in pieces, and travel packed.
Numpy works on parts of texts and groups of spans that stay in a core's cache.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.anchors import find_anchors
from ledgerline.llm.tables import id_and_text, slices
from ledgerline.llm.words import BYTE_CODES, mixed, prefix_hashes, span_hashes, text_bytes
from ledgerline.session import settle

#: Different border spans of an anchor that one task compares by suffix order.
HOT = 20_000
#: Bytes of them; a span has less than twice the bytes of a window.
HOT_BYTES = 8 << 20
#: Bytes whose suffixes are sorted together; their ranks stay in a core's cache.
SORTED_BYTES = 1 << 16
#: Bytes of text whose spans are counted or placed together.
HASHED_BYTES = 1 << 20
#: Bytes of text whose windows are hashed together, at over a hundred bytes of numbers each; they stay in a core's cache.
CACHED_BYTES = 3 << 14
#: Bytes of an anchor's gram.
GRAM = 32
#: Numbers of the bytes for the second hash of a window.
OTHER_CODES = mixed(BYTE_CODES)


def _spans(raw: np.ndarray, bounds: np.ndarray, length: int):
    found = find_anchors(raw, bounds, length, GRAM)
    return found, span_hashes(found.sums, found.low, found.high + length) if len(found.at) else found.gram


def _text_spans(texts: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """gram, span and row of the text for all spans of the column ``text``."""
    grams, spans, rows, start = [], [], [], 0
    for part in slices(texts, limit=CACHED_BYTES):
        found, span = _spans(*text_bytes(part.column("text")), length)
        grams.append(found.gram)
        spans.append(span)
        rows.append(found.text + start)
        start += part.num_rows
    return np.concatenate(grams), np.concatenate(spans), np.concatenate(rows)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _rows(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _counted(texts: DataFrame, length: int) -> DataFrame:
    """gram, span, n: added up for each slice of texts, so that a hot span is a row per slice."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=HASHED_BYTES):
                gram, span, _ = _text_spans(part, length)
                order = np.lexsort((span, gram))
                gram, span = gram[order], span[order]
                new = np.ones(len(span), dtype=bool)
                new[1:] = (gram[1:] != gram[:-1]) | (span[1:] != span[:-1])
                n = np.diff(np.append(np.flatnonzero(new), len(span)))
                yield _rows({"gram": _long(gram[new]), "span": _long(span[new]), "n": _long(n)})

    return texts.select("text").mapInArrow(rows, "gram long, span long, n long")


def _repeated(texts: DataFrame, length: int) -> DataFrame:
    """The spans whose anchor occurs twice: gram, span, whole (the span itself repeats), mixed (other spans of the
    anchor do not), hot (the anchor has very many spans)."""
    spans = settle(_counted(texts, length).groupBy("gram", "span").agg(F.sum("n").alias("n")))
    grams = spans.groupBy("gram").agg(F.sum("n").alias("total"), F.min("n").alias("least"), F.count("*").alias("spans"))
    grams = settle(grams.where("total > 1"))
    # each span of an anchor reaches its task once, by _contexts
    hot = F.col("spans") > min(HOT, HOT_BYTES // (2 * length))
    return spans.join(grams, "gram").select(
        "gram", "span", F.expr("n > 1").alias("whole"), F.expr("least = 1").alias("mixed"), hot.alias("hot")
    )


def _placed(texts: DataFrame, length: int) -> DataFrame:
    """gram, span, key, mark: the spans of each text, once per slice."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=HASHED_BYTES):
                gram, span, text = _text_spans(part, length)
                key = part.column("key").to_numpy(zero_copy_only=False)[text]
                mark = part.column("mark").to_numpy(zero_copy_only=False)[text]
                yield _rows({"gram": _long(gram), "span": _long(span), "key": _long(key), "mark": pa.array(mark, pa.int32())})

    return texts.select("key", "mark", "text").mapInArrow(rows, "gram long, span long, key long, mark int")


def _packed(texts: DataFrame) -> DataFrame:
    """Texts as compressed bytes, for the shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in slices(batch):
                texts = [press.compress((text or "").encode()) for text in part.column("text").to_pylist()]
                yield _rows({name: part.column(name) for name in part.schema.names if name != "text"} | {"packed": pa.array(texts, pa.binary())})

    schema = texts.drop("text").select("*", F.lit(None).cast("binary").alias("packed")).schema
    return texts.mapInArrow(rows, schema)


def _unpacked(packed: pa.Array) -> Iterator[bytes]:
    press = zstandard.ZstdDecompressor()
    for value in packed:
        yield press.decompress(value.as_py())


def _cached(packed: pa.Array) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """The texts, a few at a time: each by itself, all their bytes, and where each starts and ends."""
    texts, filled = [], 0
    for data in _unpacked(packed):
        if texts and filled + len(data) > CACHED_BYTES:
            yield texts, np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])
            texts, filled = [], 0
        texts.append(data)
        filled += len(data)
    if texts:
        yield texts, np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])


def _members(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


#: Bytes of border spans that a task holds as Python objects.
HELD_BYTES = 4 << 20
CONTEXTS = "hot boolean, gram long, key long, mark int, low int, high int, body binary"


def _contexts(docs: DataFrame, length: int) -> DataFrame:
    """The bytes of the border spans of each text. A span that repeats in its text is wanted as one copy of many, so
    its first place is enough; other border spans have one place."""

    def found_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            filled = 0
            hot = [set(names) for names in batch.column("hot").to_pylist()]
            wanted = [{*names, *more} for names, more in zip(batch.column("sorted").to_pylist(), hot)]
            keys, marks = batch.column("key").to_pylist(), batch.column("mark").to_pylist()
            first = 0
            for texts, raw, bounds in _cached(batch.column("packed")):
                found, span = _spans(raw, bounds, length)
                lows, highs = ((x - bounds[found.text]).tolist() for x in (found.low, found.high))
                rows = zip(found.text.tolist(), span.view(np.int64).tolist(), found.gram.view(np.int64).tolist(), lows, highs)
                for text, name, gram, low, high in rows:
                    row = first + text
                    if name not in wanted[row]:
                        continue
                    wanted[row].remove(name)
                    values = (name in hot[row], gram, keys[row], marks[row], low, high, texts[text][low : high + length])
                    for column, value in zip(out.values(), values):
                        column.append(value)
                    filled += high + length - low
                    if filled >= HELD_BYTES:
                        yield pa.RecordBatch.from_pydict(out, schema=schema)
                        out, filled = {name: [] for name in schema.names}, 0
                first += len(texts)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema(
        [
            ("hot", pa.bool_()), ("gram", pa.int64()), ("key", pa.int64()), ("mark", pa.int32()),
            ("low", pa.int32()), ("high", pa.int32()), ("body", pa.binary()),
        ]
    )
    return docs.mapInArrow(found_in, CONTEXTS)


def suffix_ranks(data: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 8, 16, 32, ... bytes, up to ``depth`` at most; a suffix goes on behind a gap."""
    ranks, size = [_dense(first_words(data))], 8
    while 2 * size <= depth:
        ranks.append(_dense(_joined(ranks[-1], ranks[-1], size)))
        size *= 2
    return ranks


def first_words(data: np.ndarray) -> np.ndarray:
    """The first 8 bytes of all suffixes, as one number each; zeros follow the end."""
    word = np.concatenate([data, np.zeros(7, dtype=np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        word = (word[:-size] << np.uint64(8 * size)) | word[size:]
    return word


def _dense(values: np.ndarray) -> np.ndarray:
    """Ranks from 1 on; equal values have one rank."""
    order = np.argsort(values)
    steps = np.ones(len(values), dtype=np.int64)
    if len(values):
        held = values[order]
        steps[1:] = held[1:] != held[:-1]
    rank = np.empty(len(values), dtype=np.int64)
    rank[order] = np.cumsum(steps)
    return rank


def _joined(first: np.ndarray, second: np.ndarray, offset: int) -> np.ndarray:
    """Pairs of a rank and the rank ``offset`` bytes on, as one number; 0 behind the end."""
    ahead = np.zeros(len(first), dtype=np.int64)
    ahead[: len(first) - offset] = second[offset:]
    return first * (int(second.max(initial=0)) + 1) + ahead


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with a smaller value, or -1; all places jump at once."""
    near = np.arange(-1, len(values) - 1)
    open_ = np.flatnonzero(near >= 0)
    while len(open_):
        open_ = open_[(near[open_] >= 0) & (values[np.maximum(near[open_], 0)] >= values[open_])]
        near[open_] = near[near[open_]]
    return near


def previous_factors(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous factors of the suffixes at ``starts`` (ascending), counted up to ``length`` bytes, which all
    of them have, and where they start.

    In suffix order the best earlier match of a place is one of the two nearest places with a
    smaller position. Ranks of growing powers of two give the suffix order to the depth of
    ``length`` and the common prefixes.
    """
    words, ranks = first_words(data), suffix_ranks(data, length)
    last = 8 << (len(ranks) - 1)
    deep = _joined(ranks[-1], ranks[-1], length - last)[starts]
    order = np.argsort(deep)
    position = starts[order]
    best, source = np.zeros(len(order), dtype=np.int64), np.full(len(order), -1)
    for turned in (False, True):
        near = nearest_smaller(position[::-1] if turned else position)
        if turned:
            near = np.where(near[::-1] >= 0, len(order) - 1 - near[::-1], -1)
        has = np.flatnonzero(near >= 0)
        common = common_prefixes(words, ranks, position[has], position[near[has]], length)
        more = common > best[has]
        best[has[more]], source[has[more]] = common[more], position[near[has[more]]]
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.arange(len(order))
    return best[back], source[back]


def common_prefixes(words: np.ndarray, ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` share, up to ``length``, which both have; ``words`` are their first bytes."""
    total = np.zeros(len(a), dtype=np.int64)
    last = len(words) - 1
    for level in range(len(ranks) - 1, -1, -1):
        size = 8 << level
        for _ in range(2 if level + 1 == len(ranks) else 1):
            at, to = np.minimum(a + total, last), np.minimum(b + total, last)
            total += size * ((ranks[level][at] == ranks[level][to]) & (total + size <= length))
    at, to = np.minimum(a + total, last), np.minimum(b + total, last)
    differ = words[at] ^ words[to]
    for rest in range(1, 8):  # bytes from the last one on that the words may differ in
        total += differ < np.uint64(1 << 8 * rest)
    return np.minimum(total, length)


FOUND = "key long, mark int, found array<struct<low: int, high: int>>"


def _sorted_matches(contexts: DataFrame, length: int) -> DataFrame:
    """Window starts that repeat, as ranges, from the suffix arrays of whole groups of spans with one anchor."""

    def solve(group: pa.Table) -> pa.RecordBatch:
        key, mark, low = (group.column(name).to_numpy() for name in ("key", "mark", "low"))
        raw, bounds = text_bytes(pa.concat_arrays(group.column("body").chunks))
        sizes = np.diff(bounds)
        ends = np.cumsum(sizes + 1) - 1
        data = np.zeros(len(raw) + len(sizes), dtype=np.uint8)
        data[np.arange(len(raw)) + np.repeat(np.arange(len(sizes)), sizes)] = raw
        windows = sizes - length + 1
        starts = np.repeat(ends - sizes, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        before, source = previous_factors(data, starts, length)
        later = before >= length
        repeats = np.zeros(len(data) + 1, dtype=np.int8)
        repeats[starts[later]] = 1
        repeats[source[later]] = 1  # the first copies: the second ones match nothing else before them
        edge = np.diff(repeats, prepend=np.int8(0))
        first, last = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0) - 1
        row = np.searchsorted(ends, first)  # a window starts before the end of its span, so no run goes over it
        base = low[row] - (ends - sizes)[row]
        places = [pa.array((x + base).astype(np.int32)) for x in (first, last)]
        owner, n = np.unique(row, return_counts=True)
        found = pa.ListArray.from_arrays(np.cumsum([0, *n], dtype=np.int32), pa.StructArray.from_arrays(places, names=["low", "high"]))
        return _rows({"key": pa.array(key[owner]), "mark": pa.array(mark[owner]), "found": found})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            gram = held.column("gram").to_numpy()
            filled = np.cumsum(pc.binary_length(held.column("body")).to_numpy())
            start, done = 0, 0
            for end in (np.flatnonzero(gram[1:] != gram[:-1]) + 1).tolist():  # the last anchor may go on in the next batch
                if filled[end - 1] - done >= SORTED_BYTES:
                    yield solve(held.slice(start, end - start))
                    start, done = end, filled[end - 1]
            held = held.slice(start)
        if held is not None and held.num_rows:
            yield solve(held)

    return contexts.drop("hot").repartition("gram").sortWithinPartitions("gram").mapInArrow(rows, FOUND)


def _hashed_matches(contexts: DataFrame, length: int) -> DataFrame:
    """The same for hot anchors: each window is a row, counted by two hashes."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = np.frombuffer(row["body"], dtype=np.uint8)
                starts = np.arange(len(raw) - length + 1)
                a, b = (span_hashes(prefix_hashes(codes[raw]), starts, starts + length) for codes in (BYTE_CODES, OTHER_CODES))
                n = len(starts)
                yield _rows(
                    {
                        "a": _long(a), "b": _long(b), "key": pa.array([row["key"]] * n, pa.int64()),
                        "mark": pa.array([row["mark"]] * n, pa.int32()), "low": pa.array(row["low"] + starts, pa.int32()),
                    }
                )

    rows = contexts.select("key", "mark", "low", "body").mapInArrow(windows, "a long, b long, key long, mark int, low int")
    rows = settle(rows)
    often = rows.groupBy("a", "b").count().where("count > 1").select("a", "b")
    one = F.array(F.struct("low", F.col("low").alias("high")))
    return rows.join(often, ["a", "b"], "left_semi").select("key", "mark", one.alias("found"))


RESULT = "n_bytes long, n_removed long, n_spans long, kept binary"


def _removed(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    edges = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends, -1)
    return np.cumsum(edges[:-1]) > 0


def _totals(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])


def _without(docs: DataFrame, length: int) -> DataFrame:
    def gone_of(texts: list[bytes], bounds: np.ndarray, whole: list, found: list) -> np.ndarray:
        ranges = [(at + r["low"], at + r["high"]) for at, lists in zip(bounds.tolist(), found) for f in lists or [] for r in f]
        starts, ends = np.array(ranges, dtype=np.int64).reshape(-1, 2).T
        own = np.array([i for i, names in enumerate(whole) if names], dtype=np.int64)
        if len(own):  # a span that repeats as a whole does so in all texts
            data = [texts[i] for i in own.tolist()]
            edges = np.cumsum([0, *map(len, data)])
            at, span = _spans(np.frombuffer(b"".join(data), dtype=np.uint8), edges, length)
            ours = _members(span.view(np.int64), np.unique(np.concatenate([whole[i] for i in own.tolist()])))
            ahead = (bounds[own] - edges[:-1])[at.text[ours]]
            starts, ends = np.append(starts, at.low[ours] + ahead), np.append(ends, at.high[ours] + ahead)
        return _removed(int(bounds[-1]), starts, ends + length)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, found = (batch.column(name).to_pylist() for name in ("whole", "found"))
            out: list[list[np.ndarray]] = [[], [], [], []]
            start, row, filled = 0, 0, 0
            for texts, raw, bounds in _cached(batch.column("packed")):
                upto = row + len(texts)
                gone = gone_of(texts, bounds, whole[row:upto], found[row:upto])
                rises = gone.copy()
                rises[1:] &= ~gone[:-1]
                edges = bounds[:-1][np.diff(bounds) > 0]
                rises[edges] = gone[edges]
                for column, values in zip(out, (np.diff(bounds), _totals(gone, bounds), _totals(rises, bounds), raw[~gone])):
                    column.append(values)
                row, filled = upto, filled + len(raw)
                if filled >= HASHED_BYTES or row == batch.num_rows:
                    sizes, removed, spans, kept = map(np.concatenate, out)
                    ends = pa.array(np.cumsum([0, *(sizes - removed)], dtype=np.int32))
                    bodies = pa.Array.from_buffers(pa.binary(), len(sizes), [None, ends.buffers()[1], pa.py_buffer(kept)])
                    yield _rows(
                        {
                            "id": batch.column("id").slice(start, row - start), "n_bytes": pa.array(sizes, pa.int64()),
                            "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept": bodies,
                        }
                    )
                    out, start, filled = [[], [], [], []], row, 0

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "packed", "whole", "found").mapInArrow(rows, f"id {kind}, {RESULT}")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans (removed runs), kept (the remaining bytes).

    All copies of a repeated string go, also the first; strings are judged on the input and
    matches do not cross rows. A null text is an empty one. Equal rows repeat each other;
    rows that share an id are judged by themselves, and null ids are kept. Other columns
    are not read.
    """
    if length <= GRAM:  # an anchor is shorter than its window, and suffix ranks start at eight bytes
        raise ValueError(f"length must be over {GRAM}")
    texts = id_and_text(df, id_col, text_col)
    # id and a hash of the text: what belongs to a row
    key = F.coalesce(F.col("id").cast("long"), F.xxhash64("text"))
    texts = texts.withColumns({"text": F.coalesce("text", F.lit("")), "key": key, "mark": F.hash("text")})
    repeated = settle(_repeated(texts, length))
    places = settle(_placed(texts, length).join(repeated, ["gram", "span"]))
    # of a repeated span next to others one copy is enough
    one = places.where("whole and mixed").groupBy("gram", "span", "hot").agg(F.min(F.struct("key", "mark")).alias("of"))
    one = one.select("of.key", "of.mark", "span", F.lit(False).alias("whole"), "hot")
    needed = places.select("key", "mark", "span", "whole", "hot").unionByName(one)
    kinds = {"whole": "whole", "sorted": "not whole and not hot", "hot": "not whole and hot"}
    of_kind = [F.collect_set(F.when(F.expr(kind), F.col("span"))).alias(name) for name, kind in kinds.items()]
    lists = settle(needed.groupBy("key", "mark").agg(*of_kind))
    borders = lists.where("size(sorted) > 0 or size(hot) > 0").drop("whole")
    packed = _packed(texts)
    docs = packed.join(borders, ["key", "mark"]).dropDuplicates(["key", "mark"])
    contexts = settle(_contexts(docs, length))
    found = _sorted_matches(contexts.where("not hot"), length)
    if not contexts.where("hot").isEmpty():
        found = found.unionByName(_hashed_matches(contexts.where("hot"), length))
    ranges = found.groupBy("key", "mark").agg(F.collect_list("found").alias("found"))
    known = lists.select("key", "mark", "whole").join(ranges, ["key", "mark"], "left")
    result = _without(packed.join(settle(known), ["key", "mark"], "left"), length)
    return result.withColumnRenamed("id", id_col)
