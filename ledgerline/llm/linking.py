"""Links between sets that meet in lists of any size, by signature trees over cells.

A cell is what one task compares. Its sets, sorted by size, are the leaves of a tree
whose nodes hold the OR of their bitmaps and the range of their sizes. Two nodes can
only hold similar sets if their sizes fit and their common bits, plus the tokens that
share a bit, could be the overlap that is needed; all other pairs of nodes are pruned
with everything below them. Node pairs of all trees of a task descend together, and
nodes that are linked already are not compared again, so a group of copies costs a few
comparisons per member.

A list of more than ``CELL`` members is dealt to several cells, each with the same few
pivots. What is then still apart from the list's largest component meets all cells in a
second round, so no pair in different components is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.tables import SLICE_BYTES
from ledgerline.llm.words import mixed
from ledgerline.session import settle

#: Bits of the bitmap of up to so many tokens; twice the tokens, twice the bits, up to ``WIDEST`` doublings.
BITS, TOKENS, WIDEST = 1024, 256, 5
#: Members of a cell; of more, parts of half that size are dealt. Pivots go to all parts.
CELL, PIVOTS = 2048, 4
#: Children of a node.
FAN = 16
#: Rows whose trees descend together, and pairs that are looked at in one step.
ROWS, PAIRS = 4096, 1 << 15


def width_class(n: np.ndarray) -> np.ndarray:
    """Doublings of the bitmap for sets of ``n`` tokens."""
    return np.clip(np.ceil(np.log2(np.maximum(n, 1) / TOKENS)), 0, WIDEST).astype(np.int64)


def bitmap(tokens: np.ndarray, width: int) -> np.ndarray:
    """A bit for every token; half the bitmap, OR-ed with the other half, is the bitmap of half the width."""
    bits = np.zeros(BITS << width, dtype=bool)
    bits[mixed(tokens.view(np.uint64)) & np.uint64((BITS << width) - 1)] = True
    return np.packbits(bits, bitorder="little")


def codes(values: np.ndarray) -> np.ndarray:
    """16 bits for each 64-bit value, in the same order: four of its size, twelve of its first digits.

    What is equal stays equal. Values below 2**-15 of the range, hence of sets of millions of tokens, have no size
    bits and are told apart by the digits alone.
    """
    y = (values.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(36)
    size = np.maximum(np.frexp(y.astype(np.float64))[1] - 13, 0)
    digits = (y >> np.maximum(size, 1).astype(np.uint64)) & np.uint64(0xFFF)
    return (size.astype(np.uint64) << np.uint64(12) | digits).astype("<u2")


def ranked(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Codes of consecutive ascending sketches, different within a sketch: equal ones are numbered.

    Two sketches have at least as many in common as before, and their union is no larger.
    """
    row = np.repeat(np.arange(len(sizes)), sizes)
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (codes[1:] != codes[:-1]) | (row[1:] != row[:-1])
    starts = np.flatnonzero(new)
    place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
    return codes.astype(np.int64) << 32 | place


class Labels:
    """Components of the rows of a task; a component is named by its first row."""

    def __init__(self, known: np.ndarray) -> None:
        _, first, inverse = np.unique(known, return_index=True, return_inverse=True)
        self.up = first[inverse]

    def find(self, rows: np.ndarray) -> np.ndarray:
        return self.up[rows]

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """All pairs (a, b) at once."""
        while len(a):
            x, y = self.up[a], self.up[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            apart = low < high
            if not apart.any():
                return
            np.minimum.at(self.up, high[apart], low[apart])
            while len(moved := np.flatnonzero(self.up[self.up] != self.up)):
                self.up[moved] = self.up[self.up[moved]]


class Trees:
    """The signature trees of several cells, whose rows follow each other, sorted by size within a cell."""

    def __init__(self, cell: np.ndarray, n: np.ndarray, bits: np.ndarray, known: np.ndarray, percent: int, same=None) -> None:
        """``same(a, b)`` decides pairs of rows that signatures leave open; without it, what is left open is linked."""
        self.percent, self.same, self.labels = percent, same, Labels(known)
        #: of every level: first row, first child, OR of bitmaps, sizes, most tokens that share a bit
        extra = n - np.bitwise_count(bits).sum(axis=1)
        rows = np.arange(len(n))
        self.levels = [(rows, rows, bits, n, n, extra)]
        self.tree = [cell]
        while True:
            first, _, ors, low, high, extra = self.levels[-1]
            cells = self.tree[-1]
            new = np.concatenate([[True], cells[1:] != cells[:-1]])
            if new.all():
                break
            starts = np.flatnonzero(new)
            place = np.arange(len(cells)) - np.repeat(starts, np.diff(np.append(starts, len(cells))))
            child = np.flatnonzero(place % FAN == 0)
            self.levels.append(
                (first[child], child, np.bitwise_or.reduceat(ors, child), np.minimum.reduceat(low, child),
                 np.maximum.reduceat(high, child), np.maximum.reduceat(extra, child))
            )
            self.tree.append(cells[child])

    def _ends(self, level: int) -> np.ndarray:
        """One past the last child of every node."""
        return np.append(self.levels[level][1][1:], len(self.levels[level - 1][0]))

    def _single(self, level: int) -> np.ndarray:
        """The component of every node's rows, -1 for nodes with several."""
        first = self.levels[level][0]
        up = self.labels.up
        low, high = np.minimum.reduceat(up, first), np.maximum.reduceat(up, first)
        return np.where(low == high, low, -1)

    def _fitting(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the sets below two nodes could be similar."""
        _, _, ors, low, high, extra = self.levels[level]
        p = self.percent
        fits = (100 * high[a] >= p * low[b]) & (100 * high[b] >= p * low[a])
        at = np.flatnonzero(fits)
        most = np.bitwise_count(ors[a[at]] & ors[b[at]]).sum(axis=1) + np.minimum(extra[a[at]], extra[b[at]])
        fits[at] = (100 + p) * most >= p * (low[a[at]] + low[b[at]])
        return fits

    def _pairs_within(self, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of different children of the same node of a level."""
        start, end = self.levels[level][1], self._ends(level)
        for step in range(1, FAN):
            for low in range(0, len(start), PAIRS // FAN):
                at, upto = start[low : low + PAIRS // FAN], end[low : low + PAIRS // FAN]
                count = np.maximum(upto - at - step, 0)
                a = np.repeat(at, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                if len(a):
                    yield a, a + step

    def _below(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a child of ``a`` with a child of ``b``."""
        start, end = self.levels[level][1], self._ends(level)
        of_a, of_b = end[a] - start[a], end[b] - start[b]
        count = of_a * of_b
        pair = np.repeat(np.arange(len(a)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return start[a][pair] + place // of_b[pair], start[b][pair] + place % of_b[pair]

    def _decide(self, a: np.ndarray, b: np.ndarray, links: list) -> None:
        """Link those pairs of rows that are similar and not yet connected."""
        apart = self.labels.find(a) != self.labels.find(b)
        a, b = a[apart], b[apart]
        fits = self._fitting(0, a, b)
        a, b = a[fits], b[fits]
        if self.same is None:
            self.labels.link(a, b)
            links.append((a, b))
            return
        for x, y in zip(a, b):
            if self.labels.up[x] != self.labels.up[y] and self.same(x, y):
                self.labels.link(np.array([x]), np.array([y]))
                links.append((np.array([x]), np.array([y])))

    def _open(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        single = self._single(level)
        apart = (single[a] != single[b]) | (single[a] < 0)
        a, b = a[apart], b[apart]
        fits = self._fitting(level, a, b)
        return a[fits], b[fits]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows (a, b) that connect every component: neighbours first, then ever larger nodes with each other."""
        links: list = []
        for level in range(1, len(self.levels)):
            for a, b in self._pairs_within(level):
                stack = [(level - 1, a, b)]
                while stack:
                    at, a, b = stack.pop()
                    if at == 0:
                        self._decide(a, b, links)
                        continue
                    a, b = self._open(at, a, b)
                    # one pair of rows often settles a pair of nodes
                    self._decide(self.levels[at][0][a], self.levels[at][0][b], links)
                    a, b = self._open(at, a, b)
                    some = max(1, PAIRS // FAN**2)
                    for i in range(0, len(a), some):
                        stack.append((at - 1, *self._below(at, a[i : i + some], b[i : i + some])))
        if not links:
            none = np.zeros(0, dtype=np.int64)
            return none, none
        return np.concatenate([a for a, _ in links]), np.concatenate([b for _, b in links])


def _folded(bits: bytes, width: int) -> bytes:
    """A bitmap folded to a smaller width."""
    return np.bitwise_or.reduce(np.frombuffer(bits, dtype=np.uint8).reshape(-1, (BITS << width) // 8), axis=0).tobytes()


def _estimate(a: np.ndarray, b: np.ndarray) -> float:
    """The similarity of two sets by the sketch of their union; sketches are of equal length, ascending, or whole sets."""
    k = max(len(a), len(b))
    union = np.union1d(a, b)[:k]
    common = np.intersect1d(a, b, assume_unique=True)
    return float((common <= union[-1]).sum()) / len(union)


def _links_in(cells: pa.Table, percent: int, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) for the rows of whole cells: the least id of a component, and each other one.

    Rows have cell, id, n, component, and ``bits`` (possible overlaps link), ``codes`` (of a sketch: estimates of
    at least ``floor`` link) or ``whole`` (similar sets link).
    """
    cell, ids, n, known = (cells.column(c).to_numpy() for c in ("cell", "id", "n", "component"))
    if "bits" in cells.column_names:
        held, widths, bits = None, width_class(n), cells.column("bits").to_pylist()
    else:
        if "whole" in cells.column_names:
            held = [v.values.to_numpy() for v in cells.column("whole")]
        else:
            coded = cells.column("codes").to_pylist()
            sizes = np.array([len(v) // 2 for v in coded], dtype=np.int64)
            held = np.split(ranked(np.frombuffer(b"".join(coded), dtype="<u2"), sizes), np.cumsum(sizes)[:-1])
        n = np.array([len(v) for v in held], dtype=np.int64)
        widths = width_class(n)
        bits = [bitmap(v, w).tobytes() for v, w in zip(held, widths.tolist())]
    labels = Labels(known)
    for width in np.unique(widths):
        # sets of the next width meet these where they are small enough
        other = (widths == width + 1) & (percent * n <= 100 * (TOKENS << width))
        rows = np.flatnonzero((widths == width) | other)
        wide = b"".join(_folded(bits[i], width) if widths[i] > width else bits[i] for i in rows.tolist())

        def same(x: int, y: int, rows: np.ndarray = rows) -> bool:
            a, b = held[rows[x]], held[rows[y]]
            if "whole" not in cells.column_names:
                return _estimate(a, b) >= floor
            both = len(np.intersect1d(a, b, assume_unique=True))
            return 100 * both >= percent * (len(a) + len(b) - both)

        signatures = np.frombuffer(wide, dtype=np.uint64).reshape(len(rows), -1)
        trees = Trees(cell[rows], n[rows], signatures, labels.up[rows], percent, None if held is None else same)
        a, b = trees.links()
        labels.link(rows[a], rows[b])
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, labels.up, np.minimum(ids, known))
    least = least[labels.up]
    apart = least < ids
    return least[apart], ids[apart]


def _compared(members: DataFrame, sets: DataFrame, percent: int, floor: float) -> DataFrame:
    """a, b: every member (cell, id, component) of a cell that is linked, with the least id of what it is linked with.

    ``sets`` has their id, n and bits, codes or whole.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            if held.num_rows < ROWS and held.nbytes < SLICE_BYTES:
                continue
            cells = held.column("cell").to_numpy()
            ends = np.flatnonzero(cells[1:] != cells[:-1]) + 1
            if len(ends):
                yield from linked(held.slice(0, ends[-1]))
                held = held.slice(ends[-1])
        if held is not None and held.num_rows:
            yield from linked(held)

    def linked(cells: pa.Table) -> Iterator[pa.RecordBatch]:
        a, b = _links_in(cells.combine_chunks(), percent, floor)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = members.join(sets, "id").repartition("cell").sortWithinPartitions("cell", "n", "id")
    kept = [c for c in ("cell", "id", "n", "component", "bits", "codes", "whole") if c in dealt.columns]
    return dealt.select(*kept).mapInArrow(rows, "a long, b long")


def joined(members: DataFrame, sets: DataFrame, percent: int, floor: float = 0.0) -> tuple[DataFrame, bool]:
    """Links (a, b) that connect the members (list, id) of each list, whatever its size, and whether a list took several cells."""
    held = settle(members.groupBy("list").agg(F.count("*").alias("held")).where(F.col("held") > CELL))
    if held.isEmpty():
        return settle(_compared(_celled(members.withColumn("component", F.col("id")), "list"), sets, percent, floor)), False
    placed = members.join(held, "list", "left")
    parts = F.coalesce(F.ceil(F.col("held") / (CELL // 2)), F.lit(1)).cast("long")
    placed = settle(placed.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id", "list"), "parts")))
    large = placed.where("parts > 1")
    pivots = large.groupBy("list", "parts").agg(
        F.array_distinct(F.array(*(F.min_by("id", F.xxhash64("id", F.lit(i))) for i in range(PIVOTS)))).alias("pivots")
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    shared = pivots.select("list", "parts", F.explode("pivots").alias("id")).select("list", "id", every)
    first = placed.select("list", "id", "part").unionByName(shared).distinct().withColumn("component", F.col("id"))
    links = settle(_compared(_celled(first, "list", "part"), sets, percent, floor))
    return links.unionByName(_second_round(large, links, sets, percent, floor)), True


def _celled(rows: DataFrame, *keys: str) -> DataFrame:
    """The cell's number is a hash: should two cells share it, their rows are compared too, which makes no wrong link."""
    return rows.select(F.xxhash64(*keys).alias("cell"), "id", *(c for c in rows.columns if c == "component"))


def _second_round(large: DataFrame, links: DataFrame, sets: DataFrame, percent: int, floor: float) -> DataFrame:
    """Members outside their list's largest component with every part of the list."""
    known = large.join(components(links).withColumnRenamed("node", "id"), "id", "left")
    known = settle(known.withColumn("component", F.coalesce("component", "id")))
    sizes = known.groupBy("list", "component").agg(F.count("*").alias("held"))
    main = sizes.groupBy("list").agg(F.max_by("component", F.struct("held", "component")).alias("main"))
    stray = settle(known.join(main, "list").where("component <> main").drop("main"))
    groups = stray.groupBy("list").agg(F.ceil(F.count("*") / (CELL // 2)).cast("long").alias("groups"))
    of_parts, of_groups = (F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)) for c in ("parts", "groups"))
    asked = stray.join(groups, "list").withColumn("group", F.pmod(F.xxhash64("id", "list"), F.col("groups")))
    asked = asked.select("list", "id", "component", "group", of_parts.alias("part"))
    met = known.join(groups, "list").select("list", "id", "component", "part", of_groups.alias("group"))
    cells = _celled(asked.unionByName(met).distinct(), "list", "group", "part")
    return _compared(cells, sets, percent, floor)


def clustered(tokens: DataFrame, sets: DataFrame, percent: int, floor: float = 0.0) -> DataFrame:
    """list, id: clusters of at least two sets that a chain of links connects, among sets that share a token (token, id)."""
    common = tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1").select("token")
    shared = settle(tokens.join(common, "token", "left_semi"))
    # tokens that the same sets hold are one list
    marks = [F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    lists = shared.groupBy("token").agg(F.count("*").alias("held"), F.min("id").alias("low"), F.max("id").alias("high"), *marks)
    lists = settle(lists.groupBy("held", "low", "high", "mark0", "mark1").agg(F.min("token").alias("token")).select("token"))
    members = settle(shared.join(lists, "token", "left_semi").select(F.col("token").alias("list"), "id"))
    of = components(joined(members, sets, percent, floor)[0])
    heads = of.select(F.col("component").alias("list"), F.col("component").alias("id")).distinct()
    return settle(of.select(F.col("component").alias("list"), F.col("node").alias("id")).unionByName(heads))


def linked_classes(every: DataFrame, carried: list[str], links_of: Callable[[DataFrame], tuple[DataFrame, bool]]) -> DataFrame:
    """id, n, component_id for all rows (id, n, f1, f2 and ``carried``) from the links between the distinct sets.

    ``links_of`` gets one row per distinct set (its least id, n, ``carried``) and returns links (a, b) with a
    the least id of a component, and whether they have to be followed further.
    """
    named = every.where("id is not null and n > 0")
    classes = settle(named.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep")))
    keys = classes.select(F.col("rep").alias("id"), "n", "f1", "f2")
    reps = settle(
        named.join(keys, ["id", "n", "f1", "f2"], "left_semi").dropDuplicates(["id", "n", "f1", "f2"]).select("id", "n", *carried)
    )
    links, large = links_of(reps)
    # texts of one document belong together, whatever they say
    mark = F.struct("n", "f1", "f2")
    several = settle(named.groupBy("id").agg(F.min(mark).alias("one"), F.max(mark).alias("other")).where("one <> other").select("id"))
    if large or not several.isEmpty():
        own = named.join(several, "id", "left_semi").join(classes, ["n", "f1", "f2"]).select(F.col("id").alias("a"), F.col("rep").alias("b"))
        of = components(links.unionByName(own))
    else:  # clusters are disjoint, so links within them are final
        of = links.select(F.col("b").alias("node"), F.col("a").alias("component")).distinct()
    found = classes.join(of.withColumnRenamed("node", "rep"), "rep", "left").select("n", "f1", "f2", F.coalesce("component", "rep").alias("component_id"))
    result = every.select("id", "n", "f1", "f2").join(found, ["n", "f1", "f2"], "left")
    component: Column = F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component_id", "id"))
    return result.select("id", "n", component.alias("component_id"))
