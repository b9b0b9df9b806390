"""Approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to length one, which makes the largest cosine the smallest
distance. Both halves of a vector are quantised separately; a cell of the index is a
pair of centroids. A query visits cells in order of the summed distance of its halves
to the two centroids, taken from a heap, until the visited cells hold enough vectors;
these are ranked by their exact cosine. How many are enough is measured on the sample
that the centroids are fitted on: few where the vectors form clusters, most of them
where the vectors have no structure at all and no index can tell near from far.

Equal vectors are one entry with the smallest few of their ids, which is all that any
answer can show of them, and equal queries are answered once. Cells of any size are
met by a join that adaptive execution splits; each task keeps the best of its part
before the answers of a query come together.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import settle

#: Vectors that the centroids are fitted on; the index holds all.
SAMPLE = 20_000
#: Vectors of an average cell, and most centroids of a half: the table of cells has at most their square.
CELL, MOST = 200, 1024
ROUNDS = 12
#: Recall that the sample's own neighbours shall reach, and the sample's queries that measure it.
RECALL, PROBES = 0.96, 400
#: Vectors a query meets at least.
VISIT = 1_000
#: Vectors and queries that a task compares at a time; larger cells are cut.
ENTRIES, QUERIES = 4096, 1024


@dataclass(frozen=True)
class Codebook:
    """Centroids of the two halves."""

    left: np.ndarray
    right: np.ndarray

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        half = vectors.shape[1] // 2
        a, b = _distances(vectors[:, :half], self.left), _distances(vectors[:, half:], self.right)
        return a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)


def _distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (vectors**2).sum(axis=1)[:, None] - 2 * vectors @ centroids.T + (centroids**2).sum(axis=1)


def _fitted(vectors: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Lloyd's rounds from distinct vectors; an empty centroid stays where it was."""
    if not vectors.shape[1]:
        return np.zeros((1, 0))
    random = np.random.default_rng(seed)
    distinct = np.unique(vectors, axis=0)
    centroids = distinct[random.permutation(len(distinct))[:count]]
    for _ in range(ROUNDS):
        nearest = _distances(vectors, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        sizes = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


def fit(vectors: np.ndarray, centroids: int) -> Codebook:
    unit = _unit(vectors)
    half = unit.shape[1] // 2
    return Codebook(_fitted(unit[:, :half], centroids, 1), _fitted(unit[:, half:], centroids, 2))


def share_for(vectors: np.ndarray, book: Codebook, top: int, recall: float = RECALL) -> float:
    """Share of the sample that must be visited for ``recall`` of its own queries' neighbours."""
    unit = _unit(vectors)
    cells = book.cells(unit)
    sizes = np.bincount(cells, minlength=len(book.left) * len(book.right))
    half = unit.shape[1] // 2
    needs = []
    for probe in range(min(PROBES, len(unit))):
        near = unit @ unit[probe]
        near[probe] = -np.inf
        best = np.argsort(-near)[: min(top, len(unit) - 1)]
        sums = _distances(unit[probe : probe + 1, :half], book.left)[0][:, None] + _distances(unit[probe : probe + 1, half:], book.right)[0]
        order = np.argsort(sums.reshape(-1), kind="stable")
        met = np.empty(len(order))
        met[order] = np.cumsum(sizes[order])
        needs.extend(met[cells[best]] / len(unit))
    return float(np.quantile(needs, recall)) if needs else 1.0


def visited(query: np.ndarray, book: Codebook, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells in order of summed distance until they hold ``enough`` vectors, by a heap over sorted centroid pairs."""
    half = len(query) // 2
    a = _distances(query[None, :half], book.left)[0]
    b = _distances(query[None, half:], book.right)[0]
    left, right = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    a, b, width = a[left], b[right], len(book.right)
    heap, pushed, cells, held = [(a[0] + b[0], 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(left[i]) * width + int(right[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        for pair in ((i + 1, j), (i, j + 1)):
            if pair not in pushed and pair[0] < len(a) and pair[1] < len(b):
                pushed.add(pair)
                heapq.heappush(heap, (a[pair[0]] + b[pair[1]], *pair))
    return cells


def usable(vector: str = "vector") -> str:
    """SQL: not null, without null or non-finite parts, and not zero."""
    whole = f"{vector} is not null and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    return f"{whole} and exists({vector}, x -> x <> 0)"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def centroids_for(count: int) -> int:
    return int(min(MOST, max(2, round((count / CELL) ** 0.5))))


def nearest(
    df: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    top: int = 5,
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank, id, score: for each row of ``queries`` its ``top`` nearest rows of ``df`` other than itself.

    Largest cosine first, in double precision on the vectors as given, ties to the smaller
    id. Rows without id and vectors that are null, zero, of another length than most, or
    that hold null or non-finite parts take no part. Rows that share id and vector are one.
    Fewer candidates than ``top`` give fewer rows. Other columns are not read.
    """
    entries = settle(_smallest(_rows(df, id_col, vector_col), top + 1))
    lengths = entries.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("count"))
    common = lengths.orderBy(F.desc("count"), "n").first()
    result = f"query_id long, rank int, `{id_col}` long, score double"
    if common is None:
        return df.sparkSession.createDataFrame([], result)
    entries = entries.where(F.size("vector") == common["n"])
    sample = entries.select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE).collect()  # bounded
    sample = np.array([row["vector"] for row in sample])
    book = fit(sample, centroids_for(common["count"]))
    visit = max(VISIT, int(np.ceil(share_for(sample, book, top, recall) * common["count"])))
    index = settle(_celled(entries, book))
    sizes = _by_cell(index, book)
    asked = _rows(queries, id_col, vector_col).where(F.size("vector") == common["n"])
    name = F.concat_ws(":", F.min("id"), F.hex(F.xxhash64("vector")))
    distinct = settle(asked.groupBy("vector").agg(name.alias("q")))
    visits = settle(_visits(distinct, book, sizes, visit))
    best = _best(visits, index, sizes, _by_cell(visits, book), top + 1)
    # the best of each part, together the best of each query
    window = Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0])
    best = best.withColumn("n", F.row_number().over(window)).where(F.col("n") <= top + 1)
    names = asked.join(distinct, "vector").select(F.col("id").alias("query_id"), "q")
    rows = names.join(best, "q").select("query_id", F.explode("ids").alias("id"), "score").where("id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = rows.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Distinct usable (id, vector)."""
    named = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    )
    return named.where(f"id is not null and {usable()}").distinct()


def _smallest(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors with their ``keep`` smallest ids; a vector of very many ids is cut in parts first."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    window = Window.partitionBy("vector", "salt").orderBy("id")
    few = salted.withColumn("n", F.row_number().over(window)).where(F.col("n") <= keep)
    ids = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return ids.select("vector", F.slice("ids", 1, keep).alias("ids"))


def _by_cell(rows: DataFrame, book: Codebook) -> np.ndarray:
    sizes = np.zeros(len(book.left) * len(book.right), dtype=np.int64)
    for row in rows.groupBy("cell").count().collect():  # one row per pair of centroids
        sizes[row["cell"]] = row["count"]
    return sizes


def _celled(entries: DataFrame, book: Codebook) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = book.cells(_unit(_matrix(batch.column("vector"))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vector"), batch.column("ids"), pa.array(cells.astype(np.int32))], names=["vector", "ids", "cell"]
                )

    return entries.mapInArrow(rows, "vector array<double>, ids array<long>, cell int")


def _visits(asked: DataFrame, book: Codebook, sizes: np.ndarray, enough: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                cells = [visited(query, book, sizes, enough) for query in _unit(_matrix(part.column("vector")))]
                part = part.take(pa.array(np.repeat(np.arange(len(cells)), [len(x) for x in cells])))
                flat = pa.array(np.concatenate([np.array(x, dtype=np.int32) for x in cells]))
                yield pa.RecordBatch.from_arrays([part.column("q"), part.column("vector"), flat], names=["q", "vector", "cell"])

    return asked.mapInArrow(rows, "q string, vector array<double>, cell int")


def _cut(rows: DataFrame, mine: np.ndarray, most: int, theirs: np.ndarray, other: int, name: str, others: str, by) -> DataFrame:
    """Rows of large cells in parts by a hash, and once for every part of the other side."""
    spark = rows.sparkSession
    parts = spark.createDataFrame(
        [(int(c), int(-(-mine[c] // most)), int(-(-theirs[c] // other))) for c in np.flatnonzero((mine > 0) & (theirs > 0))],
        "cell int, mine int, theirs int",
    )
    cut = rows.join(parts, "cell").withColumn(name, F.pmod(F.xxhash64(by), F.col("mine")).cast("int"))
    return cut.withColumn(others, F.explode(F.sequence(F.lit(0), F.col("theirs") - 1))).drop("mine", "theirs")


BEST = "q string, score double, ids array<long>"


def _best(visits: DataFrame, index: DataFrame, sizes: np.ndarray, asked: np.ndarray, keep: int) -> DataFrame:
    """Of each query the ``keep`` best entries of each part of a cell."""
    key = ["cell", "e", "a"]
    left = _cut(visits, asked, QUERIES, sizes, ENTRIES, "a", "e", "q").groupBy(*key)
    right = _cut(index, sizes, ENTRIES, asked, QUERIES, "e", "a", "vector").groupBy(*key)

    def rows(queries: pa.Table, entries: pa.Table) -> pa.Table:
        if not queries.num_rows or not entries.num_rows:
            return schema.empty_table()
        queries, entries = queries.combine_chunks(), entries.combine_chunks()
        a, b = (_matrix(table.column("vector").combine_chunks()) for table in (queries, entries))
        ids = entries.column("ids").combine_chunks()
        first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets.to_numpy()[0]]
        names = queries.column("q").to_pylist()
        out = {"q": [], "score": [], "ids": []}
        near = min(keep + 16, len(b))
        rough = _unit(a) @ _unit(b).T
        chosen = np.argpartition(-rough, near - 1, axis=1)[:, :near]
        for name, vector, row, some in zip(names, a, rough, chosen):
            if len(b) > near:  # with all that are as good as the last one, up to rounding
                some = np.flatnonzero(row >= row[some].min() - 1e-9)
            scores = exact(vector, b[some])
            order = np.lexsort((first[some], -scores))[:keep]
            out["q"] += [name] * len(order)
            out["score"] += scores[order].tolist()
            out["ids"] += [ids[int(i)].as_py() for i in some[order]]
        return pa.Table.from_pydict(out, schema=schema)

    schema = pa.schema([("q", pa.string()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])
    return left.cogroup(right).applyInArrow(rows, BEST)


def _scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which is exact and keeps squares from vanishing or overflowing."""
    _, exponent = np.frexp(np.abs(matrix).max(axis=-1, keepdims=True))
    return np.ldexp(matrix, -exponent)


def exact(vector: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosines of one vector with each row, added up the same way whatever else is in the rows."""
    vector, others = _scaled(vector), _scaled(others)
    dots = np.einsum("j,ij->i", vector, others)
    return dots / (np.sqrt(np.einsum("j,j->", vector, vector)) * np.sqrt(np.einsum("ij,ij->i", others, others)))
