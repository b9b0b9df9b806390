"""Token ids in files: fixed-width bit packing with block offsets.

Every id takes the minimum number of bits that the vocabulary needs. 64 ids fill
exactly ``bits`` 64-bit words, so that packing and unpacking are a few numpy
operations over columns of words and the words of any id are found by arithmetic.

The files are a Parquet table of blocks, sorted by shard and block:

    shard  int           place of the file's range of documents
    block  int           place of the block in its shard
    first  long          ids of the shard before this block
    n_ids  long          ids of the block
    bits   int           bits of an id
    doc    array<long>   documents of the block, in order; a document is never split
    offset array<long>   where each document starts in the block
    words  binary        the packed ids, little-endian 64-bit words

Spark commits the files, so that a repeated task or a lost executor leaves no
half-written shard, and the table may be in any store that Spark reaches.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.bpe import Labels
from ledgerline.llm.chunks import ByteMemory
from ledgerline.llm.tables import id_and_text, slices

#: Ids that close a block; documents are whole, so a block may be longer.
BLOCK_IDS = 1 << 16
BLOCKS = (
    "shard int, block int, first long, n_ids long, bits int, doc array<long>, offset array<long>, words binary"
)


#: Widths at which an id is a little-endian number of whole bytes.
WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}


def width_of(vocabulary: int) -> int:
    """Bits that hold every id of a vocabulary."""
    if vocabulary < 1:
        raise ValueError("a vocabulary has at least one id")
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """64 ids to ``bits`` words; the last group is filled up with zeros."""
    groups = -(-len(ids) // 64)
    if bits in WHOLE:  # the same words: every id is a number of its own
        if len(ids) and int(ids.max()) >> bits:
            raise ValueError(f"an id does not fit into {bits} bits")
        return ids.astype(WHOLE[bits]).tobytes() + bytes((groups * 64 - len(ids)) * bits // 8)
    wide = np.zeros(groups * 64, dtype=np.uint64)
    wide[: len(ids)] = ids
    if bits < 64 and len(ids) and int(wide.max()) >> bits:
        raise ValueError(f"an id does not fit into {bits} bits")
    columns = np.ascontiguousarray(wide.reshape(groups, 64).T)
    words = np.zeros((bits, groups), dtype=np.uint64)
    for i in range(64):
        word, shift = divmod(i * bits, 64)
        words[word] |= columns[i] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= columns[i] >> np.uint64(64 - shift)
    return words.T.astype("<u8").tobytes()


def unpack(words: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from place ``start``, touching only the groups they are in."""
    if bits in WHOLE:
        return np.frombuffer(words, dtype=WHOLE[bits], offset=start * bits // 8, count=count).astype(np.uint32)
    low, high = start // 64, -(-(start + count) // 64)
    part = np.frombuffer(words, dtype="<u8", offset=low * bits * 8, count=(high - low) * bits)
    columns = np.ascontiguousarray(part.reshape(high - low, bits).T)
    mask = np.uint64((1 << bits) - 1)
    ids = np.empty((64, high - low), dtype=np.uint32)
    for i in range(64):
        word, shift = divmod(i * bits, 64)
        value = columns[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (columns[word + 1] << np.uint64(64 - shift))
        ids[i] = value & mask
    return ids.T.reshape(-1)[start - low * 64 :][:count]


#: Characters that one call of the library encodes.
CALL_CHARS = 50_000
#: Distinct chunks and parts that a worker remembers.
DISTINCT = 500_000


class LibraryEncoder:
    """The library's ids of chunks, as little-endian 32-bit integers.

    Of a byte-level vocabulary many chunks are encoded in one call: a chunk that starts with a blank goes
    on in a piece of its own behind one that ends without white space, and the byte lengths of the tokens
    tell where each chunk ends.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        labels = Labels(path).all
        self.sizes = np.zeros(max(labels, default=-1) + 1, dtype=np.int64)
        for token, label in labels.items():
            self.sizes[token] = len(label)
        self.memory = ByteMemory(self.encoded, DISTINCT, self.marks)

    def encoded(self, texts: list[str]) -> list[bytes]:
        joined = [t[:1] == " " and not t[1:2].isspace() and not t[-1:].isspace() and not any(m in t for m in self.marks) for t in texts]
        ids: dict[int, bytes] = {}
        for rows in _calls(texts, [i for i, j in enumerate(joined) if j]):
            ids.update(zip(rows, self._together([texts[i] for i in rows])))
        for rows in _calls(texts, [i for i, j in enumerate(joined) if not j]):
            batch = self.tokenizer.encode_batch_fast([texts[i] for i in rows], add_special_tokens=False)
            ids.update(zip(rows, (np.array(e.ids, dtype="<u4").tobytes() for e in batch)))
        return [ids[i] for i in range(len(texts))]

    def _together(self, texts: list[str]) -> list[bytes]:
        found = np.array(self.tokenizer.encode_batch_fast(["".join(texts)], add_special_tokens=False)[0].ids, dtype="<u4")
        upto = np.cumsum(self.sizes[found])
        ends = np.cumsum([len(t.encode()) for t in texts])
        cuts = np.searchsorted(upto, ends)
        if len(upto) == 0 or (upto[np.minimum(cuts, len(upto) - 1)] != ends).any():
            raise ValueError("a token goes on from one chunk to the next")
        data, cuts = found.tobytes(), ((cuts + 1) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts)]


def _calls(texts: list[str], rows: list[int]) -> Iterator[list[int]]:
    """Rows for one call each: an encoding takes many times the memory of its text."""
    part: list[int] = []
    filled = 0
    for i in rows:
        part.append(i)
        filled += len(texts[i])
        if filled >= CALL_CHARS:
            yield part
            part, filled = [], 0
    if part:
        yield part


@lru_cache(maxsize=2)
def _encoder(path: str) -> ByteMemory:
    """One per worker process."""
    return LibraryEncoder(path).memory


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def _row(block: int, first: int, bits: int, docs: list, ids: list[np.ndarray]) -> dict:
    lengths = np.array([len(x) for x in ids], dtype=np.int64)
    return {
        "shard": TaskContext.get().partitionId(), "block": block, "first": first, "n_ids": int(lengths.sum()),
        "bits": bits, "doc": docs, "offset": (np.cumsum(lengths) - lengths).tolist(),
        "words": pack(np.concatenate(ids), bits),
    }


def write_ids(
    df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = None
) -> None:
    """Encode ``df`` and write the block table to ``path``, documents ascending by id.

    A null text is an empty one; ``end_id`` is appended to every document. Rows that
    share an id are all written, ordered by their text's hash; null ids come first.
    A table without rows gives a table without blocks. Other columns are not read.
    """
    bits = width_of(max(vocabulary_size(tokenizer), (end_id or 0) + 1))
    end = np.array([] if end_id is None else [end_id], dtype="<u4")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _encoder(tokenizer).alone()
        shard = {"block": 0, "first": 0}
        docs: list = []
        ids: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            row = _row(shard["block"], shard["first"], bits, list(docs), ids)
            shard["block"] += 1
            shard["first"] += row["n_ids"]
            docs.clear()
            ids.clear()
            return pa.RecordBatch.from_pylist([row], schema=schema)

        filled = 0
        for batch in batches:
            for part in slices(batch):
                found, ends = memory.ids(part.column("text"))
                for doc, low, high in zip(part.column("id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                    docs.append(doc)
                    ids.append(np.append(found[low:high].view("<u4"), end))
                    filled += len(ids[-1])
                    if filled >= BLOCK_IDS:
                        yield close()
                        filled = 0
        if docs:
            yield close()

    schema = pa.schema(
        [
            ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
            ("bits", pa.int32()), ("doc", pa.list_(pa.int64())), ("offset", pa.list_(pa.int64())), ("words", pa.binary()),
        ]
    )
    rows = id_and_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    order = (F.col("id"), F.xxhash64("text"))
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges.mapInArrow(blocks, BLOCKS).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc, start (ids of all documents before it), ids (little-endian 32-bit integers)."""
    table = spark.read.schema(BLOCKS).parquet(path)
    # one row per shard, that is per partition of the write: small enough for a broadcast at any size
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = table.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    starts = shards.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("shard_start"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["words"], row["bits"], 0, row["n_ids"]).astype("<u4")
                at = np.array([*row["offset"], row["n_ids"]], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc"], pa.int64()),
                        pa.array(np.full(len(at) - 1, row["shard"], dtype=np.int32)),
                        pa.array(row["first"] + at[:-1]),
                        pa.array([ids[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                    ],
                    names=["doc", "shard", "start", "ids"],
                )

    docs = table.mapInArrow(documents, "doc long, shard int, start long, ids binary")
    return docs.join(F.broadcast(starts), "shard").select("doc", (F.col("shard_start") + F.col("start")).alias("start"), "ids")


def read_range(spark: SparkSession, path: str, start: int, count: int) -> np.ndarray:
    """Random access: ids from place ``start`` over all shards, reading only the blocks that hold them."""
    table = spark.read.schema(BLOCKS).parquet(path)
    sizes = table.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # one row per shard
    found, place = [], 0
    for shard in sizes:
        low, high = max(start, place) - place, min(start + count, place + shard["n"]) - place
        if low < high:
            inside = (F.col("first") < high) & (F.col("first") + F.col("n_ids") > low)
            for row in table.where((F.col("shard") == shard["shard"]) & inside).orderBy("first").toLocalIterator():
                a, b = max(low, row["first"]) - row["first"], min(high, row["first"] + row["n_ids"]) - row["first"]
                found.append(unpack(row["words"], row["bits"], a, b - a))
        place += shard["n"]
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)
