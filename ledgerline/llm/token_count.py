"""Token counts by the whole-token shortcut.

Before any text is read, the driver proves for every vocabulary string which
closes a word whether BPE encodes it, alone, as that one token: it runs the
merges on the string and keeps those that end in one symbol. A pre-token in this
table counts as one; only the rest is merged. The table is bounded by the
vocabulary and travels with the tasks.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bpe import byte_of_char
from ledgerline.llm.chunks import ChunkMemory
from ledgerline.llm.tables import id_and_text, slices, whole


class WordVocabulary:
    """A BPE vocabulary with a word-end mark: NFC, one blank for white space, lower case, a split, bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = spec["normalizer"]["normalizers"]
        pre = spec["pre_tokenizer"]["pretokenizers"]
        known = (
            model["type"] == "BPE"
            and model["end_of_word_suffix"]
            and not any(model.get(key) for key in ("unk_token", "continuing_subword_prefix", "dropout", "ignore_merges"))
            and [step["type"] for step in steps] == ["NFC", "Replace", "Lowercase"]
            and [step["type"] for step in pre] == ["Split", "ByteLevel"]
            and pre[0]["invert"] and pre[0]["behavior"] == "Removed" and not pre[1]["add_prefix_space"]
        )
        if not known or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("not a vocabulary of the kind that is covered")
        self.mark = model["end_of_word_suffix"]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        self.rank = {(u, v): rank for rank, (u, v) in enumerate(pairs)}
        self.vocabulary = set(model["vocab"])
        self.split = regex.compile(pre[0]["pattern"]["Regex"])
        self.blank = regex.compile(steps[1]["pattern"]["Regex"])
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.char_of = {b: c for c, b in byte_of_char().items()}

    def normal(self, text: str) -> str:
        """Lower case goes character by character: a sigma that ends a word is no exception."""
        text = self.blank.sub(" ", unicodedata.normalize("NFC", text))
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def symbols(self, word: str) -> list[str]:
        chars = [self.char_of[b] for b in word.encode()]
        return [*chars[:-1], chars[-1] + self.mark]

    def merged(self, symbols: list[str]) -> list[str]:
        """What the merges leave, best first and from the left; a heap keeps long words from costing a square."""
        count = len(symbols)
        symbols = list(symbols)
        after, before = [*range(1, count), -1], [*range(-1, count - 1)]
        heap = [(self.rank[pair], i) for i in range(count - 1) if (pair := (symbols[i], symbols[i + 1])) in self.rank]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if symbols[i] is None or j < 0 or self.rank.get((symbols[i], symbols[j])) != rank:
                continue
            symbols[i], symbols[j] = symbols[i] + symbols[j], None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0:
                    rank = self.rank.get((symbols[left], symbols[after[left]]))
                    if rank is not None:
                        heapq.heappush(heap, (rank, left))
        return [symbol for symbol in symbols if symbol is not None]

    def proven(self) -> frozenset[str]:
        """Words, as their bytes' characters, that are one token each."""
        words = (entry.removesuffix(self.mark) for entry in self.vocabulary if entry.endswith(self.mark))
        return frozenset(
            word for word in words if word and self.merged([*word[:-1], word[-1] + self.mark]) == [word + self.mark]
        )

    def count(self, text: str, single: frozenset[str]) -> int:
        if self.specials is None or not self.specials.search(text):
            return self._count(text, single)
        return sum(self._count(part, single) for part in self.specials.split(text)) + len(self.specials.findall(text))

    def _count(self, text: str, single: frozenset[str]) -> int:
        total = 0
        for word in self.split.findall(self.normal(text)):
            shown = word if word.isascii() else "".join(self.char_of[b] for b in word.encode())
            total += 1 if shown in single else len(self.merged(self.symbols(word)))
        return total


@lru_cache(maxsize=2)
def word_vocabulary(path: str) -> WordVocabulary:
    return WordVocabulary(path)


@lru_cache(maxsize=2)
def proven_words(path: str) -> frozenset[str]:
    return word_vocabulary(path).proven()


_MEMORY: dict[str, ChunkMemory] = {}


def _memory(path: str, single: frozenset[str]) -> ChunkMemory:
    """One per worker process."""
    if path not in _MEMORY:
        words = word_vocabulary(path)
        _MEMORY[path] = ChunkMemory(lambda chunks: [words.count(chunk, single) for chunk in chunks])
    return _MEMORY[path]


def count_tokens(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit.

    A null text is an empty one: no bytes, no tokens. Null and repeated ids are kept
    as they are; other columns are not read.
    """
    single = df.sparkSession.sparkContext.broadcast(proven_words(path))  # bounded by the vocabulary

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(path, single.value).alone()
        for batch in batches:
            for part in slices(batch):
                counts = [sum(values) for values in memory.values(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("n_bytes"), pa.array(np.array(counts, dtype=np.int64))],
                    names=["id", "n_bytes", "n_tokens"],
                )

    texts = id_and_text(df, id_col, text_col).withColumn("text", whole("text"))
    texts = texts.withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = texts.schema["id"].dataType.simpleString()
    counted = texts.mapInArrow(rows, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
