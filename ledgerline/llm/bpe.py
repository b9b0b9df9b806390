"""BPE as a deterministic automaton over tokens.

The merges are compiled one after the other, in order of priority. Every merge is
a gadget: ``(u, v) -> w`` bars the arc ``v`` behind an arc ``u`` from that moment
on, puts an arc ``w`` wherever an arc ``u`` was then possible, and lets the state
behind ``w`` inherit what the state behind ``v`` barred until then. The state of
the automaton is the last token. A path over a word is accepted exactly if it is
the word's BPE encoding, so every prefix of a word has one live state and a word
is encoded from left to right by table look-ups, without running merges.

Decoding emits the byte labels of the arcs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.chunks import ByteMemory
from ledgerline.llm.tables import slices

#: The byte-level pre-tokeniser's split. A fixed value that decides results.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Transitions a worker keeps.
TRANSITIONS = 400_000
#: Distinct chunks and parts that a worker remembers.
DISTINCT = 200_000
#: Ids that are decoded at a time, at dozens of bytes of numbers for each byte of text.
DECODED = 1 << 18
#: Bytes of text that are encoded and decoded together.
CODED_BYTES = 1 << 20


def byte_of_char() -> dict[str, int]:
    """Vocabulary files write each byte as one printable character: itself, or the next free one from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class MergeAutomaton:
    """``labels``: bytes of each token; ``merges``: (left, right, result) in order of priority."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        size = max(labels, default=-1) + 1
        self.labels = labels
        self.rank: dict[tuple[int, int], int] = {}  # gadgets: the arc that is barred, and from when
        self.birth = [-1] * size  # when an arc appeared; bytes were there before all merges
        self.left, self.right = list(range(size)), list(range(size))
        made: set[int] = set()
        for rank, (u, v, w) in enumerate(merges):
            if w in made or self.birth[w] >= 0 or (u, v) in self.rank:
                raise ValueError("two merges give the same token")
            known = all(part in made or len(labels[part]) == 1 for part in (u, v))
            if not known or labels[u] + labels[v] != labels[w]:
                raise ValueError("a merge uses a token that is made later")
            self.rank[u, v] = rank
            self.birth[w], self.left[w], self.right[w] = rank, u, v
            made.add(w)
        single = {label[0] for token, label in labels.items() if len(label) == 1 and self.birth[token] < 0}
        if labels and len(single) < 256:
            raise ValueError("the vocabulary does not hold every byte")
        self.arcs = {}  # label -> token, for tokens that stand for themselves
        for token in sorted(labels, key=lambda t: self.birth[t]):
            label = labels[token]
            if len(label) == 1 or (self.birth[token] >= 0 and self._whole(token)):
                self.arcs[label] = token
        self.next: dict[int, int] = {}  # 256 * node + byte -> node, of the tree of arc labels
        self.ends = [-1]  # node -> token
        for label, token in self.arcs.items():
            node = 0
            for byte in label:
                if (key := node << 8 | byte) not in self.next:
                    self.next[key] = len(self.ends)
                    self.ends.append(-1)
                node = self.next[key]
            self.ends[node] = token
        self.sizes = [len(labels.get(token, b"")) for token in range(size)]
        self.shorter = [-1] * size  # the longest arc label that the token's label goes on from
        for label, token in self.arcs.items():
            node = 0
            for byte in label[:-1]:
                node = self.next[node << 8 | byte]
                if self.ends[node] >= 0:
                    self.shorter[token] = self.ends[node]
        self.steps: dict[int, bool] = {}

    def _open(self, a: int, b: int, until: int) -> bool:
        """Whether no gadget before ``until`` bars the arc ``b`` behind ``a``: their inner merges are undone, last first."""
        while True:
            rank = self.rank.get((a, b))
            if rank is not None and rank < until:
                return False
            if self.birth[a] < 0 and self.birth[b] < 0:
                return True
            if self.birth[a] > self.birth[b]:
                until, a = min(until, self.birth[a]), self.right[a]
            else:  # of equal pairs the left one merges first, also across the border
                until, b = min(until, self.birth[b] + 1), self.left[b]

    def _whole(self, token: int) -> bool:
        """Whether the token's label is encoded as this token."""
        u, v = self.left[token], self.right[token]
        parts = (self.arcs.get(self.labels[u]) == u) and (self.arcs.get(self.labels[v]) == v)
        return parts and self._open(u, v, self.birth[token])

    def step(self, state: int, token: int) -> bool:
        """Whether the automaton has an arc ``token`` behind the state ``state``."""
        arc = state << 32 | token
        known = self.steps.get(arc)
        if known is None:
            if len(self.steps) > TRANSITIONS:
                self.steps.clear()
            known = self.steps[arc] = self._open(state, token, len(self.rank))
        return known

    def _longest(self, word: bytes, start: int) -> int:
        """The longest arc label that the word goes on with; a single byte at least."""
        follow, ends, node, found = self.next.get, self.ends, 0, -1
        for byte in word[start:]:
            node = follow(node << 8 | byte)
            if node is None:
                break
            if ends[node] >= 0:
                found = ends[node]
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """The one path that spells the word.

        Arcs are tried from the longest on. The path to any place is the only one, so a place that
        has once come to nothing is never entered again.
        """
        whole = self.arcs.get(word)
        if whole is not None:
            return [whole]
        step, sizes, shorter, size = self.step, self.sizes, self.shorter, len(word)
        path: list[int] = []
        dead: set[int] = set()
        place, token = 0, self._longest(word, 0) if word else -1
        while place < size:
            while token >= 0 and (place + sizes[token] in dead or (path and not step(path[-1], token))):
                token = shorter[token]
            if token >= 0:
                path.append(token)
                place += sizes[token]
                token = self._longest(word, place)
            else:
                dead.add(place)
                last = path.pop()
                place -= sizes[last]
                token = shorter[last]
        return path


class Labels:
    """A byte-level BPE vocabulary file: the byte labels of its tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        odd = ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout", "ignore_merges", "byte_fallback")
        if model["type"] != "BPE" or not plain or spec["normalizer"] or any(model.get(key) for key in odd):
            raise ValueError("not a plain byte-level BPE vocabulary")
        if any(token["lstrip"] or token["rstrip"] or token["single_word"] for token in spec["added_tokens"]):
            raise ValueError("added tokens that take up their surroundings are not covered")
        of_char = byte_of_char()
        self.model = model
        self.added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.tokens = {
            i: bytes(of_char[c] for c in text) for text, i in model["vocab"].items() if text not in self.added
        }
        self.all = self.tokens | {i: text.encode() for text, i in self.added.items()}

        size = max(self.all, default=-1) + 1
        known = [self.all.get(i, b"") for i in range(size)]
        self.flat = np.frombuffer(b"".join(known), dtype=np.uint8)
        self.ends = np.cumsum([len(label) for label in known], dtype=np.int64)
        self.sizes = np.diff(self.ends, prepend=0)

    def decode(self, ids: list[int]) -> str:
        """The bytes of the arcs; what is no UTF-8 becomes the replacement character. Unknown ids have no label."""
        return b"".join([self.all.get(i, b"") for i in ids]).decode("utf-8", "replace")

    def decode_lists(self, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of consecutive lists of ids; list ``i`` ends at ``ends[i]`` of all ids."""
        flat = np.where((flat >= 0) & (flat < len(self.sizes)), flat, -1)
        sizes = np.where(flat >= 0, self.sizes[flat], 0) if len(self.sizes) else np.zeros(len(flat), dtype=np.int64)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(upto[-1]) + np.repeat(self.ends[flat] - sizes - upto[:-1], sizes)
        data = self.flat[places].tobytes()
        offsets = np.concatenate([[0], upto[ends]]).astype(np.int64)
        try:
            data.decode("utf-8")
            # whole texts are characters, if none starts inside of one
            starts = offsets[:-1][offsets[:-1] < len(data)]
            if not ((np.frombuffer(data, dtype=np.uint8)[starts] & 0xC0) == 0x80).any():
                return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())
        except UnicodeDecodeError:
            pass
        return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])], pa.string())


class Codec:
    """Pre-tokeniser, automaton and added tokens of a vocabulary file."""

    def __init__(self, path: str):
        self.labels = labels = Labels(path)
        vocabulary = labels.model["vocab"]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in labels.model["merges"]]
        self.automaton = MergeAutomaton(
            labels.tokens, [(vocabulary[u], vocabulary[v], vocabulary[u + v]) for u, v in pairs]
        )
        self.added = labels.added
        self.split = regex.compile(SPLIT)
        marks = sorted(self.added, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.words = ByteMemory(self._chunks, DISTINCT, list(self.added))

    def _plain(self, text: str) -> list[int]:
        encode = self.automaton.encode_word
        return [token for word in self.split.findall(text) for token in encode(word.encode())]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        return [np.array(self.encode(chunk), dtype="<i4").tobytes() for chunk in chunks]

    def encode(self, text: str) -> list[int]:
        if self.marks is None or not self.marks.search(text):
            return self._plain(text)
        ids: list[int] = []
        for part in self.marks.split(text):
            ids += [self.added[part]] if part in self.added else self._plain(part)
        return ids

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(b"".join(values), dtype="<i4") for values in self.words.values(texts)]

    def encode_lists(self, texts: pa.Array) -> pa.Array:
        """The ids of a column of texts; a null text has none."""
        ids, ends = self.words.ids(texts)
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """Compiled once in each worker process."""
    return Codec(path)


@lru_cache(maxsize=2)
def labels_of(path: str) -> Labels:
    return Labels(path)


def _with(df: DataFrame, column: str, kind: str):
    """The schema of ``df`` with one more column, which replaces one of the same name."""
    rest = df.drop(column) if column in df.columns else df
    return rest, rest.select("*", F.lit(None).cast(kind).alias(column)).schema


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the token ids of its texts; a null text is an empty one and has no ids."""
    rest, schema = _with(df, ids_col, "array<int>")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(path)
        words.words.alone()
        for batch in batches:
            for part in slices(batch, text_col):
                lists = words.encode_lists(part.column(text_col))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, ids_col])

    return rest.mapInArrow(rows, schema)


def _decoded(labels: Labels, lists: pa.Array) -> pa.Array:
    """The texts of a column of id lists, a few megabytes of ids at a time; null lists are empty."""
    sizes = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()], dtype=np.int64)
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
    found, start, low = [], 0, 0
    while start < len(ends):
        upto = max(start + 1, int(np.searchsorted(ends, low + DECODED, side="right")))
        found.append(labels.decode_lists(flat[low : ends[upto - 1]], ends[start:upto] - low))
        start, low = upto, int(ends[upto - 1])
    return pa.concat_arrays(found) if found else pa.array([], pa.string())


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text that its ids spell; null ids spell the empty text."""
    rest, schema = _with(df, text_col, "string")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = labels_of(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = _decoded(words, part.column(ids_col))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, text_col])

    return rest.mapInArrow(rows, schema)


def encode_and_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids and the text that the ids spell, in one pass over the texts: one process per task holds the tables."""
    texts = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = texts.select("id", F.lit(None).cast("array<int>").alias("ids"), F.lit(None).cast("string").alias("decoded")).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(path)
        words.words.alone()
        for batch in batches:
            for part in slices(batch, limit=CODED_BYTES):
                lists = words.encode_lists(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists, _decoded(words.labels, lists)], names=["id", "ids", "decoded"])

    return texts.mapInArrow(rows, schema).withColumnRenamed("id", id_col)
