"""Texts as sequences of chunks whose tokens do not depend on their neighbours.

Every pre-tokeniser used here ends a piece before a blank that follows something
else than white space; inside a run of mixed white space a piece may go on. A text
can therefore be cut in front of the blanks that start such a run, and equal chunks
give equal tokens wherever they stand. A task tokenises each distinct chunk once
and looks the others up, in a memory of bounded size.

Byte-level vocabularies are cut finer, by the bytes of many texts at once (``cuts``).
"""

from __future__ import annotations

import re
import weakref
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa

from ledgerline.llm.words import text_bytes

#: In front of a blank that follows something else than white space: a run of white space stays whole.
SPACED = re.compile(r"(?<=\S)(?= )")
#: A blank behind other white space.
MIXED = re.compile(r" (?<=[^\S ] )")
#: In front of a line break that follows something else than white space, where no piece goes on.
BREAK = re.compile(r"(?<=\S)(?=\n)")
#: Distinct chunks of a generation; a worker remembers two.
MEMORY = 300_000


class ChunkMemory:
    """``compute`` gets a list of chunks and returns one value for each. What ``compute`` itself keeps is forgotten by its
    ``forget``, if it has one."""

    #: All memories of this process.
    living: weakref.WeakSet = weakref.WeakSet()

    def __init__(self, compute: Callable[[list[str]], Sequence], limit: int = MEMORY):
        self.compute = compute
        self.limit = limit
        # chunks as they stand, and chunks behind one blank, stored without it; then the generation before
        self.plain: dict = {}
        self.after: dict = {}
        self.old_plain: dict = {}
        self.old_after: dict = {}
        self.living.add(self)

    def forget(self) -> None:
        self.plain, self.after, self.old_plain, self.old_after = {}, {}, {}, {}
        getattr(self.compute, "forget", dict)()

    def alone(self) -> ChunkMemory:
        """This memory, when a task starts with it: what operators before it left in a worker that is used again goes."""
        for other in list(self.living):
            if other is not self:
                other.forget()
        return self

    def _fill(self, known: dict, old: dict, wanted: set, blank: str) -> None:
        missing = wanted.difference(known)
        if old and missing:
            again = missing.intersection(old)
            known.update((chunk, old[chunk]) for chunk in again)
            missing -= again
        if missing:
            chunks = list(missing)
            known.update(zip(chunks, self.compute([blank + chunk for chunk in chunks])))

    def values(self, texts: list[str]) -> list[list]:
        """For each text the values of its chunks, in order."""
        if len(self.plain) + len(self.after) > self.limit:
            self.old_plain, self.old_after = self.plain, self.after
            self.plain, self.after = {}, {}
        cut = [text.split(" ") for text in texts]
        # several blanks in a row, or at an end, or behind other white space
        odd = {row for row, pieces in enumerate(cut) if "" in pieces or MIXED.search(texts[row])}
        plain, after = set(), set()
        for row, pieces in enumerate(cut):
            if row in odd:
                cut[row] = pieces = SPACED.split(texts[row])
                plain.update(pieces)
            else:
                plain.add(pieces[0])
                after.update(pieces[1:])
        self._fill(self.plain, self.old_plain, plain, "")
        self._fill(self.after, self.old_after, after, " ")
        first, rest = self.plain, self.after
        return [
            [first[piece] for piece in pieces]
            if row in odd
            else [first[pieces[0]], *map(rest.__getitem__, pieces[1:])]
            for row, pieces in enumerate(cut)
        ]


def parts_of(chunk: str) -> list[str]:
    """Parts of a chunk that are tokenised by themselves: lines, and a word apart from its comma or full stop."""
    parts: list[str] = []
    for part in BREAK.split(chunk) if "\n" in chunk else (chunk,):
        if part[-1:] in (",", ".") and part[part[:1] == " " : -1].isalpha():
            parts += [part[:-1], part[-1]]
        else:
            parts.append(part)
    return parts


def by_parts(encode: Callable[[list[str]], list[bytes]], limit: int = MEMORY) -> Callable[[list[str]], list[bytes]]:
    """For byte-level vocabularies: the ids of chunks from those of their parts, each distinct part encoded once."""
    known: dict[str, bytes] = {}

    def compute(chunks: list[str]) -> list[bytes]:
        if len(known) > limit:
            known.clear()
        cut = [parts_of(chunk) for chunk in chunks]
        missing = list({part for parts in cut for part in parts}.difference(known))
        known.update(zip(missing, encode(missing)))
        return [known[parts[0]] if len(parts) == 1 else b"".join([known[part] for part in parts]) for parts in cut]

    compute.forget = known.clear
    return compute


#: Parts of distinct chunks that are remembered while chunks are encoded.
PARTS = 1 << 16
#: Classes of bytes: what a piece of the byte-level split holds one of. Of other bytes the class is not known.
LETTER, DIGIT, MARK, SPACE, OTHER = range(5)
CLASS = np.full(256, OTHER, dtype=np.uint8)
CLASS[:128] = MARK
CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
CLASS[48:58] = DIGIT
CLASS[[*range(9, 14), 32]] = SPACE
CLASS[28:32] = OTHER  # separators are white space to some libraries only
#: Last bytes of white space outside ASCII.
WIDE_SPACE = np.isin(np.arange(256), [0x80, 0x81, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])


def cuts(raw: np.ndarray, bounds: np.ndarray, marks: Sequence[bytes] = ()) -> np.ndarray:
    """Where the chunks of UTF-8 texts start, that follow each other in ``raw`` and end at ``bounds``.

    The byte-level split ends a piece wherever letters, digits or other marks end, but for an apostrophe in front
    of letters, and looks ahead from white space only. So a text can be cut between bytes of different classes,
    unless the first is white space (a single line break apart), an apostrophe or not known, or the second not
    known. ``marks`` (added tokens) are not cut.
    """
    if not len(raw):
        return np.zeros(0, dtype=np.int64)
    kind = CLASS[raw]
    # letters of Latin-1 have the first byte C3; two of its characters are none
    latin = np.flatnonzero(raw[:-1] == 0xC3)
    latin = latin[(raw[latin + 1] != 0x97) & (raw[latin + 1] != 0xB7)]
    kind[latin] = kind[latin + 1] = LETTER
    cut = np.empty(len(raw), dtype=bool)
    cut[0] = True
    before, after = kind[:-1], kind[1:]
    np.not_equal(before, after, out=cut[1:])
    cut[1:] &= (before < SPACE) & (after != OTHER)
    cut[1:] &= (raw[:-1] != 0x27) | (after != LETTER)
    # a blank behind other characters, unless they may be white space
    wide = np.flatnonzero((before == OTHER) & (raw[1:] == 0x20)) + 1
    cut[wide[~WIDE_SPACE[raw[wide - 1]]]] = True
    edges = bounds[:-1][bounds[:-1] < len(raw)]
    breaks = np.flatnonzero((before == SPACE) & (raw[:-1] == 0x0A) & (after < SPACE)) + 1
    breaks = breaks[breaks > 1]
    single = np.isin(breaks - 1, edges) | (kind[breaks - 2] != SPACE) & (kind[breaks - 2] != OTHER)
    cut[breaks[single]] = True
    if marks:
        data = raw.tobytes()
        for mark in marks:
            at = data.find(mark)
            while at >= 0:
                cut[at + 1 : at + len(mark)] = False
                at = data.find(mark, at + 1)
    cut[edges] = True
    return np.flatnonzero(cut)


class ByteMemory(ChunkMemory):
    """The ids of texts in a byte-level vocabulary, as little-endian 32-bit integers, without an object per chunk.

    The distinct chunks of many texts are looked up; an Arrow dictionary tells where they stand.
    """

    def __init__(self, compute: Callable[[list[str]], Sequence[bytes]], limit: int = MEMORY, marks: Sequence[str] = ()):
        super().__init__(by_parts(compute, PARTS), limit)
        self.marks = [mark.encode() for mark in marks]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, and the places in them where each text starts and ends; a null text has none."""
        if len(self.plain) > self.limit:
            self.old_plain, self.plain = self.plain, {}
        raw, bounds = text_bytes(texts)
        starts = cuts(raw, bounds, self.marks)
        if not len(starts):
            return np.zeros(0, dtype="<i4"), np.zeros(len(bounds), dtype=np.int64)
        offsets = np.append(starts, len(raw)).astype(np.int64)
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = chunks.dictionary_encode()
        _, places, held = coded.dictionary.buffers()
        places, held = np.frombuffer(places, dtype=np.int64, count=len(coded.dictionary) + 1).tolist(), held.to_pybytes()
        distinct = [held[a:b] for a, b in zip(places, places[1:])]
        known, old = self.plain, self.old_plain
        missing = [chunk for chunk in distinct if chunk not in known]
        if old:
            known.update((chunk, old[chunk]) for chunk in missing if chunk in old)
            missing = [chunk for chunk in missing if chunk not in known]
        if missing:
            known.update(zip(missing, self.compute([chunk.decode() for chunk in missing])))
        values = pa.array([known[chunk] for chunk in distinct], pa.large_binary()).take(coded.indices)
        _, upto, data = values.buffers()
        upto = np.frombuffer(upto, dtype=np.int64, count=len(values) + 1) // 4
        return np.frombuffer(data, dtype="<i4", count=int(upto[-1])), upto[np.searchsorted(starts, bounds)]

    def values(self, texts: list[str]) -> list[list]:
        """For each text its ids, as one value."""
        ids, ends = self.ids(pa.array(texts, pa.large_string()))
        return [[ids[a:b].tobytes()] for a, b in zip(ends, ends[1:])]
