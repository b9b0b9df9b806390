"""Spelling variants: frequent words as the forms of rare ones that differ by one letter.

Words meet in groups before they are compared. Of two words at one edit, cut at any
place, either everything in front of the cut is equal or everything behind it is; so a
word joins one group under what stands in front and one under what stands behind, each
group knowing the zone of letters in which its members may differ. A group that holds
too many words, or whose zone is long, is cut again within its zone. A zone of one
letter has a bounded number of words, so this ends at any skew, and no pair is lost.

Within a task the zones of many groups make one bit-sliced position index: for every
(position, letter) a bitset over all words of the pack. A search walks the letters of
its zone and updates, for all words at once, the set that agrees so far (no error), the
set with one letter replaced (no shift), and the set with one letter more, which is read
one position on. All searches of one zone length advance together.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import id_and_text, slices
from ledgerline.llm.words import LOWER, text_bytes
from ledgerline.session import settle

#: Words of fewer code points are left out; so are words seen fewer times.
LEAST_LETTERS, LEAST_SEEN = 7, 2
#: Groups of more words, or with longer zones, are cut again.
GROUP, ZONE = 2048, 64
#: Words in an index, and searches that advance together.
PACK, TOGETHER = 4096, 1024
#: Bytes of a run from which on it is summed by itself.
LONG_RUN = 64
#: One in so many occurrences is read with a letter missing, where ``noise`` asks for it.
DROPPED = 31
#: A form is seen at least so many times as often as its variant.
TIMES = 10


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _runs(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, code points) of the maximal runs of A-Z, a-z and U+00C0 to U+00FF in texts of UTF-8 bytes."""
    lead = raw == 0xC3  # the lead byte of exactly these sixty-four
    inside = ((raw | 32) >= 97) & ((raw | 32) <= 122) & (raw < 128) | lead
    inside[1:] |= lead[:-1]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    leads = np.concatenate([[0], np.cumsum(lead)])
    return starts, ends, ends - starts - (leads[ends] - leads[starts])


def _crcs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray) -> np.ndarray:
    """crc32 over the bytes of every run, going on from the sums ``states``; runs of usual length advance together, a byte at a time."""
    sizes = ends - starts
    out = np.empty(len(starts), dtype=np.uint32)
    order = np.argsort(-sizes, kind="stable")
    order = order[np.searchsorted(-sizes[order], -LONG_RUN) :]
    state = states[order] ^ np.uint32(0xFFFFFFFF)
    for i in range(int(sizes[order[0]]) if len(order) else 0):
        on = np.searchsorted(-sizes[order], -i, side="left")
        state[:on] = _CRC[(state[:on] ^ raw[starts[order[:on]] + i]) & 0xFF] ^ (state[:on] >> 8)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for row in np.flatnonzero(sizes > LONG_RUN):
        out[row] = crc32(raw[starts[row] : ends[row]].tobytes(), int(states[row]))
    return out


def _prefix_states(ids: list) -> np.ndarray:
    """The crc32 of ``<id>:`` of every row; a null id is empty."""
    return np.array([crc32(f"{'' if i is None else i}:".encode()) for i in ids], dtype=np.uint32)


def _words_of(part: pa.RecordBatch, noise: int) -> pa.Array:
    raw, bounds = text_bytes(part.column("text"))
    raw = LOWER[raw]
    starts, ends, letters = _runs(raw, bounds)
    keep = letters >= LEAST_LETTERS
    starts, ends, letters = starts[keep], ends[keep], letters[keep]
    if noise:
        text = np.searchsorted(bounds, starts, side="right") - 1
        crcs = _crcs(raw, starts, ends, _prefix_states(part.column("id").to_pylist())[text])
        hit = crcs % noise == 0
        cut = []
        for s, e, crc in zip(starts[hit].tolist(), ends[hit].tolist(), crcs[hit].tolist()):
            word = raw[s:e].tobytes().decode()
            at = crc % len(word)
            cut.append(word[:at] + word[at + 1 :])
        cut = [word for word in cut if len(word) >= LEAST_LETTERS]
        starts, ends = starts[~hit], ends[~hit]
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    words = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(raw[places].tobytes()))
    return pa.concat_arrays([words, pa.array(cut, pa.large_string())]) if noise and cut else words


def vocabulary(texts: DataFrame, noise: int = 0) -> DataFrame:
    """word, n: words of enough letters that are seen often enough in (id, text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counted = _words_of(part, noise).value_counts()
                yield pa.RecordBatch.from_arrays(
                    [counted.field("values").cast(pa.string()), counted.field("counts").cast(pa.int64())], names=["word", "n"]
                )

    counted = texts.mapInArrow(rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_SEEN)


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows (word, n, size, low, high) with the key of their group: pairs whose shorter word has ``size`` letters
    and that differ within its letters ``low`` to ``high`` only."""
    behind = F.col("size") - F.col("high")
    front = F.substring("word", F.lit(1), F.col("low"))
    back = F.substring("word", F.char_length("word") - behind + 1, behind)
    return rows.withColumn("key", F.xxhash64("size", "low", "high", front, back))


def _halved(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), F.col("high")))
    return _grouped(rows.withColumn("_half", F.explode(halves)).select("word", "n", "size", "_half.low", "_half.high"))


def groups(words: DataFrame) -> DataFrame:
    """word, n, size, low, high, key: every word in the groups where it may meet a near one."""
    long = F.char_length("word")
    sizes = F.filter(F.array(long, long - 1), lambda s: s >= LEAST_LETTERS)
    rows = words.select("word", "n", F.explode(sizes).alias("size")).withColumns({"low": F.lit(0), "high": F.col("size")})
    ready, rows = None, settle(_halved(rows))
    while True:
        held = rows.groupBy("key").agg(F.count("*").alias("held"), F.max(F.col("high") - F.col("low")).alias("zone"))
        held = settle(held.where("held > 1"))
        # a zone of one letter is cut no further: its members differ in at most two letters
        again = (F.col("zone") > 1) & ((F.col("held") > GROUP) | (F.col("zone") > ZONE))
        done = rows.join(held.where(~again).select("key"), "key", "left_semi")
        ready = done if ready is None else ready.unionByName(done)
        if held.where(again).isEmpty():
            return ready
        rows = settle(_halved(rows.join(held.where(again).select("key"), "key", "left_semi")))


class _Index:
    """Bitsets over the zones of a pack of words."""

    def __init__(self, zones: list[str], groups: np.ndarray) -> None:
        self.sizes = np.array([len(z) for z in zones])
        self.words = -(-len(zones) // 64)
        most = int(self.sizes.max())
        ends = np.cumsum(self.sizes)
        codes = np.frombuffer("".join(zones).encode("utf-32-le"), dtype=np.uint32)
        letters, flat = np.unique(codes, return_inverse=True)
        row = np.repeat(np.arange(len(zones)), self.sizes)
        place = np.arange(len(codes)) - np.repeat(ends - self.sizes, self.sizes)
        #: letter numbers of every zone; one number more stands for no letter
        self.letters = np.full((len(zones), most + 1), len(letters), dtype=np.int64)
        self.letters[row, place] = flat
        one = np.zeros((most + 1, len(letters) + 1, self.words * 64), dtype=bool)
        one[place, flat, row] = True
        self.at = self._packed(one)
        self.of_size = self._packed(np.arange(most + 2)[:, None] == np.pad(self.sizes, (0, self.words * 64 - len(zones)), constant_values=-1))
        names, self.group = np.unique(groups, return_inverse=True)
        members = np.zeros((len(names), self.words * 64), dtype=bool)
        members[self.group, np.arange(len(zones))] = True
        self.of_group = self._packed(members)

    @staticmethod
    def _packed(bits: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(np.packbits(bits, axis=-1, bitorder="little")).view(np.uint64)

    def near(self, searches: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
        """(search, word) of words in the search's group with one letter replaced or one more; all searches have one zone length.

        With ``last`` unset, words that only have a letter more at the very end are left to the group that shares all letters.
        """
        size = int(self.sizes[searches[0]])
        letters = self.letters[searches]
        agree = self.of_group[self.group[searches]]
        replaced, longer = np.zeros_like(agree), np.zeros_like(agree)
        for i in range(size):
            here = self.at[i][letters[:, i]]
            longer |= agree  # the next letter of the word is the one too many
            longer &= self.at[i + 1][letters[:, i]]
            replaced &= here
            replaced |= agree & ~here
            agree = agree & here
        if last:
            longer |= agree
        else:
            longer &= ~agree
        found = (replaced & self.of_size[size]) | (longer & self.of_size[size + 1])
        search, block = np.nonzero(found)
        bits = np.unpackbits(found[search, block].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(bits)
        return searches[search[which]], block[which] * 64 + bit


def _near_in(pack: pa.Table) -> list[tuple[str, str, int]]:
    """(a, b, n of b) of the near pairs of whole groups, in both directions."""
    words, counts = pack.column("word").to_pylist(), pack.column("n").to_pylist()
    size, low, high = (pack.column(c).to_numpy() for c in ("size", "low", "high"))
    behind = size - high
    zones = [w[a : len(w) - b] for w, a, b in zip(words, low.tolist(), behind.tolist())]
    index = _Index(zones, pack.column("key").to_numpy())
    short = np.flatnonzero(index.sizes == high - low)  # the others are met as the longer ones
    a, b = [], []
    for width in np.unique(index.sizes[short]):
        for last in (True, False):
            part = short[(index.sizes[short] == width) & ((behind[short] == 0) == last)]
            for at in range(0, len(part), TOGETHER):
                x, y = index.near(part[at : at + TOGETHER], last)
                a.append(x)
                b.append(y)
    a, b = np.concatenate(a or [short]), np.concatenate(b or [short])
    found = []
    for x, y in zip(a.tolist(), b.tolist()):
        v, w = words[x], words[y]
        # the key of a group is a hash, so what it stands for is compared as well
        if v[: low[x]] != w[: low[x]] or v[len(v) - behind[x] :] != w[len(w) - behind[x] :]:
            continue
        found.append((v, w, counts[y]))
        if len(v) != len(w):
            found.append((w, v, counts[x]))
    return found


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b, n_b: every ordered pair of words (word, n) that one inserted, deleted or replaced letter tells apart, once."""

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Whole groups, several to a pack; rows come sorted by group."""
        held = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            while held.num_rows > PACK:
                keys = held.column("key").to_numpy()
                ends = np.flatnonzero(keys[1:] != keys[:-1]) + 1
                if not len(ends):
                    break
                upto = ends[max(0, np.searchsorted(ends, PACK, side="right") - 1)]
                yield held.slice(0, upto)
                held = held.slice(upto)
        if held is not None and held.num_rows:
            yield held

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in packs(batches):
            columns = zip(*_near_in(pack))
            kinds = {"a": pa.string(), "b": pa.string(), "n_b": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array(next(columns, []), kind) for kind in kinds.values()], names=list(kinds))

    dealt = groups(words).repartition("key").sortWithinPartitions("size", "low", "high", "key")
    return dealt.mapInArrow(rows, "a string, b string, n_b long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): forms followed to the last one, by doubling the steps."""
    steps = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = steps.join(ahead, "root", "left")
        moved = settle(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps


def spelling_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int = 0, times: int = TIMES) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF of all texts, A-Z lower-cased, with at
    least ``LEAST_LETTERS`` letters and ``LEAST_SEEN`` occurrences ``n``. ``n_near`` is the number of
    words at one inserted, deleted or replaced letter; the form is the one of them seen most often
    (of equals the smallest by code points), if that is at least ``times`` times as often as the word,
    else null, and then ``form_n`` is null too. ``root`` is where forms lead to, the word itself
    without one. With ``noise`` k, an occurrence whose crc32 of ``<id>:<run>`` is divisible by k is
    read without the letter at place crc32 mod length.

    A null text has no words, a null id counts as empty in the crc32, rows that share an id or repeat
    are all counted, other columns are not read, and an empty table gives an empty result.
    """
    texts = id_and_text(df, id_col, text_col)
    words = settle(vocabulary(texts, noise))
    pairs = near_pairs(words)
    # the smallest of the largest counts, then the smallest word by its bytes
    best: Column = F.min(F.struct((-F.col("n_b")).alias("less"), "b"))
    near = pairs.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left").withColumn("often", -F.col("best.less"))
    fits = F.col("often") >= times * F.col("n")
    known = settle(
        known.select(
            "word", F.when(fits, F.col("best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("often")).alias("form_n"),
        )
    )
    roots = _roots(known.where("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
