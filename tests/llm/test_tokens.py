"""Token files, automaton and counts against the tokenizers library."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
from ledgerline.llm import bpe, chunks, token_count, token_files
from ledgerline.llm.queries import BYTE_BPE, WORD_BPE, documents
from tests.conftest import SF
from tests.llm.cases import ODD, empty, table

BYTE, WORD = Tokenizer.from_file(BYTE_BPE), Tokenizer.from_file(WORD_BPE)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=300), st.data())
@settings(max_examples=80, deadline=None)
def test_packing_round_trip(bits, values, data):
    ids = np.array([v & ((1 << bits) - 1) for v in values], dtype=np.uint32)
    words = token_files.pack(ids, bits)
    assert len(words) == -(-len(ids) // 64) * bits * 8
    start = data.draw(st.integers(0, len(ids)))
    count = data.draw(st.integers(0, len(ids) - start))
    assert token_files.unpack(words, bits, start, count).tolist() == ids[start : start + count].tolist()


def test_width_is_the_least():
    assert [token_files.width_of(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]
    with pytest.raises(ValueError):
        token_files.pack(np.array([4]), 2)


def test_files_hold_all_rows_in_order_and_allow_random_access(spark, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_ids(table(spark), path, BYTE_BPE, end_id=2)
    rows = sorted(token_files.read_ids(spark, path).collect(), key=lambda r: r["start"])
    texts = sorted([(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (-1, "row without id")])
    assert [r["doc"] for r in rows] == [None if i < 0 else i for i, _ in texts]
    whole = [i for _, t in texts for i in [*ids_of(BYTE, t), 2]]
    got = [np.frombuffer(r["ids"], dtype="<u4").tolist() for r in rows]
    assert [i for ids in got for i in ids] == whole
    assert [r["start"] for r in rows] == np.cumsum([0, *map(len, got)])[:-1].tolist()
    for start, count in ((0, 1), (5, 60), (100, 5000), (len(whole) - 3, 3)):
        assert token_files.read_range(spark, path, start, count).tolist() == whole[start : start + count]


def test_empty_table_of_files(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_ids(empty(spark), path, BYTE_BPE)
    assert token_files.read_ids(spark, path).count() == 0
    assert len(token_files.read_range(spark, path, 0, 5)) == 0


def test_op1(spark):
    start, expected = 0, {}
    for row in documents(spark, SF).orderBy("doc_id").collect():
        ids = [*ids_of(BYTE, row["text"]), 2]
        expected[row["doc_id"]] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    got = entry.queries()["op1_token_files"](spark, SF).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == expected and len(got) == len(expected)


def test_automaton_is_the_library_on_random_text():
    codec, random_ = bpe.codec(BYTE_BPE), random.Random(7)
    letters = "abeinorst  aeiouéßñ中\n.,'’!0123😀"
    for _ in range(400):
        text = "".join(random_.choice(letters) for _ in range(random_.randrange(60)))
        assert codec.encode(text) == ids_of(BYTE, text)
        assert codec.encode("a" * random_.randrange(200)) is not None
    for text in ODD:
        ids = ids_of(BYTE, text)
        assert codec.encode(text or "") == ids
        assert bpe.labels_of(BYTE_BPE).decode(ids) == BYTE.decode(ids, skip_special_tokens=False)


SPACES = ["x \u00a0 \u00a0 y", "a \t b\t \tc", "a \n b \r\n \n  c", "end \u00a0 ", "\u00a0 \u00a0 start", "a \u00a0\n\u00a0 b", "\n \u3000 z."]


def test_runs_of_mixed_white_space_stay_whole():
    random_ = random.Random(11)
    texts = [*ODD, *SPACES]
    for _ in range(1500):
        texts.append("".join(random_.choice("    \u00a0\u00a0\t\n\r\u2003\u0085ab.,1'") for _ in range(random_.randrange(25))))
    texts = [text or "" for text in texts]
    expected = [ids_of(BYTE, text) for text in texts]
    library = token_files.LibraryEncoder(BYTE_BPE).memory.values(texts)
    assert [np.frombuffer(b"".join(values), dtype="<u4").tolist() for values in library] == expected
    assert [ids.tolist() for ids in bpe.codec(BYTE_BPE).encode_texts(texts)] == expected
    words, single = token_count.word_vocabulary(WORD_BPE), token_count.proven_words(WORD_BPE)
    memory = token_count.ChunkMemory(lambda chunks: [words.count(chunk, single) for chunk in chunks])
    assert [sum(values) for values in memory.values(texts)] == [len(ids_of(WORD, text)) for text in texts]


def test_decoding_of_broken_and_unknown_ids():
    ids = [random.Random(3).randrange(50257) for _ in range(300)]
    assert bpe.labels_of(BYTE_BPE).decode(ids) == BYTE.decode(ids, skip_special_tokens=False)
    assert bpe.labels_of(BYTE_BPE).decode([10**6]) == ""


def test_gadgets_on_a_tiny_vocabulary():
    labels = {b: bytes([b]) for b in range(256)} | {256: b"ab", 257: b"aa", 258: b"abaa"}
    merges = [(97, 98, 256), (97, 97, 257), (256, 257, 258)]
    automaton = bpe.MergeAutomaton(labels, merges)
    assert automaton.encode_word(b"aab") == [97, 256]  # the earlier merge takes the second a
    assert automaton.encode_word(b"aaa") == [257, 97]  # of equal pairs the left one
    assert automaton.encode_word(b"abaaaab") == [258, 97, 256]
    with pytest.raises(ValueError):
        bpe.MergeAutomaton(labels, [merges[2], *merges[:2]])


def test_encode_keeps_rows_and_columns(spark):
    rows = bpe.decode(bpe.encode(table(spark), BYTE_BPE, ids_col="key"), BYTE_BPE, ids_col="key").collect()
    assert len(rows) == len(ODD) + 2
    for row in rows:
        assert row["key"] == ids_of(BYTE, row["text"]) and row["id"] == "x" and row["decoded"] == BYTE.decode(row["key"], skip_special_tokens=False)
    assert bpe.encode(empty(spark), BYTE_BPE).count() == 0


def test_op2(spark):
    expected = {}
    for row in documents(spark, SF).collect():
        ids = ids_of(BYTE, row["text"])
        shown = ",".join(map(str, ids)), BYTE.decode(ids, skip_special_tokens=False)
        expected[row["doc_id"]] = (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in shown))
    got = entry.queries()["op2_bpe_automaton"](spark, SF).collect()
    assert {r["doc_id"]: tuple(r[1:]) for r in got} == expected and len(got) == len(expected)


def test_proven_words_are_one_token():
    proven = token_count.proven_words(WORD_BPE)
    assert len(proven) > 30_000
    for word in sorted(proven)[::500]:
        if word.isascii() and word.isalpha():
            assert len(ids_of(WORD, word)) == 1


def test_counts_are_the_library(spark):
    got = token_count.count_tokens(table(spark), WORD_BPE, limit=100).collect()
    expected = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "row without id")]
    rows = [(i, len((t or "").encode()), len(ids_of(WORD, t)), len(ids_of(WORD, t)) > 100) for i, t in expected]
    assert Counter(map(tuple, got)) == Counter(rows)
    assert token_count.count_tokens(empty(spark), WORD_BPE).count() == 0


def test_op6(spark):
    got = {r["doc_id"]: tuple(r[1:]) for r in entry.queries()["op6_token_counts"](spark, SF).collect()}
    for row in documents(spark, SF).collect():
        n = len(ids_of(WORD, row["text"]))
        assert got[row["doc_id"]] == (len((row["text"] or "").encode()), n, n > 2048)


def test_path_is_a_parameter():
    assert BYTE_BPE == public_tokenizers.path("byte_bpe_50k.json")


def test_a_worker_keeps_the_chunks_of_one_operator():
    """pipeline: workers are used again by the next stage, which must not find the memory of the last one full."""
    left = chunks.ChunkMemory(chunks.by_parts(lambda texts: [t.upper().encode() for t in texts]))
    ours = chunks.ChunkMemory(lambda texts: [len(t) for t in texts])
    texts = ["a bc, d", "  e\nf g"]
    before = left.values(texts), ours.values(texts)
    assert ours.alone() is ours
    assert not left.plain and not left.after and not left.compute.forget.__self__
    assert ours.plain and ours.after
    assert (left.values(texts), ours.values(texts)) == before


GLUED = ["it's", "'s", "!'s x", "a'LL'll", "d'été×3÷4", "Ñandú,\nÉl.\n\nÀ\n", "x\n y", "\nx\n", "1st,2nd;3'4'x", "…. ….a", "a\u0301b.", "λόγος,\nκαι",
         "!\x1c?\x1d a", "x\u3000 y\u2003 z\u00a0 \u00a0w", "p<|endoftext|>q'<|endoftext|>", "<|endo ftext|>", "\u180e x\u200b y", "½x ²y", "a_b-c"]


def test_chunks_cut_by_bytes_are_the_library():
    """op1, op2: cuts between letters, digits and marks change no id, wherever they fall."""
    random_ = random.Random(5)
    alphabet = [*"aZ09.,'!-_\n\n  \t\r\x00\x0b\x1c\x7f", "'s", "'ll", *"éß×÷ªµñλ中😀…½²\u0301\u00a0\u0085\u2003\u3000\u1680\u200b", "<|endoftext|>", "<|"]
    texts = [*GLUED, *ODD, *("".join(random_.choice(alphabet) for _ in range(random_.randrange(14))) for _ in range(6000))]
    expected = [ids_of(BYTE, text) for text in texts]
    for memory in (token_files.LibraryEncoder(BYTE_BPE).memory, bpe.Codec(BYTE_BPE).words):
        for low in range(0, len(texts), 500):
            ids, ends = memory.ids(pa.array(texts[low : low + 500], pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == expected[low : low + 500]


@pytest.mark.parametrize("memory_of", [lambda: token_files.LibraryEncoder(BYTE_BPE).memory, lambda: bpe.Codec(BYTE_BPE).words])
def test_words_are_encoded_once_whatever_follows_them(memory_of):
    """op1, op2: most of the time went to words that are known with another ending or line in front."""
    memory, seen, words = memory_of(), [], [f"{a}re{b}n" for a in "bcdfg" for b in "aeiou"]
    compute = memory.compute
    memory.compute = lambda chunks: seen.extend(chunks) or compute(chunks)
    memory.values([f"the {w}{end}{w.title()} {w}" for w in words for end in ("!\n", "...", ":\n", "###", ");", "?\n")])
    assert len(seen) <= 3 * len(words) + 10
