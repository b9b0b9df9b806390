"""What a task holds follows its pieces, not its batches."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.llm import repeats, words
from ledgerline.llm.shingles import WORD_BYTES
from ledgerline.session import settle


def test_words_of_megabytes_are_hashed_in_parts():
    texts = [" ".join(f"Word{i % 977}" for i in range(n)) for n in (200_000, 0, 1, 300_000)] + ["x" * 600_000 + " end", None]
    whole = pa.array(texts, pa.string())
    words._powers.cache_clear()
    tracemalloc.start()
    try:
        got, bounds = words.hashed_words(whole.slice(0, 4), WORD_BYTES)
        kept, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    size = sum(map(len, texts[:4]))
    assert kept - got.nbytes - bounds.nbytes < 4 * size  # what stays in the worker
    assert peak < 16 * size
    got, bounds = words.hashed_words(whole, WORD_BYTES)
    for row, text in enumerate(texts):
        distinct = {w: words.hashed_words(pa.array([w]), WORD_BYTES)[0][0] for w in set((text or "").split())}
        want = np.array([distinct[w] for w in (text or "").split()], dtype=np.uint64)
        assert (got[bounds[row] : bounds[row + 1]] == want).all() and bounds[row + 1] - bounds[row] == len(want)


def _batch_bytes(spark):
    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "held"])

    texts = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))
    return settle(texts.mapInArrow(rows, "n long, held long")).agg(F.sum("n"), F.max("held")).first()


def test_settle_hands_small_batches_to_python(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    assert spark.conf.get(key, None) is None
    n, held = _batch_bytes(spark)
    assert n == 6000 and held < 6 << 20
    assert spark.conf.get(key, None) is None
    try:  # a session's own setting wins and stays
        spark.conf.set(key, "1m")
        n, held = _batch_bytes(spark)
        assert n == 6000 and held < 2 << 20
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


def test_a_slice_is_hashed_in_parts_that_stay_in_cache():
    """op9: the numbers of a window take many bytes, so a megabyte of texts is hashed a few at a time."""
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdefgh ", k=rng.choice([0, 150, 199, 200, 260, 9_000]))) for _ in range(240)] + ["x" * 700, None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    repeats._text_spans(batch.slice(0, 10), 200)
    tracemalloc.start()
    try:
        gram, span, row = repeats._text_spans(batch, 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 20 * sum(len(t or "") for t in texts)
    alone = [repeats._text_spans(batch.slice(i, 1), 200) for i in range(len(texts))]
    assert (gram == np.concatenate([g for g, _, _ in alone])).all() and (span == np.concatenate([s for _, s, _ in alone])).all()
    assert (row == np.repeat(np.arange(len(texts)), [len(g) for g, _, _ in alone])).all()


def test_suffixes_are_sorted_in_parts_that_stay_in_cache(spark):
    """op9: spans of few anchors are sorted together, whatever a batch holds; each anchor's are."""
    rng = random.Random(9)
    rows = []
    for gram in range(400):
        body = bytes(rng.choices(b"abc", k=300))
        rows += [(False, gram, 2 * gram + i, 0, i, 100 + i, body[i:] + bytes(rng.choices(b"xyz", k=i))) for i in range(2)]
    contexts = spark.createDataFrame(rows, repeats.CONTEXTS).coalesce(1)
    got = repeats._sorted_matches(contexts, 200).collect()
    assert {(r["key"], *((f["low"], f["high"]) for f in r["found"])) for r in got} == {(k, (1, 100)) for k in range(800)}
    assert repeats.SORTED_BYTES <= 1 << 17 and repeats.CACHED_BYTES <= 1 << 16
