"""Small helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task turns into Python objects at a time.
SLICE_BYTES = 4 << 20


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names; other columns, whatever their names, are not read."""
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def whole(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with a few megabytes of text each: long texts do not add up in memory."""
    values = batch.column(column)
    start, filled = 0, 0
    for row, value in enumerate(values):
        filled += len(value.as_buffer()) if value.is_valid else 0
        if filled >= limit:
            yield batch.slice(start, row + 1 - start)
            start, filled = row + 1, 0
    if start < batch.num_rows or batch.num_rows == 0:
        yield batch.slice(start)
