"""Incremental ingestion: new snapshot files in, touched partitions out.

Snapshots are whole files and marts are keyed by month, so no watermark is
needed: each run takes the files it has not seen, and stops.

A snapshot is known by its name (``source_file``), wherever it was delivered. A
later delivery of the name takes the place of the earlier one. Every batch
writes partitions of its own, so a repeated batch replaces what it wrote before.
"""

from __future__ import annotations

import uuid
from typing import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import manifest
from ..session import settle
from ..sources.readers import sheet_name


def snapshot_stream(
    spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Files of a folder as a stream. Column order and types come from ``schema``.

    ``files_per_batch`` only cuts the work into batches; all files are taken.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True)
    return (reader.option("header", True).csv if kind == "csv" else reader.parquet)(path)


def named_snapshots(stream: DataFrame) -> DataFrame:
    """A stream of files with the name of the snapshot each row came from."""
    return stream.select("*", sheet_name(F.col("_metadata.file_path")).alias("source_file"))


def drain(stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]) -> None:
    """Process everything that is there now, then stop.

    The checkpoint remembers the files that were done, so the next call starts
    after them, on whatever machine it runs.
    """
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest(
    stream: DataFrame, target: str, checkpoint: str, clean: Callable[[DataFrame], DataFrame]
) -> None:
    """Clean each batch and write it under its batch number.

    A batch that is repeated after a failure replaces its own folder, so every
    file is taken exactly once.
    """

    def write(batch: DataFrame, number: int) -> None:
        cleaned = clean(batch).withColumn("batch", F.lit(number))
        cleaned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch"
        ).parquet(target)

    drain(stream, checkpoint, write)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of earlier batches; no rows before the first one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _save(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


# --- monthly marts from partial states ------------------------------------------------------


def maintain_months(
    stream: DataFrame,
    states: str,
    mart: str,
    checkpoint: str,
    clean: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    measures: Mapping[str, Column],
    month: str = "month",
) -> None:
    """Keep a monthly mart of sums and counts current from partial states.

    Each file leaves one partial state per month and key: its own ``measures``, which add up. A batch
    computes the states of its files, and the mart rows of the months it touches are added up again
    from states. So a batch reads its new files and the states of touched months, and no line of
    earlier batches. A file that comes again under its name is taken back: only the states of a
    file's last batch count, in all months that any delivery of it had touched.

    ``stream`` comes from :func:`named_snapshots`. Read the mart with :func:`month_mart`.
    """
    named = ["source_file", month, *keys]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        # files without a clean line are deliveries too
        files = batch.select("source_file").distinct().withColumn("batch", F.lit(number))
        _save(files, f"{states}/files", "batch")
        fresh = clean(batch).groupBy(*named).agg(*[c.alias(n) for n, c in measures.items()])
        _save(fresh.withColumn("batch", F.lit(number)), f"{states}/months", month, "batch")
        schema = fresh.schema.add("batch", T.IntegerType())
        stored = _stored(spark, f"{states}/months", schema)
        delivered = spark.read.schema(files.schema).parquet(f"{states}/files")
        last = delivered.groupBy("source_file").agg(F.max("batch").alias("_last"))
        again = last.filter(F.col("_last") == number)
        # months are few: a partition list
        touched = [r[0] for r in stored.join(again, "source_file", "left_semi").select(month).distinct().collect()]
        if not touched:
            return
        now = F.col(month).isin([m for m in touched if m is not None])
        known = stored.filter(now | F.col(month).isNull() if None in touched else now).join(last, "source_file")
        live = F.col("batch") == F.col("_last")
        # rows that only replaced deliveries had stay, without files, so that their partition is overwritten
        sums = [F.coalesce(F.sum(F.when(live, F.col(n))), F.lit(0).cast(schema[n].dataType)).cast(schema[n].dataType).alias(n) for n in measures]
        _save(known.groupBy(month, *keys).agg(F.count_if(live).alias("files"), *sums), mart, month)

    drain(stream, checkpoint, write)


def month_mart(spark: SparkSession, mart: str) -> DataFrame:
    """The mart, with the number of files behind each row."""
    return spark.read.parquet(mart).filter(F.col("files") > 0)


# --- snapshots by content -------------------------------------------------------------------

_INDEX = (
    T.StructType()
    .add("source_file", "string").add("rows", "long").add("content_hash", "string").add("decision", "string").add("batch", "integer")
)


def ingest_by_content(stream: DataFrame, target: str, index: str, checkpoint: str, clean: Callable[[DataFrame], DataFrame]) -> None:
    """Clean and store the files whose content is new; ``index`` says what became of every delivery.

    The index has a row per delivered file: its rows, a content hash that does not depend on their order,
    and the decision: ``new``, ``changed`` (takes the place of the earlier delivery of the name), ``again``
    (same name and content) or ``copy`` (content that another current file has). The last two are skipped;
    a skipped copy stays skipped when the other file changes later. All parts of a file belong to one batch.

    ``stream`` comes from :func:`named_snapshots`. Read the lines with :func:`current_lines`.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        past = _stored(spark, index, _INDEX).filter(F.col("batch") < number)
        current = current_files(past).select("source_file", F.col("content_hash").alias("_held"))
        content = [c for c in batch.columns if c != "source_file"]
        delivered = settle(manifest(batch, "source_file", content).join(current, "source_file", "left"))
        same = F.coalesce(F.col("_held") == F.col("content_hash"), F.lit(False))
        # content of files that this batch does not change
        changing = delivered.filter(~same).select("source_file")
        held = current.join(changing, "source_file", "left_anti").select(F.col("_held").alias("content_hash")).distinct()
        first = delivered.groupBy("content_hash").agg(F.min("source_file").alias("_first"))
        judged = delivered.join(held.withColumn("_kept", F.lit(True)), "content_hash", "left").join(first, "content_hash")
        decision = (
            F.when(same, "again")
            .when(F.col("_kept").isNotNull() | (F.col("source_file") != F.col("_first")), "copy")
            .when(F.col("_held").isNotNull(), "changed")
            .otherwise("new")
        )
        judged = settle(judged.select("source_file", "rows", "content_hash", decision.alias("decision")))
        taken = judged.filter(F.col("decision").isin("new", "changed")).select("source_file")
        lines = clean(batch.join(taken, "source_file", "left_semi"))
        _save(lines.withColumn("batch", F.lit(number)), target, "batch")
        _save(judged.withColumn("batch", F.lit(number)), index, "batch")

    drain(stream, checkpoint, write)


def read_index(spark: SparkSession, index: str) -> DataFrame:
    return _stored(spark, index, _INDEX)


def current_files(index: DataFrame) -> DataFrame:
    """The delivery that counts for each file: the last one that was taken."""
    taken = index.filter(F.col("decision").isin("new", "changed"))
    last = taken.groupBy("source_file").agg(F.max_by(F.struct("batch", "rows", "content_hash"), "batch").alias("_last"))
    return last.select("source_file", "_last.*")


def current_lines(spark: SparkSession, target: str, index: str) -> DataFrame:
    """Lines of the deliveries that count."""
    files = current_files(read_index(spark, index)).select("source_file", "batch")
    return spark.read.parquet(target).join(files, ["source_file", "batch"], "left_semi").drop("batch")


def fresh_folder(base: str, names: Sequence[str]) -> list[str]:
    """Paths for one run below the shared work folder."""
    run = f"{base}/run-{uuid.uuid4().hex}"
    return [f"{run}/{n}" for n in names]
