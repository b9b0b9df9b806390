"""Session defaults. A cluster's own settings always win over these."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "ledgerline", **conf: str) -> SparkSession:
    """A single-machine session for tests and benches. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables and stream checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    master may fall back to a folder of this machine, because there every task
    runs on it; a cluster without the setting is an error, not a guess.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerline-")


#: Rows of a shuffle partition, bytes that small ones are joined to, and bytes of files that a task reads, where
#: ``settle`` is told how many rows there are.
TASK_ROWS, JOINED_BYTES, READ_BYTES = 500_000, "16m", "32m"


@contextmanager
def sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffle partitions and scans for ``rows`` rows while something is written; adaptive execution joins small ones again.

    A fixed number of partitions lets every sort and hash table grow with the data until it spills.
    Settings that are already enough stay, and all come back afterwards.
    """
    ours = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(ours, None) is None:
        ours = "spark.sql.shuffle.partitions"
    wanted = {
        ours: str(-(-rows // TASK_ROWS)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": JOINED_BYTES,
        "spark.sql.files.maxPartitionBytes": READ_BYTES,
    }
    before = {key: spark.conf.get(key) for key in wanted}
    if int(wanted[ours]) <= int(before[ours]):
        yield
        return
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


#: Bytes of an Arrow batch that a Python worker gets, where the session has no setting of its own.
BATCH_BYTES = "4m"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of a few megabytes while something is written: both sides of a Python operator hold a batch or two."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is not None:
        yield
        return
    try:
        spark.conf.set(key, BATCH_BYTES)
        yield
    finally:
        spark.conf.unset(key)


def settle(df: DataFrame, rows: int = 0) -> DataFrame:
    """Write an aggregate once and read it back.

    For an aggregate that several branches of a plan need: the tables below
    it are scanned once instead of once per branch, and what follows survives the
    loss of executors. ``rows``: how many rows go through its largest shuffle, where that is known.
    """
    path = f"{work_dir(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    with sized(df.sparkSession, rows), small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
