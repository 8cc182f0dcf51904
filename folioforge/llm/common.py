"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_ROWS = "2000"
ARROW_BYTES = str(32 << 20)
#: Surrogate ids of rows without a doc_id start here, above every real id.
SURROGATE = 1 << 62


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for very long texts; a stricter setting of the session stays."""
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    if int(rows) <= 0 or int(rows) > int(ARROW_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    size = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    if not size.isdigit() or int(size) > int(ARROW_BYTES):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def give_back() -> None:
    """Hand freed memory to the system: a worker is kept for later tasks and stages, and what it holds counts with its executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, per_batch: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply a function of one Arrow batch to every batch of df, without a shuffle."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := per_batch(batch)) is not None:
                yield out
        give_back()

    return df.mapInArrow(run, schema)


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with checkpoint() in the folder of spark.checkpoint.dir; one of our own only where none is set."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="folioforge-checkpoint-")
        context.setCheckpointDir(shared)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of df has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_row_id(docs: DataFrame, file: str, at: str) -> DataFrame:
    """docs with two longs that tell its rows apart: a hash of the file's path and the row's place in it.

    A table just read from Parquet has them; any other is first written to the checkpoint folder with numbers of its own, so
    that a row keeps them however often it is read.
    """
    if docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation" and docs.inputFiles() and "_metadata" not in (c.lower() for c in docs.columns):
        return docs.select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at))
    return durable(docs.withColumns({file: F.lit(0).cast("long"), at: F.monotonically_increasing_id()}))


def keyed(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id, or for a row without one a surrogate made from its text, above every real id."""
    spare = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).bitwiseAND(F.lit(SURROGATE - 1)) + F.lit(SURROGATE)
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), spare)
