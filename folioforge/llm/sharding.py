"""Sharding: contiguous shards of near equal bytes, cut by global prefix sums.

Documents are put in the order of a digest of their text, so that equal texts stand together, and of doc_id. They are dealt
by ranges of that order and sorted; per-partition totals of bytes and rows, summed over the partitions
before, give each partition its offset, so no task ever sees more than its own range. A document whose first byte, in
the running sum over all documents, lies in the k-th of `shards` equal parts of the total goes to shard k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

OVERHEAD = 16


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 2000, max_ranges: int = 5000) -> DataFrame:
    """One row a document: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null), global_offset.

    size is the text's bytes in UTF-8 (none for a null text, which counts as empty otherwise) plus OVERHEAD. Shards are
    contiguous in the order of the text's 64-bit xxHash (as a signed number) and doc_id, rows without an id first. A shard
    holds its share of the bytes but for one document at either end. slot counts from 0 within a shard without a gap.
    Equal texts share a shard, unless a cut between shards falls among them; a group larger than a shard fills several. Rows
    alike in text and id are interchangeable; the row's place in the input, taken as last, spreads them over ranges. No text
    is shuffled, and other columns are not read.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("digest"),
        F.monotonically_increasing_id().alias("row_at"),
    )
    n = docs.count()
    ranges = max(1, -(-n // max(rows_per_range, -(-n // max_ranges))))
    order = ["digest", "doc_id", "row_at"]
    # The dealt rows are written once: a partition's number has to stay the same in both uses of it.
    dealt = durable(rows.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    offsets = (
        dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"))
    )
    total = dealt.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    within = Window.partitionBy("part").orderBy(*order)
    start = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    placed = (
        dealt.withColumns({"start": start, "row": F.row_number().over(within) - 1})
        .join(F.broadcast(offsets), "part")  # at most max_ranges rows
        .select("doc_id", "size", "text_crc32", (F.col("start") + F.col("bytes_before")).alias("global_offset"), (F.col("row") + F.col("rows_before")).cast("long").alias("row"))
        .withColumn("shard", F.expr(f"cast(cast(global_offset as decimal(38,0)) * {shards} div {max(total, 1)} as int)"))
    )
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(  # at most `shards` rows
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "global_offset",
    )
