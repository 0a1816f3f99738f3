"""Contiguous shards of equal bytes by global prefix sums.

Native: DataFrame functions only.  The order is (order columns, row number);
each range partition is summed on its own, the per-partition totals (one row a
partition) give every partition its offset, and the global prefix sum of a row
is offset + running sum.  Shards are cut at equal targets of the total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.llm.common import materialise, row_id, shuffle_partitions

_UID, _PART = "_shard_uid", "_shard_part"


def global_prefix(rows: DataFrame, order: list[str], value: str) -> DataFrame:
    """Add ``_before`` (sum of ``value`` over earlier rows), ``_position`` (from 0) and ``_total``.

    ``rows`` should be narrow: it is written twice.  Equal order values are told apart
    by a row number, so one repeated key spreads over partitions like any other rows.
    Null order values come first; a null ``value`` counts 0.
    """
    spark = rows.sparkSession
    keyed = materialise(row_id(rows.withColumn(value, F.coalesce(value, F.lit(0)).cast("long")), _UID))
    ranged = materialise(
        keyed.repartitionByRange(shuffle_partitions(spark), *order, _UID).withColumn(_PART, F.spark_partition_id())
    )
    totals = ranged.groupBy(_PART).agg(F.sum(value).alias("_sum"), F.count("*").alias("_rows"))
    # One row a partition: the only place where all partitions meet.
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        _PART,
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_sum").over(everything).alias("_total"),
    )
    running = Window.partitionBy(_PART).orderBy(*order, _UID)
    return (
        ranged.join(F.broadcast(offsets), _PART)  # at most one row for each shuffle partition
        .withColumn("_position", F.col("_rows_before") + F.row_number().over(running) - 1)
        .withColumn(
            "_before",
            F.col("_sum_before") + F.sum(value).over(running.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value),
        )
        .drop(_PART, _UID, "_sum_before", "_rows_before")
    )


def shard_by_bytes(rows: DataFrame, shards: int, order: list[str], size: str = "size") -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 within the shard).

    A row goes to the shard in which the middle of its bytes lies, so a shard's bytes miss
    total / shards by at most half a row at either end.  An empty input gives an empty
    output.  When all sizes are 0 every row goes to shard 0.
    """
    placed = global_prefix(rows, order, size)
    # Whole number division: shards * doubled stays below 2**63 up to about 10**17 bytes.
    shard = F.when(F.col("_total") > 0, F.expr(f"({shards} * (2 * _before + {size})) div (2 * _total)")).otherwise(0)
    placed = placed.withColumn("shard", F.least(shard, F.lit(shards - 1)).cast("int"))
    first = placed.groupBy("shard").agg(F.min("_position").alias("_first"))  # one row a shard
    return (
        placed.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("_position") - F.col("_first"))
        .drop("_first", "_position", "_before", "_total")
    )


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Contiguous, byte-balanced shards of documents in doc_id order.

    Sizes are UTF-8 bytes of the text plus 1, so null and empty texts count 1.  Null
    doc_ids come first, repeated rows stay apart.  Only doc_id, size and crc32 move.
    """
    small = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    return shard_by_bytes(small, shards, ["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
