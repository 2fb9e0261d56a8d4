"""Dense ids in sort order, without sorting the whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.storage import pinned


def range_ids(df: DataFrame, order: Sequence[str], name: str,
              partitions: int | None = None) -> DataFrame:
    """Number the rows 1..n by `order`, which must be a total order.

    Range partitions put the rows in global order.  Their bounds come from a
    sample, so the partitioned rows are pinned before they are read twice: once
    for the per-partition counts (one row per partition) and once for the rank
    within a partition.
    """
    keys = [F.col(c) for c in order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions \
        else df.repartitionByRange(*keys)
    placed = pinned(ranged.withColumn("_slot", F.spark_partition_id()))
    sizes = placed.groupBy("_slot").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_slot", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_slot").orderBy(*keys))
    # One row per shuffle partition: the broadcast cannot grow with the data.
    return (placed.withColumn("_in_slot", rank)
            .join(F.broadcast(offsets), "_slot")
            .withColumn(name, (F.col("_in_slot") + F.col("_offset")).cast("long"))
            .drop("_slot", "_in_slot", "_offset"))


def calendar_ids(df: DataFrame, day: str, minor: str, order: Sequence[str], name: str,
                 block: int = 1024) -> DataFrame:
    """Number rows 1..n by (day, minor, *order) where `minor` is a dense integer id.

    Rows fall into blocks of one day and `block` neighbouring minor ids, so a
    block stays small however many rows a day or the table holds.  Offsets are
    added in two steps: blocks before this one on the same day, then days before
    this one.  Only the second runs in one task, over one row per calendar day.
    Blocks follow from the values alone, so nothing has to be pinned.
    """
    blocked = in_blocks(df, minor, block).filter(F.col(day).isNotNull() & F.col("_block").isNotNull())
    rank = F.row_number().over(
        Window.partitionBy(day, "_block").orderBy(minor, *order))
    return (blocked.withColumn("_in_slot", rank)
            # Every block has its row; readers of other columns need no join then.
            .join(block_offsets(blocked, day), [day, "_block"], "left")
            .withColumn(name, (F.col("_in_slot") + F.col("_offset")).cast("long"))
            .drop("_block", "_in_slot", "_offset"))


def in_blocks(df: DataFrame, minor: str, block: int = 1024) -> DataFrame:
    """The rows with the block of neighbouring ids they fall in, `_block`."""
    return df.withColumn("_block", F.floor(F.col(minor) / F.lit(block)).cast("long"))


def block_offsets(blocked: DataFrame, day: str) -> DataFrame:
    """Per day and block the number of rows before it, `_offset`."""
    sizes = blocked.groupBy(day, "_block").agg(F.count("*").alias("_size"))
    before = (Window.unboundedPreceding, -1)
    in_day = Window.partitionBy(day).orderBy("_block").rowsBetween(*before)
    blocks = sizes.withColumn(
        "_in_day", F.coalesce(F.sum("_size").over(in_day), F.lit(0)))
    days = sizes.groupBy(day).agg(F.sum("_size").alias("_day_size"))
    over_days = Window.orderBy(day).rowsBetween(*before)
    day_offsets = days.select(
        F.col(day), F.coalesce(F.sum("_day_size").over(over_days), F.lit(0)).alias("_by_day"))
    return (blocks.join(day_offsets, day)
            .select(day, "_block", (F.col("_in_day") + F.col("_by_day")).alias("_offset")))
