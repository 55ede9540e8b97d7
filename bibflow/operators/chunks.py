"""Chunk assignment (S12) and per-chunk progress counters.

The feed cuts its records into consecutive chunks of ``n`` in a total
order.  ``row_number()`` over the whole data set would put every row into
one task, so the global position is computed in two distributed steps:

1. the rows are range-partitioned by the order columns (any types, as many as
   needed), sorted within their partition and written once to the shared
   folder with their partition and their place in it;
2. per-partition counts (one row per partition) become start offsets that are
   joined back: position = offset + place.

The order must be total: rows that share all order values get positions next
to each other in no defined order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibflow.session import scratch_path

_PART, _PLACE = "__part", "__place"
# ``monotonically_increasing_id`` holds the partition above this bit and the row's place below.
_PLACE_BITS = 33


def assign_chunks(df: DataFrame, order_cols: str | Sequence[str], chunk_size: int = 1000,
                  n_parts: int | None = None, position_col: str = "position",
                  chunk_col: str = "chunk_id") -> DataFrame:
    """Add the 1-based global position and the chunk id (0-based).

    ``n_parts`` defaults to the larger of the shuffle partitions and the
    default parallelism, so no count is needed to plan the job.
    """
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    spark = df.sparkSession
    if n_parts is None:
        n_parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    path = scratch_path(spark, "chunk-order")
    ranged.withColumn(_PLACE, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn(_PART, F.shiftright(_PLACE, _PLACE_BITS).cast("int"))
    counts = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: the window runs over ``n_parts`` rows and the broadcast is bounded by them.
    before = F.sum("__n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    offsets = counts.select(F.col(_PART).alias("__p"), before.alias("__offset"))
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    out = rows.join(F.broadcast(offsets), F.col(_PART) == F.col("__p"))
    return out.select(*df.columns, (F.col("__offset") + place + 1).alias(position_col)).withColumn(
        chunk_col, F.floor((F.col(position_col) - 1) / chunk_size))


def chunk_progress(chunked: DataFrame, chunk_size: int, flag=None,
                   chunk_col: str = "chunk_id") -> DataFrame:
    """Per chunk: its size, the running total, and how many rows ``flag``.

    Every chunk before the last is full, so the running total after chunk
    ``c`` is ``c * chunk_size + size(c)`` - no window over all chunks.
    """
    aggs = [F.count(F.lit(1)).alias("chunk_size")]
    if flag is not None:
        aggs.append(F.count_if(flag).alias("n_flagged"))
    per = chunked.groupBy(chunk_col).agg(*aggs)
    return per.withColumn("running_total", F.col(chunk_col) * chunk_size + F.col("chunk_size"))
