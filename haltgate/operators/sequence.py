"""Previous / next row within a key, without putting a whole key in one task.

A plain ``lag``/``lead`` over ``partitionBy(key)`` sends every row of a key
to one task; a hot scope such as GLOBAL could hold a large share of all
rows. Here rows are windowed within (key, time bucket); the first (or last)
row of each bucket takes its neighbour from the nearest non-empty bucket,
found with a window over a per-bucket summary that has one row per key and
bucket. The summary's size is bounded by the time span, not by the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Default bucket of the per-(key, bucket) windows: a task sorts at most one
# key-minute of rows (a hot scope holding a third of a month's rows is cut
# into ~43k groups), and the stitching summary has at most one row per
# non-empty (key, minute), never more rows than the input.
SEQ_BUCKET_MS = 60_000


def neighbour_in_key(df: DataFrame, key: str, order_cols: list[str], bucket: Column,
                     value_cols: list[str], direction: str, out: str) -> DataFrame:
    """Adds struct column ``out`` holding ``value_cols`` of the previous
    (``direction='prev'``) or next (``'next'``) row of the same ``key`` in
    ``order_cols`` order; null when there is none."""
    if direction not in ("prev", "next"):
        raise ValueError(direction)
    shift = F.lag if direction == "prev" else F.lead
    vals = F.struct(*[F.col(v) for v in value_cols])
    order = F.struct(*[F.col(o) for o in order_cols])
    d = df.withColumn("_bk", bucket)
    local = Window.partitionBy(key, "_bk").orderBy(*order_cols)
    d = d.withColumn("_nb", shift(vals).over(local))
    # Edge row of each bucket: the last one feeds the next bucket's first row
    # (prev), the first one feeds the previous bucket's last row (next).
    edge = F.max_by(vals, order) if direction == "prev" else F.min_by(vals, order)
    summary = (d.groupBy(key, "_bk").agg(edge.alias("_edge"))
               .withColumn("_carry", shift("_edge").over(Window.partitionBy(key).orderBy("_bk")))
               .select(key, "_bk", "_carry"))
    return (d.join(summary, [key, "_bk"], "left")
            .withColumn(out, F.coalesce(F.col("_nb"), F.col("_carry")))
            .drop("_bk", "_nb", "_carry"))


def number_in_key(df: DataFrame, key: str, order_cols: list[str], bucket: Column, out: str) -> DataFrame:
    """Adds ``out``: the row's number, from 0, among those of its ``key`` in ``order_cols``
    order, from its number within (key, bucket) and the counts of earlier buckets."""
    d = df.withColumn("_bk", bucket)
    local = F.row_number().over(Window.partitionBy(key, "_bk").orderBy(*order_cols))
    counts = d.groupBy(key, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    summary = counts.select(key, "_bk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (d.withColumn("_local", local).join(summary, [key, "_bk"], "left")
            .withColumn(out, F.col("_before") + F.col("_local") - 1).drop("_bk", "_local", "_before"))


def day_bucket(ts_ms_col: str, bucket_ms: int = SEQ_BUCKET_MS) -> Column:
    return F.floor(F.col(ts_ms_col) / F.lit(bucket_ms)).cast("bigint")


def next_non_null_in_key(df: DataFrame, key: str, order_cols: list[str], bucket: Column,
                         value_col: str, out: str) -> DataFrame:
    """Adds ``out``: the first non-null ``value_col`` at or after each row
    within ``key`` (in ``order_cols`` order), computed per (key, bucket) with
    a carry from the nearest following bucket that has one."""
    return nearest_non_null_in_key(df, key, order_cols, bucket, value_col, out, "next")


def nearest_non_null_in_key(df: DataFrame, key: str, order_cols: list[str], bucket: Column,
                            value_col: str, out: str, direction: str) -> DataFrame:
    if direction not in ("prev", "next"):
        raise ValueError(direction)
    # Looking ahead is looking back in descending order: such a frame grows row
    # by row, while one that starts at the row would be rebuilt for each row.
    ahead = direction == "next"
    by = F.desc if ahead else F.asc
    d = df.withColumn("_bk", bucket)
    local = (Window.partitionBy(key, "_bk").orderBy(*[by(o) for o in order_cols])
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_loc", F.last(value_col, ignorenulls=True).over(local))
    order = F.struct(*[F.col(o) for o in order_cols])
    edge = F.min_by(value_col, order) if ahead else F.max_by(value_col, order)
    summary = (d.filter(F.col(value_col).isNotNull()).groupBy(key, "_bk").agg(edge.alias("_edge")))
    beyond = (Window.partitionBy(key).orderBy(by("_bk"))
              .rowsBetween(Window.unboundedPreceding, -1))
    # Buckets without a value still need a carry: take every bucket that
    # has rows, attach the summary, then look over the other buckets.
    buckets = d.select(key, "_bk").distinct().join(summary, [key, "_bk"], "left")
    carry = (buckets.withColumn("_carry", F.last("_edge", ignorenulls=True).over(beyond))
             .select(key, "_bk", "_carry"))
    return (d.join(carry, [key, "_bk"], "left")
            .withColumn(out, F.coalesce(F.col("_loc"), F.col("_carry")))
            .drop("_bk", "_loc", "_carry"))
