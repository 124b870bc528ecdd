"""Exact ranks, quotas and running sums inside large groups without sorting a group in one task.

A group (a class) may hold a third of all rows. Rows are ordered by a salted
hash; the leading hash digits cut each group into many small buckets. Counting
the buckets gives every bucket's offset, so ranks are only formed inside
buckets, in parallel. Keys identify rows: they must be unique and not null. Rows
without a group are a group of their own. Running sums over an order that has to
be kept (scores) are formed inside ranges of (group, order) of about equal size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import null_safe_join
from ..session import materialize

# Rows a bucket should hold at most, were all rows in one group.
BUCKET_ROWS = 100_000


def bucket_digits(n_rows: int) -> int:
    """Leading hex digits of the hash that name a bucket: 16 times the buckets for each digit."""
    return max(1, min(12, math.ceil(math.log(max(n_rows, 1) / BUCKET_ROWS, 16))))


def hash_order(key: Column, seed: int) -> Column:
    """The pseudo-random position of a row: a hex digest of its key and the seed."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def _buckets(df: DataFrame, group: str) -> DataFrame:
    """Rows (group, bucket, size, before): rows per bucket and rows in earlier buckets."""
    sizes = df.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0).cast("bigint")))


def _with_order(df: DataFrame, key: str, seed: int, n_rows: int) -> DataFrame:
    return (df.withColumn("_order", hash_order(F.col(key), seed))
            .withColumn("_bucket", F.substring("_order", 1, bucket_digits(n_rows))))


def hash_rank(df: DataFrame, group: str, key: str, seed: int, out: str, n_rows: int) -> DataFrame:
    """Add the 1-based rank of each row inside its group by hash order (ties by key).

    ``n_rows`` is the number of all rows; it only sets the number of buckets.
    """
    ordered = _with_order(df, key, seed, n_rows)
    offsets = _buckets(ordered.select(group, "_bucket"), group).drop("size")
    inside = Window.partitionBy(group, "_bucket").orderBy("_order", key)
    return (null_safe_join(ordered.withColumn("_rank", F.row_number().over(inside)), offsets, [group, "_bucket"])
            .withColumn(out, F.col("before") + F.col("_rank"))
            .drop("_order", "_bucket", "_rank", "before"))


def first_by_hash(df: DataFrame, group: str, key: str, seed: int, quotas: DataFrame, out: str,
                  n_rows: int) -> DataFrame:
    """Add a flag: is the row among the first ``quota`` rows of its group by hash order?

    ``quotas`` holds (group, quota), one row per group. Only rows of the one
    bucket per group that the quota cuts are ranked; all others are decided by
    their bucket alone, without a shuffle.
    """
    ordered = _with_order(df, key, seed, n_rows)
    cut = (null_safe_join(_buckets(ordered.select(group, "_bucket"), group), quotas, [group])
           .filter((F.col("before") < F.col("quota")) & (F.col("before") + F.col("size") >= F.col("quota")))
           .select(group, F.col("_bucket").alias("_cut"), (F.col("quota") - F.col("before")).alias("_take")))
    inside = Window.partitionBy(group).orderBy("_order", key)
    edge = (null_safe_join(ordered.select(group, key, "_order", "_bucket"), cut, [group])
            .filter(F.col("_bucket") == F.col("_cut"))
            .withColumn("_rank", F.row_number().over(inside)))
    last = edge.filter(F.col("_rank") == F.col("_take")).select(
        group, F.col("_order").alias("_last"), F.col(key).alias("_last_key"))
    before_or_at = (F.col("_order") < F.col("_last")) | (
        (F.col("_order") == F.col("_last")) & (F.col(key) <= F.col("_last_key")))
    # A group with quota 0 has no cut: none of its rows is taken.
    return (null_safe_join(ordered, last, [group], "left")
            .withColumn(out, F.coalesce(before_or_at, F.lit(False)))
            .drop("_order", "_bucket", "_last", "_last_key"))


def sums_before(points: DataFrame, keys: list[str], order: str, sums: list[str], ascending: bool = True) -> DataFrame:
    """Add ``<s>_before`` for each s in ``sums``: the total over the rows of the same group that come strictly earlier.

    ``points`` has one row for each (keys, order), none of them null. A range
    shuffle deals it to parts of about equal size, whatever the groups and
    however close their values; only the parts' totals are summed up along a
    group. The parts are written once, so both steps see the same ones.
    """
    by = [*keys, F.col(order).asc() if ascending else F.col(order).desc()]
    dealt = materialize(points.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id()),
                        "ranges")
    zero = F.lit(0).cast("bigint")
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*keys, "_part").agg(*[F.sum(s).alias(f"_{s}") for s in sums]).select(
        *keys, "_part", *[F.coalesce(F.sum(f"_{s}").over(earlier), zero).alias(f"_{s}_offset") for s in sums])
    inside = Window.partitionBy(*keys, "_part").orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.select("*", *[F.coalesce(F.sum(s).over(inside), zero).alias(f"_{s}_inside") for s in sums])
    return local.join(totals, [*keys, "_part"]).select(
        *points.columns, *[(F.col(f"_{s}_inside") + F.col(f"_{s}_offset")).alias(f"{s}_before") for s in sums])
