"""Per-key results when a few keys hold most rows (problem 5).

Rows are range-partitioned on the composite (key, secondary order); Spark's range partitioner samples the quantiles of
that pair, so a key that holds a third of all rows is cut into as many ranges as its size asks for. Each range makes
partial states; what is shuffled afterwards is one row per key and range, and only those meet to be stitched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataloom.session import checkpointed, parallelism


def ranged(df: DataFrame, key: str, order: Sequence[str], partitions: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """``df``, or its ``columns``, in ranges of (key, order...), heavy keys split across ranges; ``range_no`` names the range.

    Ties beyond ``order`` are broken by the row's place in the input, a hash of its partition and number there: rows of one
    key with null or equal order, and exact repeats, are split like any others. The place depends on the row alone for a
    given input split, so that a task run again deals its rows out alike.
    """
    n = partitions or parallelism(df.sparkSession)
    rows = df.select(*[F.col(f"`{c}`") for c in (columns if columns is not None else df.columns)], F.xxhash64(F.monotonically_increasing_id()).alias("_place"))
    return rows.repartitionByRange(n, F.col(key), *[F.col(c) for c in order], F.col("_place")).drop("_place").withColumn("range_no", F.spark_partition_id())


def stitched_totals(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows, non-null values and sums per key: columns key, n_rows and, for each value v, n_v and sum_v.

    A null key is a key of its own. Nulls in a value count in n_rows only; the sum of no value is null. An empty table
    gives no rows. Only the columns named are read. The states of a range are built map-side right after the range
    partitioning; the exchange that follows carries one row per key and range.
    """
    rows = ranged(df, key, order, partitions, [key, *dict.fromkeys(c for c in (*order, *values) if c != key)])
    states: list[Column] = [F.count("*").alias("n_rows")]
    merge: list[Column] = [F.sum("n_rows").alias("n_rows")]
    for v in values:
        states += [F.count(v).alias(f"n_{v}"), F.sum(F.col(v).cast("bigint")).alias(f"sum_{v}")]
        merge += [F.sum(f"n_{v}").alias(f"n_{v}"), F.sum(f"sum_{v}").alias(f"sum_{v}")]
    return rows.groupBy("range_no", key).agg(*states).groupBy(key).agg(*merge)


def stitched_running(df: DataFrame, key: str, order: Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``seq_no`` (1, 2, ... within the key in ``order``) and ``running_sum`` of ``value`` up to the row.

    Ranges are numbered and summed on their own; the totals of a key's earlier ranges, at most one row per key and
    range, are added at the boundaries. Nulls add nothing. Rows that tie on ``order`` are numbered in some order.
    """
    rows = checkpointed(ranged(df, key, order, partitions))
    local = Window.partitionBy("range_no", key).orderBy(*order)
    totals = rows.groupBy("range_no", key).agg(F.count("*").alias("n"), F.coalesce(F.sum(value), F.lit(0)).alias("s"))
    before = Window.partitionBy(key).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        F.col("range_no").alias("c_range"), F.col(key).alias("c_key"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("c_n"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("c_s")
    ).where("c_n > 0")
    numbered = rows.withColumn("seq_no", F.row_number().over(local).cast("bigint")).withColumn(
        "running_sum", F.coalesce(F.sum(value).over(local.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    )
    joined = numbered.join(carry, (F.col("range_no") == F.col("c_range")) & F.col(key).eqNullSafe(F.col("c_key")), "left")
    return joined.withColumn("seq_no", F.col("seq_no") + F.coalesce("c_n", F.lit(0))).withColumn("running_sum", F.col("running_sum") + F.coalesce("c_s", F.lit(0))).drop("c_range", "c_key", "c_n", "c_s", "range_no")


def heavy_values(totals: DataFrame, key: str, share: float = 0.04) -> DataFrame:
    """Values (as text ``key_value``) with at least ``share`` of all rows, null keys counted in the total only.

    The total is a sum over the per-key rows; at most 1/share rows come out.
    """
    total = totals.agg(F.sum("n_rows")).scalar()
    return totals.where(F.col(key).isNotNull() & (F.col("n_rows") >= total * share)).select(F.col(key).cast("string").alias("key_value"))
