from datetime import datetime as t

import pytest

from strataloom.operators.orphans import BloomFilter, orphans, salted_join
from pyspark.sql import functions as F


def test_kinds_of_orphans(spark):
    parents = spark.createDataFrame([(1, t(2020, 1, 1), None, 0), (2, t(2020, 1, 1), t(2020, 2, 1), 0), (2, t(2020, 3, 1), None, 0), (2, t(2020, 3, 1), None, 0), (3, None, None, 0), (4, t(2020, 1, 1), t(2020, 2, 1), 0)], "id long, loaded_at timestamp, deleted_at timestamp, t int")
    children = [(1, 1, t(2020, 1, 1)), (2, 1, t(2019, 12, 31)), (3, 2, t(2020, 2, 15)), (4, 2, t(2020, 1, 15)), (5, 2, t(2020, 4, 1)), (6, 9, None), (7, 1, None), (8, None, t(2020, 1, 1)), (9, 3, t(2020, 1, 1)), (10, 4, t(2020, 2, 1)), (2, 1, t(2019, 12, 31)), (11, 99, t(2021, 5, 1))]
    rows = orphans(spark.createDataFrame(children, "id long, ref long, loaded_at timestamp"), parents, "id", "ref", "loaded_at")
    got = sorted(tuple(r) for r in rows.collect())
    assert got == [(2, "late", "2019-12"), (3, "deleted", "2020-02"), (6, "missing", "unknown"), (9, "late", "2020-01"), (10, "deleted", "2020-02"), (11, "missing", "2021-05")]


@pytest.mark.parametrize("n,size", [(0, 8 << 20), (3000, 8 << 20), (3000, 64)])
def test_filter_never_denies_a_key(spark, n, size):
    keys = spark.range(n).select((F.col("id") * 7919 - 5).alias("k")).union(spark.createDataFrame([(None,)], "k long"))
    known = BloomFilter(keys, "k", max_bytes=size)
    assert keys.where("k is not null").where(~known.might_contain(F.col("k"))).isEmpty()
    assert keys.where("k is null").where(known.might_contain(F.col("k"))).isEmpty()
    if size > 64:
        assert spark.range(10_000).where(known.might_contain(F.col("id") * 7919 - 4)).count() < 300


def test_no_parents_and_no_children(spark):
    parents = spark.createDataFrame([], "id long, loaded_at timestamp, deleted_at timestamp")
    children = spark.createDataFrame([(1, 5, None)], "id long, ref long, loaded_at timestamp")
    assert [tuple(r) for r in orphans(children, parents, "id", "ref", "loaded_at").collect()] == [(1, "missing", "unknown")]
    assert orphans(children.limit(0), parents, "id", "ref", "loaded_at").isEmpty()


def test_salted_join_is_the_join(spark):
    left = spark.range(150_000).select((F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))).alias("k"), "id")
    right = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    a, b = salted_join(left, right, "k"), left.join(right, "k", "left")
    assert a.agg(F.count("*"), F.sum("v"), F.sum("id")).first() == b.agg(F.count("*"), F.sum("v"), F.sum("id")).first()
    few = left.limit(300)
    for how in ("left", "inner"):
        a, b, c = (salted_join(few, right, "k", how, least_rows=0), salted_join(few, right, "k", how), few.join(right, "k", how))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) == sorted(map(str, c.collect()))
