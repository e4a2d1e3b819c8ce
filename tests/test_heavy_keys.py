from pyspark.sql import functions as F

from strataloom.operators.heavy_keys import heavy_values, ranged, stitched_running, stitched_totals


def rows(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
    return spark.range(3000).select(key.alias("key"), (F.col("id") % 11).alias("at"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"), F.lit(1).alias("n_rows"), "id")


def test_totals_equal_the_plain_aggregate(spark):
    df = rows(spark)
    got = stitched_totals(df, "key", ["at"], ["v"], 8)
    want = df.groupBy("key").agg(F.count("*").alias("n_rows"), F.count("v").alias("n_v"), F.sum("v").alias("sum_v"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert stitched_totals(df.limit(0), "key", ["at"], ["v"]).isEmpty()


def test_a_heavy_key_lies_in_several_ranges(spark):
    parts = ranged(rows(spark), "key", ["at"], 8).where("key = 'hot'").select("range_no").distinct().count()
    assert parts > 1


def test_running_sums_are_stitched(spark):
    got = stitched_running(rows(spark), "key", ["at", "id"], "v", 8).where("key = 'hot'").orderBy("seq_no").collect()
    want = rows(spark).where("key = 'hot'").orderBy("at", "id").collect()
    total = 0
    for i, (g, w) in enumerate(zip(got, want, strict=True)):
        total += w["v"] or 0
        assert (g["seq_no"], g["id"], g["running_sum"]) == (i + 1, w["id"], total)


def test_heavy_values_count_nulls_in_the_total(spark):
    df = spark.createDataFrame([("a",)] * 4 + [("b",)] * 3 + [(None,)] * 93, "key string")
    assert [r[0] for r in heavy_values(stitched_totals(df, "key", [], []), "key").collect()] == ["a"]


def test_one_key_with_null_or_no_order_is_split_evenly(spark):
    # repeated rows of one key, without any date to order by
    df = spark.range(0, 40_000, 1, 5).select(F.lit("hot").alias("key"), F.lit(None).cast("timestamp").alias("at"), F.lit(1).alias("v"))
    for order in (["at"], []):
        sizes = [r["count"] for r in ranged(df, "key", order, 8, ["key", *order]).groupBy("range_no").count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 2 * 40_000 / 8
    assert [tuple(r) for r in stitched_totals(df, "key", ["at"], ["v"], 8).collect()] == [("hot", 40_000, 40_000, 40_000)]
    assert {r["seq_no"] for r in stitched_running(df, "key", ["at"], "v", 8).collect()} == set(range(1, 40_001))
