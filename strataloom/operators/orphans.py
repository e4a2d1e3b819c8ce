"""References to parents that weren't there at the time (problem 2).

A Bloom filter over the parent keys is built by an aggregation and broadcast, its size bounded by a parameter. What the
filter denies is an orphan for certain and skips every join; only what it affirms is verified by exact joins.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from strataloom.session import checkpointed

#: Beyond this size the filter is not widened; it then affirms more and the exact joins have more to do.
MAX_FILTER_BYTES = 8 << 20


class BloomFilter:
    """A bounded Bloom filter over one bigint key, built by Catalyst and probed in Arrow batches.

    Positions come from one xxhash64 by double hashing. The bits are set by a distributed aggregation (``bit_or`` per
    64-bit word, combined map-side); the driver receives the words alone, at most ``max_bytes``. A null key is never
    contained. The filter of an empty table contains nothing.
    """

    def __init__(self, keys: DataFrame, key: str, fpp: float = 0.01, max_bytes: int = MAX_FILTER_BYTES):
        spark = keys.sparkSession
        n = max(1, keys.agg(F.approx_count_distinct(key)).first()[0])
        bits = min(max_bytes * 8, max(64, int(-n * math.log(fpp) / math.log(2) ** 2)))
        self.bits = 1 << (bits - 1).bit_length()
        if self.bits > max_bytes * 8:
            self.bits >>= 1
        self.hashes = max(1, min(8, round(self.bits / n * math.log(2))))
        h = F.xxhash64(F.col(key).cast("bigint"))
        mask = self.bits - 1
        low, high = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 33).bitwiseOR(F.lit(1))
        spots = F.array(*[(low + high * i).bitwiseAND(F.lit(mask)) for i in range(self.hashes)])
        words = (
            keys.where(F.col(key).isNotNull())
            .select(F.explode(spots).alias("spot"))
            .groupBy(F.shiftright("spot", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("value"))
            .toArrow()
        )
        array = np.zeros(self.bits >> 6, dtype=np.int64)
        array[words["word"].to_numpy()] = words["value"].to_numpy()
        self.shared = spark.sparkContext.broadcast(array)

    def might_contain(self, key: Column) -> Column:
        shared, mask, hashes = self.shared, self.bits - 1, self.hashes

        @F.pandas_udf(BooleanType())
        def probe(h: pd.Series) -> pd.Series:
            words, x = shared.value, h.to_numpy(dtype=np.int64)
            low, high = x & 0x7FFFFFFF, ((x.view(np.uint64) >> np.uint64(33)) | np.uint64(1)).astype(np.int64)
            hit = np.ones(len(x), dtype=bool)
            for i in range(hashes):
                spot = (low + high * i) & mask
                hit &= (words[spot >> 6] >> (spot & 63)) & 1 == 1
            return pd.Series(hit)

        return key.isNotNull() & probe(F.xxhash64(key.cast("bigint")))


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", heavy_share: float = 0.02, salts: int = 16, least_rows: int = 100_000) -> DataFrame:
    """Equi-join on ``key`` whose hot left keys are spread over ``salts`` tasks.

    Keys with at least ``heavy_share`` of the left rows, at most 1/heavy_share of them, are found by a combined count;
    their left rows get a salt from a hash of the row, their right rows are repeated once per salt. Other keys join as
    they are; so do all of fewer than ``least_rows`` rows. Rows come out as from the plain join.
    """
    counts = left.where(F.col(key).isNotNull()).groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    heavy = [r[0] for r in counts.where(F.col("count") >= max(2, total * heavy_share)).collect()] if total > least_rows else []
    if not heavy:
        return left.join(right, key, how)
    hot = F.col(key).isin(heavy)
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, kind in left.dtypes if not kind.startswith("map")]), F.lit(salts)).cast("int")
    left = left.withColumn("_salt", F.when(hot, spread).otherwise(F.lit(0)))
    right = right.withColumn("_salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def orphans(children: DataFrame, parents: DataFrame, child_id: str, ref: str, at: str, parent_id: str = "id", loaded: str = "loaded_at", deleted: str = "deleted_at", fpp: float = 0.01) -> DataFrame:
    """References that fail at the child's time: child_id, orphan_kind (missing, deleted, late) and period.

    A null reference is no orphan. With a null time only ``missing`` can be told and the period is ``unknown``. A parent
    row without loading time never holds but keeps the reference from being missing. Repeated rows on either side change
    nothing; every combination comes out once. Extra columns are not read. Empty children give no rows, empty parents
    make every reference missing.

    A parent key is reduced to one row by a combined aggregation; the few references that fall between reloads, later
    than a deletion and earlier than an open row, are held against the closed spells.
    """
    wanted = children.select(F.col(child_id).cast("bigint").alias("child_id"), F.col(ref).cast("bigint").alias("ref"), F.col(at).alias("t")).where("ref is not null").distinct()
    spells = parents.select(F.col(parent_id).cast("bigint").alias("ref"), F.col(loaded).alias("a"), F.col(deleted).alias("z")).where("ref is not null")
    known = BloomFilter(spells.select("ref"), "ref", fpp)
    # read by several branches: the filter is asked once per reference
    flagged = checkpointed(wanted.withColumn("maybe", known.might_contain(F.col("ref"))))
    denied = flagged.where("not maybe").select("child_id", F.lit("missing").alias("orphan_kind"), "t")
    summary = spells.groupBy("ref").agg(F.lit(True).alias("there"), F.min("a").alias("first"), F.min(F.when(F.col("z").isNull(), F.col("a"))).alias("open"))
    closed = spells.where("a is not null and z > a").groupBy("ref", "a").agg(F.max("z").alias("z"))
    checked = salted_join(flagged.where("maybe").drop("maybe"), summary, "ref")
    unresolved = checked.where("there is null or (t is not null and (open is null or open > t))")
    between = F.col("there") & (F.col("first") <= F.col("t"))
    spell = closed.select(F.col("ref").alias("c_ref"), "a", "z")
    dead = unresolved.where(between).join(spell, (F.col("ref") == F.col("c_ref")) & (F.col("a") <= F.col("t")) & (F.col("z") > F.col("t")), "left_anti")
    rest = unresolved.where(~F.coalesce(between, F.lit(False))).select("child_id", F.when(F.col("there").isNull(), "missing").otherwise("late").alias("orphan_kind"), "t")
    found = denied.unionByName(rest).unionByName(dead.select("child_id", F.lit("deleted").alias("orphan_kind"), "t"))
    return found.select("child_id", "orphan_kind", F.coalesce(F.date_format("t", "yyyy-MM"), F.lit("unknown")).alias("period")).distinct()
