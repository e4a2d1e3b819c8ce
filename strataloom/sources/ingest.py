"""From parsed documents to typed raw tables, and from tables to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions.exprs import CODE_SUFFIXES, file_extension, partition_key
from strataloom.operators.oltp import replace_by_key

MOST_FILES = 1000
#: Folders are pruned by value up to so many touched partitions; a partition of more rows than this is written by several
#: tasks if it also has more than its share, so that at most as many partitions as tasks are split.
PRUNED_UP_TO, ROWS_A_TASK = 256, 100_000


def register(spark: SparkSession, root: str, tier: str, name: str) -> DataFrame:
    """Scans a tier's Parquet table and names it ``{tier}_{name}``."""
    df = spark.read.parquet(f"{root}/{tier}/{name}")
    df.createOrReplaceTempView(f"{tier}_{name}")
    return df


def file_hacker(commits: DataFrame) -> DataFrame:
    """Commits with file lists (owner, repo_name, author, commit_id, date, file_list) -> one row per code file of a
    commit; commits of more than a thousand files are left out."""
    rows = commits.where(F.size("file_list") <= MOST_FILES).select("owner", "repo_name", "author", "commit_id", F.col("date").alias("commit_date"), F.explode("file_list").alias("file_path", "f"))
    rows = rows.where(file_extension("file_path").isin(CODE_SUFFIXES))
    keys = ["owner", "repo_name", "file_path", "author", "commit_id", "commit_date"]
    out = rows.groupBy(*keys).agg(F.sum("f.inserts").alias("total_inserts"), F.sum("f.deletes").alias("total_deletes"), F.first("f.binary").cast("tinyint").alias("is_binary"))
    return with_keys(out)


def with_keys(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("owner_repo", F.concat_ws("/", "owner", "repo_name"))
    return rows.withColumn("partition_key", partition_key("owner_repo"))


def blame_rows(blame: DataFrame, kinds: tuple[str, ...] = ("author_hash_map",)) -> DataFrame:
    """Nested blame records -> one row per file, author, blame type and hash."""
    authors = blame.select("owner", "repo_name", "owner_repo", "file_path", "partition_key", F.explode("authors").alias("a"))
    maps = F.explode(F.array(*[F.struct(F.lit(k).alias("blame_type"), F.col(f"a.{k}").alias("m")) for k in kinds]))
    rows = authors.select("owner", "repo_name", "owner_repo", "file_path", "partition_key", "a.author", maps.alias("x"))
    rows = rows.select("owner", "repo_name", "owner_repo", "file_path", "partition_key", "author", "x.blame_type", F.explode("x.m").alias("commit_id", "v"))
    return rows.select("owner", "repo_name", "owner_repo", "file_path", "author", "blame_type", "commit_id", "v.epoch", "v.lines", "v.time_zone", "partition_key").distinct()


def dependency_rows(maps: DataFrame) -> DataFrame:
    """Maps of path -> dependencies (owner, repo_name, deps) -> distinct rows; dependencies with a tab are dropped."""
    rows = maps.select("owner", "repo_name", F.explode("deps").alias("file_path", "d")).select("owner", "repo_name", "file_path", F.explode("d").alias("dependency"))
    return with_keys(rows.where(~F.col("dependency").contains("\t")).distinct())


def recent_repos(items: DataFrame, languages: dict[str, str] | None = None) -> DataFrame:
    """Search items -> repositories in the languages wanted (name -> extension), licence ``Proprietary`` if none."""
    languages = languages or {"Java": ".java"}
    ext = F.create_map(*[F.lit(x) for pair in languages.items() for x in pair])[F.col("language")]
    rows = items.select(F.col("owner.login").alias("owner"), F.col("name").alias("repo_name"), ext.alias("extension"), F.try_to_timestamp("pushed_at").alias("last_update"), F.coalesce("license.key", F.lit("Proprietary")).alias("license"), F.col("watchers_count").cast("int").alias("num_stars"), F.col("forks_count").cast("int").alias("num_forks"))
    return with_keys(rows.where("extension is not null"))


def overwrite(df: DataFrame, path: str, files: int | None = None) -> None:
    """Replaces a table; ``files`` sets how many files a small report has."""
    (df.coalesce(files) if files else df).write.mode("overwrite").parquet(path)


def merge_partitions(spark: SparkSession, fresh: DataFrame, path: str, key: str = "owner_repo", partition: str = "partition_key") -> None:
    """Replaces the rows of the batch's keys in a table partitioned by ``partition``.

    Only the partitions that the batch touches are kept of the existing rows, by a null-safe semi-join with its distinct
    partition values, however many there are; where they are few the values also prune the folders that are read. These
    partitions are written anew (dynamic overwrite) from a checkpoint, so that nothing is deleted before its replacement
    is safe. A null partition is one of its own. A partition of many rows is written by several tasks.
    """
    from strataloom.session import checkpointed, parallelism

    fresh = checkpointed(fresh)
    touched = fresh.select(F.col(partition).alias("_touched")).distinct()
    existing = spark.read.schema(fresh.schema).parquet(path)
    few = [r[0] for r in touched.limit(PRUNED_UP_TO + 1).collect()]
    if len(few) <= PRUNED_UP_TO:
        values = [v for v in few if v is not None]
        existing = existing.where(F.col(partition).isin(values) | F.col(partition).isNull() if None in few else F.col(partition).isin(values))
    existing = existing.join(touched, existing[partition].eqNullSafe(touched["_touched"]), "left_semi")
    merged = checkpointed(replace_by_key(existing, fresh, key))
    tasks = parallelism(spark)
    salt = F.pmod(F.xxhash64(key), F.lit(tasks)).cast("int")
    sizes = merged.groupBy(F.col(partition).alias("_p")).count()
    mean = merged.count() / tasks
    large = F.broadcast(sizes.where(F.col("count") > max(ROWS_A_TASK, mean)).select("_p", F.lit(True).alias("_large")))
    dealt = merged.join(large, merged[partition].eqNullSafe(F.col("_p")), "left").withColumn("_salt", F.when(F.col("_large"), salt).otherwise(F.lit(0)))
    # a stated number of partitions, which aren't merged again
    dealt.repartition(tasks, F.col(partition), F.col("_salt")).drop("_p", "_large", "_salt").sortWithinPartitions(partition, key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
