"""Roll-ups of parsed commits and contributor statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def author_rollup(commits: DataFrame, samples: int = 10) -> DataFrame:
    """Per author (author, commit_id, date, n_files): commits, first and last date and commit, files, and the ids of the
    latest ``samples`` commits. The window keeps only the latest rows of an author on either side of the shuffle."""
    order = F.struct("date", "commit_id")
    totals = commits.groupBy("author").agg(
        F.countDistinct("commit_id").alias("commit_count"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.min_by("commit_id", order).alias("first_commit"), F.max_by("commit_id", order).alias("last_commit"), F.sum("n_files").alias("file_count")
    )
    latest = Window.partitionBy("author").orderBy(F.desc("date"), F.desc("commit_id"))
    rows = commits.select("author", "date", "commit_id").withColumn("k", F.row_number().over(latest)).where(F.col("k") <= samples)
    lists = rows.groupBy("author").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "commit_id"))), lambda x: x["commit_id"]).alias("latest_commits"))
    return totals.join(lists, "author")


def contributor_weeks(contributors: DataFrame) -> DataFrame:
    """Weekly statistics (login, weeks array of w, a, d, c): added less deleted lines where positive, commits, and the
    first and last week with commits; contributors without any are left out."""
    rows = contributors.select("login", F.explode("weeks").alias("w")).where("w.c > 0")
    return rows.groupBy("login").agg(F.sum(F.greatest(F.col("w.a") - F.col("w.d"), F.lit(0))).alias("net_lines"), F.sum("w.c").alias("commits"), F.min("w.w").alias("first_week"), F.max("w.w").alias("last_week"))


def merged_commits(commits: DataFrame) -> DataFrame:
    """Commits seen in several projects, once each with the set of projects."""
    return commits.groupBy("commit_id").agg(F.array_sort(F.collect_set("seen_in")).alias("seen_in"))


def dependency_counts(rows: DataFrame, column: str = "dependency") -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def job_slice(rows: DataFrame, key: str, low: str, high: str, part: int, parts: int) -> DataFrame:
    """Rows of a key range, cut into equal hash parts; the parts together are the whole."""
    return rows.where(F.col(key).between(low, high)).where(F.pmod(F.xxhash64(key), F.lit(parts)) == part)


def with_jobs(rows: DataFrame, flags: str, jobs: dict[str, int]) -> DataFrame:
    """One boolean per job from a bit mask."""
    return rows.select("*", *[(F.col(flags).bitwiseAND(bit) != 0).alias(name) for name, bit in jobs.items()])
