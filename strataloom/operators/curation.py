"""Curated aggregates of commits, files, blame and dependencies.

Every function is DataFrame -> DataFrame; one aggregation, one shuffle on its keys, and the final order of a report is
left to the writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataloom.functions.exprs import CODE_SUFFIXES, file_extension, quarter_of


def hacker_extension(commits: DataFrame) -> DataFrame:
    """Per author and extension of text files: sums, distinct commit times, distinct paths."""
    return (
        commits.where("is_binary = 0")
        .groupBy("author", file_extension("file_path").alias("extension"))
        .agg(F.sum("total_inserts").alias("total_inserts"), F.sum("total_deletes").alias("total_deletes"), F.countDistinct("commit_date").alias("num_commits"), F.countDistinct("file_path").alias("num_files"))
    )


def hacker_extension_monthly(commits: DataFrame) -> DataFrame:
    """The same per month (its first instant in UTC), for code suffixes only."""
    rows = commits.where("is_binary = 0").withColumn("extension", file_extension("file_path")).where(F.col("extension").isin(CODE_SUFFIXES))
    return rows.groupBy("author", "extension", F.date_trunc("MM", "commit_date").alias("year_month")).agg(
        F.sum("total_inserts").alias("total_inserts"), F.sum("total_deletes").alias("total_deletes"), F.countDistinct("commit_date").alias("num_commits"), F.countDistinct("file_path").alias("num_files")
    )


def hacker_dependency(blame: DataFrame, dependency: DataFrame) -> DataFrame:
    """Blamed lines per author, extension and dependency; a file's lines count for each of its dependencies."""
    joined = blame.join(dependency.select("partition_key", "owner_repo", "file_path", "dependency"), ["partition_key", "owner_repo", "file_path"])
    return joined.groupBy("author", file_extension("file_path").alias("extension"), "dependency").agg(F.sum("lines").alias("line_count"))


def repo_dependency(dependency: DataFrame) -> DataFrame:
    return dependency.groupBy("partition_key", "owner", "repo_name", "owner_repo", file_extension("file_path").alias("extension"), "dependency").agg(F.count("*").alias("file_count"))


def repo_extension(files: DataFrame) -> DataFrame:
    """Per repository and extension of text files: sums, distinct paths, commits."""
    return (
        files.where("is_binary = 0")
        .groupBy("owner", "repo_name", file_extension("file_path").alias("extension"))
        .agg(F.sum("total_inserts").alias("total_inserts"), F.sum("total_deletes").alias("total_deletes"), F.countDistinct("file_path").alias("num_files"), F.sum("num_commits").alias("total_commits"))
    )


def repo_extension_rows(files: DataFrame) -> DataFrame:
    """``repo_extension`` in its older form: the rows of a repository and extension are counted, without commits."""
    keys = ["owner", "repo_name", file_extension("file_path").alias("extension")]
    return files.where("is_binary = 0").groupBy(*keys).agg(F.sum("total_inserts").alias("total_inserts"), F.sum("total_deletes").alias("total_deletes"), F.count("*").alias("num_files"))


def report(df: DataFrame, path: str, order: list[str], files: int = 1) -> None:
    """Writes a report in order: sorted as a whole, as so many files (several keep the order within each)."""
    df.orderBy(*order).coalesce(files).write.mode("overwrite").parquet(path)


def repo_hacker(commits: DataFrame) -> DataFrame:
    """Per repository, author and extension, binary files included: distinct paths and inserted lines."""
    return commits.groupBy("owner", "repo_name", "partition_key", "owner_repo", "author", file_extension("file_path").alias("extension")).agg(
        F.countDistinct("file_path").alias("num_files"), F.sum("total_inserts").alias("total_inserts")
    )


def repo_extension_summary(curated: DataFrame, suffixes: list[str] = CODE_SUFFIXES) -> DataFrame:
    """One row per repository with inserts, deletes, files and commits of each suffix, 0 where it has none.

    One pivot over a stated list of suffixes instead of a self-join for each: one shuffle whatever their number.
    """
    measures = {"inserts": "total_inserts", "deletes": "total_deletes", "files": "num_files", "commits": "total_commits"}
    wide = curated.groupBy("owner", "repo_name").pivot("extension", suffixes).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    names = [(f"{s}_{n}", f"{s[1:]}_{n}") for s in suffixes for n in measures]
    return wide.select("owner", "repo_name", *[F.coalesce(F.col(f"`{old}`"), F.lit(0)).alias(new) for old, new in names])


def extension_windows(monthly: DataFrame) -> DataFrame:
    """Months of an author and extension beside the totals of their year and quarter, with continuous period numbers."""
    day = F.to_date("year_month")
    rows = monthly.select("author", "extension", F.year(day).alias("year"), quarter_of(F.month(day)).alias("quarter"), F.month(day).alias("month"), F.col("num_files").alias("month_files"), F.col("total_inserts").alias("month_lines"))
    year, quarter = Window.partitionBy("author", "extension", "year"), Window.partitionBy("author", "extension", "year", "quarter")
    return rows.select(
        "*",
        F.col("year").alias("year_ce"),
        (F.col("quarter") + 4 * F.col("year")).alias("quarter_ce"),
        (F.col("month") + 12 * F.col("year")).alias("month_ce"),
        *[F.sum(f"month_{x}").over(w).alias(f"{n}_{x}") for x in ("files", "lines") for n, w in (("year", year), ("qrtr", quarter))],
    )


def popular_dependencies(repo_deps: DataFrame, more_than: int) -> DataFrame:
    """Dependencies of an extension in more than so many repositories."""
    return repo_deps.groupBy("extension", "dependency").agg(F.count("*").alias("num_repos"), F.sum("file_count").alias("num_files")).where(F.col("num_repos") > more_than)


def files_from_commits(commits: DataFrame) -> DataFrame:
    """Totals per file out of its commits: commits, first and last date, sums, and is_binary of the earliest commit."""
    return commits.groupBy("owner_repo", "file_path").agg(
        F.countDistinct("commit_id").alias("num_commits"), F.min("commit_date").alias("first_commit_date"), F.max("commit_date").alias("last_commit_date"), F.sum("total_inserts").alias("total_inserts"), F.sum("total_deletes").alias("total_deletes"), F.min_by("is_binary", F.struct("commit_date", "commit_id", F.coalesce("is_binary", F.lit(-1)))).alias("is_binary")
    )
