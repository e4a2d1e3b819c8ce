"""Batch forms of operational SQL: upserts as merges, selections of queues, reductions of states and JSON shredding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_counts(existing: DataFrame, changes: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Adds the changes' values to those of equal keys; new keys are inserted."""
    return existing.select(*keys, value).unionByName(changes.select(*keys, value)).groupBy(*keys).agg(F.sum(value).alias(value))


def get_or_create(existing: DataFrame, values: DataFrame, natural: str, key: str) -> DataFrame:
    """Surrogate keys of natural values: those that exist keep theirs, new ones get a hash of the value."""
    new = values.select(natural).where(F.col(natural).isNotNull()).distinct().join(existing.select(natural), natural, "left_anti")
    return existing.select(natural, key).unionByName(new.withColumn(key, F.xxhash64(natural)))


def merge_ranges(rows: DataFrame, keys: list[str], first: str, last: str, count: str) -> DataFrame:
    """Earliest, latest and added counts per key; nulls are skipped."""
    return rows.groupBy(*keys).agg(F.min(first).alias(first), F.max(last).alias(last), F.sum(count).alias(count))


def latest_state(events: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """The last event per key, ties by the greater ``tie``: a reduction, not a sort of the key's rows."""
    rest = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(at, tie)).alias("s")).select(*keys, "s.*")


def replace_by_key(existing: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The fresh rows and those existing ones whose key the batch doesn't hold."""
    return fresh.unionByName(existing.join(fresh.select(key).distinct(), key, "left_anti").select(*fresh.columns))


def listing_difference(new: DataFrame, old: DataFrame, line: str) -> DataFrame:
    """Lines of the new listing that the old one lacks; repeats stay."""
    return new.join(old.select(line).distinct(), line, "left_anti")


def orphan_commits(commits: DataFrame, bridge: DataFrame) -> DataFrame:
    """Commits that no bridge row refers to."""
    return commits.join(bridge.select("commit_id").distinct(), "commit_id", "left_anti")


def parallel_repos(repo_commits: DataFrame) -> DataFrame:
    """Per repository: the other repositories with a commit of its own, and those commits: forks and mirrors.

    A commit meets its own repositories only, so the join is as wide as commits are shared.
    """
    rows = repo_commits.where("repo is not null and commit_id is not null").select("repo", "commit_id").distinct()
    shared = rows.groupBy("commit_id").agg(F.count("*").alias("n")).where("n > 1").select("commit_id")
    rows = rows.join(shared, "commit_id", "left_semi")
    other = rows.select(F.col("repo").alias("other"), "commit_id")
    per = rows.join(other, "commit_id").where("other <> repo").groupBy("repo", "other").agg(F.count("*").alias("n"))
    return per.groupBy("repo").agg(F.count("*").alias("parallel_repos"), F.sum("n").alias("shared_commits"))


def job_priority(repos: DataFrame, reserved: DataFrame, limit: int = 15_000) -> DataFrame:
    """The first stage of a queue refill: unreserved repositories of bounded size with watchers, by priority.

    A top-k report: the limit is the feature; ties go by id. The random order of the second stage is the caller's
    (``shuffled``).
    """
    rows = repos.join(reserved.select("repo_id").distinct(), "repo_id", "left_anti").where("size is not null and size < 800000 and watchers > 9")
    priority = F.round(F.log1p("commits") * F.log1p("size"), 6)
    return rows.select("repo_id", priority.alias("priority")).orderBy(F.desc("priority"), "repo_id").limit(limit)


def shuffled(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """A seeded random order cut to n rows."""
    return rows.orderBy(F.rand(seed)).limit(n)


def counters(rows: DataFrame, **conditions: str) -> DataFrame:
    """Global counts of conditions, in one pass."""
    return rows.agg(*[F.count_if(F.expr(c)).alias(name) for name, c in conditions.items()])


def back_off(times: DataFrame, at: str, minutes: int = 2) -> DataFrame:
    return times.withColumn(at, F.col(at) + F.expr(f"interval {minutes} minutes"))


def json_table(rows: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Entries of a flat JSON object of integers: id, key, value; an outer unnest, the row stays without any."""
    entries = F.from_json(json_col, "map<string,bigint>")
    return rows.select(id_col, F.explode_outer(entries).alias("key", "value"))


def file_set_patterns(rows: DataFrame, key: str, item: str) -> DataFrame:
    """How many keys have exactly this set of items."""
    sets = rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(item)), ",").alias("items"))
    return sets.groupBy("items").agg(F.count("*").alias("n_keys"))
