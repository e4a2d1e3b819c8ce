"""Batch forms of the operational procedures: inserts if absent over several tables, alias states, queues and hand-overs.

Each takes the tables as they are and a batch of calls, and gives the tables, or the rows to add to them, as they are after
all calls. A batch is one pass of joins and aggregations instead of a statement per call.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.operators import nested
from strataloom.session import spread

#: The longest names and file types that are stored.
NAME_LENGTH, TYPE_LENGTH = 256, 128


def counted_aliases(aliases: DataFrame, calls: DataFrame) -> DataFrame:
    """Aliases (md5, name, count) after calls (md5, name, n): counts of known ones grow, new ones are inserted with their
    first name, cut to its stored length. The first name is the least one; calls without md5 are left out."""
    added = calls.where("md5 is not null").groupBy("md5").agg(F.sum("n").alias("n"), F.min(F.substring("name", 1, NAME_LENGTH)).alias("new_name"))
    known = aliases.groupBy("md5").agg(F.min("name").alias("name"), F.max("count").cast("bigint").alias("count"))
    both = known.join(added, "md5", "full")
    return both.select("md5", F.coalesce("name", "new_name").alias("name"), (F.coalesce("count", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("count"))


def new_commits(commits: DataFrame, batch: DataFrame) -> DataFrame:
    """Commits of the batch (commit_id, md5, date, gmt_offset) that aren't there yet, once each."""
    first = F.min(F.struct("md5", "date", "gmt_offset")).alias("first")
    fresh = batch.where("commit_id is not null").join(commits.select("commit_id").distinct(), "commit_id", "left_anti")
    return fresh.groupBy("commit_id").agg(first).select("commit_id", "first.*")


def new_rows(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of the batch that the table lacks; a null within a key is a value like any other."""
    fresh, have = batch.select(*keys).distinct().alias("f"), existing.select(*keys).distinct().alias("h")
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    return fresh.join(have, same, "left_anti")


def commit_stats(done: DataFrame, batch: DataFrame) -> DataFrame:
    """Statistics per file type of the batch's commits (commit_id, filetypes) that have none: the types of one of the calls
    that bring any."""
    fresh = batch.where("commit_id is not null and filetypes is not null").join(done.select("commit_id").distinct(), "commit_id", "left_anti")
    kinds = F.transform(F.map_entries("filetypes"), lambda e: F.struct(F.substring(e["key"], 1, TYPE_LENGTH).alias("file_type"), e["value"]["inserts"].alias("insert_count"), e["value"]["deletes"].alias("delete_count"), e["value"]["occurrences"].alias("occurrence_count")))
    return fresh.groupBy("commit_id").agg(F.min(F.array_sort(kinds)).alias("kinds")).select("commit_id", F.inline("kinds"))


def contributors(documents: DataFrame, repo: str = "repo_id", column: str = "document") -> DataFrame:
    """Contributor documents, JSON arrays of login and change_count -> repo_id, login, md5, n; one row per entry."""
    entries = F.explode(F.from_json(column, "array<struct<login:string,change_count:bigint>>")).alias("c")
    return documents.select(repo, entries).select(repo, F.col("c.login").alias("login"), F.md5("c.login").alias("md5"), F.col("c.change_count").alias("n"))


def contributor_totals(rows: DataFrame, repo: str = "repo_id") -> DataFrame:
    return rows.groupBy(repo).agg(F.count("*").alias("contributor_count"), F.sum("n").alias("contributor_sum"))


def resolved_aliases(aliases: DataFrame, answers: DataFrame) -> DataFrame:
    """Aliases with the accounts of the answers (md5, github_user_id) in place of theirs; of several answers the greatest."""
    told = answers.groupBy("md5").agg(F.max(F.struct(F.col("github_user_id"))).alias("told"))
    return aliases.join(told, "md5", "left").withColumn("github_user_id", F.when(F.col("told").isNotNull(), F.col("told.github_user_id")).otherwise(F.col("github_user_id"))).drop("told")


def reserved_aliases(aliases: DataFrame, reservations: DataFrame, requests: DataFrame) -> DataFrame:
    """Reservations that requests (md5, reserver, at) win: alias_id, reserver; the first per alias, unless it is reserved.
    Unknown aliases can't be reserved."""
    ids = aliases.where("id is not null").groupBy("md5").agg(F.min("id").alias("alias_id"))
    asked = requests.join(ids, "md5").join(reservations.select("alias_id").distinct(), "alias_id", "left_anti")
    return asked.groupBy("alias_id").agg(F.min(F.struct("at", "reserver")).alias("first")).select("alias_id", "first.reserver")


def drained(queue: DataFrame, key: str, value: str, max_records: int) -> DataFrame:
    """The first ``max_records`` entries of a queue by id, folded per key: n, total, last_id. The limit is the feature."""
    taken = queue.orderBy("id", key, value).limit(max_records)
    return taken.groupBy(key).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.max("id").alias("last_id"))


def handed_over(queue: DataFrame, repos: DataFrame, done: DataFrame) -> DataFrame:
    """Queue entries of repositories that exist and aren't in the target yet: distinct repo_id."""
    return queue.select("repo_id").join(repos.select(F.col("id").alias("repo_id")), "repo_id", "left_semi").join(done.select("repo_id"), "repo_id", "left_anti").distinct()


def open_work(aliases: DataFrame, commits: DataFrame, bridge: DataFrame) -> DataFrame:
    """Per alias without account: its commits and the repositories that these are in (alias -> commit -> bridge)."""
    accounts = aliases.groupBy("id").agg(F.max("github_user_id").alias("g")).where("g is null").select(F.col("id").alias("alias_id"))
    mine = commits.where("alias_id is not null").select("alias_id", "commit_id").distinct().join(accounts, "alias_id", "left_semi")
    rows = mine.join(bridge.where("owner_repo is not null").select("commit_id", "owner_repo").distinct(), "commit_id")
    return rows.groupBy("alias_id").agg(F.countDistinct("commit_id").alias("n_commits"), F.countDistinct("owner_repo").alias("n_repos"))


def orphan_aliases(aliases: DataFrame, commits: DataFrame, bridge: DataFrame) -> DataFrame:
    """Aliases that a cascade deletes: without account and without a commit that a bridge row refers to."""
    kept = commits.join(bridge.select("commit_id").distinct(), "commit_id", "left_semi").select(F.col("alias_id").alias("id")).distinct()
    return aliases.groupBy("id").agg(F.max("github_user_id").alias("g")).where("g is null").select("id").join(kept, "id", "left_anti")


_ASSOCIATION = "rec_id bigint, part string, repo_owner string, repo_name string, hacker_hash string, hacker_name string, lang_ext string, item string, amount string"


def association_table(records: DataFrame, id_col: str = "id", json_col: str = "stats_json") -> DataFrame:
    """Association documents as a table: one row per extension (part ``extension``; item its name, amount its count) and per
    import (part ``import``; lang_ext, name, contributions) of each hacker, beside the hacker and the repository.

    Documents are unwrapped and single objects stand for lists as in problem 1. A hacker without extensions, or an import
    array without imports, gives a row without item, as an outer unnest does. Repeated records give repeated rows.
    """
    text, objects = nested._key, nested._objects

    def rows_of(document: dict) -> Iterator[tuple]:
        repo = text(document.get("repo_owner")), text(document.get("repo_name"))
        for hacker in nested.hackers_of(document):
            who = text(hacker.get("hacker_hash")), text(hacker.get("hacker_name"))
            for x in objects(hacker.get("hacker_extension_map")) or [{}]:
                yield "extension", *repo, *who, None, text(x.get("ext")), text(x.get("cnt"))
            for array in objects(hacker.get("hacker_import_array")) or [{}]:
                for x in objects(array.get("import_map")) or [{}]:
                    yield "import", *repo, *who, text(array.get("lang_ext")), text(x.get("name")), text(x.get("contributions"))

    def shred(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(rec_id, *row) for rec_id, document, _ in nested._documents(batch) if document is not None for row in rows_of(document)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _ASSOCIATION.split(", ")], dtype=object)

    rows = spread(nested._source(records, id_col, json_col)).mapInPandas(shred, _ASSOCIATION)
    return rows.withColumn("amount", F.expr("try_cast(amount as double)"))
