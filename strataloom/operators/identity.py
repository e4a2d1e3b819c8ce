"""Identities: alias pairs by name, address and shared projects, hashed identities and lookups by hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.functions.exprs import author_email, author_name, email_domain


#: Fixed value: the account of aliases that can't be resolved.
UNRESOLVABLE = "<UNABLE_TO_RESOLVE>"


def _pairs(authors: DataFrame, on: str, other: str) -> DataFrame:
    left = authors.select(F.col("author").alias("left_author"), F.col(on).alias("k"), F.col(other).alias("l"))
    right = authors.select(F.col("author").alias("right_author"), F.col(on).alias("k"), F.col(other).alias("r"))
    return left.join(right, "k").where("l <> r").select("left_author", "right_author")


def alias_pairs(repo_hacker: DataFrame) -> DataFrame:
    """Pairs of authors, both ways, with equal address and different names or the other way round, and in how many
    repositories the right one is.

    The pairs are found among distinct authors, so a repository with many rows adds nothing to the self-joins; the
    repositories are counted once per author before they are joined on.
    """
    rows = repo_hacker.where("author is not null").select("author", "owner", "repo_name").distinct()
    repos = rows.groupBy("author").agg(F.countDistinct(F.struct("owner", "repo_name")).alias("num_repos"))
    authors = repos.select("author", author_name("author").alias("name"), author_email("author").alias("email"))
    by_email = _pairs(authors, "email", "name").withColumns({"name_match": F.lit(0), "email_match": F.lit(1)})
    by_name = _pairs(authors, "name", "email").withColumns({"name_match": F.lit(1), "email_match": F.lit(0)})
    return by_email.union(by_name).join(repos.withColumnRenamed("author", "right_author"), "right_author").select("left_author", "right_author", "name_match", "email_match", "num_repos")


def at_risk_aliases(targets: DataFrame, repo_hacker: DataFrame, extension: str) -> DataFrame:
    """Hashed aliases of targeted authors: the same address, or the same name and a shared project in ``extension``.

    The shared project is tested per candidate pair by a semi-join on both ends, not by pairing all authors of a project.
    """
    people = targets.select("author", author_name("author").alias("name"), author_email("author").alias("email")).distinct()
    left = people.select(*[F.col(c).alias(f"l_{c}") for c in people.columns])
    right = people.select(*[F.col(c).alias(f"r_{c}") for c in people.columns])
    by_email = left.join(right, F.col("l_email") == F.col("r_email")).where("l_author <> r_author")
    by_name = left.join(right, F.col("l_name") == F.col("r_name")).where("l_author <> r_author")
    work = repo_hacker.where(F.col("extension") == extension).select("owner_repo", "author").distinct()
    shared = by_name.select("l_author", "r_author").distinct().join(work.withColumnRenamed("author", "l_author"), "l_author").join(work.withColumnRenamed("author", "r_author"), ["r_author", "owner_repo"]).select("l_author", "r_author")
    both = by_email.union(by_name.join(shared, ["l_author", "r_author"], "left_semi").select(*by_email.columns))
    return both.select(
        email_domain("l_email").alias("author_email_domain"), F.md5("l_email").alias("author_email_hash"), F.col("r_name").alias("alias_name"), email_domain("r_email").alias("alias_email_domain"), F.md5("r_email").alias("alias_email_hash")
    ).distinct()


def at_risk_repos(repo_hacker: DataFrame, targets: DataFrame) -> DataFrame:
    """Repositories of targeted authors, with name, domain and hash of the address."""
    rows = repo_hacker.join(targets.select("author").distinct(), "author", "left_semi")
    pattern = "(.*) <(.*)@(.*)>"
    return rows.select("owner", "repo_name", "partition_key", "owner_repo", F.regexp_extract("author", pattern, 1).alias("author_name"), F.regexp_extract("author", pattern, 3).alias("author_email_domain"), F.md5(author_email("author")).alias("author_email_hash")).distinct()


def shared_commit_ids(commits: DataFrame, aliases: DataFrame, unresolved: str = UNRESOLVABLE) -> DataFrame:
    """Aliases without account that committed what a resolved alias committed: alias id and the account it takes."""
    known = aliases.where(F.col("github_user_id").isNotNull() & (F.col("github_user_id") != unresolved)).select(F.col("id").alias("alias_id"), "github_user_id").distinct()
    open_ids = aliases.groupBy("id").agg(F.max("github_user_id").alias("g")).where("g is null").select(F.col("id").alias("alias_id"))
    rows = commits.where("commit_id is not null and alias_id is not null").select("commit_id", "alias_id").distinct()
    owners = rows.join(known, "alias_id").groupBy("commit_id").agg(F.min("github_user_id").alias("github_user_id"))
    return rows.join(open_ids, "alias_id", "left_semi").join(owners, "commit_id").groupBy("alias_id").agg(F.min("github_user_id").alias("github_user_id"))


def lookup(table: DataFrame, hash_col: str, email_hash: str) -> DataFrame:
    """Rows of one hashed address; the value is bound, never spliced into SQL."""
    return table.where(F.col(hash_col) == F.lit(email_hash))


def recommendations(suggestions: DataFrame, keys: list[str], score: str) -> DataFrame:
    """Distinct suggestions with their best score (a distinct ordered by a column that isn't selected)."""
    return suggestions.groupBy(*keys).agg(F.max(score).alias(score))


def lookup_bundle(aliases: DataFrame, projects: DataFrame, email_hash: str) -> DataFrame:
    """One JSON document of the aliases and projects of a hashed address."""
    parts = [("aliases", lookup(aliases, "author_email_hash", email_hash)), ("projects", lookup(projects, "author_email_hash", email_hash))]
    rows = [df.select(F.lit(name).alias("part"), F.struct(*df.columns).alias("row")) for name, df in parts]
    lists = [r.agg(F.collect_list("row").alias(name)) for (name, _), r in zip(parts, rows)]
    return lists[0].join(lists[1], F.lit(True)).select(F.to_json(F.struct("aliases", "projects")).alias("bundle"))
