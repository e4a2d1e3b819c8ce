"""Queries of the operational procedures and of further reference operators over the test tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions import exprs
from strataloom.operators import curation, features, identity, oltp, procedures, rollups, text
from strataloom.plans import reference, training
from strataloom.session import table

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- commit graph: the log's commits are the calls, the other tables what is there -------------------------------

_CALLS = "(select md5(author) as md5, author as name, commit_id, owner_repo, date, orig_timezone as gmt_offset, filetypes from commit_stat_log)"


def calls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "commit_stat_log").select(F.md5("author").alias("md5"), F.col("author").alias("name"), "commit_id", "owner_repo", "date", F.col("orig_timezone").alias("gmt_offset"), "filetypes")


def there(spark: SparkSession, d: str) -> DataFrame:
    """Adapter: the commits that were loaded before 2021 are there when the calls come."""
    return table(spark, d, "git_commit").where("loaded_at < timestamp_ntz'2021-01-01 00:00:00'")


@query(
    f"""with a as (select md5, sum(1) as n, min(left(name, 256)) as new_name from {_CALLS} where md5 is not null group by 1), k as (select md5, min(name) as name, max(count) as count from dev_alias group by 1)
select md5, coalesce(k.name, new_name) as name, cast(coalesce(k.count, 0) + coalesce(n, 0) as bigint) as count from k full join a using (md5)"""
)
def commit_graph_aliases(spark: SparkSession, d: str) -> DataFrame:
    return procedures.counted_aliases(table(spark, d, "dev_alias"), calls(spark, d).select("md5", "name", F.lit(1).alias("n")))


@query(
    f"""select commit_id, x.md5 as md5, x.date as date, x.gmt_offset as gmt_offset from (select commit_id, first({{'md5': md5, 'date': date, 'gmt_offset': gmt_offset}} order by md5 nulls first, date nulls first, gmt_offset nulls first) as x
from {_CALLS} where commit_id is not null and commit_id not in (select commit_id from git_commit where commit_id is not null and loaded_at < timestamp '2021-01-01') group by 1)"""
)
def commit_graph_commits(spark: SparkSession, d: str) -> DataFrame:
    return procedures.new_commits(there(spark, d), calls(spark, d))


@query(f"select distinct commit_id, owner_repo from {_CALLS} c where not exists (select 1 from file_hacker_commit f where f.commit_id is not distinct from c.commit_id and f.owner_repo is not distinct from c.owner_repo)")
def commit_graph_bridge(spark: SparkSession, d: str) -> DataFrame:
    return procedures.new_rows(table(spark, d, "file_hacker_commit"), calls(spark, d), ["commit_id", "owner_repo"])


@query(
    """with c as (select commit_id, list_sort(list_transform(map_entries(filetypes), lambda e: {'file_type': left(e.key, 128), 'insert_count': e.value.inserts, 'delete_count': e.value.deletes, 'occurrence_count': e.value.occurrences}), 'asc', 'nulls first') as kinds
  from commit_stat_log where commit_id is not null and filetypes is not null and commit_id not in (select commit_id from git_commit where commit_id is not null and loaded_at < timestamp '2021-01-01')),
f as (select commit_id, count(distinct kinds) as forms, any_value(kinds) as kinds from c group by 1 having forms = 1)
select commit_id, k.file_type as file_type, k.insert_count as insert_count, k.delete_count as delete_count, k.occurrence_count as occurrence_count from (select commit_id, unnest(kinds) as k from f)"""
)
def commit_graph_stats(spark: SparkSession, d: str) -> DataFrame:
    """Commits that come with one form of statistics; which of several forms is first isn't told."""
    batch = calls(spark, d).where("filetypes is not null")
    forms = batch.groupBy("commit_id").agg(F.countDistinct(F.array_sort(F.map_entries("filetypes"))).alias("forms")).where("forms = 1")
    return procedures.commit_stats(there(spark, d), batch.join(forms.select("commit_id"), "commit_id", "left_semi"))


# ---- contributors -------------------------------------------------------------------------------------------------

_CONTRIBUTED = "(select repo_id, 'u' || import_id as login, md5('u' || import_id) as md5, count as n from repo_import_association where import_id is not null)"


def contributed(spark: SparkSession, d: str) -> DataFrame:
    """Adapter: imports of a repository stand for its contributors, as JSON arrays."""
    rows = table(spark, d, "repo_import_association").where("import_id is not null").select("repo_id", F.struct(F.concat(F.lit("u"), F.col("import_id")).alias("login"), F.col("count").alias("change_count")).alias("c"))
    return procedures.contributors(rows.groupBy("repo_id").agg(F.to_json(F.collect_list("c")).alias("document")))


@query(f"select repo_id, count(*) as contributor_count, cast(sum(n) as bigint) as contributor_sum from {_CONTRIBUTED} group by 1")
def contributor_totals(spark: SparkSession, d: str) -> DataFrame:
    return procedures.contributor_totals(contributed(spark, d))


@query(f"select coalesce(k.md5, a.md5) as md5, coalesce(name, login) as name, cast(coalesce(count, 0) + coalesce(n, 0) as bigint) as count from (select md5, min(name) as name, max(count) as count from dev_alias group by 1) k full join (select md5, min(login) as login, sum(n) as n from {_CONTRIBUTED} group by 1) a on a.md5 = k.md5")
def contributor_aliases(spark: SparkSession, d: str) -> DataFrame:
    return procedures.counted_aliases(table(spark, d, "dev_alias"), contributed(spark, d).select("md5", F.col("login").alias("name"), "n"))


# ---- states of aliases, queues and hand-overs ---------------------------------------------------------------------


@query("select id, md5, case when md5 in (select md5 from dev_alias where last_traced is not null) then 'account-' || md5 else github_user_id end as github_user_id from dev_alias")
def alias_resolve(spark: SparkSession, d: str) -> DataFrame:
    """Adapter: traced aliases get an account that is named by their hash."""
    aliases = table(spark, d, "dev_alias").select("id", "md5", "github_user_id", "last_traced")
    answers = aliases.where("last_traced is not null").select("md5", F.concat(F.lit("account-"), F.col("md5")).alias("github_user_id"))
    return procedures.resolved_aliases(aliases, answers).select("id", "md5", "github_user_id")


@query(
    """with i as (select md5, min(id) as alias_id from dev_alias where id is not null group by 1), r as (select distinct id from dev_alias where last_traced is not null),
q as (select alias_id, owner_repo as reserver, log_id as moment from commit_stat_log join i on i.md5 = md5(author) where alias_id not in (select id from r))
select alias_id, first(reserver order by moment, reserver nulls first) as reserver from q group by 1"""
)
def alias_reserve(spark: SparkSession, d: str) -> DataFrame:
    aliases = table(spark, d, "dev_alias")
    requests = table(spark, d, "commit_stat_log").select(F.md5("author").alias("md5"), F.col("owner_repo").alias("reserver"), F.col("log_id").alias("at"))
    return procedures.reserved_aliases(aliases, aliases.where("last_traced is not null").select(F.col("id").alias("alias_id")), requests)


@query("select alias_id, count(*) as n, cast(sum(count) as bigint) as total, max(id) as last_id from (select * from hacker_extension_association order by id, alias_id nulls first, count nulls first limit 500) group by 1")
def queue_drain(spark: SparkSession, d: str) -> DataFrame:
    return procedures.drained(table(spark, d, "hacker_extension_association").select("id", "alias_id", "count"), "alias_id", "count", 500)


@query("select distinct repo_id from staged_eval_job_q q where exists (select 1 from repo r where r.id = q.repo_id) and not exists (select 1 from repo_import_association a where a.repo_id = q.repo_id)")
def queue_hand_over(spark: SparkSession, d: str) -> DataFrame:
    return procedures.handed_over(table(spark, d, "staged_eval_job_q"), table(spark, d, "repo"), table(spark, d, "repo_import_association"))


@query("select id, repo_id, tstamp + interval 2 minutes as tstamp from staged_eval_job_q")
def queue_back_off(spark: SparkSession, d: str) -> DataFrame:
    return oltp.back_off(table(spark, d, "staged_eval_job_q"), "tstamp")


_OPEN = "select id as alias_id from dev_alias group by 1 having max(github_user_id) is null"


@query(f"select alias_id, count(distinct c.commit_id) as n_commits, count(distinct f.owner_repo) as n_repos from git_commit c join file_hacker_commit f on f.commit_id = c.commit_id and f.owner_repo is not null where alias_id in ({_OPEN}) group by 1")
def open_alias_work(spark: SparkSession, d: str) -> DataFrame:
    return procedures.open_work(table(spark, d, "dev_alias"), table(spark, d, "git_commit"), table(spark, d, "file_hacker_commit"))


@query(f"select alias_id as id from ({_OPEN}) where alias_id not in (select alias_id from git_commit c where alias_id is not null and exists (select 1 from file_hacker_commit f where f.commit_id = c.commit_id))")
def alias_cascade(spark: SparkSession, d: str) -> DataFrame:
    return procedures.orphan_aliases(table(spark, d, "dev_alias"), table(spark, d, "git_commit"), table(spark, d, "file_hacker_commit"))


@query(
    """select (select count(*) from dev_alias) as n_aliases, (select count(*) from dev_alias where github_user_id is null) as n_unresolved, (select count(*) from dev_alias where github_user_id = '<UNABLE_TO_RESOLVE>') as n_unresolvable,
  (select count(*) from git_commit) as n_commits, (select count(*) from commit_stat_log) as n_stats, (select count(*) from import_performance_tracking) as n_log, (select count(*) from repo) as n_repos, (select count(*) from repo_file) as n_bridge"""
)
def global_counters(spark: SparkSession, d: str) -> DataFrame:
    """All counters of the operational tables in one row; each table is read once."""
    out = oltp.counters(table(spark, d, "dev_alias"), n_aliases="true", n_unresolved="github_user_id is null", n_unresolvable=f"github_user_id = '{identity.UNRESOLVABLE}'")
    for name, source in (("n_commits", "git_commit"), ("n_stats", "commit_stat_log"), ("n_log", "import_performance_tracking"), ("n_repos", "repo"), ("n_bridge", "repo_file")):
        out = out.crossJoin(table(spark, d, source).agg(F.count("*").alias(name)))
    return out


_HACKERS = training.P1_SQL[: training.P1_SQL.index("exts as (")].replace("select distinct id, cast", "select id, cast")


@query(
    f"""{_HACKERS}
base as (select id, {training._text("(h -> 'hacker_hash')")} as hacker_hash, {training._text("(h -> 'hacker_name')")} as hacker_name, repo_owner, repo_name, h from (select id, {training._text("(j -> 'repo_owner')")} as repo_owner, {training._text("(j -> 'repo_name')")} as repo_name, unnest({training._list("(j -> 'hack_assoc_map')")}) as h from docs) where json_type(h) = 'OBJECT'),
e as (select *, list_filter({training._list("(h -> 'hacker_extension_map')")}, lambda x: json_type(x) = 'OBJECT') as l from base),
e2 as (select *, unnest(case when len(l) = 0 then [cast('{{}}' as json)] else l end) as x from e),
a as (select *, list_filter({training._list("(h -> 'hacker_import_array')")}, lambda x: json_type(x) = 'OBJECT') as l from base),
a2 as (select * exclude (l), unnest(case when len(l) = 0 then [cast('{{}}' as json)] else l end) as y from a),
i as (select *, list_filter({training._list("(y -> 'import_map')")}, lambda x: json_type(x) = 'OBJECT') as l from a2),
i2 as (select *, unnest(case when len(l) = 0 then [cast('{{}}' as json)] else l end) as x from i)
select id as rec_id, 'extension' as part, repo_owner, repo_name, hacker_hash, hacker_name, cast(null as varchar) as lang_ext, {training._text("(x -> 'ext')")} as item, try_cast({training._text("(x -> 'cnt')")} as double) as amount from e2
union all select id, 'import', repo_owner, repo_name, hacker_hash, hacker_name, {training._text("(y -> 'lang_ext')")}, {training._text("(x -> 'name')")}, try_cast({training._text("(x -> 'contributions')")} as double) from i2"""
)
def association_table(spark: SparkSession, d: str) -> DataFrame:
    return procedures.association_table(table(spark, d, "import_performance_tracking"))


@query(
    """with k as (select distinct id as alias_id, github_user_id as g from dev_alias where github_user_id is not null and github_user_id <> '<UNABLE_TO_RESOLVE>'),
o as (select id as alias_id from dev_alias group by 1 having max(github_user_id) is null),
c as (select distinct left(commit_id, 3) as commit_id, alias_id from git_commit where commit_id is not null and alias_id is not null),
w as (select commit_id, min(g) as g from c join k using (alias_id) group by 1)
select alias_id, min(g) as github_user_id from c join o using (alias_id) join w using (commit_id) group by 1"""
)
def alias_propagation_shared(spark: SparkSession, d: str) -> DataFrame:
    """Adapter: commits of one beginning of their hash stand for one commit, as no two aliases share a whole one."""
    commits = table(spark, d, "git_commit").withColumn("commit_id", F.substring("commit_id", 1, 3))
    return identity.shared_commit_ids(commits, table(spark, d, "dev_alias"))


# ---- further aggregates, features and texts -----------------------------------------------------------------------


@query(f"select owner, repo_name, {reference._EXT} as extension, cast(sum(total_inserts) as bigint) as total_inserts, cast(sum(total_deletes) as bigint) as total_deletes, count(*) as num_files from repo_file where is_binary = 0 group by 1, 2, 3")
def repo_extension_rows(spark: SparkSession, d: str) -> DataFrame:
    """The older form of repo_extension: rows are counted, not distinct paths."""
    return curation.repo_extension_rows(table(spark, d, "repo_file"))


@query("select commit_id, array_to_string(list_sort(list(distinct owner_repo)), ',') as seen_in from file_hacker_commit group by 1")
def commits_seen_in(spark: SparkSession, d: str) -> DataFrame:
    rows = rollups.merged_commits(reference.commits(spark, d).select("commit_id", F.col("owner_repo").alias("seen_in")))
    return rows.select("commit_id", F.nullif(F.array_join("seen_in", ","), F.lit("")).alias("seen_in"))


@query(f"select dependency, count(*) as n from ({reference.DEPENDENCY}) group by 1")
def dependency_frequency(spark: SparkSession, d: str) -> DataFrame:
    return rollups.dependency_counts(reference.dependencies(spark, d))


@query(f"select owner, repo_name, extension, round(num_files / sum(num_files) over (partition by owner, repo_name), 6) as file_share from ({reference.REPO_EXTENSION})")
def extension_shares(spark: SparkSession, d: str) -> DataFrame:
    return features.shares(reference.repo_extension(spark, d), ["owner", "repo_name"], "num_files", "file_share").select("owner", "repo_name", "extension", F.round("file_share", 6).alias("file_share"))


_HACKER_DEP = "select author, dependency, sum(line_count) as n from ({}) where author is not null and line_count > 0 group by 1, 2".format(reference.ORACLES["hacker_dependency"])


@query(
    f"""with c as ({_HACKER_DEP}), g as (select count(distinct author) as total from c), f as (select dependency, count(distinct author) as df from c group by 1),
w as (select author, dependency, (1 + ln(n)) * (ln((1 + total) / (1 + df)) + 1) as w from c join f using (dependency), g),
s as (select author, dependency, round(w / sqrt(sum(w * w) over (partition by author)), 6) as tfidf from w)
select author, dependency, tfidf, cast(row_number() over (partition by author order by tfidf desc, dependency) as int) as rank from s where tfidf > 0 qualify rank <= 5"""
)
def author_dependency_tfidf(spark: SparkSession, d: str) -> DataFrame:
    """The dependencies that tell an author's work best: TF-IDF of blamed lines, the top five of each."""
    rows = reference.hacker_dependency(spark, d).where("author is not null and line_count > 0").groupBy("author", "dependency").agg(F.sum("line_count").alias("n"))
    return text.top_terms(text.tfidf(rows, "author", "dependency", "n"), "author", "dependency", 5, 0.0)


@query(
    f"""with c as ({reference._COUNTS}), g as (select count(distinct lang) as total from c), f as (select word, count(distinct lang) as df from c group by 1),
k as (select word, df from f, g where df >= 2 and df <= 0.8 * total),
w as (select lang, word, (1 + ln(n)) * (ln((1 + total) / (1 + df)) + 1) as w from c join k using (word), g)
select lang, word, round(w / sqrt(sum(w * w) over (partition by lang)), 6) as tfidf from w"""
)
def word_tfidf_bounded(spark: SparkSession, d: str) -> DataFrame:
    """TF-IDF of the words that at least two languages and at most 80 % of them have."""
    return text.tfidf(text.word_counts(reference._docs(spark, d), "lang"), "lang", "word", "n", min_df=2, max_df=0.8)


@query("select id, regexp_extract(name, '(.*) <(.*)>', 1) || ' <' || regexp_extract(name, '(.*) <(.*)>', 2) || '>' as author, sha256(name) as name_sha2 from dev_alias")
def synthetic_authors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dev_alias").select("id", exprs.synthetic_author(exprs.author_name("name"), exprs.author_email("name")).alias("author"), F.sha2("name", 256).alias("name_sha2"))


@query(f"with h as (select min(author_email_hash) as x from ({reference._RISKY})) select r.* from ({reference._RISKY}) r, h where author_email_hash = x")
def projects_of_hash(spark: SparkSession, d: str) -> DataFrame:
    """Lookup of one hashed address: the least one there is."""
    rows = reference.at_risk_repo(spark, d)
    return identity.lookup(rows, "author_email_hash", rows.agg(F.min("author_email_hash")).first()[0])


@query("select c_custkey as repo_id, cast(floor(c_acctbal * 100) as bigint) as size from customer where c_acctbal >= 0 order by size, repo_id limit 100")
def smallest_repos(spark: SparkSession, d: str) -> DataFrame:
    """The smallest repositories first: a report of the n smallest."""
    rows = table(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("repo_id"), F.floor(F.col("c_acctbal") * 100).alias("size"))
    return rows.orderBy("size", "repo_id").limit(100)


@query()
def logreg_folds(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy of the logistic regression in five folds, per regularisation."""
    return features.cross_validated(reference._vectors(spark, d), [0.0, 0.01])


@query()
def naive_bayes_languages(spark: SparkSession, d: str) -> DataFrame:
    """Confusion of a naive Bayes classifier of word counts that tells a page's kind."""
    docs = table(spark, d, "documents").where("text is not null and doc_kind is not null").select("doc_id", "text", F.col("doc_kind").alias("label"))
    return text.bayes_confusion(docs)
