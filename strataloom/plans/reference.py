"""Queries of the reference operators over the test tables, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions import exprs
from strataloom.operators import curation, features, graph, identity, oltp, text
from strataloom.sources import ingest
from strataloom.session import table

# ---- inputs in the shape of the raw tables ----------------------------------------------------------------------

_PATH_EXT = "case when contains({0}, '.') then '.' || list_extract(string_split({0}, '.'), -1) when {0} is not null then '' end"
_EXT = _PATH_EXT.format("file_path")
_SUFFIXES = ", ".join(f"'{s}'" for s in exprs.CODE_SUFFIXES)


def commits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "file_hacker_commit")


def dependencies(spark: SparkSession, d: str) -> DataFrame:
    """Adapter: a file depends on the top folder of its repository that it lies in."""
    rows = commits(spark, d).where("owner_repo is not null and partition_key is not null")
    return rows.select("owner", "repo_name", "owner_repo", "file_path", "partition_key", F.split_part("file_path", F.lit("/"), F.lit(1)).alias("dependency")).distinct()


def blamed(spark: SparkSession, d: str) -> DataFrame:
    """Adapter: lines blamed on an author are the lines that the author inserted."""
    rows = commits(spark, d).where("owner_repo is not null and partition_key is not null and author is not null")
    return rows.groupBy("partition_key", "owner_repo", "file_path", "author").agg(F.sum("total_inserts").alias("lines"))


def activity(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "R", "worker_paid").when(F.col("l_returnflag") == "A", "work_submitted").otherwise("other")
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("profile_id"), F.col("l_orderkey").alias("bounty_pk"), kind.alias("activity_type"), F.col("l_linestatus").alias("status"))


def bounties(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("pk"), F.col("o_orderpriority").alias("title"))


DEPENDENCY = "select distinct owner, repo_name, owner_repo, file_path, partition_key, split_part(file_path, '/', 1) as dependency from file_hacker_commit where owner_repo is not null and partition_key is not null"
BLAMED = "select partition_key, owner_repo, file_path, author, cast(sum(total_inserts) as bigint) as lines from file_hacker_commit where owner_repo is not null and partition_key is not null and author is not null group by all"
ACTIVITY = "select l_partkey as profile_id, l_orderkey as bounty_pk, case l_returnflag when 'R' then 'worker_paid' when 'A' then 'work_submitted' else 'other' end as activity_type, l_linestatus as status from lineitem"

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


# ---- curation ---------------------------------------------------------------------------------------------------

_SUMS = "cast(sum(total_inserts) as bigint) as total_inserts, cast(sum(total_deletes) as bigint) as total_deletes"
_DISTINCT = "count(distinct commit_date) as num_commits, count(distinct file_path) as num_files"
HACKER_EXTENSION = f"select author, {_EXT} as extension, {_SUMS}, {_DISTINCT} from file_hacker_commit where is_binary = 0 group by 1, 2"
MONTHLY = f"select author, {_EXT} as extension, date_trunc('month', commit_date at time zone 'UTC') at time zone 'UTC' as year_month, {_SUMS}, {_DISTINCT} from file_hacker_commit where is_binary = 0 and {_EXT} in ({_SUFFIXES}) group by 1, 2, 3"
REPO_DEPENDENCY = f"select partition_key, owner, repo_name, owner_repo, {_EXT} as extension, dependency, count(*) as file_count from ({DEPENDENCY}) group by all"
REPO_EXTENSION = f"select owner, repo_name, {_EXT} as extension, {_SUMS}, count(distinct file_path) as num_files, cast(sum(num_commits) as bigint) as total_commits from repo_file where is_binary = 0 group by 1, 2, 3"
REPO_HACKER = f"select owner, repo_name, partition_key, owner_repo, author, {_EXT} as extension, count(distinct file_path) as num_files, cast(sum(total_inserts) as bigint) as total_inserts from file_hacker_commit group by 1, 2, 3, 4, 5, 6"


@query(HACKER_EXTENSION)
def hacker_extension(spark: SparkSession, d: str) -> DataFrame:
    return curation.hacker_extension(commits(spark, d))


@query(MONTHLY)
def hacker_extension_monthly(spark: SparkSession, d: str) -> DataFrame:
    return curation.hacker_extension_monthly(commits(spark, d))


@query(f"select author, {_PATH_EXT.format('b.file_path')} as extension, dependency, cast(sum(lines) as bigint) as line_count from ({BLAMED}) b join ({DEPENDENCY}) d on d.partition_key = b.partition_key and d.owner_repo = b.owner_repo and d.file_path = b.file_path group by 1, 2, 3")
def hacker_dependency(spark: SparkSession, d: str) -> DataFrame:
    return curation.hacker_dependency(blamed(spark, d), dependencies(spark, d))


@query(REPO_DEPENDENCY)
def repo_dependency(spark: SparkSession, d: str) -> DataFrame:
    return curation.repo_dependency(dependencies(spark, d))


@query(REPO_EXTENSION)
def repo_extension(spark: SparkSession, d: str) -> DataFrame:
    return curation.repo_extension(table(spark, d, "repo_file"))


@query(REPO_HACKER)
def repo_hacker(spark: SparkSession, d: str) -> DataFrame:
    return curation.repo_hacker(commits(spark, d))


_PIVOT = ", ".join(
    f"coalesce(cast(sum({c}) filter (where extension = '{s}') as bigint), 0) as \"{s[1:]}_{n}\"" for s in exprs.CODE_SUFFIXES for n, c in (("inserts", "total_inserts"), ("deletes", "total_deletes"), ("files", "num_files"), ("commits", "total_commits"))
)


@query(f"select owner, repo_name, {_PIVOT} from ({REPO_EXTENSION}) group by 1, 2")
def repo_extension_summary(spark: SparkSession, d: str) -> DataFrame:
    return curation.repo_extension_summary(repo_extension(spark, d))


@query(
    f"""with m as (select author, extension, cast(year(year_month at time zone 'UTC') as int) as year, cast(month(year_month at time zone 'UTC') as int) as month, num_files as month_files, total_inserts as month_lines from ({MONTHLY})),
q as (select *, (month + 2) // 3 as quarter from m)
select *, year as year_ce, quarter + 4 * year as quarter_ce, month + 12 * year as month_ce,
  cast(sum(month_files) over (partition by author, extension, year) as bigint) as year_files, cast(sum(month_files) over (partition by author, extension, year, quarter) as bigint) as qrtr_files,
  cast(sum(month_lines) over (partition by author, extension, year) as bigint) as year_lines, cast(sum(month_lines) over (partition by author, extension, year, quarter) as bigint) as qrtr_lines from q"""
)
def extension_window_by_time(spark: SparkSession, d: str) -> DataFrame:
    return curation.extension_windows(hacker_extension_monthly(spark, d))


@query(f"select extension, dependency, count(*) as num_repos, cast(sum(file_count) as bigint) as num_files from ({REPO_DEPENDENCY}) group by 1, 2 having num_repos > 5")
def popular_dependencies(spark: SparkSession, d: str) -> DataFrame:
    return curation.popular_dependencies(repo_dependency(spark, d), 5)


@query(f"select owner_repo, file_path, count(distinct commit_id) as num_commits, min(commit_date) as first_commit_date, max(commit_date) as last_commit_date, {_SUMS}, first(is_binary order by commit_date, commit_id, coalesce(is_binary, -1)) as is_binary from file_hacker_commit group by 1, 2")
def repo_file_totals(spark: SparkSession, d: str) -> DataFrame:
    return curation.files_from_commits(commits(spark, d))


# ---- identities and serving -------------------------------------------------------------------------------------

_NAME, _MAIL = "regexp_extract({0}, '(.*) <(.*)>', 1)", "regexp_extract({0}, '(.*) <(.*)>', 2)"
_AUTHORS = f"select author, {_NAME.format('author')} as name, {_MAIL.format('author')} as email, count(distinct (owner, repo_name)) as num_repos from ({REPO_HACKER}) where author is not null group by 1"
_ALIASES = f"""with a as ({_AUTHORS})
select l.author as left_author, r.author as right_author, 0 as name_match, 1 as email_match, r.num_repos from a l join a r on l.email = r.email and l.name <> r.name
union select l.author, r.author, 1, 0, r.num_repos from a l join a r on l.name = r.name and l.email <> r.email"""
_TARGETS = "select author from file_hacker_commit where author is not null group by 1 having sum(total_inserts) > 200"
_HASHED = f"""with p as (select author, {_NAME.format('author')} as name, {_MAIL.format('author')} as email from ({_TARGETS})),
w as (select distinct owner_repo, author from ({REPO_HACKER}) where extension = '.js'),
s as (select distinct a.author as a1, b.author as a2 from w a join w b on a.owner_repo = b.owner_repo and a.author <> b.author),
x as (select l.email as le, r.name as rn, r.email as re from p l join p r on l.email = r.email and l.author <> r.author
  union all select l.email, r.name, r.email from p l join p r on l.name = r.name and l.author <> r.author join s on s.a1 = l.author and s.a2 = r.author)
select distinct regexp_extract(le, '(.*)@(.*)', 2) as author_email_domain, md5(le) as author_email_hash, rn as alias_name, regexp_extract(re, '(.*)@(.*)', 2) as alias_email_domain, md5(re) as alias_email_hash from x"""
_RISKY = f"select distinct owner, repo_name, partition_key, owner_repo, regexp_extract(author, '(.*) <(.*)@(.*)>', 1) as author_name, regexp_extract(author, '(.*) <(.*)@(.*)>', 3) as author_email_domain, md5({_MAIL.format('author')}) as author_email_hash from ({REPO_HACKER}) where author in ({_TARGETS})"


def targets(spark: SparkSession, d: str) -> DataFrame:
    """Adapter: authors with more than 200 inserted lines."""
    return commits(spark, d).where("author is not null").groupBy("author").agg(F.sum("total_inserts").alias("n")).where("n > 200").select("author")


@query(_ALIASES)
def hacker_alias_pairs(spark: SparkSession, d: str) -> DataFrame:
    return identity.alias_pairs(repo_hacker(spark, d))


@query(_HASHED)
def at_risk_alias(spark: SparkSession, d: str) -> DataFrame:
    return identity.at_risk_aliases(targets(spark, d), repo_hacker(spark, d), ".js")


@query(_RISKY)
def at_risk_repo(spark: SparkSession, d: str) -> DataFrame:
    return identity.at_risk_repos(repo_hacker(spark, d), targets(spark, d))


@query(f"select author_email_hash, count(*) as n_projects from ({_RISKY}) group by 1")
def projects_by_hash(spark: SparkSession, d: str) -> DataFrame:
    return at_risk_repo(spark, d).groupBy("author_email_hash").agg(F.count("*").alias("n_projects"))


@query("select c_mktsegment as owner, o_orderpriority as repo_name, max(o_totalprice) as score from orders join customer on c_custkey = o_custkey group by 1, 2")
def recommendations(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return identity.recommendations(rows.select(F.col("c_mktsegment").alias("owner"), F.col("o_orderpriority").alias("repo_name"), F.col("o_totalprice").alias("score")), ["owner", "repo_name"], "score")


@query(
    """with k as (select distinct id as alias_id, github_user_id as g from dev_alias where github_user_id is not null and github_user_id <> '<UNABLE_TO_RESOLVE>'),
o as (select id as alias_id from dev_alias group by 1 having max(github_user_id) is null),
c as (select distinct commit_id, alias_id from git_commit where commit_id is not null and alias_id is not null),
w as (select commit_id, min(g) as g from c join k using (alias_id) group by 1)
select alias_id, min(g) as github_user_id from c join o using (alias_id) join w using (commit_id) group by 1"""
)
def alias_propagation(spark: SparkSession, d: str) -> DataFrame:
    return identity.shared_commit_ids(table(spark, d, "git_commit"), table(spark, d, "dev_alias"))


# ---- matrices and graphs ----------------------------------------------------------------------------------------

_PAIRS = f"select distinct l.profile_id as left_id, l.bounty_pk as shared, r.profile_id as right_id from ({ACTIVITY}) l join ({ACTIVITY}) r on l.bounty_pk = r.bounty_pk and r.profile_id > l.profile_id"
_MATRIX = f"select left_id, right_id, count(*) as weight from ({_PAIRS}) group by 1, 2"
_NET = f"select left_id, right_id from ({_MATRIX}) where weight >= 1"
_DEGREE = "(select node, count(*) as degree from (select left_id as node from net union all select right_id from net) group by 1)"


def user_matrix(spark: SparkSession, d: str) -> DataFrame:
    return graph.sparse_matrix(graph.ordered_pairs(activity(spark, d), "profile_id", "bounty_pk"))


@query(_PAIRS)
def user_pairs(spark: SparkSession, d: str) -> DataFrame:
    return graph.ordered_pairs(activity(spark, d), "profile_id", "bounty_pk")


@query(_MATRIX)
def user_sparse_matrix(spark: SparkSession, d: str) -> DataFrame:
    return user_matrix(spark, d)


@query(f"with m as ({_MATRIX}) select * from m union select right_id, left_id, weight from m")
def user_square_matrix(spark: SparkSession, d: str) -> DataFrame:
    return graph.square_matrix(user_matrix(spark, d))


def _kind(a: str) -> str:
    return f"(select distinct profile_id, bounty_pk from ({ACTIVITY}) where activity_type = '{a}')"


def _kind_pairs(kind: str) -> str:
    return f"select distinct l.profile_id as left_id, l.bounty_pk as shared, r.profile_id as right_id from ({ACTIVITY}) l join ({ACTIVITY}) r on r.bounty_pk = l.bounty_pk and r.profile_id > l.profile_id where l.activity_type = '{kind}' and r.activity_type = '{kind}'"


@query(_kind_pairs("worker_paid"))
def paid_pairs(spark: SparkSession, d: str) -> DataFrame:
    return graph.ordered_pairs(activity(spark, d).where("activity_type = 'worker_paid'"), "profile_id", "bounty_pk")


@query(_kind_pairs("work_submitted"))
def submit_pairs(spark: SparkSession, d: str) -> DataFrame:
    return graph.ordered_pairs(activity(spark, d).where("activity_type = 'work_submitted'"), "profile_id", "bounty_pk")


_FULFIL = f"(select * from ({ACTIVITY}) where status = 'F')"


@query(f"select distinct l.profile_id as left_id, l.bounty_pk as shared, r.profile_id as right_id from {_FULFIL} l join {_FULFIL} r on r.bounty_pk = l.bounty_pk and r.profile_id > l.profile_id")
def user_fulfil_pairs(spark: SparkSession, d: str) -> DataFrame:
    return graph.ordered_pairs(activity(spark, d).where("status = 'F'"), "profile_id", "bounty_pk")


_BOUNTY_PAIRS = f"select distinct l.bounty_pk as left_id, l.profile_id as shared, r.bounty_pk as right_id from ({ACTIVITY}) l join ({ACTIVITY}) r on r.profile_id = l.profile_id and r.bounty_pk > l.bounty_pk"
_BOUNTY_MATRIX = f"select left_id, right_id, count(*) as weight from ({_BOUNTY_PAIRS}) group by 1, 2"


def bounty_matrix(spark: SparkSession, d: str) -> DataFrame:
    return graph.sparse_matrix(graph.ordered_pairs(activity(spark, d), "bounty_pk", "profile_id"))


@query(f"select count(distinct bounty_pk) as n_bounties from (select left_id as bounty_pk, weight from ({_BOUNTY_MATRIX}) union select right_id, weight from ({_BOUNTY_MATRIX})) where weight > 1")
def heavy_bounties(spark: SparkSession, d: str) -> DataFrame:
    """Bounties that share more than one user with some other bounty."""
    return graph.square_matrix(bounty_matrix(spark, d).where("weight > 1")).agg(F.countDistinct("left_id").alias("n_bounties"))


@query(f"select left_id, l.o_orderpriority as left_title, right_id, r.o_orderpriority as right_title from ({_BOUNTY_MATRIX}) s join orders l on l.o_orderkey = s.left_id join orders r on r.o_orderkey = s.right_id where s.weight = 2")
def bounty_title_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The titles of each pair of bounties of one weight; the pair itself stays."""
    title = bounties(spark, d)
    left, right = title.select(F.col("pk").alias("left_id"), F.col("title").alias("left_title")), title.select(F.col("pk").alias("right_id"), F.col("title").alias("right_title"))
    return bounty_matrix(spark, d).where("weight = 2").join(left, "left_id").join(right, "right_id").select("left_id", "left_title", "right_id", "right_title")


@query(
    f"""with p as (select distinct l.profile_id as left_id, l.bounty_pk as shared, r.profile_id as right_id from {_kind('work_submitted')} l join {_kind('work_submitted')} r on l.bounty_pk = r.bounty_pk and r.profile_id > l.profile_id),
n as (select profile_id, count(*) as n from ({ACTIVITY}) where activity_type = 'worker_paid' group by 1)
select left_id, right_id, cast(sum(l.n * r.n) as bigint) as weight from p join n l on l.profile_id = left_id join n r on r.profile_id = right_id group by 1, 2"""
)
def paid_submit_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of submitters joined with both ends' payments on the profile alone: each pair counts payments times payments.
    The payments are counted per profile before the joins instead of being multiplied out."""
    rows = activity(spark, d)
    pairs = graph.ordered_pairs(rows.where("activity_type = 'work_submitted'"), "profile_id", "bounty_pk")
    paid = rows.where("activity_type = 'worker_paid'").groupBy("profile_id").agg(F.count("*").alias("n"))
    left, right = paid.select(F.col("profile_id").alias("left_id"), F.col("n").alias("l")), paid.select(F.col("profile_id").alias("right_id"), F.col("n").alias("r"))
    return pairs.join(left, "left_id").join(right, "right_id").groupBy("left_id", "right_id").agg(F.sum(F.col("l") * F.col("r")).alias("weight"))


_POAP = "select distinct o_orderkey from orders where o_orderpriority like '%URGENT%'"


@query(f"select left_id, right_id, count(*) as weight from (select distinct l.profile_id as left_id, l.bounty_pk, r.profile_id as right_id from ({ACTIVITY}) l join ({ACTIVITY}) r on l.bounty_pk = r.bounty_pk and r.profile_id > l.profile_id where l.status = 'F' and r.status = 'F' and l.bounty_pk not in ({_POAP})) group by 1, 2")
def non_poap_matrix(spark: SparkSession, d: str) -> DataFrame:
    done = activity(spark, d).where("status = 'F'")
    poap = bounties(spark, d).where("title like '%URGENT%'")
    return graph.sparse_matrix(graph.ordered_pairs(graph.without(done, "bounty_pk", poap, "pk"), "profile_id", "bounty_pk"))


@query(f"select l.bounty_pk as left_id, r.bounty_pk as right_id, count(*) as weight from ({ACTIVITY}) l join ({ACTIVITY}) r on l.profile_id = r.profile_id and r.bounty_pk > l.bounty_pk where l.status = 'F' and r.status = 'F' group by 1, 2")
def bounty_fulfil_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Bounties fulfilled by one user; repeated fulfilments count again, as counts multiplied, not as repeated pairs."""
    rows = activity(spark, d).where("status = 'F'").groupBy("profile_id", "bounty_pk").agg(F.count("*").alias("n"))
    left = rows.select("profile_id", F.col("bounty_pk").alias("left_id"), F.col("n").alias("l"))
    right = rows.select("profile_id", F.col("bounty_pk").alias("right_id"), F.col("n").alias("r"))
    return left.join(right, "profile_id").where("right_id > left_id").groupBy("left_id", "right_id").agg(F.sum(F.col("l") * F.col("r")).alias("weight"))


@query(f"select a.o_orderpriority as left_title, b.o_orderpriority as right_title, cast(sum(weight) as bigint) as weight from (select l.bounty_pk as left_id, r.bounty_pk as right_id, count(*) as weight from ({ACTIVITY}) l join ({ACTIVITY}) r on l.profile_id = r.profile_id and r.bounty_pk > l.bounty_pk where l.status = 'F' and r.status = 'F' group by 1, 2) join orders a on a.o_orderkey = left_id join orders b on b.o_orderkey = right_id group by 1, 2")
def bounty_titles(spark: SparkSession, d: str) -> DataFrame:
    title = bounties(spark, d)
    left, right = title.select(F.col("pk").alias("left_id"), F.col("title").alias("left_title")), title.select(F.col("pk").alias("right_id"), F.col("title").alias("right_title"))
    return bounty_fulfil_matrix(spark, d).join(left, "left_id").join(right, "right_id").groupBy("left_title", "right_title").agg(F.sum("weight").alias("weight"))


@query(f"with net as ({_NET}) select (select count(*) from {_DEGREE}) as n_nodes, (select count(*) from net) as n_edges, round(2 * (select count(*) from net) / ((select count(*) from {_DEGREE}) * ((select count(*) from {_DEGREE}) - 1)), 6) as density")
def graph_density(spark: SparkSession, d: str) -> DataFrame:
    return graph.density(graph.network(user_matrix(spark, d), 1))


def _density_at(w: int) -> str:
    net = f"(select left_id, right_id from ({_MATRIX}) where weight >= {w})"
    nodes = f"(select count(*) from (select left_id from {net} union select right_id from {net}))"
    return f"select {w} as least_weight, {nodes} as n_nodes, (select count(*) from {net}) as n_edges, round(2 * (select count(*) from {net}) / ({nodes} * ({nodes} - 1)), 6) as density"


@query(" union all ".join(_density_at(w) for w in (1, 2, 3)))
def density_by_weight(spark: SparkSession, d: str) -> DataFrame:
    """Nodes, edges and density of the networks of pairs with at least 1, 2 and 3 shared bounties."""
    matrix = user_matrix(spark, d)
    parts = [graph.density(graph.network(matrix, w)).select(F.lit(w).alias("least_weight"), "n_nodes", "n_edges", "density") for w in (1, 2, 3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"with net as ({_NET}) select node, round(degree / ((select count(*) from {_DEGREE}) - 1), 6) as centrality from {_DEGREE}")
def degree_centrality(spark: SparkSession, d: str) -> DataFrame:
    return graph.degree_centrality(graph.network(user_matrix(spark, d), 1))


@query(f"with net as ({_NET}), g as (select * from {_DEGREE}), e as (select l.degree as x, r.degree as y from net join g l on l.node = left_id join g r on r.node = right_id) select round(corr(x, y), 6) as assortativity from (select x, y from e union all select y, x from e)")
def assortativity(spark: SparkSession, d: str) -> DataFrame:
    return graph.assortativity(graph.network(user_matrix(spark, d), 1))


@query(f"select count(distinct profile_id) as n_users from (select left_id as profile_id, weight from ({_MATRIX}) union select right_id, weight from ({_MATRIX})) where weight > 2")
def heavy_users(spark: SparkSession, d: str) -> DataFrame:
    """Users that share more than two bounties with some other user, on either side."""
    return graph.square_matrix(user_matrix(spark, d).where("weight > 2")).agg(F.countDistinct("left_id").alias("n_users"))


# ---- operational selections and merges --------------------------------------------------------------------------

_REPOS = "select c_custkey as repo_id, cast(floor(c_acctbal * 100) as bigint) as size, c_custkey % 40 as watchers, c_custkey % 97 as commits from customer"


@query(f"select repo_id, round(ln(1 + commits) * ln(1 + size), 6) as priority from ({_REPOS}) where size < 800000 and size >= 0 and watchers > 9 and repo_id not in (select o_custkey from orders where o_orderstatus = 'P') order by priority desc, repo_id limit 15000")
def job_priority_topk(spark: SparkSession, d: str) -> DataFrame:
    repos = table(spark, d, "customer").select(F.col("c_custkey").alias("repo_id"), F.floor(F.col("c_acctbal") * 100).alias("size"), (F.col("c_custkey") % 40).alias("watchers"), (F.col("c_custkey") % 97).alias("commits")).where("size >= 0")
    reserved = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("repo_id"))
    return oltp.job_priority(repos, reserved)


@query(
    """with r as (select distinct owner_repo as repo, split_part(file_path, '/', -1) as commit_id from file_hacker_commit where owner_repo is not null and file_path is not null),
p as (select a.repo, b.repo as other, count(*) as n from r a join r b on a.commit_id = b.commit_id and a.repo <> b.repo group by 1, 2)
select repo, count(*) as parallel_repos, cast(sum(n) as bigint) as shared_commits from p group by 1"""
)
def parallel_repos(spark: SparkSession, d: str) -> DataFrame:
    """Adapter: a file name that several repositories have stands for a shared commit."""
    return oltp.parallel_repos(commits(spark, d).select(F.col("owner_repo").alias("repo"), F.substring_index("file_path", "/", -1).alias("commit_id")))


@query("select author, cast(floor((epoch(min(commit_date)) + epoch(max(commit_date))) / 2) as bigint) as midpoint from file_hacker_commit group by 1")
def date_midpoint(spark: SparkSession, d: str) -> DataFrame:
    return commits(spark, d).groupBy("author").agg(F.min("commit_date").alias("a"), F.max("commit_date").alias("z")).select("author", exprs.midpoint(F.col("a"), F.col("z")).alias("midpoint"))


@query("select owner_repo, min(first_commit_date) as first_commit_date, max(last_commit_date) as last_commit_date, cast(sum(num_commits) as bigint) as num_commits from repo_file group by 1")
def repo_range_merge(spark: SparkSession, d: str) -> DataFrame:
    return oltp.merge_ranges(table(spark, d, "repo_file"), ["owner_repo"], "first_commit_date", "last_commit_date", "num_commits")


@query("select alias_id, extension_id, cast(sum(count) as bigint) as count from hacker_extension_association group by 1, 2")
def upsert_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "hacker_extension_association")
    return oltp.upsert_counts(rows.where("loaded_at is null"), rows.where("loaded_at is not null"), ["alias_id", "extension_id"], "count")


@query(f"with f as (select distinct ext from file_extension), v as (select distinct {_EXT} as ext from repo_file) select (select count(*) from f) + count(*) as n_keys, (select count(*) from f) as n_kept from v where ext not in (select ext from f)")
def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    existing = table(spark, d, "file_extension").select("ext", F.col("id").cast("bigint").alias("id"))
    out = oltp.get_or_create(existing, table(spark, d, "repo_file").select(exprs.file_extension("file_path").alias("ext")), "ext", "id")
    return out.agg(F.countDistinct("ext").alias("n_keys"), F.count_if(F.col("id").between(0, 1_000_000)).alias("n_kept"))


@query("select id, name, deleted_at, loaded_at from (select *, row_number() over (partition by id order by loaded_at desc nulls last, name desc nulls last) as k from dev_alias where loaded_at is not null) where k = 1")
def latest_alias(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dev_alias").where("loaded_at is not null").select("id", "name", "deleted_at", "loaded_at")
    return oltp.latest_state(rows, ["id"], "loaded_at", "name")


@query("select * from staged_eval_job_q q where not exists (select 1 from repo r where r.id = q.repo_id)")
def queue_without_repo(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "staged_eval_job_q").join(table(spark, d, "repo").select(F.col("id").alias("repo_id")).distinct(), "repo_id", "left_anti")


@query("select q.id, coalesce(max(r.commit_count), 0) as commit_count from staged_eval_job_q q left join repo r on r.id = q.repo_id group by 1")
def queue_with_default(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "repo").groupBy(F.col("id").alias("repo_id")).agg(F.max("commit_count").alias("c"))
    return table(spark, d, "staged_eval_job_q").select("id", "repo_id").join(counts, "repo_id", "left").groupBy("id").agg(F.coalesce(F.max("c"), F.lit(0)).alias("commit_count"))


@query("select count(*) filter (where deleted_at is not null) as n_deleted, count(*) filter (where github_user_id is not null) as n_resolved, count(*) filter (where count > 5) as n_active from dev_alias")
def alias_counters(spark: SparkSession, d: str) -> DataFrame:
    return oltp.counters(table(spark, d, "dev_alias"), n_deleted="deleted_at is not null", n_resolved="github_user_id is not null", n_active="count > 5")


@query("select * from git_commit c where not exists (select 1 from file_hacker_commit f where f.commit_id = c.commit_id)")
def orphan_commits(spark: SparkSession, d: str) -> DataFrame:
    return oltp.orphan_commits(table(spark, d, "git_commit"), commits(spark, d))


@query("select o_orderkey, o_custkey from orders where o_orderkey % 2 = 1")
def listing_diff(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return oltp.listing_difference(rows, rows.where("o_orderkey % 2 = 0"), "o_orderkey").select("o_orderkey", "o_custkey")


@query("select l_orderkey, l_linenumber, case when l_orderkey % 3 = 0 then l_quantity + 1 else l_quantity end as l_quantity from lineitem")
def replace_by_key_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return oltp.replace_by_key(rows, rows.where("l_orderkey % 3 = 0").withColumn("l_quantity", F.col("l_quantity") + 1), "l_orderkey")


@query("select items, count(*) as n_keys from (select commit_id, coalesce(array_to_string(list_sort(list(distinct is_binary)), ','), '') as items from file_hacker_commit group by 1) group by 1")
def file_set_patterns(spark: SparkSession, d: str) -> DataFrame:
    return oltp.file_set_patterns(commits(spark, d).select("commit_id", F.col("is_binary").cast("string").alias("is_binary")), "commit_id", "is_binary")


@query("select event_id, key, cast(json_extract_string(props, '$.' || key) as bigint) as value from (select event_id, props, unnest(json_keys(props)) as key from events)")
def json_shred(spark: SparkSession, d: str) -> DataFrame:
    return oltp.json_table(table(spark, d, "events"), "event_id", "props").where("key is not null")


@query("select event_type, cast(json_extract_string(props, '$.k') as bigint) as k, count(*) as n from events group by 1, 2")
def json_path(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k")).agg(F.count("*").alias("n"))


_BLAME_ROWS = "select distinct owner, repo_name, owner_repo, file_path, author, blame_type, unnest(map_keys(m)) as commit_id, unnest(map_values(m)) as v, partition_key from (select owner, repo_name, owner_repo, file_path, partition_key, a.author as author, unnest(['author_hash_map', 'commit_hash_map']) as blame_type, unnest([a.author_hash_map, a.commit_hash_map]) as m from (select owner, repo_name, owner_repo, file_path, partition_key, unnest(authors) as a from blame))"


@query(f"select owner, repo_name, owner_repo, file_path, author, blame_type, commit_id, v.epoch as epoch, v.lines as lines, v.time_zone as time_zone, partition_key from ({_BLAME_ROWS})")
def ingest_blame(spark: SparkSession, d: str) -> DataFrame:
    return ingest.blame_rows(table(spark, d, "blame"), ("author_hash_map", "commit_hash_map"))


@query("select owner, repo_name, concat_ws('/', owner, repo_name) as owner_repo, 'pk' || substr(md5(concat_ws('/', owner, repo_name)), 1, 2) as partition_key from (select distinct owner, repo_name from repo_file)")
def partition_keys(spark: SparkSession, d: str) -> DataFrame:
    return ingest.with_keys(table(spark, d, "repo_file").select("owner", "repo_name").distinct())


# ---- texts ------------------------------------------------------------------------------------------------------

_WORDS = "select coalesce(lang, 'none') as lang, regexp_extract(unnest(string_split(text, ' ')), '^([a-zA-Z\\-]*)', 1) as word from documents where text is not null"
_COUNTS = f"select lang, word, count(*) as n from ({_WORDS}) where word <> '' group by 1, 2"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.coalesce("lang", F.lit("none")).alias("lang"), "text")


@query(_COUNTS)
def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return text.word_counts(_docs(spark, d), "lang")


@query(
    f"""with c as ({_COUNTS}), g as (select count(distinct lang) as total from c), f as (select word, count(distinct lang) as df from c group by 1),
w as (select lang, word, (1 + ln(n)) * (ln((1 + total) / (1 + df)) + 1) as w from c join f using (word), g),
s as (select lang, word, round(w / sqrt(sum(w * w) over (partition by lang)), 6) as tfidf from w),
r as (select *, row_number() over (partition by lang order by tfidf desc, word) as rank from s where tfidf > 0.01)
select lang, word, tfidf, cast(rank as int) as rank from r where rank <= 20"""
)
def word_tfidf_top20(spark: SparkSession, d: str) -> DataFrame:
    return text.top_terms(text.tfidf(text.word_counts(_docs(spark, d), "lang"), "lang", "word", "n"), "lang", "word", 20, 0.01)


_SCAN = {k: text.IMPORTS[k] for k in ("javascript", "javascript_require", "c")}


@query(" union all ".join("select '{0}' as language, dependency, count(distinct doc_id) as n_docs from (select doc_id, unnest(regexp_extract_all(text, '{1}', 1)) as dependency from documents) group by 2".format(k, p.replace("'", "''")) for k, p in _SCAN.items()))
def import_scan(spark: SparkSession, d: str) -> DataFrame:
    return text.import_counts(table(spark, d, "documents"), list(_SCAN))


@query()
def import_scan_all(spark: SparkSession, d: str) -> DataFrame:
    """``import_scan`` in every language of IMPORTS."""
    return text.import_counts(table(spark, d, "documents"), list(text.IMPORTS))


# ---- features of commits and models -----------------------------------------------------------------------------

_TYPE_ROWS = """select log_id, regexp_replace(lower(type), '^[.]', '') as type, cast(sum(coalesce(v.inserts, 0)) as bigint) as inserts, cast(sum(coalesce(v.deletes, 0)) as bigint) as deletes, cast(sum(coalesce(v.occurrences, 0)) as bigint) as occurrences
from (select log_id, unnest(map_keys(f)) as type, unnest(map_values(f)) as v from (select log_id, any_value(filetypes) as f from commit_stat_log group by 1)) group by 1, 2"""
_POPULAR = f"select type, count(*) as n_commits, cast(sum(inserts) as bigint) as inserts, cast(sum(occurrences) as bigint) as occurrences from ({_TYPE_ROWS}) group by 1"
TYPES = ["css", "go", "html", "java", "js", "json", "md", "py", "rs", "toml", "ts", "yml"]
_WIDE = f"select log_id, {', '.join(f"cast(coalesce(sum(inserts) filter (where type = '{t}'), 0) as bigint) as {t}" for t in TYPES)} from ({_TYPE_ROWS}) group by 1"


def types(spark: SparkSession, d: str) -> DataFrame:
    return features.type_rows(table(spark, d, "commit_stat_log"))


@query(_POPULAR)
def type_popularity(spark: SparkSession, d: str) -> DataFrame:
    return features.type_popularity(types(spark, d))


@query(f"select type, n_commits from ({_POPULAR}) where n_commits * 1000 > 50 * (select count(distinct log_id) from ({_TYPE_ROWS}))")
def main_types(spark: SparkSession, d: str) -> DataFrame:
    return features.main_types(types(spark, d), 50)


@query(_WIDE)
def type_matrix(spark: SparkSession, d: str) -> DataFrame:
    return features.type_matrix(types(spark, d), TYPES)


@query(" union all ".join(f"select '{a}' as left_type, '{b}' as right_type, round(corr({a}, {b}), 6) as correlation from w having correlation > 0.01" for i, a in enumerate(TYPES) for b in TYPES[i + 1 :]).join([f"with w as ({_WIDE}) ", ""]))
def type_correlation(spark: SparkSession, d: str) -> DataFrame:
    return features.type_correlations(type_matrix(spark, d), TYPES, 0.01)


_MAIN = f"select type from ({_POPULAR}) where n_commits * 1000 > (select count(distinct log_id) from ({_TYPE_ROWS}))"


@query(f"select log_id, type, inserts from ({_TYPE_ROWS}) where type in ({_MAIN})")
def type_matrix_all(spark: SparkSession, d: str) -> DataFrame:
    return features.main_type_inserts(types(spark, d), 1)


@query(
    f"""with t as ({_TYPE_ROWS}), w as (select i.log_id, m.type, coalesce(t.inserts, 0) as v from (select distinct log_id from t) i cross join ({_MAIN}) m left join t on t.log_id = i.log_id and t.type = m.type)
select l.type as left_type, r.type as right_type, round(corr(l.v, r.v), 6) as correlation from w l join w r on l.log_id = r.log_id and l.type < r.type group by 1, 2 having corr(l.v, r.v) > 0.01"""
)
def type_correlation_all(spark: SparkSession, d: str) -> DataFrame:
    return features.all_type_correlations(types(spark, d), 1, 0.01)


@query("with e as (select min(value) as lo, max(value) as hi from events) select cast(least(floor((value - lo) * 100 / (hi - lo)), 99) as int) as bin, count(*) as n from events, e where value is not null group by 1")
def value_histogram(spark: SparkSession, d: str) -> DataFrame:
    return features.histogram(table(spark, d, "events"), "value", 100)


def _percent(a: str, b: str) -> str:
    return f"case when {a} = 0 then 0.0 when {b} = 0 then 100.0 else floor(cast({a} as double) * 10000 / {b}) / 100 end"


def _of(types: list[str], value: str) -> str:
    return f"cast(sum(case when type in ({', '.join(repr(x) for x in types)}) then {value} else 0 end) as bigint)"


_ACTION_SUMS = ", ".join(f'{_of(ts, "occurrences")} as "{a}_files"' + (f', {_of(ts, "inserts")} as "{a}_lines"' if kind == "text" else "") for a, (kind, ts) in exprs.ACTIONS.items())
_ACTION_SHARES = ", ".join(_percent(f'"{a}_files"', "total_files") + f' as "{a}_file_pct"' + (", " + _percent(f'"{a}_lines"', "text_lines") + f' as "{a}_line_pct"' if kind == "text" else "") for a, (kind, _) in exprs.ACTIONS.items())


@query(
    f"""with s as (select log_id, cast(sum(occurrences) as bigint) as total_files, cast(sum(case when inserts > 0 or deletes > 0 then occurrences else 0 end) as bigint) as text_files,
  cast(sum(case when inserts > 0 or deletes > 0 then 0 else occurrences end) as bigint) as bin_files, cast(sum(case when inserts > 0 or deletes > 0 then inserts else 0 end) as bigint) as text_lines, {_ACTION_SUMS} from ({_TYPE_ROWS}) group by 1)
select *, {_ACTION_SHARES} from s"""
)
def commit_features(spark: SparkSession, d: str) -> DataFrame:
    return features.commit_features(types(spark, d), exprs.ACTIONS)


@query(
    """with p as (select user_id, event_type, count(*) as n from events group by 1, 2)
select user_id, cast(sum(n) as bigint) as total, string_agg(event_type || ':' || n, ',' order by n desc, event_type) as history from p group by 1"""
)
def label_histories(spark: SparkSession, d: str) -> DataFrame:
    rows = features.label_histories(table(spark, d, "events"), "user_id", "event_type")
    flat = F.array_join(F.transform("history", lambda x: F.concat(x["label"], F.lit(":"), x["n"].cast("string"))), ",")
    return rows.select("user_id", "total", flat.alias("history"))


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return table(spark, d, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@query()
def cluster_medians(spark: SparkSession, d: str) -> DataFrame:
    rows = commit_features(spark, d)
    wide = features.log_vectors(rows, ["total_files", "text_lines", "javascript_lines", "markdown_lines"]).join(rows, "log_id")
    return features.cluster_medians(features.clusters(wide, 8), ["total_files", "text_lines", "javascript_lines", "markdown_lines"])


@query()
def logreg_scores(spark: SparkSession, d: str) -> DataFrame:
    return features.scores(features.classified(_vectors(spark, d)), "vec_id")


@query()
def logreg_confusion(spark: SparkSession, d: str) -> DataFrame:
    return features.confusion(features.classified(_vectors(spark, d)))
