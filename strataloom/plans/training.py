"""Queries of the core data problems over the test tables, and the SQL that DuckDB runs beside them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.operators import heavy_keys, instants, nested, orphans
from strataloom.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.nested_links(table(spark, d, "import_performance_tracking"), table(spark, d, "blame"))


def p1_store(spark: SparkSession, d: str) -> DataFrame:
    return nested.store_summary(nested.merkle_tables(table(spark, d, "import_performance_tracking"), "id", "stats_json"))


def p1_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Texts of the tracking table that hold no document, by reason."""
    return nested.merkle_tables(table(spark, d, "import_performance_tracking"), "id", "stats_json").reject.groupBy("reason").agg(F.count("*").alias("n"))


def _list(field: str) -> str:
    return f"case json_type({field}) when 'ARRAY' then json_extract({field}, '$[*]') when 'OBJECT' then [{field}] else [] end"


def _text(field: str) -> str:
    return f"case when json_type({field}) in ('OBJECT', 'ARRAY', 'NULL') then null else {field} ->> '$' end"


_TRIM = "ltrim({0}, chr(65279) || ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160))"
P1_SQL = f"""with recursive u as (
  select id, {_TRIM.format("stats_json")} as t from import_performance_tracking
  union all
  select id, case json_type(t) when 'ARRAY' then cast(t -> '$[0]' as varchar) else {_TRIM.format("(t ->> '$')")} end
  from u where json_valid(t) and (json_type(t) = 'VARCHAR' or (json_type(t) = 'ARRAY' and json_array_length(t) = 1))),
docs as (select distinct id, cast(t as json) as j from u where json_valid(t) and json_type(t) = 'OBJECT'),
hackers as (select id, h, {_text("(h -> 'hacker_hash')")} as hash from (select id, unnest({_list("(j -> 'hack_assoc_map')")}) as h from docs) where json_type(h) = 'OBJECT'),
exts as (select id, coalesce(hash, '') as hash, {_text("(e -> 'ext')")} as child from (select id, hash, unnest({_list("(h -> 'hacker_extension_map')")}) as e from hackers) where json_type(e) = 'OBJECT'),
langs as (select id, coalesce(hash, '') || '/' || coalesce({_text("(a -> 'lang_ext')")}, '') as parent, a from (select id, hash, unnest({_list("(h -> 'hacker_import_array')")}) as a from hackers) where json_type(a) = 'OBJECT'),
imports as (select id, parent, {_text("(i -> 'name')")} as child from (select id, parent, unnest({_list("(a -> 'import_map')")}) as i from langs) where json_type(i) = 'OBJECT'),
authors as (select blame_id, unnest(authors) as a from blame)
select 'hacker' as link_kind, id as rec_id, '' as parent_key, hash as child_key from hackers where hash is not null
union select 'extension', id, hash, child from exts where child is not null
union select 'import', id, parent, child from imports where child is not null
union select 'blame_author', blame_id, coalesce(a.author, ''), unnest(map_keys(a.author_hash_map)) from authors where a is not null
union select 'blame_commit', blame_id, coalesce(a.author, ''), unnest(map_keys(a.commit_hash_map)) from authors where a is not null"""

#: child table, reference, time of the child, parent table
REFERENCES = [
    ("git_commit", "alias_id", "loaded_at", "dev_alias"),
    ("hacker_extension_association", "alias_id", "loaded_at", "dev_alias"),
    ("repo_import_association", "import_id", "loaded_at", "source_import"),
    ("staged_eval_job_q", "repo_id", "tstamp", "repo"),
]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [orphans.orphans(table(spark, d, child), table(spark, d, parent), "id", ref, at).withColumn("child_table", F.lit(child)) for child, ref, at, parent in REFERENCES]
    return reduce(DataFrame.unionByName, parts).select("child_table", "child_id", "orphan_kind", "period")


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return p2_found(spark, d).groupBy("child_table", "period", "orphan_kind").agg(F.count("*").alias("n_orphans"))


def _p2_sql(child: str, ref: str, at: str, parent: str) -> str:
    return f"""select distinct '{child}' as child_table, c.id as child_id,
  case when not exists (select 1 from {parent} p where p.id = c.{ref}) then 'missing'
       when exists (select 1 from {parent} p where p.id = c.{ref} and p.loaded_at <= c.{at}) then 'deleted' else 'late' end as orphan_kind,
  coalesce(strftime(c.{at}, '%Y-%m'), 'unknown') as period
from {child} c where c.{ref} is not null
  and not exists (select 1 from {parent} p where p.id = c.{ref} and p.loaded_at <= c.{at} and (p.deleted_at is null or p.deleted_at > c.{at}))
  and (c.{at} is not null or not exists (select 1 from {parent} p where p.id = c.{ref}))"""


P2_SQL = "\nunion all\n".join(_p2_sql(*x) for x in REFERENCES)

#: table, key, secondary order, summed columns
HEAVY = [
    ("file_hacker_commit", "owner_repo", ["commit_date"], ["total_inserts", "total_deletes"]),
    ("git_commit", "alias_id", ["date"], []),
    ("repo_file", "partition_key", ["last_commit_date"], ["total_inserts", "total_deletes"]),
]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for name, key, order, values in HEAVY:
        totals = heavy_keys.stitched_totals(table(spark, d, name), key, order, values)
        parts.append(heavy_keys.heavy_values(totals, key).select(F.lit(name).alias("table_name"), F.lit(key).alias("key_field"), "key_value"))
    return reduce(DataFrame.unionByName, parts)


def p5_totals(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for name, key, order, _ in HEAVY:
        if name == "git_commit":
            continue
        totals = heavy_keys.stitched_totals(table(spark, d, name), key, order, ["total_inserts", "total_deletes"])
        parts.append(totals.withColumn("table_name", F.lit(name)).withColumnRenamed(key, "key_value"))
    return reduce(DataFrame.unionByName, parts).select("table_name", "key_value", "n_rows", "n_total_inserts", "sum_total_inserts", "n_total_deletes", "sum_total_deletes")


def p5_totals_all(spark: SparkSession, d: str) -> DataFrame:
    """``p5_totals`` over every key of HEAVY; a table without summed columns has null there."""
    parts = []
    for name, key, order, values in HEAVY:
        totals = heavy_keys.stitched_totals(table(spark, d, name), key, order, values)
        sums = [F.col(c) if c in totals.columns else F.lit(None).cast("bigint").alias(c) for v in ("total_inserts", "total_deletes") for c in (f"n_{v}", f"sum_{v}")]
        parts.append(totals.select(F.lit(name).alias("table_name"), F.lit(key).alias("key_field"), F.col(key).cast("string").alias("key_value"), "n_rows", *sums))
    return reduce(DataFrame.unionByName, parts)


def p5_running_all(spark: SparkSession, d: str) -> DataFrame:
    """``p5_running`` over every row of git_commit, repeated ones too."""
    rows = table(spark, d, "git_commit").select("alias_id", "id", "commit_id", "loaded_at").withColumn("one", F.lit(1).cast("bigint"))
    out = heavy_keys.stitched_running(rows, "alias_id", ["id", "commit_id", "loaded_at"], "one")
    return out.groupBy("alias_id").agg(F.max("seq_no").alias("last_seq"), F.sum("running_sum").alias("sum_running"))


def p5_running(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "git_commit").select("alias_id", "id", "commit_id", "loaded_at").distinct().withColumn("one", F.lit(1).cast("bigint"))
    out = heavy_keys.stitched_running(rows, "alias_id", ["id", "commit_id", "loaded_at"], "one")
    return out.groupBy("alias_id").agg(F.max("seq_no").alias("last_seq"), F.sum("running_sum").alias("sum_running"))


P5_FOUND_SQL = "\nunion all\n".join(
    f"select '{t}' as table_name, '{k}' as key_field, cast({k} as varchar) as key_value from {t} where {k} is not null group by {k} having count(*) >= 0.04 * (select count(*) from {t})" for t, k, _, _ in HEAVY
)
P5_TOTALS_SQL = "\nunion all\n".join(
    f"select '{t}' as table_name, {k} as key_value, count(*) as n_rows, count(total_inserts) as n_total_inserts, cast(sum(total_inserts) as bigint) as sum_total_inserts, count(total_deletes) as n_total_deletes, cast(sum(total_deletes) as bigint) as sum_total_deletes from {t} group by {k}"
    for t, k, _, v in HEAVY
    if v
)
P5_TOTALS_ALL_SQL = "\nunion all\n".join(
    f"select '{t}' as table_name, '{k}' as key_field, cast({k} as varchar) as key_value, count(*) as n_rows, "
    + ", ".join(f"count({c}) as n_{c}, cast(sum({c}) as bigint) as sum_{c}" if v else f"cast(null as bigint) as n_{c}, cast(null as bigint) as sum_{c}" for c in ("total_inserts", "total_deletes"))
    + f" from {t} group by {k}"
    for t, k, _, v in HEAVY
)
P5_RUNNING_ALL_SQL = "select alias_id, count(*) as last_seq, cast(count(*) * (count(*) + 1) / 2 as bigint) as sum_running from git_commit group by alias_id"
P5_RUNNING_SQL = """select alias_id, count(*) as last_seq, cast(count(*) * (count(*) + 1) / 2 as bigint) as sum_running
from (select distinct alias_id, id, commit_id, loaded_at from git_commit) group by alias_id"""


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return instants.instants(table(spark, d, "git_commit"), table(spark, d, "commit_stat_log"), table(spark, d, "blame"))


QUERIES = {
    "p1_found": p1_found,
    "p1_store": p1_store,
    "p1_rejects": p1_rejects,
    "p2_found": p2_found,
    "p2_report": p2_report,
    "p5_found": p5_found,
    "p5_totals": p5_totals,
    "p5_running": p5_running,
    "p5_totals_all": p5_totals_all,
    "p5_running_all": p5_running_all,
    "p6_found": p6_found,
}
ORACLES = {
    "p1_found": P1_SQL,
    "p2_found": P2_SQL,
    "p2_report": f"select child_table, period, orphan_kind, count(*) as n_orphans from ({P2_SQL}) group by all",
    "p5_found": P5_FOUND_SQL,
    "p5_totals": P5_TOTALS_SQL,
    "p5_running": P5_RUNNING_SQL,
    "p5_totals_all": P5_TOTALS_ALL_SQL,
    "p5_running_all": P5_RUNNING_ALL_SQL,
}
