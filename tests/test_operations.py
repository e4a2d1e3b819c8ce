"""The operational procedures, and the functions that no query over the test tables calls."""

import json
from datetime import datetime as t

import pytest
from pyspark.sql import functions as F

from strataloom.functions import exprs
from strataloom.operators import curation, features, identity, oltp, procedures, rollups, text
from strataloom.plans import operations
from strataloom.sources import ingest, logs, tables
from strataloom.streaming import increments
from tests.test_whole_job import compared


@pytest.mark.parametrize("name", ["commit_graph_aliases", "commit_graph_commits", "commit_graph_stats", "association_table", "alias_reserve", "queue_drain", "alias_propagation_shared", "author_dependency_tfidf"])
def test_operations_equal_their_sql(spark, name):
    assert compared(spark, operations, name)


def test_inserts_if_absent(spark):
    aliases = spark.createDataFrame([("a", "Ann", 3), ("b", "Bob", None)], "md5 string, name string, count int")
    calls = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("c", "n" * 300, 1), (None, "x", 1)], "md5 string, name string, n int")
    assert sorted(map(tuple, procedures.counted_aliases(aliases, calls).collect())) == [("a", "Ann", 6), ("b", "Bob", 0), ("c", "n" * 256, 1)]
    have = spark.createDataFrame([("1", None), ("2", "r")], "k string, r string")
    assert sorted(map(str, procedures.new_rows(have, have.union(spark.createDataFrame([("1", "r"), ("1", "r"), (None, None)], have.schema)), ["k", "r"]).collect())) == ["Row(k='1', r='r')", "Row(k=None, r=None)"]
    batch = spark.createDataFrame([("c1", {"py": (1, 2, 3)}), ("c2", {"y" * 200: (1, 1, 1)}), ("c3", None)], "commit_id string, filetypes map<string,struct<inserts:int,deletes:int,occurrences:int>>")
    done = spark.createDataFrame([("c1",)], "commit_id string")
    assert [tuple(r) for r in procedures.commit_stats(done, batch).collect()] == [("c2", "y" * 128, 1, 1, 1)]


def test_contributors_and_states(spark):
    rows = procedures.contributors(spark.createDataFrame([(1, '[{"login":"x","change_count":4},{"login":"y","change_count":1}]'), (2, "[]"), (3, None), (4, "{")], "repo_id long, document string"))
    assert [tuple(r) for r in procedures.contributor_totals(rows).collect() if r["repo_id"] == 1] == [(1, 2, 5)]
    aliases = spark.createDataFrame([(1, "a", None), (2, "b", "g")], "id long, md5 string, github_user_id string")
    answers = spark.createDataFrame([("a", "h"), ("a", "i"), ("z", "j")], "md5 string, github_user_id string")
    assert sorted(tuple(r)[:3] for r in procedures.resolved_aliases(aliases, answers).select("id", "md5", "github_user_id").collect()) == [(1, "a", "i"), (2, "b", "g")]
    asked = spark.createDataFrame([("a", "r2", 2), ("a", "r1", 1), ("b", "r1", 1), ("z", "r1", 1)], "md5 string, reserver string, at long")
    assert [tuple(r) for r in procedures.reserved_aliases(aliases, spark.createDataFrame([(2,)], "alias_id long"), asked).collect()] == [(1, "r1")]
    queue = spark.createDataFrame([(i, "k", i) for i in range(1, 6)], "id long, k string, v long")
    assert [tuple(r) for r in procedures.drained(queue, "k", "v", 3).collect()] == [("k", 3, 6, 3)]


def test_association_rows_are_an_outer_unnest(spark):
    doc = {"repo_owner": "o", "repo_name": "r", "hack_assoc_map": {"hacker_hash": "h", "hacker_extension_map": [], "hacker_import_array": {"lang_ext": "py", "import_map": [{"name": "a", "contributions": "1.5"}]}}}
    rows = spark.createDataFrame([(1, json.dumps(doc)), (2, None), (3, "[")], "id long, stats_json string")
    got = {tuple(r) for r in procedures.association_table(rows).collect()}
    assert got == {(1, "extension", "o", "r", "h", None, None, None, None), (1, "import", "o", "r", "h", None, "py", "a", 1.5)}


def test_imports_by_the_suffix_of_a_path(spark):
    files = spark.createDataFrame([("A/B.PY", "import os\nfrom a import b, c"), ("x.js", "require('y')"), ("x.txt", "import os"), ("x.rs", None)], "file_path string, text string")
    assert [r["dependencies"] for r in text.file_imports(files).collect()] == [["os", "a.b", "a.c"], ["y"], [], None]


def test_readers_and_writers(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "k int, v string")
    for path, write in (("w", lambda p: ingest.overwrite(df, p, 1)), ("r", lambda p: curation.report(df, p, ["k"]))):
        write(str(tmp_path / "raw" / path))
        write(str(tmp_path / "raw" / path))
        assert len(list((tmp_path / "raw" / path).glob("*.parquet"))) == 1
    assert [r["k"] for r in spark.read.parquet(str(tmp_path / "raw" / "r")).collect()] == [1, 2, 3]
    assert ingest.register(spark, str(tmp_path), "raw", "w").count() == spark.table("raw_w").count() == 3
    tables.json_lines(df, str(tmp_path / "j"))
    texts = logs.read_logs(spark, str(tmp_path), "*.bz2")
    assert sum(len(r["text"].split()) for r in texts.collect()) == 3 and texts.columns == ["source", "text"]
    items = spark.createDataFrame([json.dumps({"owner": {"login": "o"}, "name": n, "language": lang, "pushed_at": "2020-01-01T00:00:00Z", "license": None, "watchers_count": 5, "forks_count": 1}) for n, lang in (("a", "Java"), ("b", "C"))], "string")
    schema = "owner struct<login:string>, name string, language string, pushed_at string, license struct<key:string>, watchers_count int, forks_count int"
    found = ingest.recent_repos(items.select(F.from_json("value", schema).alias("x")).select("x.*")).collect()
    assert [(r["owner_repo"], r["extension"], r["license"], r["num_stars"]) for r in found] == [("o/a", ".java", "Proprietary", 5)]
    cut = spark.createDataFrame([('[{"a":1},{"a":2}',), ('[{"a":1}]',)], "t string")
    assert [len(r[0]) for r in cut.select(logs.repaired_json(F.col("t"), "array<struct<a:int>>")).collect()] == [2, 1]


def test_lookups_counts_and_samples(spark):
    aliases = spark.createDataFrame([("h", "x"), ("g", "y")], "author_email_hash string, alias_name string")
    bundle = json.loads(identity.lookup_bundle(aliases, aliases.withColumnRenamed("alias_name", "repo"), "h").first()["bundle"])
    assert [r["alias_name"] for r in bundle["aliases"]] == ["x"] and [r["repo"] for r in bundle["projects"]] == ["x"]
    assert identity.lookup(aliases, "author_email_hash", "' or 1=1 --").isEmpty()
    times = spark.createDataFrame([(t(2020, 1, 1, 23, 59),)], "at timestamp")
    assert oltp.back_off(times, "at").first()["at"] == t(2020, 1, 2, 0, 1)
    rows = spark.range(100).withColumn("g", F.col("id") % 4)
    assert {r["count"] for r in features.sample_per_group(rows, "g", 20, 1).groupBy("g").count().collect()} == {20}
    assert oltp.shuffled(rows, 7, 1).count() == 7
    seen = rollups.merged_commits(spark.createDataFrame([("c", "b"), ("c", "a"), ("c", "a")], "commit_id string, seen_in string"))
    assert [tuple(r) for r in seen.collect()] == [("c", ["a", "b"])]
    assert [tuple(r) for r in rollups.dependency_counts(spark.createDataFrame([("x",), ("x",)], "dependency string")).collect()] == [("x", 2)]
    capped = spark.createDataFrame([(3, 2), (1, 3)], "a long, b long").select(exprs.percent_capped(F.col("a"), F.col("b")))
    assert [r[0] for r in capped.collect()] == [100.0, 33.33]


def test_streams_count(spark, tmp_path):
    source = str(tmp_path / "s")
    spark.createDataFrame([("a", t(2020, 1, 1, 0, 5), 2), ("a", t(2020, 1, 1, 0, 20), 3), ("b", t(2020, 1, 1, 2), 1)], "k string, at timestamp, v int").write.parquet(source)
    for name, shape in (("totals", lambda s: increments.running_counts(s, ["k"], "v")), ("windows", lambda s: increments.windowed_counts(s, "at", "1 hour", "1 day", "k"))):
        stream = shape(spark.readStream.schema("k string, at timestamp, v int").parquet(source))
        stream.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted(tuple(r) for r in spark.table("totals").collect()) == [("a", 2, 5), ("b", 1, 1)]
    assert sorted((r["k"], r["n"]) for r in spark.table("windows").collect()) == [("a", 2), ("b", 1)]


def test_models_are_kept_and_applied(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression

    rows = spark.createDataFrame([(f"c{i}", "ann" if i % 2 else "bob", float(i % 2), i % 2 * 50.0 + i % 7) for i in range(80)], "commit_id string, author string, label double, x double")
    labelled = features.training_rows(rows.select("commit_id", "x"), rows, ["x"])
    model = features.saved(LogisticRegression(maxIter=20).fit(labelled), str(tmp_path / "m"))
    vectors = features.log_vectors(rows, ["x"], "commit_id").join(rows.select("commit_id", "author"), "commit_id")
    told = features.author_histories(vectors, {"first": model, "second": model})
    assert {(r["model"], r["author"], r["total"], r["history"][0]["label"]) for r in told.collect()} == {(m, a, 40, label) for m in ("first", "second") for a, label in (("ann", 1), ("bob", 0))}
    assert features.cross_validated(labelled, [0.0]).first()["accuracy"] > 0.95
    perceptron = features.classified(labelled, layers=[1, 4, 2])
    assert features.confusion(perceptron).where("label <> prediction").isEmpty()


STAT = """commit aaaaaaa1
Author: Ann <a@x>
Date:   Fri Oct 22 01:39:41 2021 +0800

    first line

 src/a.py | 4 +++-
 img/blob | Bin 10 -> 20 bytes
 2 files changed, 3 insertions(+), 1 deletion(-)
commit bbbbbbb2
Author: Bob <b@x>
Date:   Fri Oct 22 01:39:41 2021 +0000

    second"""


def test_stat_logs_are_commits(spark):
    rows = {r["commit_id"]: r for r in logs.stat_commits(spark.createDataFrame([("s", STAT), ("n", None)], "source string, text string")).collect()}
    assert set(rows) == {"aaaaaaa1", "bbbbbbb2"}
    first = rows["aaaaaaa1"]
    assert tuple(first["file_list"]["src/a.py"]) == (0, 3, 1) and first["file_list"]["img/blob"]["binary"] == 1
    assert set(first["filetypes"]) == {"py", "noextbin"} and first["comment"] == "first line" and rows["bbbbbbb2"]["file_list"] == {}


def test_fast_blame_agrees_with_the_parser(spark):
    def group(letter, name, lines, known):
        head = [f"{letter * 40} 1 1 {lines}"] + ([] if known else [f"author {name}", f"author-mail <{name}@x>", "author-time 10", "author-tz +0100", "committer C", "committer-mail <c@x>", "committer-time 11", "committer-tz +0000"]) + ["filename f.py", "\tcode"]
        return head + [x for i in range(1, lines) for x in (f"{letter * 40} {i} {i}", "\tcode")]

    text = "\n".join(group("a", "ann", 3, False) + group("b", "bob", 1, False) + group("a", "ann", 2, True) + group("c", "ann", 1, False))
    df = spark.createDataFrame([("s", text), ("n", None)], "source string, text string")
    got = {tuple(r) for r in logs.fast_blame(df).collect()}
    assert got == {("s", "ann {ann@x}", 6, 2), ("s", "bob {bob@x}", 1, 1)}


def test_commits_of_many_files(spark, tmp_path):
    for owner in ("o", "p", "q"):
        (tmp_path / owner / "r").mkdir(parents=True)
        (tmp_path / owner / "r" / "commit-stat.log.json").write_text(json.dumps([{"commit": f"c{owner}", "Author": "Ann", "Date": "2020-01-01T00:00:00+01:00", "fileTypes": {"py": {"inserts": 1}}}]))
    rows = logs.commit_files(spark, str(tmp_path), "commit-stat.log.json").collect()
    assert {(r["commit"], r["seen_in"][0]) for r in rows} == {(f"c{o}", f"{o}/r") for o in "opq"}
    assert {r["utc_datetime"] for r in rows} == {t(2019, 12, 31, 23)} and rows[0]["fileTypes"]["py"]["inserts"] == 1
    parts = [[r["commit"] for r in logs.commit_files(spark, str(tmp_path), "commit-stat.log.json", i, 2).collect()] for i in (0, 2)]
    assert [len(p) for p in parts] == [2, 1] and len({c for p in parts for c in p}) == 3


def test_catalog_views(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("default.strataloom_three")
    assert tables.catalog_view(spark, "default", "strataloom_three", "three").count() == spark.table("three").count() == 3
    spark.sql("drop table default.strataloom_three")


def test_relational_tables(spark):
    url, driver = "jdbc:derby:memory:strataloom;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df = spark.range(250).select("id", F.concat(F.lit("n"), F.col("id")).alias("name"))
    tables.jdbc_insert(df, url, "people", driver=driver)
    rows = tables.jdbc_table(spark, url, "people", "id", 50, 200, 4, driver=driver)
    assert rows.count() == 250 and rows.rdd.getNumPartitions() == 4 and rows.agg(F.sum("id")).first()[0] == sum(range(250))
