import math
from datetime import datetime as t

import duckdb
import pytest
from pyspark.sql import functions as F

from strataloom.functions import exprs
from strataloom.operators import curation, features, graph, identity, oltp, text
from strataloom.plans import reference, training
from strataloom.sources import ingest, logs
from strataloom.streaming import increments

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("path,ext", [("a/b.py", ".py"), ("a.b/c", ".b/c"), (".gitignore", ".gitignore"), ("abc", ""), ("", ""), (None, None), ("x.tar.gz", ".gz")])
def test_extension(spark, path, ext):
    assert spark.createDataFrame([(path,)], "p string").select(exprs.file_extension("p")).first()[0] == ext


def test_percent_is_cut(spark):
    rows = spark.createDataFrame([(0, 5), (5, 0), (1, 3), (2, 3)], "a long, b long")
    assert [r[0] for r in rows.select(exprs.percent(F.col("a"), F.col("b"))).collect()] == [0.0, 100.0, 33.33, 66.66]


def test_window_totals_and_periods(spark):
    rows = spark.createDataFrame([("a", ".py", t(2020, 1, 1), 1, 10), ("a", ".py", t(2020, 3, 1), 2, 20), ("a", ".py", t(2020, 4, 1), 4, 40)], "author string, extension string, year_month timestamp, num_files long, total_inserts long")
    got = {r["month"]: (r["year_files"], r["qrtr_files"], r["quarter_ce"], r["month_ce"]) for r in curation.extension_windows(rows).collect()}
    assert got == {1: (7, 3, 8081, 24241), 3: (7, 3, 8081, 24243), 4: (7, 4, 8082, 24244)}


def test_square_matrix_is_symmetric_and_measures(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (1, "y"), (2, "y"), (4, "z"), (None, "x")], "item long, grp string")
    edges = graph.sparse_matrix(graph.ordered_pairs(rows, "item", "grp"))
    assert {tuple(r) for r in edges.collect()} == {(1, 2, 2), (1, 3, 1), (2, 3, 1)}
    square = {tuple(r)[:2] for r in graph.square_matrix(edges).collect()}
    assert square == {(b, a) for a, b in square} and len(square) == 6
    assert graph.density(edges).first()["density"] == 1.0
    assert {r["centrality"] for r in graph.degree_centrality(edges).collect()} == {1.0}


def test_merge_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 1)], "k string, v int")
    once = oltp.replace_by_key(old, new, "k")
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 9), ("c", 1)] == sorted(map(tuple, oltp.replace_by_key(once, new, "k").collect()))


def test_parallel_repos_and_propagation(spark):
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("b", "2"), ("c", "3"), (None, "1")], "repo string, commit_id string")
    assert {tuple(r) for r in oltp.parallel_repos(rows).collect()} == {("a", 1, 2), ("b", 1, 2)}
    commits = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "commit_id string, alias_id long")
    aliases = spark.createDataFrame([(1, "g"), (2, None), (3, None)], "id long, github_user_id string")
    assert [tuple(r) for r in identity.shared_commit_ids(commits, aliases).collect()] == [(2, "g")]


LOG = """commit aaaaaaa1
Author: Ann <a@x>
Date:   Fri Oct 22 01:39:41 2021 +0800

    first line

3\t1\tsrc/a.py
-\t-\timg/b.png
2\t0\tMakefile
commit bbbbbbb2
Merge: 1 2
Author: Bob <b@x>
Date:   never

    only words
commit ccccccc3
Author: Cyd <c@x>
Date:   Fri Oct 22 01:39:41 2021 +0000

5\t5\tsrc/a.py"""

BLAME = "\n".join(["a" * 40 + " 1 1 1", "author Ann", "author-mail <a@x>", "author-time 10", "author-tz +0100", "committer Bob", "committer-mail <b@x>", "committer-time 11", "committer-tz +0000", "filename f.py", "\tcode"] * 2)


def test_log_parsers(spark):
    rows = {r["commit_id"]: r for r in logs.numstat_commits(spark.createDataFrame([("s", LOG), ("e", ""), ("n", None)], "source string, text string")).collect()}
    assert set(rows) == {"aaaaaaa1", "bbbbbbb2", "ccccccc3"}
    first = rows["aaaaaaa1"]
    assert first["orig_timezone"] == "+0800" and first["comment"] == "first line" and first["date"] == t(2021, 10, 21, 17, 39, 41)
    assert first["file_list"]["img/b.png"]["binary"] == 1 and first["filetypes"]["noexttext"]["inserts"] == 2 and first["filetypes"]["py"]["deletes"] == 1
    assert rows["bbbbbbb2"]["date"] is None and rows["bbbbbbb2"]["file_list"] == {}
    got = {tuple(r) for r in logs.blame_lines(spark.createDataFrame([("s", BLAME)], "source string, text string")).collect()}
    assert got == {("s", "f.py", "Ann {a@x}", "author_hash_map", "a" * 40, 10, "+0100", 2), ("s", "f.py", "Bob {b@x}", "commit_hash_map", "a" * 40, 11, "+0000", 2)}


def test_ingest_and_merge(spark, tmp_path):
    raw = logs.numstat_commits(spark.createDataFrame([("s", LOG)], "source string, text string")).withColumns({"owner": F.lit("o"), "repo_name": F.lit("r")})
    files = ingest.file_hacker(raw)
    assert {(r["file_path"], r["total_inserts"], r["owner_repo"]) for r in files.collect()} == {("src/a.py", 3, "o/r"), ("src/a.py", 5, "o/r")}
    target = str(tmp_path / "t")
    files.write.partitionBy("partition_key").parquet(target)
    ingest.merge_partitions(spark, files.limit(1), target)
    assert spark.read.parquet(target).count() == 1
    source = str(tmp_path / "s")
    files.write.parquet(source)
    schema = ", ".join(f"{n} {k}" for n, k in files.dtypes)
    increments.merge_new_files(spark, source, schema, target, str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(target).count() == 2


def keyed(spark, rows):
    return spark.createDataFrame(rows, "owner_repo string, v long, partition_key string")


def merged(spark, path, old, new):
    keyed(spark, old).write.partitionBy("partition_key").parquet(path)
    ingest.merge_partitions(spark, keyed(spark, new), path)
    return sorted((r["owner_repo"], r["v"], r["partition_key"] or "") for r in spark.read.parquet(path).collect())


def test_merge_into_many_partitions_keeps_every_row(spark, tmp_path):
    old = [(f"old{i}", i, f"p{i:03}") for i in range(300)]
    new = [(f"new{i}", i, f"p{i:03}") for i in range(300)]
    assert merged(spark, str(tmp_path / "t"), old, new) == sorted(old + new)


def test_merge_into_the_null_partition_keeps_its_rows(spark, tmp_path):
    old = [("a", 1, None), ("b", 2, None), ("c", 3, "p")]
    assert merged(spark, str(tmp_path / "t"), old, [("b", 9, None), ("d", 4, None)]) == [("a", 1, ""), ("b", 9, ""), ("c", 3, "p"), ("d", 4, "")]


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "ROWS_A_TASK", 100)
    path = str(tmp_path / "t")
    new = [(f"k{i}", i, "hot") for i in range(2000)] + [("x", 1, "cold")]
    assert merged(spark, path, [("k1", -1, "hot"), ("y", 2, "cold")], new) == sorted(new + [("y", 2, "cold")])
    assert len(list((tmp_path / "t" / "partition_key=hot").glob("*.parquet"))) > 1


def test_dependencies_and_listings(spark):
    maps = spark.createDataFrame([("o", "r", {"a.py": ["x", "x", "y\tz"], "b.py": []})], "owner string, repo_name string, deps map<string,array<string>>")
    assert [(r["file_path"], r["dependency"]) for r in ingest.dependency_rows(maps).collect()] == [("a.py", "x")]
    rows = logs.listing(spark.createDataFrame([("2022-01-01 00:00:00  12 repo/o/r/blame_map.json.bz2",), ("bad",)], "value string"))
    assert [tuple(r)[:3] for r in rows.collect()] == [("o", "r", "blame_map.json.bz2")]


SOURCES = {
    "java": ("import a.b.C;\nimport static d.E.*;\n// import no", ["a.b.C", "d.E.*"]),
    "python": ("import os\nimport a, b\n  import no\nimport x as y", ["os", "a, b", "x"]),
    "python_from": ("from a.b import c, d\n from no import e\nfrom os import path, sep as s\nfrom . import x\nfrom m import n as k", ["a.b.c", "a.b.d", "os.path", "os.sep", "..x", "m.n"]),
    "javascript": ("import {a} from 'b';\nimport 'c'\nlet x = 1", ["b", "c"]),
    "javascript_require": ("const a = require('b'); require (\"c\"); require(['no'])", ["b", "c"]),
    "go": ('import "fmt"\nimport (\n  "os"\n  x "a/b"\n)', ["fmt", "os", "a/b"]),
    "scala": ("import a.b.C\nimport d.{e, f}", ["a.b.C", "d."]),
    "c": ('#include <a.h>\n# include "b.h"', ["a.h", "b.h"]),
    "rust": ("use std::io;\nuse crate::no;", ["std::io", "crate::no"]),
}


@pytest.mark.parametrize("language", SOURCES)
def test_imports(spark, language):
    source, want = SOURCES[language]
    assert spark.createDataFrame([(source,)], "t string").select(text.imports(F.col("t"), language)).first()[0] == want


def test_tfidf_by_hand(spark):
    rows = text.tfidf(spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "x", 1)], "g string, w string, n long"), "g", "w", "n")
    x, y = (1 + math.log(2)) * 1.0, math.log(3 / 2) + 1
    got = {(r["g"], r["w"]): r["tfidf"] for r in rows.collect()}
    assert got[("a", "x")] == round(x / math.hypot(x, y), 6) and got[("b", "x")] == 1.0


def test_histories_and_histogram(spark):
    rows = spark.createDataFrame([("u", "b"), ("u", "b"), ("u", "a")], "who string, label string")
    assert features.label_histories(rows, "who", "label").first()["history"][0]["label"] == "b"
    same = spark.createDataFrame([(1.0,), (1.0,), (None,)], "v double")
    assert [tuple(r) for r in features.histogram(same, "v", 10).collect()] == [(0, 2)]


@pytest.mark.parametrize("name", ["hacker_extension", "repo_extension_summary", "hacker_alias_pairs", "assortativity", "word_tfidf_top20", "p2_found", "p5_found"])
def test_queries_equal_their_sql(spark, name):
    from pathlib import Path

    part = reference if name in reference.QUERIES else training
    db = duckdb.connect()
    db.execute("set TimeZone = 'UTC'")
    for f in Path(DATA).glob("*.parquet"):
        db.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    df = part.QUERIES[name](spark, DATA)
    want = db.execute(f"select {', '.join(f'"{c}"' for c in df.columns)} from ({part.ORACLES[name]})").fetchall()
    tidy = lambda rows: sorted(str([round(v, 5) if isinstance(v, float) else v for v in r]) for r in rows)
    assert tidy(df.collect()) == tidy(want)
