from datetime import datetime as t

import pytest

from strataloom.operators import rollups
from strataloom.sources import logs, tables


def test_readers(spark, tmp_path):
    (tmp_path / "c.csv").write_text('Id,Signed,Description\n1,2020-01-02,"a, b"\n2,never,x\n')
    rows = tables.contracts(spark, str(tmp_path / "c.csv"), {"id": "Id", "signed": "Signed", "description": "Description"}, ["signed"]).orderBy("id").collect()
    assert rows[0]["signed"] == t(2020, 1, 2) and rows[1]["signed"] is None and rows[0]["description"] == "a, b"
    tables.label_template(spark.createDataFrame([("c1", 3)], "commit_id string, cluster int"), str(tmp_path / "l"))
    assert tuple(tables.labels(spark, str(tmp_path / "l")).first()) == ("c1", None, 3)
    lines = spark.createDataFrame([("s", "files 3"), ("s", "locs 40"), ("s", "odd line here")], "source string, value string")
    assert tuple(tables.name_value_stats(lines, ["files", "locs", "none"]).first()) == ("s", 3, 40, None)
    book = spark.createDataFrame([("1 Kings 2:3\tAnd so",), ("no verse",)], "value string")
    assert [tuple(r) for r in tables.verses(book).collect()] == [("1 Kings", 2, 3, "And so")]


def test_repo_info(spark):
    docs = [('{"id": 1, "name": "r", "owner": {"login": "o"}, "license": null, "created_at": "2020-01-02T03:04:05Z", "pushed_at": "x"}',), ('{"watchers": 3}',), ("[",), (None,)]
    rows = tables.repo_info(spark.createDataFrame(docs, "value string")).collect()
    assert len(rows) == 1 and rows[0]["owner"] == "o" and rows[0]["license_key"] is None and rows[0]["created_at"] == t(2020, 1, 2, 3, 4, 5) and rows[0]["pushed_at"] is None


def test_file_stats(spark, tmp_path):
    (tmp_path / "a.rs").write_text("x\ny\n")
    (tmp_path / "b.bin").write_bytes(b"\x00\x01\x02")
    row = tables.file_stats(spark.read.format("binaryFile").load(str(tmp_path)), {"rust": [".rs"]}).first()
    assert (row["num_files"], row["num_locs"], row["num_binary_files"], row["num_binary_bytes"], row["num_rust_files"], row["num_rust_locs"]) == (2, 2, 1, 3, 1, 2)


def test_rollups(spark):
    commits = spark.createDataFrame([("a", f"c{i:02}", t(2020, 1, 1 + i), 2) for i in range(12)], "author string, commit_id string, date timestamp, n_files long")
    row = rollups.author_rollup(commits).first()
    assert (row["commit_count"], row["file_count"], row["first_commit"], row["last_commit"]) == (12, 24, "c00", "c11") and row["latest_commits"][:2] == ["c11", "c10"] and len(row["latest_commits"]) == 10
    weeks = spark.createDataFrame([("x", [(1, 5, 9, 1), (2, 9, 5, 2), (3, 0, 0, 0)]), ("y", [])], "login string, weeks array<struct<w long, a long, d long, c long>>")
    assert [tuple(r) for r in rollups.contributor_weeks(weeks).collect()] == [("x", 4, 3, 1, 2)]
    parts = [rollups.job_slice(commits, "commit_id", "c03", "c09", i, 3).count() for i in range(3)]
    assert sum(parts) == 7
    flags = rollups.with_jobs(spark.createDataFrame([(5,)], "f int"), "f", {"one": 1, "two": 2, "four": 4}).first()
    assert (flags["one"], flags["two"], flags["four"]) == (True, False, True)


@pytest.mark.parametrize("line,want", [(" src/a.py | 10 ++++-", ("src/a.py", 8, 2, 0)), (" i.png | Bin 10 -> 20 bytes", ("i.png", 0, 0, 20)), (" e | 0", ("e", 0, 0, 0)), (" 3 files changed", None), ("", None)])
def test_stat_lines(line, want):
    assert logs.parse_stat_line(line) == want
