"""Results that must hold the whole job, not a part of it."""

from pathlib import Path

import duckdb
import pytest

from strataloom.plans import reference, training

DATA = "/root/testdata/sf0.001"


def compared(spark, part, name):
    db = duckdb.connect()
    db.execute("set TimeZone = 'UTC'")
    for f in Path(DATA).glob("*.parquet"):
        db.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    df = part.QUERIES[name](spark, DATA)
    want = db.execute(f"select {', '.join(f'"{c}"' for c in df.columns)} from ({part.ORACLES[name]})").fetchall()
    tidy = lambda rows: sorted(str([round(v, 5) if isinstance(v, float) else v for v in r]) for r in rows)
    rows = df.collect()
    assert tidy(rows) == tidy(want)
    return rows


@pytest.mark.parametrize("name", ["p5_totals_all", "p5_running_all"])
def test_heavy_key_queries_have_every_row(spark, name):
    rows = compared(spark, training, name)
    got = sum(r["n_rows"] for r in rows if r["table_name"] == "git_commit") if name == "p5_totals_all" else sum(r["last_seq"] for r in rows)
    assert got == spark.read.parquet(f"{DATA}/git_commit.parquet").count()
    if name == "p5_totals_all":
        assert {r["table_name"] for r in rows} == {t for t, *_ in training.HEAVY}


def test_types_beyond_the_list(spark):
    assert {r["type"] for r in compared(spark, reference, "type_matrix_all")} - set(reference.TYPES)
    pairs = compared(spark, reference, "type_correlation_all")
    assert {t for r in pairs for t in (r["left_type"], r["right_type"])} - set(reference.TYPES)


def test_imports_of_every_language(spark, tmp_path):
    from tests.test_reference import SOURCES

    spark.createDataFrame([(i, source) for i, (source, _) in enumerate(SOURCES.values())], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["language"], r["dependency"]) for r in reference.import_scan_all(spark, str(tmp_path)).collect()}
    assert {(language, name) for language, (_, names) in SOURCES.items() for name in names} <= got


@pytest.mark.parametrize("shared", [0, 1, 2])
def test_density_of_networks_without_edges(spark, tmp_path, shared):
    # two users share so many bounties, so that the networks of a greater weight are empty
    rows = [(n, user, "R", "F") for n in range(shared) for user in (1, 2)] + [(10, 1, "A", "O"), (11, 2, "A", "O")]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_returnflag string, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    db = duckdb.connect()
    db.execute(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    for name in ("density_by_weight", "graph_density"):
        got = sorted(str(tuple(r)) for r in reference.QUERIES[name](spark, str(tmp_path)).collect())
        assert got == sorted(map(str, db.execute(reference.ORACLES[name]).fetchall()))


def test_density_of_one_node(spark):
    edges = spark.createDataFrame([(1, 1, 2)], "left_id long, right_id long, weight long")
    assert tuple(reference.graph.density(edges).first()) == (1, 1, float("inf"))
