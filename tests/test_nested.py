import json
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataloom.operators.nested import Merkle, flat_tables, hacker_rows, hackers_of, merkle_tables, nested_links, occurrences, parse_deep, parse_document, rebuilt

DOC = {"hack_assoc_map": [{"hacker_hash": "h1", "hacker_extension_map": {"ext": "py", "cnt": 1}, "hacker_import_array": [{"lang_ext": "py", "import_map": {"name": "a"}}, {"import_map": [{"name": "b"}, {"name": None}, {}]}]}]}
VALUES = st.recursive(st.none() | st.booleans() | st.integers(-5, 5) | st.text(max_size=3), lambda kids: st.lists(kids, max_size=4) | st.dictionaries(st.text(max_size=2), kids, max_size=4), max_leaves=25)


def test_documents_are_unwrapped():
    text = json.dumps(DOC)
    for form in (text, f"﻿  {text}", f"[{text}]", json.dumps(text), json.dumps([text])):
        assert parse_document(form) == DOC
    for form in (None, "", "  ", text[:-1], "NaN", "[" * 100_000):
        assert parse_document(form) is None
    assert parse_document(f"[{text},{text}]") == [DOC, DOC]


def test_neither_wraps_nor_depth_are_bounded(spark):
    wrapped = text = json.dumps(DOC)
    for _ in range(12):
        wrapped = json.dumps([wrapped]) if len(wrapped) < 4000 else f"[{wrapped}]"
    assert parse_document(wrapped) == DOC
    deep = '{"a":' * 20_000 + text + "}" * 20_000
    value, depth = parse_document(deep), 0
    while "a" in value:
        value, depth = value["a"], depth + 1
    assert value == DOC and depth == 20_000
    below = f'{{"hack_assoc_map": {{"hacker_hash": "h", "hacker_extension_map": {{"ext": "c", "x": {"[" * 3000}{"]" * 3000}}}}}}}'
    df = spark.createDataFrame([(1, below)], "id long, doc string")
    assert {tuple(r) for r in occurrences(*flat_tables(df, "id", "doc", hackers_of, hacker_rows)).collect()} == {("hacker", 1, "", "h"), ("extension", 1, "h", "c")}


@given(VALUES)
@settings(max_examples=200, deadline=None)
def test_the_deep_parser_agrees_with_the_library(value):
    text = json.dumps(value, indent=random.choice([None, 1]))
    assert parse_deep(text) == value
    for cut in (text[:-1] if text[-1] in "]}\"" else text + "]", text + " 1", "," + text):
        with pytest.raises(ValueError):
            parse_deep(cut)


@given(VALUES)
@settings(max_examples=200, deadline=None)
def test_the_store_gives_back_every_document(value):
    tree = Merkle(value)
    back = rebuilt(tree.root, tree.nodes, {p: [tuple(x) for x in links] for p, links in tree.edges.items()})
    assert json.dumps(back, sort_keys=True) == json.dumps(value, sort_keys=True)


def test_equal_subtrees_have_one_identity():
    tree = Merkle({"x": [{"k": 1, "l": 2}, {"l": 2, "k": 1}], "y": {"l": 2, "k": 1}})
    kids = [child for *_, child in tree.edges[tree.root] if child]
    assert len(set(kids)) == 1 and len(kids) == 3 and len(tree.nodes) == 2
    distinct = [{"x": {}}, {"x": [{}]}, {"x": []}, {"x": None}, {}, {"x": [[]]}, {"x": [1, 2]}, {"x": [2, 1]}, {"x": ["1", 2]}, []]
    assert len({Merkle(d).root for d in distinct}) == len(distinct)


def test_tables_of_the_store_and_rejects(spark):
    docs = {1: {"a": [], "b": {"c": [1, [2], {}]}}, 2: {"a": {}, "b": {"c": [1, [2], {}]}}, 3: DOC}
    rows = [(i, json.dumps(d), "x") for i, d in docs.items()] + [(1, json.dumps(docs[1]), "x"), (4, "{", "x"), (5, "[1, 2]", "x"), (6, None, "x"), (7, " ", "x")]
    tables = merkle_tables(spark.createDataFrame(rows, "id long, doc string, payload string"), "id", "doc")
    nodes = {bytes(r["child"]): (r["kind"], r["payload"]) for r in tables.node.collect()}
    edges = defaultdict(list)
    for r in tables.edge.collect():
        edges[bytes(r["parent"])].append((r["field"], r["form"], r["ordinal"], bytes(r["child"]) if r["child"] else None))
    roots = [(r["rec_id"], bytes(r["root"])) for r in tables.root.collect()]
    assert sorted(i for i, _ in roots) == [1, 1, 2, 3] and all(rebuilt(root, nodes, edges) == docs[i] for i, root in roots)
    assert sorted(map(tuple, tables.reject.collect())) == [(4, "incomplete JSON"), (5, "no object"), (7, "no object")]


def test_links_of_documents(spark):
    rows = [(1, json.dumps(DOC), "x"), (1, json.dumps(DOC), "x"), (2, f"[{json.dumps(DOC)}]", "x"), (3, "{", "x"), (4, None, "x"), (None, json.dumps(DOC), "x")]
    bridge, flat = flat_tables(spark.createDataFrame(rows, "id long, doc string, payload string"), "id", "doc", hackers_of, hacker_rows)
    assert bridge.count() == 4 and flat.count() == 1
    found = occurrences(bridge, flat)
    want = {(k, i, p, c) for i in (1, 2, None) for k, p, c in (("hacker", "", "h1"), ("extension", "h1", "py"), ("import", "h1/py", "a"), ("import", "h1/", "b"))}
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)


def test_blame_and_empty_tables(spark):
    schema = "blame_id long, authors array<struct<author string, author_hash_map map<string,struct<epoch bigint>>, commit_hash_map map<string,struct<epoch bigint>>>>"
    rows = [(7, [("a", {"h": (1,), "g": None}, None), ("a", {"h": (1,)}, {"h": (1,)})]), (8, []), (9, None)]
    empty = spark.createDataFrame([], "id long, stats_json string")
    got = sorted(tuple(r) for r in nested_links(empty, spark.createDataFrame(rows, schema)).collect())
    assert got == [("blame_author", 7, "a", "g"), ("blame_author", 7, "a", "h"), ("blame_commit", 7, "a", "h")]
    assert nested_links(empty, spark.createDataFrame([], schema)).isEmpty()
