"""Deeply nested records as related flat tables (problem 1).

Every JSON object and array of a record is canonicalised (keys sorted, scalars in one spelling) and hashed bottom-up,
so that equal subtrees have equal identities wherever they occur. The store has four tables:

* ``root``: one row per record occurrence, record id -> identity of its document;
* ``node``: one row per distinct object or array element, its kind and its scalar fields as a JSON payload;
* ``edge``: per distinct node, its fields that hold objects or arrays: a row ``object`` per object, a row ``array`` with
  the length per array, and a row ``item`` per element with its ordinal;
* ``reject``: one row per text that is no document, with the reason.

As an identity fixes the whole subtree below it, a subtree is stored once and still gives back every occurrence from the
roots, whole and in order (``rebuilt``). Flat tables of parent and child keys are stored alike: the rows of a subtree that
stands for an entity, such as a hacker, once per distinct subtree, and the occurrences of that subtree as bridge rows of
record, ordinal and identity (``flat_tables``).
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.session import checkpointed, spread

_STORE = "part string, rec_id bigint, parent binary, field string, form string, ordinal int, child binary, payload string"
_FLAT = "rec_id bigint, ordinals array<int>, entities array<binary>, entity binary, links array<struct<link_kind:string,parent_key:string,child_key:string>>"
#: Local duplicates are dropped before the shuffle through a set that is emptied beyond this size.
_SEEN_LIMIT = 200_000
_BLANKS = "﻿ \t\r\n\x0b\x0c\xa0"
_TOKEN = re.compile(r'[ \t\r\n]*(?:([\[\]{},:])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null))', re.S)


def _reject(constant: str):
    raise ValueError(f"{constant} is not JSON")


def parse_deep(text: str):
    """The JSON value of a text of any depth, by a stack of its own; ValueError if the text isn't one complete value."""
    holders: list = []
    keys: list = []
    value, at, expect = None, 0, "value"
    end = len(text.rstrip(" \t\r\n"))
    while True:
        token = _TOKEN.match(text, at)
        if token is None:
            raise ValueError("incomplete")
        at = token.end()
        mark, string, scalar = token.groups()
        done = False
        if expect in ("value", "value or end") and mark in ("{", "["):
            holders.append({} if mark == "{" else [])
            keys.append(None)
            expect = "key or end" if mark == "{" else "value or end"
        elif expect in ("value", "value or end") and mark is None:
            value, done = json.loads(string if string is not None else scalar), True
        elif expect in ("key", "key or end") and string is not None:
            keys[-1], expect = json.loads(string), ":"
        elif expect == ":" and mark == ":":
            expect = "value"
        elif expect == "next" and mark == ",":
            expect = "key" if isinstance(holders[-1], dict) else "value"
        elif holders and expect in ("next", "key or end", "value or end") and mark == ("}" if isinstance(holders[-1], dict) else "]"):
            value, done = holders.pop(), True
            keys.pop()
        else:
            raise ValueError("incomplete")
        if done:
            if not holders:
                if at < end:
                    raise ValueError("more than one value")
                return value
            if isinstance(holders[-1], dict):
                holders[-1][keys[-1]] = value
            else:
                holders[-1].append(value)
            expect = "next"


def parse_document(text: str | None):
    """The document in a text, or None.

    Leading byte-order marks and blanks are skipped, a list of one element and a JSON string are unwrapped, in any order and
    as often as they are wrapped. Text that is not one complete JSON value gives None. Neither depth nor wrapping is bounded.
    """
    while isinstance(text, str):
        text = text.lstrip(_BLANKS)
        try:
            value = json.loads(text, parse_constant=_reject)
        except RecursionError:
            try:
                value = parse_deep(text)
            except ValueError:
                return None
        except ValueError:
            return None
        while isinstance(value, list) and len(value) == 1:
            value = value[0]
        if not isinstance(value, str):
            return value
        text = value
    return None


#: JSON spelling of a scalar; the encoder is made once.
_scalar = json.JSONEncoder(ensure_ascii=False).encode


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


class Merkle:
    """Identities of the subtrees of one document, by the ``id`` of the parsed object or array, and, with ``store``, its
    nodes (identity, kind, payload) and edges (parent, field, form, ordinal, child).

    The walk keeps its own stack, so that depth isn't limited. An object's scalar fields are its payload; objects and
    arrays in its fields are edges. A scalar in an array is a node of its own; an array in an array, and a document that is
    one, is a node whose elements hang on the field ''.
    """

    def __init__(self, document, store: bool = True):
        self.of: dict[int, bytes] = {}
        self.nodes: dict[bytes, tuple[str, str]] = {}
        self.edges: dict[bytes, list[tuple[str, str, int, bytes | None]]] = {}
        self.store = store
        stack, order = [document], []
        while stack:
            value = stack.pop()
            order.append(value)
            for kid in value.values() if isinstance(value, dict) else (value,) if isinstance(value, list) else ():
                if isinstance(kid, dict):
                    stack.append(kid)
                elif isinstance(kid, list):
                    stack.extend(x for x in kid if isinstance(x, (dict, list)))
        for value in reversed(order):
            self._close(value)
        self.root = self.of[id(document)]

    def _close(self, value) -> None:
        if not isinstance(value, (dict, list)):
            self.of[id(value)] = own = _digest("s" + _scalar(value))
            self.nodes[own] = ("scalar", _scalar(value))
            return
        fields = sorted(value.items()) if isinstance(value, dict) else [("", value)]
        payload, parts, links = {}, [], []
        for name, field in fields:
            if isinstance(field, dict):
                kid = self.of[id(field)]
                if self.store:
                    links.append((name, "object", 0, kid))
                parts.append(f"{_scalar(name)}:o{kid.hex()}")
            elif isinstance(field, list):
                kids = []
                for x in field:
                    if isinstance(x, (dict, list)):
                        kids.append(self.of[id(x)])
                    else:
                        kids.append(_digest("s" + _scalar(x)))
                        if self.store:
                            self.nodes[kids[-1]] = ("scalar", _scalar(x))
                if self.store:
                    links.append((name, "array", len(kids), None))
                    links.extend((name, "item", i, kid) for i, kid in enumerate(kids))
                parts.append(f"{_scalar(name)}:a{','.join(k.hex() for k in kids)}")
            else:
                payload[name] = field
                parts.append(f"{_scalar(name)}:s{_scalar(field)}")
        kind = "object" if isinstance(value, dict) else "array"
        self.of[id(value)] = own = _digest(("{" if kind == "object" else "[") + ";".join(parts))
        if self.store:
            self.nodes[own] = (kind, _scalar(payload))
            self.edges[own] = links


def _documents(batch: pd.DataFrame) -> Iterator[tuple[int | None, object, str | None]]:
    """Record id, document and, where there is none, the reason; null texts come out as neither."""
    for rec_id, text in zip(batch["rec_id"], batch["doc"]):
        rec_id = None if pd.isna(rec_id) else int(rec_id)
        document = parse_document(text)
        reason = None if isinstance(document, dict) or not isinstance(text, str) else "incomplete JSON" if document is None and text.strip(_BLANKS) not in ("", "null") else "no object"
        yield rec_id, document if isinstance(document, dict) else None, reason


def _decompose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: set[bytes] = set()
    for batch in batches:
        rows = []
        for rec_id, document, reason in _documents(batch):
            if document is None:
                if reason:
                    rows.append(("reject", rec_id, None, None, None, None, None, reason))
                continue
            tree = Merkle(document)
            rows.append(("root", rec_id, None, None, None, None, tree.root, None))
            for identity, (kind, payload) in tree.nodes.items():
                if identity not in seen:
                    seen.add(identity)
                    rows.append(("node", None, None, None, kind, None, identity, payload))
                    rows.extend(("edge", None, identity, *link, None) for link in tree.edges.get(identity, ()))
            if len(seen) > _SEEN_LIMIT:
                seen.clear()
        out = pd.DataFrame(rows, columns=["part", "rec_id", "parent", "field", "form", "ordinal", "child", "payload"])
        yield out.astype({"rec_id": "Int64", "ordinal": "Int32"})


@dataclass
class MerkleTables:
    """The tables of the store; ``root`` keeps every occurrence, ``node`` and ``edge`` hold distinct rows."""

    root: DataFrame
    node: DataFrame
    edge: DataFrame
    reject: DataFrame


def _source(records: DataFrame, id_col: str, json_col: str) -> DataFrame:
    return records.select(F.col(id_col).cast("bigint").alias("rec_id"), F.col(json_col).cast("string").alias("doc"))


def merkle_tables(records: DataFrame, id_col: str, json_col: str) -> MerkleTables:
    """Decomposes the JSON documents in ``json_col`` into root, node, edge and reject tables.

    Null texts give no rows; empty texts, incomplete JSON and documents that are not an object are rejects. A null id is
    kept. Repeated records give repeated root rows but share all nodes. A key that an object has twice counts with its last
    value. Other columns of ``records``, whatever their names, aren't read. An empty table gives empty tables. Node and
    edge rows are made distinct by one aggregation each, whose map side has already dropped local repeats, so a subtree
    that a third of all records share costs one row per task.
    """
    rows = checkpointed(spread(_source(records, id_col, json_col)).mapInPandas(_decompose, _STORE))
    return MerkleTables(
        root=rows.where("part = 'root'").select("rec_id", F.col("child").alias("root")),
        node=rows.where("part = 'node'").groupBy("child").agg(F.first("form").alias("kind"), F.first("payload").alias("payload")),
        edge=rows.where("part = 'edge'").select("parent", "field", "form", "ordinal", "child").distinct(),
        reject=rows.where("part = 'reject'").select("rec_id", F.col("payload").alias("reason")),
    )


def rebuilt(root: bytes, nodes: dict[bytes, tuple[str, str]], edges: dict[bytes, list[tuple[str, str, int, bytes | None]]]):
    """The document of an identity out of node rows (identity -> kind, payload) and edge rows (parent -> field, form,
    ordinal, child) that hold its subtree; the proof that the store loses nothing."""
    built: dict[bytes, object] = {}
    stack = [root]
    while stack:
        own = stack[-1]
        kids = [k for *_, k in edges.get(own, ()) if k is not None and k not in built]
        if own not in built and kids:
            stack.extend(kids)
            continue
        stack.pop()
        if own in built:
            continue
        kind, payload = nodes[own]
        value = json.loads(payload)
        for field, form, ordinal, child in sorted(edges.get(own, ()), key=lambda e: (e[0], e[1] != "array", e[2])):
            if form == "object":
                value[field] = built[child]
            elif form == "array":
                value[field] = []
            else:
                value[field].append(built[child])
        built[own] = value.get("", []) if kind == "array" else value
    return built[root]


def flat_tables(records: DataFrame, id_col: str, json_col: str, entities: Callable, links: Callable) -> tuple[DataFrame, DataFrame]:
    """Bridge and flat rows of the entities in documents.

    ``entities(document)`` gives the objects that stand for entities, in order; ``links(entity)`` the rows (link_kind,
    parent_key, child_key) below one. The bridge has one row per record with the ordinals and Merkle identities of its entities
    (rec_id, ordinals, entities); the flat table one row per distinct entity (entity, links), however often it occurs.
    Nulls and defective documents are as in ``merkle_tables``.
    """

    def decompose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        for batch in batches:
            rows = []
            for rec_id, document, _ in _documents(batch):
                if document is None:
                    continue
                own = entities(document)
                if not own:
                    continue
                identities = [Merkle(entity, store=False).root for entity in own]
                rows.append((rec_id, list(range(len(own))), identities, None, None))
                for identity, entity in zip(identities, own):
                    if identity not in seen:
                        seen.add(identity)
                        rows.append((None, None, None, identity, [*dict.fromkeys(links(entity))]))
                if len(seen) > _SEEN_LIMIT:
                    seen.clear()
            yield pd.DataFrame(rows, columns=["rec_id", "ordinals", "entities", "entity", "links"]).astype({"rec_id": "Int64"})

    rows = checkpointed(spread(_source(records, id_col, json_col)).mapInPandas(decompose, _FLAT))
    return rows.where("entities is not null").select("rec_id", "ordinals", "entities"), rows.where("entity is not null").groupBy("entity").agg(F.first("links").alias("links"))


def occurrences(bridge: DataFrame, flat: DataFrame) -> DataFrame:
    """Every flat row of every record: link_kind, rec_id, parent_key, child_key, each once."""
    met = bridge.select("rec_id", F.explode(F.array_distinct("entities")).alias("entity")).distinct()
    return met.join(flat, "entity").select("rec_id", F.explode("links").alias("x")).select("x.link_kind", "rec_id", "x.parent_key", "x.child_key").distinct()


def _objects(value) -> list[dict]:
    """The objects of a field: a single object stands for a list of one."""
    return [x for x in (value if isinstance(value, list) else [value]) if isinstance(x, dict)]


def _key(value) -> str | None:
    """A key as text: strings as they are, other scalars in their JSON spelling, null and containers None."""
    return value if isinstance(value, str) or value is None else None if isinstance(value, (dict, list)) else _scalar(value)


def hackers_of(document: dict) -> list[dict]:
    return _objects(document.get("hack_assoc_map"))


def hacker_rows(hacker: dict) -> Iterator[tuple[str, str, str]]:
    """Rows of one hacker: itself, its extensions and imports. A child without its key field (hacker_hash, ext, name) gives
    no row; children of a hacker without hash have the parent key ''."""
    own = _key(hacker.get("hacker_hash"))
    if own is not None:
        yield "hacker", "", own
    own = own or ""
    for x in _objects(hacker.get("hacker_extension_map")):
        if (ext := _key(x.get("ext"))) is not None:
            yield "extension", own, ext
    for array in _objects(hacker.get("hacker_import_array")):
        lang = _key(array.get("lang_ext")) or ""
        for x in _objects(array.get("import_map")):
            if (name := _key(x.get("name"))) is not None:
                yield "import", f"{own}/{lang}", name


def authors_of(document: dict) -> list[dict]:
    return _objects(document.get("authors"))


def author_rows(author: dict) -> Iterator[tuple[str, str, str]]:
    """Hashes under one author of a blame record, whether their value is an object, a scalar or null. An author without
    name has the parent key ''."""
    name = _key(author.get("author")) or ""
    for kind, field in (("blame_author", "author_hash_map"), ("blame_commit", "commit_hash_map")):
        for x in _objects(author.get(field)):
            for hash_ in x:
                yield kind, name, hash_


def nested_links(performance: DataFrame, blame: DataFrame) -> DataFrame:
    """All children of problem 1, those of ``performance.stats_json`` and those of ``blame.authors``: link_kind, rec_id,
    parent_key, child_key, each once."""
    as_json = F.to_json(F.struct("authors"), {"ignoreNullFields": "false"})
    hackers = occurrences(*flat_tables(performance, "id", "stats_json", hackers_of, hacker_rows))
    authors = occurrences(*flat_tables(blame.select("blame_id", as_json.alias("doc")), "blame_id", "doc", authors_of, author_rows))
    return hackers.unionByName(authors)


def store_summary(tables: MerkleTables) -> DataFrame:
    """How often each field's children occur in distinct parents and how many distinct children there are."""
    children = tables.edge.where("child is not null")
    return children.groupBy("field").agg(F.count("*").alias("stored_edges"), F.countDistinct("child").alias("distinct_children"))
