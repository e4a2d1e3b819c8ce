"""Filling containers of fixed capacity with items of varying length (problem 9).

Items are dealt by a hash into groups that hold a bounded number of containers and items each, so that every group is
packed on its own in one task and only its last containers stay open. Within a group each container takes the largest
remaining item and then the multiset of remaining lengths that leaves the least slack: a subset-sum table over a window
of lengths, kept as one bitset per stage, whose highest bit within the room left is traced back to counts per length.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.bpe import slices, tokenizer
from strataloom.session import checkpointed, spread, tokenizer_dir

#: Distinct lengths in the window of one container.
WINDOW = 48
#: A group holds about so many containers and at most about so many items.
GROUP_CONTAINERS, GROUP_ITEMS = 400, 20_000


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """``id_col`` and ``n_tokens`` of the whole text of each row; null and empty texts have 0."""
    where = tokenizer_dir(folder)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(where, name)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = [len(ids) for a, b in slices(texts) for ids in own.encode(texts[a:b])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=[id_col, "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return spread(docs.select(id_col, F.col(text_col).cast("string").alias("text"))).mapInArrow(count, f"`{id_col}` {kind}, n_tokens bigint")


def best_fill(lengths: list[int], counts: list[int], room: int) -> tuple[list[int], int]:
    """Counts per length, at most ``counts``, whose sum comes closest to ``room`` from below; and the slack left.

    Each stage of the table takes 1, 2, 4, ... copies of a length; a stage's bitset has bit s set if the sum s can be
    reached. It stops as soon as ``room`` itself can be.
    """
    stages: list[tuple[int, int, int]] = []
    bits, full, done = 1, (1 << (room + 1)) - 1, False
    for at, (length, count) in enumerate(zip(lengths, counts)):
        left, copies = min(count, room // length), 1
        while left > 0 and not done:
            take = min(copies, left)
            stages.append((at, take, bits))
            bits = (bits | bits << (length * take)) & full
            left -= take
            copies *= 2
            done = bool(bits >> room & 1)
        if done:
            break
    total = bits.bit_length() - 1
    slack, chosen = room - total, [0] * len(lengths)
    for at, take, before in reversed(stages):
        if not before >> total & 1:
            chosen[at] += take
            total -= take * lengths[at]
    return chosen, slack


def pack(sizes: list[int], capacity: int, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Containers as lists of (item, first token, tokens). Every item of at most ``capacity`` is in one piece; a larger
    one fills whole containers and its remainder is packed as an item. Items of size 0 lie in the first container."""
    containers: list[list[tuple[int, int, int]]] = []
    by_length: dict[int, list[tuple[int, int, int]]] = {}
    empty = []
    for item, size in enumerate(sizes):
        start = 0
        while size - start > capacity:
            containers.append([(item, start, capacity)])
            start += capacity
        if size:
            by_length.setdefault(size - start, []).append((item, start, size - start))
        else:
            empty.append((item, 0, 0))
    order = sorted(by_length)
    while order:
        largest = order[-1]
        content = [by_length[largest].pop()]
        if not by_length[largest]:
            order.pop()
        room = capacity - largest
        fitting = order[: bisect.bisect_right(order, room)]
        if fitting:
            step = max(1, len(fitting) / window)
            picked = fitting if step == 1 else sorted({fitting[int(i * step)] for i in range(window)} | {fitting[-1]})
            picked.reverse()
            chosen, _ = best_fill(picked, [len(by_length[x]) for x in picked], room)
            for length, n in zip(picked, chosen):
                for _ in range(n):
                    content.append(by_length[length].pop())
                if n and not by_length[length]:
                    del order[bisect.bisect_left(order, length)]
        containers.append(content)
    if empty:
        if not containers:
            containers.append([])
        containers[0].extend(empty)
    return containers


def packed(sizes: DataFrame, kinds: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", most_kinds: int = 1000) -> DataFrame:
    """Every item in containers of every kind: container_kind, container_id, ``id_col``, piece_no, first_token, n_tokens.

    ``kinds`` (container_kind, capacity_tokens) is a parameter table of at most ``most_kinds`` rows; kinds without
    positive capacity are left out, repeats count once. A null size counts as 0. An item larger than the capacity is cut
    into pieces of it, numbered from 0; no other item is. Ids may be null or repeated: every row of ``sizes`` is packed.
    Items that tie in size are exchangeable. No items give no rows.
    """
    rows = kinds.select("container_kind", F.col("capacity_tokens").cast("bigint").alias("capacity")).where("capacity > 0").distinct().limit(most_kinds + 1).collect()
    if len(rows) > most_kinds:
        raise ValueError(f"more than {most_kinds} kinds of containers")
    items = checkpointed(sizes.select(F.col(id_col).alias("item"), F.coalesce(F.col(size_col), F.lit(0)).cast("bigint").alias("size")).withColumn("deal", F.xxhash64("item", F.monotonically_increasing_id())))
    number, total = items.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    options = [(r["container_kind"], r["capacity"], max(1, -(-total // (r["capacity"] * GROUP_CONTAINERS)), -(-number // GROUP_ITEMS))) for r in rows]
    table = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).cast("bigint").alias("capacity"), F.lit(g).cast("bigint").alias("groups")) for k, c, g in options]) if options else F.expr("cast(array() as array<struct<kind string, capacity bigint, groups bigint>>)")
    dealt = items.withColumn("o", F.explode(table)).select(F.col("o.kind").alias("container_kind"), F.col("o.capacity").alias("capacity"), F.pmod("deal", F.col("o.groups")).alias("part"), "item", "size")
    kind = sizes.schema[id_col].dataType.simpleString()

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        name, capacity, part = group["container_kind"].iloc[0], int(group["capacity"].iloc[0]), group["part"].iloc[0]
        group = group.sort_values(["size", "item"], kind="stable")
        out = [(item, f"{part}-{number}", start // capacity, start, size) for number, content in enumerate(pack(group["size"].tolist(), capacity)) for item, start, size in content]
        index, ids, pieces, starts, lengths = zip(*out)
        return pd.DataFrame({"container_kind": name, "container_id": ids, "item": group["item"].iloc[list(index)].to_numpy(), "piece_no": pieces, "first_token": starts, "n_tokens": lengths})

    schema = f"container_kind string, container_id string, item {kind}, piece_no int, first_token bigint, n_tokens bigint"
    return dealt.groupBy("container_kind", "capacity", "part").applyInPandas(fill, schema).withColumnRenamed("item", id_col)


def fill_report(contents: DataFrame, kinds: DataFrame) -> DataFrame:
    """Per kind: containers, tokens and the share of capacity in use."""
    used = contents.groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("used")).groupBy("container_kind").agg(F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"))
    return used.join(kinds.select("container_kind", "capacity_tokens").distinct(), "container_kind").select("container_kind", "n_containers", "n_tokens", (F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("fill"))


def packing_faults(contents: DataFrame, sizes: DataFrame, kinds: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens") -> DataFrame:
    """Per kind what must hold: n_items packed, and of those the ones whose pieces don't add up, that are split needlessly or
    that have wrongly placed pieces, and the containers above their capacity. Items need distinct ids."""
    capacity = kinds.select("container_kind", "capacity_tokens").distinct()
    by_item = contents.join(capacity, "container_kind").groupBy("container_kind", "capacity_tokens", id_col).agg(
        F.sum("n_tokens").alias("packed"), F.count("*").alias("pieces"), F.count_if(F.col("first_token") != F.col("piece_no") * F.col("capacity_tokens")).alias("misplaced")
    )
    held = by_item.join(sizes.select(id_col, F.coalesce(size_col, F.lit(0)).alias("size")), id_col)
    items = held.groupBy("container_kind").agg(
        F.count("*").alias("n_items"), F.count_if(F.col("packed") != F.col("size")).alias("wrong_sums"), F.count_if((F.col("pieces") > 1) & (F.col("size") <= F.col("capacity_tokens"))).alias("needless_splits"), F.count_if(F.col("misplaced") > 0).alias("misplaced")
    )
    used = contents.join(capacity, "container_kind").groupBy("container_kind", "container_id", "capacity_tokens").agg(F.sum("n_tokens").alias("used"))
    return items.join(used.groupBy("container_kind").agg(F.count_if(F.col("used") > F.col("capacity_tokens")).alias("overfull")), "container_kind")
