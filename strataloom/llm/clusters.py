"""Clusters of mutually similar records by hierarchical density clustering (problem 4).

Records are vectors of counts per type; their distance is the largest relative difference of a count, infinite between
different sets of types. Only distances up to ``reach`` matter. Equal vectors are one point. Points meet in cells of a
logarithmic grid that is just as wide as ``reach``, each pair in exactly one cell, dense cells cut into pairs of blocks; a
cell's pairs are tested in numpy and only their minimum spanning forest leaves the task. A distributed Boruvka run over these
forests gives the minimum spanning forest of the mutual-reachability graph. Its edges in the order of their own weights are the
hierarchy, which is condensed by size, and the clusters with the greatest stability are selected, their most persistent
members being the exemplars.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataloom.operators.orphans import salted_join
from strataloom.session import checkpointed, parallelism

#: Sets of types with more points than this are cut into grid cells; pairs tested at once in a cell; points of a cell from
#: which on it is cut into blocks; edges of a component up to which one task builds its hierarchy; points of a cell up to
#: which all its pairs are tested.
GRID_FROM, CHUNK, CELL_POINTS, TASK_EDGES, SMALL_CELL = 1500, 1 << 20, 20_000, 1_000_000, 64
COUNTS = ("inserts", "deletes", "textlinecount")


def count_vectors(log: DataFrame, id_col: str = "log_id", map_col: str = "filetypes", counts: Sequence[str] = COUNTS) -> DataFrame:
    """Distinct rec_id, types and vec (the counts of each type, types in order) of each record.

    Types are compared without case and one leading dot; spellings of one type in a record are added up. Null and
    negative counts are 0; a type with no count is absent. A record without any type, a null map or a null id has
    nothing to be compared and gives no row.
    """
    fields = ", ".join(f"greatest(coalesce(x.value.{c}, 0L), 0L) as {c}" for c in counts)
    rows = log.select(F.col(id_col).cast("bigint").alias("rec_id"), F.expr(f"transform(map_entries({map_col}), x -> named_struct('type', regexp_replace(lower(x.key), '^[.]', ''), 'n', struct({fields})))").alias("e")).where("rec_id is not null and e is not null")
    rows = rows.withColumn("types", F.expr("array_sort(array_distinct(transform(e, x -> x.type)))"))
    sums = ", ".join(f"aggregate(filter(e, x -> x.type = t), 0L, (a, x) -> a + x.n.{c})" for c in counts)
    rows = rows.withColumn("v", F.expr(f"filter(transform(types, t -> struct(t as type, array({sums}) as n)), y -> exists(y.n, z -> z <> 0))")).where("size(v) > 0")
    return rows.select("rec_id", F.expr("array_join(transform(v, y -> y.type), '/')").alias("types"), F.expr("flatten(transform(v, y -> y.n))").alias("vec")).distinct()


def _cell_width(reach: float) -> float:
    return -math.log(1 - reach) * (1 + 1e-9)


def relative_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Largest relative difference over the counts, row by row."""
    top = np.maximum(a, b)
    return (np.abs(a - b) / np.maximum(top, 1)).max(axis=1)


def within(a: np.ndarray, b: np.ndarray, reach_tenths: int, scale: int) -> np.ndarray:
    """Whether every count differs by at most reach_tenths/scale of the larger, in whole numbers."""
    return (np.abs(a - b) * scale <= np.maximum(a, b) * reach_tenths).all(axis=1)


def spanning_forest(n: int, left: np.ndarray, right: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Indices of a minimum spanning forest's edges by Boruvka's rounds in numpy; ties go by the edge's index."""
    order = np.argsort(weight, kind="stable")
    label, alive, kept = np.arange(n), order, []
    while len(alive):
        a, b = label[left[alive]], label[right[alive]]
        apart = a != b
        alive, a, b = alive[apart], a[apart], b[apart]
        if not len(alive):
            break
        rank = np.arange(len(alive))
        best = np.full(n, len(alive))
        np.minimum.at(best, a, rank)
        np.minimum.at(best, b, rank)
        chosen = np.unique(best[best < len(alive)])
        kept.append(alive[chosen])
        parent = np.arange(n)
        heads = np.nonzero(best < len(alive))[0]
        parent[heads] = np.where(a[best[heads]] == heads, b[best[heads]], a[best[heads]])
        two = parent[parent[heads]] == heads
        parent[heads[two]] = np.minimum(heads[two], parent[heads[two]])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        label = parent[label]
    return np.concatenate(kept) if kept else np.zeros(0, dtype=np.int64)


def _close_pairs(vec: np.ndarray, reach: float, scale: int):
    """Chunks of index pairs of rows within reach: a sweep along the coordinate with the most distinct values."""
    tenths = round(reach * scale)
    spread = max(range(vec.shape[1]), key=lambda k: len(np.unique(vec[:, k])))
    order = np.argsort(vec[:, spread], kind="stable")
    value = vec[order, spread]
    last = np.searchsorted(value, np.floor(value * scale / (scale - tenths) + 1e-9), side="right")
    start = 0
    while start < len(order):
        span = np.cumsum(last[start:] - np.arange(start, len(order)) - 1)
        stop = start + max(1, int(np.searchsorted(span, CHUNK, side="right")))
        width = last[start:stop] - np.arange(start, stop) - 1
        i = np.repeat(np.arange(start, stop), width)
        j = np.arange(len(i)) - np.repeat(np.cumsum(width) - width, width) + i + 1
        a, b = order[i], order[j]
        close = within(vec[a], vec[b], tenths, scale)
        yield a[close], b[close]
        start = stop


def _cells(points: DataFrame, reach: float) -> DataFrame:
    """Points with the cells they are compared in: types, meet (the cell's hash), part (the task), behind, side, point, vec.

    A set of types with few points is one cell. Others use the logarithms of up to four counts; a point visits its own
    cell and the next higher one in each of these, so that a close pair meets where both have the maximum, exactly once;
    ``behind`` is -1 for each count in which the cell is not the point's own. A cell of more than ``CELL_POINTS`` points is
    cut into blocks, and its points meet once for each pair of blocks: ``side`` is the point's block where two blocks meet,
    and only points of different sides are compared there; it is -1 where all are. Cells are dealt to parts of some ten
    thousand rows by their hash, so that no task is set up for a single small cell.
    """
    width = _cell_width(reach)
    crowded = points.groupBy("types").count().where(F.col("count") > GRID_FROM).select("types", F.lit(True).alias("crowded"))
    rows = salted_join(points, crowded, "types")
    log_cell = f"transform(slice(if(size(vec) > 3, array(vec[0], vec[1], vec[3], vec[4]), vec), 1, 4), v -> if(v = 0, -1000, cast(floor(ln(v) / {width!r}) as int)))"
    rows = rows.withColumn("own", F.when(F.col("crowded"), F.expr(log_cell)).otherwise(F.expr("cast(array() as array<int>)")))
    bits = "transform(own, (c, i) -> cast(shiftright(m, i) & 1 as int))"
    visits = f"transform(sequence(0, cast(shiftleft(1, size(own)) as int) - 1), m -> struct(xxhash64(types, zip_with(own, {bits}, (c, x) -> c + x)) as meet, transform({bits}, x -> -x) as behind))"
    rows = checkpointed(rows.withColumn("visit", F.explode(F.expr(visits))).select("types", "visit.meet", "visit.behind", "point", "vec"))
    dense = rows.groupBy("types", "meet").count().where(F.col("count") > CELL_POINTS).select("types", "meet", F.ceil(F.col("count") / CELL_POINTS).cast("int").alias("blocks"))
    rows = rows.join(dense, ["types", "meet"], "left")
    block = F.pmod("point", F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.xxhash64("meet", F.least(block, other), F.greatest(block, other)).alias("meet"), F.when(other == block, -1).otherwise(block).alias("side")))
    rows = rows.withColumn("pair", F.explode(F.when(F.col("blocks").isNull(), F.array(F.struct(F.col("meet"), F.lit(-1).alias("side")))).otherwise(pairs))).select("types", "pair.meet", "behind", "pair.side", "point", "vec")
    parts = max(parallelism(points.sparkSession), points.count() // 2000)
    return rows.withColumn("part", F.pmod("meet", F.lit(parts))).repartition(parts, "part")


def _close_rows(group: pd.DataFrame, reach: float, scale: int):
    """Chunks (a, b, distance) of row numbers of a part: the close pairs of its cells that belong there.

    Cells are told apart by their types and hash; should two of one set of types share a hash, their close pairs are found
    all the same. The pairs of all small cells of one number of counts are tested together, a large cell by a sweep.
    """
    types, _ = pd.factorize(group["types"])
    meet, side = group["meet"].to_numpy(), group["side"].to_numpy()
    vec = group["vec"].to_numpy()
    width = np.fromiter(map(len, vec), dtype=np.int64, count=len(vec))
    behind = np.zeros((len(vec), 4), dtype=np.int64)
    flags = group["behind"].to_numpy()
    for k in set(map(len, flags)) - {0}:
        own = np.array([len(x) == k for x in flags])
        behind[own, :k] = np.stack(flags[own])

    def here(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (np.maximum(behind[a], behind[b]) == 0).all(axis=1) & ((side[a] < 0) | (side[a] != side[b]))

    # a pair belongs to the cell if no count has both points behind, so that a row stays only if its cell has such a partner
    order = np.lexsort((meet, types))
    new = np.r_[True, (np.diff(meet[order]) != 0) | (np.diff(types[order]) != 0)]
    cell = np.cumsum(new) - 1
    pattern = (-behind @ np.array([1, 2, 4, 8]))[order]
    present = np.zeros((cell[-1] + 1, 16), dtype=bool)
    present[cell, pattern] = True
    fits = (np.arange(16)[:, None] & np.arange(16)) == 0
    stays = (present.astype(np.int8) @ fits.astype(np.int8))[cell, pattern] > 0
    order, cell = order[stays], cell[stays]
    edges = np.concatenate([[0], np.nonzero(np.diff(cell))[0] + 1, [len(order)]])
    start, size = edges[:-1], np.diff(edges)
    start, size = start[size > 0], size[size > 0]
    for w in np.unique(width):
        mine = width[order[start]] == w
        for c in np.nonzero(mine & (size > SMALL_CELL))[0]:
            at = order[start[c] : start[c] + size[c]]
            own = np.stack(vec[at]).astype(np.int64)
            for a, b in _close_pairs(own, reach, scale):
                keep = here(at[a], at[b])
                yield at[a[keep]], at[b[keep]], relative_distance(own[a[keep]], own[b[keep]])
        small = mine & (size > 1) & (size <= SMALL_CELL)
        if not small.any():
            continue
        # rows of the small cells, one cell behind the other, and how many rows of its cell follow each
        many = size[small]
        rows = order[np.repeat(start[small] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        follow = np.repeat(np.cumsum(many), many) - np.arange(many.sum()) - 1
        own = np.stack(vec[rows]).astype(np.int64)
        bounds = np.searchsorted(np.cumsum(follow), np.arange(0, follow.sum() + CHUNK, CHUNK), side="left")
        for low, high in zip(bounds, [*bounds[1:], len(rows)]):
            n = follow[low:high]
            i = np.repeat(np.arange(low, high), n)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            close = within(own[i], own[j], round(reach * scale), scale) & here(rows[i], rows[j])
            i, j = i[close], j[close]
            yield rows[i], rows[j], relative_distance(own[i], own[j])


def core_distances(points: DataFrame, reach: float, neighbours: int, scale: int = 1000, cells: DataFrame | None = None) -> DataFrame:
    """point, core: distance to the ``neighbours``-th nearest record (its own equals count), 1.0 if out of reach.
    ``cells`` as of _cells, if they are there already."""

    def nearest(group: pd.DataFrame) -> pd.DataFrame:
        best = np.full((len(group), neighbours), np.inf)
        for a, b, d in _close_rows(group, reach, scale):
            for x in (a, b):
                order = np.lexsort((d, x))
                x, near = x[order], d[order]
                first = np.r_[True, x[1:] != x[:-1]] if len(x) else np.zeros(0, bool)
                at = np.arange(len(x)) - np.maximum.accumulate(np.where(first, np.arange(len(x)), 0))
                for k in range(neighbours):
                    hit = at == k
                    best[x[hit]] = np.sort(np.column_stack([best[x[hit]], near[hit]]), axis=1)[:, :neighbours]
        rows, cols = np.nonzero(np.isfinite(best))
        return pd.DataFrame({"point": group["point"].to_numpy()[rows], "near": best[rows, cols]})

    near = (_cells(points, reach) if cells is None else cells).groupBy("part").applyInPandas(nearest, "point bigint, near double")
    ranked = near.withColumn("k", F.row_number().over(Window.partitionBy("point").orderBy("near"))).where(F.col("k") <= neighbours)
    packed = ranked.groupBy("point").agg(F.sort_array(F.collect_list("near")).alias("nears"))
    missing = F.lit(neighbours) - F.col("copies")
    return points.join(packed, "point", "left").select("point", F.when(missing <= 0, 0.0).otherwise(F.coalesce(F.try_element_at("nears", missing.cast("int")), F.lit(1.0))).alias("core"))


def reach_edges(points: DataFrame, reach: float, core: DataFrame | None = None, scale: int = 1000, cells: DataFrame | None = None) -> DataFrame:
    """Edges (left, right, weight) of the cells' minimum spanning forests of the mutual-reachability graph.

    The weight is the distance, or the larger of it and both ends' core distances; edges heavier than ``reach`` are none.
    An edge that a cell's forest leaves out closes a circle in which it is the heaviest, so no spanning forest needs it.
    """
    rows = _cells(points, reach) if cells is None else cells
    rows = rows.join(core, "point") if core is not None else rows.withColumn("core", F.lit(0.0))

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        ids, core = group["point"].to_numpy(), group["core"].to_numpy()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def reduced() -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            left, right, weight = (np.concatenate([x[k] for x in held]) for k in range(3))
            order = np.lexsort((np.maximum(ids[left], ids[right]), np.minimum(ids[left], ids[right]), weight))
            left, right, weight = left[order], right[order], weight[order]
            # of a point that is in several cells each row is a node of its own, so that this is a forest per cell
            kept = np.sort(spanning_forest(len(ids), left, right, weight))
            return [(left[kept], right[kept], weight[kept])]

        for a, b, d in _close_rows(group, reach, scale):
            w = np.maximum(d, np.maximum(core[a], core[b]))
            near = w <= reach + 1e-12
            held.append((a[near], b[near], w[near]))
            if sum(len(x[2]) for x in held) > CHUNK:
                held = reduced()
        left, right, weight = reduced()[0] if held else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pd.DataFrame({"left": np.minimum(ids[left], ids[right]), "right": np.maximum(ids[left], ids[right]), "weight": weight})

    return rows.groupBy("part").applyInPandas(forest, "left bigint, right bigint, weight double")


def _stars(parent: DataFrame) -> DataFrame:
    """node, root from node, parent without circles: pointers jump until all end at their root."""
    parent = checkpointed(parent)
    stale: list[DataFrame] = []
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = checkpointed(parent.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"), (F.coalesce("above", "parent") != F.col("parent")).alias("moved")), [parent, *stale])
        stale = [jumped]
        parent = jumped.select("node", "parent")
        if jumped.where("moved").isEmpty():
            return parent.select("node", F.col("parent").alias("root"))


def boruvka(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Minimum spanning forest (left, right, weight) and components (node, root) of an edge table.

    Each round every component takes its lightest outgoing edge, ties broken by the ends, components hook onto each
    other along these edges, pointers jump to the roots, and the edges are relabelled; the rounds end when no edge is
    left between components, after at most the logarithm of the largest component. Nothing is gathered in one place.
    """
    edges = checkpointed(edges.groupBy("left", "right").agg(F.min("weight").alias("weight")))
    labels = checkpointed(edges.select(F.col("left").alias("node")).union(edges.select("right")).distinct().withColumn("root", F.col("node")))
    live = edges.select(F.col("left").alias("a"), F.col("right").alias("b"), "left", "right", "weight")
    forest = None
    while not live.isEmpty():
        edge = F.struct("weight", "left", "right", "a", "b")
        ways = live.select(F.col("a").alias("node"), edge.alias("edge")).union(live.select(F.col("b").alias("node"), edge.alias("edge")))
        lightest = checkpointed(ways.groupBy("node").agg(F.min("edge").alias("edge")))
        picked = lightest.select("edge.left", "edge.right", "edge.weight").distinct()
        forest = picked if forest is None else forest.union(picked)
        hook = lightest.select("node", F.when(F.col("edge.a") == F.col("node"), F.col("edge.b")).otherwise(F.col("edge.a")).alias("parent"), "edge.left", "edge.right")
        mutual = hook.select(F.col("node").alias("parent"), F.col("left").alias("l"), F.col("right").alias("r"))
        hook = hook.join(mutual, "parent", "left").select("node", F.when((F.col("left") == F.col("l")) & (F.col("right") == F.col("r")), F.least("node", "parent")).otherwise(F.col("parent")).alias("parent"))
        roots = checkpointed(_stars(hook))
        to = roots.select(F.col("node").alias("root"), F.col("root").alias("top"))
        labels = checkpointed(labels.join(to, "root", "left").select("node", F.coalesce("top", "root").alias("root")), [labels])
        of_a, of_b = roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        live = checkpointed(live.join(of_a, "a").join(of_b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"), "left", "right", "weight"), [live])
    return (edges.limit(0) if forest is None else forest.select("left", "right", "weight")), labels


def _points(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    members = checkpointed(vectors.select("rec_id", "types", "vec", F.xxhash64("types", "vec").alias("point")))
    points = checkpointed(members.groupBy("point").agg(F.first("types").alias("types"), F.first("vec").alias("vec"), F.count("*").alias("copies")))
    return members.select("rec_id", "point"), points


def reachability_forest(points: DataFrame, reach: float, neighbours: int) -> tuple[DataFrame, DataFrame]:
    """Minimum spanning forest and components of the mutual-reachability graph. With one neighbour every record is its own
    nearest, core distances are 0 and the graph is that of the plain distances."""
    cells = _cells(points, reach)
    core = checkpointed(core_distances(points, reach, neighbours, cells=cells)) if neighbours > 1 else None
    return boruvka(reach_edges(points, reach, core, cells=cells))


class Condenser:
    """The condensed hierarchy of one component, built bottom-up over its edges in the order of their weights.

    A node is (id, records, cluster, gained, within): the cluster that it is the whole of, or None; the sum of its records'
    1/(distance + floor) at which they joined; the best stability of what lies within it. ``joins`` has (node, cluster,
    distance) of the nodes that join a cluster, ``born`` the distance at which each cluster forms, ``clusters`` (cluster,
    parent or None, stability, takes) of those that have ended, children before parents. A cluster that forms below
    ``unsplit`` takes its records whatever the stabilities are.
    """

    def __init__(self, nodes, least: int, floor: float, unsplit: float = 0.0):
        self.least, self.floor, self.unsplit = least, floor, unsplit
        self.up: dict = {}
        self.state: dict = {}
        self.joins: list = []
        self.born: dict = {}
        self.clusters: list = []
        for node, n, cluster, gained, within in nodes:
            self.up[node] = node
            # records, cluster, gained, within, nodes that are in no cluster yet
            self.state[node] = [n, cluster, gained, within, [] if cluster is not None else [node]]
            if cluster is None and n >= least:
                self._form(self.state[node], f"{node}", 0.0)

    def value(self, distance: float) -> float:
        return 1.0 / (distance + self.floor)

    def find(self, node):
        while self.up[node] != node:
            self.up[node] = node = self.up[self.up[node]]
        return node

    def _form(self, state: list, cluster: str, distance: float) -> None:
        self.born[cluster] = distance
        self.joins.extend((node, cluster, distance) for node in state[4])
        state[1], state[2], state[4] = cluster, state[0] * self.value(distance), []

    def end(self, state: list, parent: str | None, distance: float) -> float:
        n, cluster, gained, within, _ = state
        stability = gained - n * self.value(distance)
        # a cluster of an earlier band has no birth here; _by_bands looks it up
        self.clusters.append((cluster, parent, stability, stability >= within or self.born.get(cluster, math.inf) < self.unsplit))
        return max(stability, within)

    def merge(self, left, right, distance: float) -> None:
        left, right = self.find(left), self.find(right)
        if left == right:
            return
        a, b = self.state[left], self.state.pop(right)
        self.up[right] = left
        if a[1] is None and b[1] is not None:
            a, b = b, a
        both, within = a[1] is not None and b[1] is not None, a[3] + b[3]
        if both:
            within = self.end(a, f"{left}:{right}", distance) + self.end(b, f"{left}:{right}", distance)
        elif a[1] is not None:
            self.joins.extend((node, a[1], distance) for node in b[4])
        state = self.state[left] = [a[0] + b[0], None if both else a[1], a[2] + b[0] * self.value(distance), within, [] if a[1] is not None else a[4] + b[4]]
        if both or (state[1] is None and state[0] >= self.least):
            self._form(state, f"{left}:{right}", distance)

    def chosen(self) -> dict[str, str | None]:
        """Of each cluster the topmost one around it, itself included, that takes its records; None if there is none."""
        top: dict[str, str | None] = {}
        for cluster, parent, _, takes in reversed(self.clusters):
            top[cluster] = top.get(parent) or (cluster if takes else None)
        return top


_NODE = "node bigint, n bigint, cluster string, gained double, within double"
_EVENT = "kind string, node bigint, cluster string, parent string, distance double, stability double, takes boolean, n bigint, gained double, within double"


def _condensed(nodes: DataFrame, edges: DataFrame, least: int, floor: float, last: float | None, unsplit: float = 0.0) -> DataFrame:
    """Events of the hierarchies of components: nodes (component, and _NODE), edges (component, left, right, weight).

    With ``last``, the distance at which open clusters end: ``member`` (node, chosen cluster, distance) and ``cluster``
    (chosen cluster, stability, distance at which it forms) rows. Without it: ``join``, ``born`` and ``ended`` rows as in
    Condenser, and an ``open`` row with the state of each component's whole, under the component's id. Components are dealt
    to parts by hash; each has at most some ``TASK_EDGES`` edges.
    """
    part = F.pmod(F.xxhash64("component"), F.lit(parallelism(nodes.sparkSession))).alias("part")
    # a node is a row from itself to itself without weight, so that no id is null, which pandas would make a float of
    rows = nodes.select(part, "component", F.col("node").alias("left"), F.col("node").alias("right"), F.lit(None).cast("double").alias("weight"), "n", "cluster", "gained", "within")
    none = [F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("string").alias("cluster"), F.lit(0.0).alias("gained"), F.lit(0.0).alias("within")]
    rows = rows.unionByName(edges.select(part, "component", "left", "right", "weight", *none))

    def of_component(component: int, points: pd.DataFrame, links: pd.DataFrame) -> list[dict]:
        state = zip(points["left"].tolist(), points["n"].tolist(), [c if isinstance(c, str) else None for c in points["cluster"]], points["gained"].tolist(), points["within"].tolist())
        tree = Condenser(state, least, floor, unsplit)
        for left, right, weight in zip(links["left"].tolist(), links["right"].tolist(), links["weight"].tolist()):
            tree.merge(left, right, weight)
        if last is None:
            out = [{"kind": "join", "node": node, "cluster": c, "distance": d} for node, c, d in tree.joins]
            out += [{"kind": "born", "cluster": c, "distance": d} for c, d in tree.born.items()]
            out += [{"kind": "ended", "cluster": c, "parent": p, "stability": s, "takes": t} for c, p, s, t in tree.clusters]
            return out + [{"kind": "open", "node": component, "cluster": s[1], "n": s[0], "gained": s[2], "within": s[3]} for s in tree.state.values()]
        for s in tree.state.values():
            if s[1] is not None:
                tree.end(s, None, last)
        top = tree.chosen()
        out = [{"kind": "member", "node": node, "cluster": top[c], "distance": d} for node, c, d in tree.joins if top[c] is not None]
        return out + [{"kind": "cluster", "cluster": c, "stability": s, "distance": tree.born[c]} for c, _, s, _ in tree.clusters if top[c] == c]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out: list[dict] = []
        if last is not None:
            # fewer records than a cluster has never form one
            group = group[group.groupby("component")["n"].transform("sum") >= least]
        group = group.sort_values(["component", "weight", "left", "right"], na_position="first")
        changes = np.nonzero(np.diff(group["component"].to_numpy()))[0] + 1
        for own in np.split(np.arange(len(group)), changes) if len(group) else []:
            rows = group.iloc[own]
            edge = rows["weight"].notna().to_numpy()
            out += of_component(int(rows["component"].iloc[0]), rows[~edge], rows[edge])
        names = [x.split()[0] for x in _EVENT.split(", ")]
        frame = pd.DataFrame([[x.get(c) for c in names] for x in out], columns=names, dtype=object)
        return frame.astype({"node": "Int64", "n": "Int64", "takes": "boolean"} | dict.fromkeys(("distance", "stability", "gained", "within"), "float64"))

    return rows.groupBy("part").applyInPandas(run, _EVENT)


def _by_bands(nodes: DataFrame, edges: DataFrame, least: int, floor: float, reach: float, task_edges: int, unsplit: float = 0.0) -> DataFrame:
    """``member`` and ``cluster`` rows as of _condensed, of components too large for a task.

    Their edges are cut at quantiles of the weight into bands of about ``task_edges``; a band's edges join what the bands
    below left as single nodes, and each of its components is one task's. The clusters that a record lies in, one chain
    across the bands, are then followed upwards by pointers that jump.
    """
    names = [x.split()[0] for x in _NODE.split(", ")]
    bands = max(1, -(-edges.count() // task_edges))
    cuts = edges.agg(F.percentile_approx("weight", [i / bands for i in range(1, bands)] or [1.0], 100_000)).first()[0] or []
    cuts = sorted({*cuts[: bands - 1], reach + 1e-9})
    live, state = edges.select("left", "right", "weight"), nodes.select(*names)
    place = nodes.select(F.col("node").alias("point"), "node")
    joins = ended = born = None
    for cut in cuts:
        band = checkpointed(live.where(F.col("weight") <= cut))
        if band.isEmpty():
            continue
        _, labels = boruvka(band)
        labels = labels.select("node", F.col("root").alias("component"))
        inside = band.join(labels.withColumnRenamed("node", "left"), "left").select("component", "left", "right", "weight")
        events = checkpointed(_condensed(state.join(labels, "node"), inside, least, floor, None, unsplit))
        parts = [
            events.where("kind = 'join'").join(place, "node").select("point", "cluster", "distance"),
            events.where("kind = 'ended'").select("cluster", "parent", "stability", "takes"),
            events.where("kind = 'born'").select("cluster", F.col("distance").alias("born")),
        ]
        joins, ended, born = parts if joins is None else [a.unionByName(b) for a, b in zip((joins, ended, born), parts)]
        state = checkpointed(state.join(labels, "node", "left_anti").unionByName(events.where("kind = 'open'").select(*names)))
        place = checkpointed(place.join(labels, "node", "left").select("point", F.coalesce("component", "node").alias("node")))
        for end in ("left", "right"):
            live = live.where(F.col("weight") > cut).join(labels.select(F.col("node").alias(end), "component"), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
        live = checkpointed(live.select("left", "right", "weight"))
    own = F.col("gained") - F.col("n") / (reach + floor)
    top = ended.unionByName(state.where("cluster is not null").select("cluster", F.lit(None).cast("string").alias("parent"), own.alias("stability"), (own >= F.col("within")).alias("takes")))
    top = top.join(born, "cluster").withColumn("takes", F.col("takes") | (F.col("born") < unsplit))
    jumped = checkpointed(top.select("cluster", F.col("parent").alias("up"), F.when(F.col("takes"), F.col("cluster")).alias("chosen")))
    while not jumped.where("up is not null").isEmpty():
        above = jumped.select(F.col("cluster").alias("up"), F.col("up").alias("further"), F.col("chosen").alias("higher"))
        jumped = checkpointed(jumped.join(above, "up", "left").select("cluster", F.col("further").alias("up"), F.coalesce("higher", "chosen").alias("chosen")))
    chosen = jumped.where("chosen is not null").select("cluster", "chosen")
    member = joins.join(chosen, "cluster").select(F.lit("member").alias("kind"), F.col("point").alias("node"), F.col("chosen").alias("cluster"), "distance", F.lit(None).cast("double").alias("stability"))
    cluster = top.join(chosen.where("cluster = chosen"), "cluster").select(F.lit("cluster").alias("kind"), F.lit(None).cast("bigint").alias("node"), "cluster", F.col("born").alias("distance"), "stability")
    return member.unionByName(cluster)


def _selected(vectors: DataFrame, reach: float, least: int, neighbours: int, floor: float, task_edges: int, unsplit: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """The records of the selected clusters of the condensed hierarchy, rec_id, cluster, joins (the distance at which a
    record is first in a cluster), and the clusters, cluster, born, stability.

    A cluster has at least ``least`` records; two such that meet end there, and fewer records that meet one join it. A
    cluster's stability adds up 1/(distance + ``floor``) of each record's joining less that of the cluster's end, ``reach``
    at most; going up, a cluster replaces the clusters within it if it is at least as stable as they are together, or if it
    forms below ``unsplit``. Repeated rows count once. Components of more than ``task_edges`` edges are built in bands of
    distances.
    """
    members, points = _points(vectors.distinct())
    forest, labels = reachability_forest(points, reach, neighbours)
    forest = forest.join(labels.select(F.col("node").alias("left"), F.col("root").alias("component")), "left")
    forest = checkpointed(forest.select("component", "left", "right", "weight"))
    state = [F.lit(None).cast("string").alias("cluster"), F.lit(0.0).alias("gained"), F.lit(0.0).alias("within")]
    nodes = checkpointed(points.select(F.col("point").alias("node"), F.col("copies").alias("n"), *state).join(labels.withColumnRenamed("root", "component"), "node", "left").withColumn("component", F.coalesce("component", "node")))
    large = checkpointed(forest.groupBy("component").count().where(F.col("count") > task_edges).select("component"))
    wanted = ["kind", "node", "cluster", "distance", "stability"]
    events = _condensed(nodes.join(large, "component", "left_anti"), forest.join(large, "component", "left_anti"), least, floor, reach, unsplit).select(*wanted)
    if not large.isEmpty():
        events = events.unionByName(_by_bands(nodes.join(large, "component", "left_semi"), forest.join(large, "component", "left_semi"), least, floor, reach, task_edges, unsplit).select(*wanted))
    events = checkpointed(events)
    placed = events.where("kind = 'member'").select(F.col("node").alias("point"), "cluster", F.col("distance").alias("joins"))
    rows = checkpointed(members.distinct().join(placed, "point").select("rec_id", "cluster", "joins"))
    return rows, events.where("kind = 'cluster'").select("cluster", F.col("distance").alias("born"), "stability")


def chained_groups(vectors: DataFrame, reach: float = 0.1, least: int = 3, neighbours: int = 2, floor: float = 0.02, task_edges: int = TASK_EDGES) -> DataFrame:
    """Groups of records linked by chains of likeness, at least ``least`` records each: head_id (the smallest), member_id.

    These are the clusters of the condensed hierarchy of which none that forms within ``reach`` is split: the outermost
    ones take the records whatever the stabilities within them are. With two neighbours a record's core distance is that
    to its nearest other one and never above the distance of a pair that it is in, so that mutual reachability leaves the
    chains as they are; with more, the thin ends of chains are noise. One row for each record but the head. ``vectors``
    as from ``count_vectors``; an id with several vectors counts once in a group; no rows give no rows.
    """
    rows, _ = _selected(vectors, reach, least, neighbours, floor, task_edges, math.inf)
    rows = rows.select("rec_id", "cluster").distinct()
    heads = rows.groupBy("cluster").agg(F.min("rec_id").alias("head_id"), F.count("*").alias("n")).where(F.col("n") >= least)
    return salted_join(rows, heads, "cluster", "inner").where("rec_id <> head_id").select("head_id", F.col("rec_id").alias("member_id")).distinct()


def density_clusters(vectors: DataFrame, reach: float = 0.1, least: int = 3, neighbours: int = 2, exemplars: int = 3, floor: float = 0.02, task_edges: int = TASK_EDGES) -> DataFrame:
    """Stable density clusters: cluster_id (smallest record), n_members, born (the distance it forms at), stability and
    the ids of its most persistent members.

    The hierarchy is that of the spanning forest's own weights, the selection that of _selected. The records that were in
    some cluster at the smallest distance are the most persistent ones, ties by id. Records outside every selected cluster
    are noise and give no row. Repeated rows count once; no rows give no rows.
    """
    rows, own = _selected(vectors, reach, least, neighbours, floor, task_edges)
    by = Window.partitionBy("cluster").orderBy("joins", "rec_id")
    typical = rows.withColumn("k", F.row_number().over(by)).where(F.col("k") <= exemplars).groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "rec_id"))), lambda x: x["rec_id"]).alias("exemplars"))
    stats = rows.groupBy("cluster").agg(F.min("rec_id").alias("cluster_id"), F.count("*").alias("n_members"))
    return stats.join(own, "cluster").join(typical, "cluster").select("cluster_id", "n_members", F.round("born", 6).alias("born"), F.round("stability", 6).alias("stability"), "exemplars")
