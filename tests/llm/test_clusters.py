import random

from pyspark.sql import functions as F

from strataloom.llm.clusters import boruvka, chained_groups, core_distances, count_vectors, relative_distance

SCHEMA = "log_id long, filetypes map<string,struct<inserts long, deletes long, occurrences long, textlinecount long, binbytecount long>>, point string"


def chained(points):
    parent = list(range(len(points)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (t, a) in enumerate(points):
        for j, (u, b) in enumerate(points[:i]):
            if t == u and all(abs(x - y) * 10 <= max(x, y) for x, y in zip(a, b)):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(points)):
        groups.setdefault(find(i), []).append(i)
    return {(min(g), m) for g in groups.values() if len(g) >= 3 for m in g if m != min(g)}


def test_vectors(spark):
    rows = [(1, {".MD": (1, None, 5, 0, 0), "md": (2, 3, 1, 0, 0), "rs": (0, 0, 9, None, 7), "js": None}, "x"), (2, {}, "x"), (3, None, "x"), (None, {"md": (1, 1, 1, 1, 1)}, "x"), (4, {"a": (0, 0, 0, 0, 0)}, "x")]
    assert [(r["rec_id"], r["types"], list(r["vec"])) for r in count_vectors(spark.createDataFrame(rows, SCHEMA)).collect()] == [(1, "md", [3, 3, 0])]


def test_groups_are_the_chains(spark):
    random.seed(7)
    points = [(random.choice(["a", "a/b"]), [random.choice([0, 9, 10, 11, 100, 105, 111, 118, 126])] * 2 + [random.randint(95, 130)]) for _ in range(160)]
    points += [("hot", [random.randint(900, 1100), random.randint(40, 60), random.randint(0, 3)]) for _ in range(1700)]
    points += points[:20]
    df = spark.createDataFrame([(i, t, v) for i, (t, v) in enumerate(points)], "rec_id long, types string, vec array<long>")
    got = {tuple(r) for r in chained_groups(df.union(df.limit(30))).collect()}
    assert got == chained(points)
    assert chained_groups(df.limit(0)).isEmpty()


def test_spanning_forest(spark):
    edges = [(a, b, w / 10) for w, (a, b) in enumerate([(1, 2), (2, 3), (1, 3), (3, 4), (7, 8), (1, 4), (8, 9), (7, 9)])] + [(1, 2, 0.9)]
    forest, labels = boruvka(spark.createDataFrame(edges, "left long, right long, weight double"))
    assert {(r["left"], r["right"]) for r in forest.collect()} == {(1, 2), (2, 3), (3, 4), (7, 8), (8, 9)}
    roots = {r["node"]: r["root"] for r in labels.collect()}
    assert len({roots[x] for x in (1, 2, 3, 4)}) == 1 and len({roots[x] for x in (7, 8, 9)}) == 1 and roots[1] != roots[7]


def test_core_distances(spark):
    vec = [[100, 1, 1], [100, 1, 1], [104, 1, 1], [300, 1, 1]]
    points = spark.createDataFrame([(1, "t", vec[0], 2), (2, "t", vec[2], 1), (3, "t", vec[3], 1)], "point long, types string, vec array<long>, copies long")
    core = {r["point"]: r["core"] for r in core_distances(points, 0.1, 2).collect()}
    assert core[1] == 0.0 and abs(core[2] - 4 / 104) < 1e-9 and core[3] == 1.0
    import numpy as np

    assert abs(relative_distance(np.array([vec[0]]), np.array([vec[2]]))[0] - 4 / 104) < 1e-12


def test_density_clusters(spark):
    from strataloom.llm.clusters import density_clusters

    tight = [[100, 100, 50]] * 3 + [[101, 100, 50]] * 2
    far = [[1000, 7, 7]] * 4
    noise = [[5000 * (i + 1), 1, 1] for i in range(3)]
    df = spark.createDataFrame([(i, "t", v) for i, v in enumerate(tight + far + noise)], "rec_id long, types string, vec array<long>")
    rows = {r["cluster_id"]: r for r in density_clusters(df).collect()}
    assert {k: r["n_members"] for k, r in rows.items()} == {0: 5, 5: 4}
    assert list(rows[5]["exemplars"]) == [5, 6, 7] and rows[5]["stability"] > 0


def brute_clusters(vectors, reach, least, neighbours, floor):
    """Top-down: components of the mutual-reachability graph as the bound on its distances falls."""
    import numpy as np

    n = len(vectors)
    d = np.array([[max(abs(x - y) / max(x, y, 1) for x, y in zip(a, b)) for b in vectors] for a in vectors])
    core = np.sort(d, axis=1)[:, neighbours - 1]
    m = np.maximum(d, np.maximum.outer(core, core))
    value = lambda x: 1 / (x + floor)

    def components(of, bound, strict):
        left, out = set(of), []
        while left:
            todo, seen = [left.pop()], set()
            while todo:
                a = todo.pop()
                seen.add(a)
                near = {b for b in left if (m[a, b] < bound if strict else m[a, b] <= bound)}
                left -= near
                todo.extend(near)
            out.append(seen)
        return out

    def best_of(cluster, end):
        """(stability, selected clusters as (members, born, stability), first joins) of a cluster that ends at ``end``."""
        joins, inside, own = {}, cluster, sorted({m[a, b] for a in cluster for b in cluster if a != b and m[a, b] <= reach}, reverse=True)
        first, kids, born = {}, [], 0.0
        for w in own:
            if w == 0:
                break
            parts = components(inside, w, True)
            big = [p for p in parts if len(p) >= least]
            if len(big) == 1:
                joins |= {x: w for x in inside - big[0]}
                inside = big[0]
                continue
            born = w
            joins |= {x: w for x in inside}
            kids = [best_of(p, w) for p in big]
            inside = set()
            break
        joins |= {x: 0.0 for x in inside}
        first = dict(joins)
        for _, _, f in kids:
            first |= f
        stability = sum(value(j) for j in joins.values()) - len(cluster) * value(end)
        within = sum(k[0] for k in kids)
        if stability >= within:
            return stability, [(cluster, born, stability)], first
        return within, [c for k in kids for c in k[1]], first

    out = set()
    for part in components(range(n), reach, False):
        if len(part) >= least:
            _, found, first = best_of(part, reach)
            out |= {(min(c), len(c), round(born, 6), round(s, 4), tuple(sorted(c, key=lambda x: (first[x], x))[:3])) for c, born, s in found}
    return out


def test_density_clusters_against_brute_force(spark):
    from strataloom.llm import clusters

    random.seed(11)
    for least, neighbours in ((3, 2), (4, 3)):
        vectors = [[int(c * random.uniform(0.97, 1.03)), 700, 40] for c in (1000, 1000, 1055, 1110, 1300, 1330, 2000) for _ in range(9)] + [[1000, 700, 40]] * 4
        df = spark.createDataFrame([(i, "t", v) for i, v in enumerate(vectors)], "rec_id long, types string, vec array<long>")
        want = brute_clusters(vectors, 0.1, least, neighbours, 0.02)
        assert len(want) > 2
        for task_edges in (1000, 5):
            rows = clusters.density_clusters(df.union(df.limit(5)), least=least, neighbours=neighbours, task_edges=task_edges).collect()
            assert {(r["cluster_id"], r["n_members"], r["born"], round(r["stability"], 4), tuple(r["exemplars"])) for r in rows} == want
    assert clusters.density_clusters(df.limit(0)).isEmpty()


def test_dense_cells_are_cut_into_blocks(spark, monkeypatch):
    from strataloom.llm import clusters

    random.seed(3)
    vectors = [[random.randint(900, 1100), random.randint(90, 110), 5] for _ in range(400)]
    df = spark.createDataFrame([(i, "t", v) for i, v in enumerate(vectors)], "rec_id long, types string, vec array<long>")
    want = chained([("t", v) for v in vectors])
    members, points = clusters._points(df)
    core = {r["point"]: r["core"] for r in core_distances(points, 0.1, 3).collect()}
    monkeypatch.setattr(clusters, "CELL_POINTS", 60)
    assert {tuple(r) for r in chained_groups(df).collect()} == want
    assert {r["point"]: r["core"] for r in core_distances(points, 0.1, 3).collect()} == core


def reachable(vectors, neighbours, least=3):
    """Members of the components of the mutual-reachability graph by their heads."""
    import numpy as np

    d = np.array([[max(abs(x - y) / max(x, y, 1) for x, y in zip(a, b)) for b in vectors] for a in vectors])
    core = np.sort(d, axis=1)[:, neighbours - 1]
    near = np.maximum(d, np.maximum.outer(core, core)) <= 0.1
    head = np.arange(len(vectors))
    while ((lower := np.where(near, head, len(vectors)).min(axis=1).clip(max=head)) != head).any():
        head = lower
    return {(int(h), i) for i, h in enumerate(head) if h != i and (head == h).sum() >= least}


def test_groups_come_from_the_condensed_hierarchy(spark, monkeypatch):
    from strataloom.llm import clusters

    random.seed(5)
    # dense places that chains link, and a chain with thin ends
    vectors = [[int(c * random.uniform(0.98, 1.02)), 700, 40] for c in (1000, 1075, 1150) for _ in range(8)] + [[3000 + 250 * i, 700, 40] for i in range(4)]
    df = spark.createDataFrame([(i, "t", v) for i, v in enumerate(vectors)], "rec_id long, types string, vec array<long>")
    seen = []
    for step in ("core_distances", "_condensed"):
        monkeypatch.setattr(clusters, step, lambda *a, step=step, f=getattr(clusters, step), **k: seen.append(step) or f(*a, **k))
    want = chained([("t", v) for v in vectors])
    assert len({h for h, _ in want}) < len(clusters.density_clusters(df).collect())
    seen.clear()
    assert {tuple(r) for r in clusters.chained_groups(df).collect()} == want == reachable(vectors, 2)
    assert seen == ["core_distances", "_condensed"]
    assert {tuple(r) for r in clusters.chained_groups(df, task_edges=12).collect()} == want
    assert {tuple(r) for r in clusters.chained_groups(df, neighbours=3).collect()} == reachable(vectors, 3) != want


def test_an_id_with_several_vectors_counts_once(spark):
    rows = [(1, [100]), (1, [101]), (2, [102]), (3, [500]), (4, [501]), (5, [502]), (5, [500])]
    df = spark.createDataFrame([(i, "t", v) for i, v in rows], "rec_id long, types string, vec array<long>")
    assert {tuple(r) for r in chained_groups(df).collect()} == {(3, 4), (3, 5)}
