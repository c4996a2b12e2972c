"""The exact density hierarchy against a brute-force version that works on sets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from herald.operators.hierarchy import exact_clusters, spanning_tree
from test_density import planted, three_groups

SCHEMA = "originator_id string, template_hash string, embedding array<double>"


def brute(rows, min_size, min_samples, epsilon, allow_single=False):
    """Components at every distinct distance from the full matrix; clusters as (set, ...) on paper."""
    ids = sorted(r[1] for r in rows)
    x = np.array([np.float32(r[2]) for r in sorted(rows, key=lambda r: r[1])], dtype=np.float64)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    n = len(ids)
    d = np.sqrt(np.clip(2 - 2 * x @ x.T, 0, None))
    np.fill_diagonal(d, np.inf)
    core = np.sort(d, axis=1)[:, min_samples - 2] if min_samples > 1 else np.zeros(n)
    w = np.rint(np.maximum(d, np.maximum(core[:, None], core[None, :])) * 1e6)
    levels = sorted(set(w[np.isfinite(w)].tolist()))

    def components(level):
        comp = np.arange(n)
        while True:
            near = np.where(w <= level, comp[None, :], n).min(axis=1)
            new = np.minimum(comp, near)
            new = new[new]
            if (new == comp).all():
                return comp
            comp = new

    lam = lambda v: 1e6 / max(v, 1)
    state = {frozenset([i]): None for i in range(n)}
    clusters, first = {}, {}
    for level in levels:
        comp = components(level)
        if len(set(comp)) == len(state):
            continue
        new = {}
        for c in set(comp):
            s = frozenset(np.flatnonzero(comp == c).tolist())
            if s in state:
                new[s] = state[s]
                continue
            parts = [p for p in state if p < s]
            big = [p for p in parts if state[p] is not None]
            name = None
            if len(big) == 1:
                name = state[big[0]]
            elif len(s) >= min_size:
                name = len(clusters)
                clusters[name] = dict(leave={}, parent=None, end=None, kids=[state[p] for p in big])
                for p in big:
                    clusters[state[p]].update(parent=name, end=level, size=len(p))
                    for i in p:
                        clusters[name]["leave"][i] = lam(level)
            if name is not None:
                for p in parts:
                    if state[p] is None:
                        for i in p:
                            clusters[name]["leave"][i] = lam(level)
                            first[i] = name
            new[s] = name
        state = new
    for s, name in state.items():
        if name is not None:
            clusters[name].update(size=len(s), end=None if len(state) == 1 else 2e6)
    value = {}
    for name, c in clusters.items():
        own = sum(c["leave"].values()) - (c["size"] * lam(c["end"]) if c["end"] is not None else 0)
        below = sum(value[k][1] for k in c["kids"])
        value[name] = (own >= below and (c["end"] is not None or allow_single), max(own, below))

    def line(name):
        while name is not None:
            yield name
            name = clusters[name]["parent"]

    def selected(name):
        kept = [x for x in line(name) if value[x][0]]
        if not kept:
            return None
        c = kept[-1]
        while clusters[c]["parent"] is not None and clusters[c]["end"] < epsilon * 1e6 and not (
                clusters[clusters[c]["parent"]]["end"] is None and not allow_single):
            c = clusters[c]["parent"]
        return c

    final = {selected(x) for x in clusters} - {None}
    chosen = {i: next((x for x in line(first[i]) if x in final), None) if i in first else None for i in range(n)}
    number = {}
    for i in range(n):
        if chosen[i] is not None:
            number.setdefault(chosen[i], len(number))
    return {ids[i]: number.get(chosen[i], -1) for i in range(n)}


def cloud(seed, n=90, dim=3, copies=6):
    """Points of uneven density on a sphere, some of them copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    x = [centres[rng.integers(6)] * rng.choice([1, 1, 4]) + 0.35 * rng.normal(size=dim) for _ in range(n)]
    x += [x[3]] * copies
    return [("s", f"r{i:03d}", [float(v) for v in p]) for i, p in enumerate(x)]


def labels(spark, rows, **kw):
    out = exact_clusters(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    return {r.template_hash: r.cluster_label for r in out}


@pytest.mark.parametrize("seed,size,samples,epsilon", [(1, 5, 2, 0.0), (2, 4, 1, 0.05), (3, 6, 3, 0.3), (4, 3, 2, 0.6)])
def test_single_task_equals_brute_force(spark, seed, size, samples, epsilon):
    rows = cloud(seed)
    want = brute(rows, size, samples, epsilon)
    assert len(set(want.values())) > 2
    assert labels(spark, rows, min_cluster_size=size, min_samples=samples, epsilon=epsilon) == want


@pytest.mark.parametrize("seed,size,samples,epsilon,edges", [(1, 5, 2, 0.0, 10 ** 6), (4, 3, 2, 0.6, 18)])
def test_tiled_equals_brute_force(spark, seed, size, samples, epsilon, edges):
    """Several tiles, Boruvka rounds, and the tree climbed at once or in many ranges."""
    rows = cloud(seed, n=60)
    got = labels(spark, rows, min_cluster_size=size, min_samples=samples, epsilon=epsilon, tile_rows=20, edge_range=edges)
    assert got == brute(rows, size, samples, epsilon)


def test_senders_apart_and_small_senders(spark):
    df = planted(spark)
    got = {(r.originator_id, r.template_hash): r.cluster_label for r in exact_clusters(df, 5, 2, 0.0).collect()}
    rows = [tuple(r) for r in df.collect()]
    for sender in ("s1", "s2"):
        mine = [r for r in rows if r[0] == sender]
        assert {k[1]: v for k, v in got.items() if k[0] == sender} == brute(mine, 5, 2, 0.0)
    assert labels(spark, [("s", "a", [1.0, 0.0]), ("s", "b", [0.0, 1.0])], min_cluster_size=5, min_samples=4) == {"a": -1, "b": -1}
    assert exact_clusters(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("tile_rows", [1024, 8])
def test_root_is_no_cluster_unless_allowed(spark, tile_rows):
    rows = [r for r in three_groups() if r[1].startswith("g0")]
    kw = dict(min_cluster_size=5, min_samples=1, epsilon=0.0, tile_rows=tile_rows)
    assert set(labels(spark, rows, **kw).values()) == {-1}
    assert set(labels(spark, rows, allow_single_cluster=True, **kw).values()) == {0}
    assert brute(rows, 5, 1, 0.0, True) == dict.fromkeys((r[1] for r in rows), 0)


def test_labels_do_not_depend_on_the_order_of_rows(spark):
    rows = cloud(7)
    one = labels(spark, rows, min_cluster_size=4, min_samples=2, epsilon=0.1)
    assert labels(spark, rows[::-1], min_cluster_size=4, min_samples=2, epsilon=0.1) == one


def test_spanning_tree_is_minimal(spark):
    rng = np.random.default_rng(3)
    n = 60
    edges = [("s", f"{i:02d}", f"{j:02d}", int(rng.integers(1, 40))) for i in range(n) for j in range(i) if rng.random() < 0.2]
    got = spanning_tree(spark.createDataFrame(edges, "originator_id string, a string, b string, w long"), "originator_id").collect()

    def kruskal():
        root = {f"{i:02d}": f"{i:02d}" for i in range(n)}
        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        total = count = 0
        for _, a, b, w in sorted(edges, key=lambda e: e[3]):
            if find(a) != find(b):
                root[find(a)] = find(b)
                total, count = total + w, count + 1
        return total, count
    assert (sum(r.w for r in got), len(got)) == kruskal()


def test_blocks_copy_a_row_a_bounded_number_of_times_and_emit_edges_between_them(spark):
    """A row was copied once per pivot cell, and a pair of tiles emitted the edges inside both again."""
    from herald.operators import hierarchy as H
    x = np.random.default_rng(5).normal(size=(400, 6))
    points = spark.createDataFrame([("s", i, [float(c) for c in v], 3, 1) for i, v in enumerate(x)],
                                   "originator_id string, id long, vec array<float>, min_size int, min_samples int").cache()
    tiling = H.blocks(points, "originator_id", 10)
    n = tiling.rows.select("tile").distinct().count()
    assert n == H.BLOCKS and tiling.groups().count().agg(F.sum("count")).first()[0] == n * len(x)
    cores = points.select("originator_id", "id", F.lit(0.0).alias("core"))
    tile = {r.id: r.tile for r in tiling.rows.select("id", "tile").collect()}
    inside = [e for e in H.tile_forests(tiling, cores, 16).collect() if tile[e.a] == tile[e.b]]
    assert len(inside) == len(x) - n

    def weights(t, step):
        e = H.tile_forests(t, cores, step).toPandas()
        return sorted(H._lighter([tuple(e[c].to_numpy() for c in "abw")], len(x))[0][2].tolist())

    small = weights(tiling, 16)
    assert small == weights(tiling, 2048) == weights(H.blocks(points, "originator_id", 1000), 64) and len(small) == len(x) - 1


def test_forests_are_made_in_turns_and_merged_before_a_sender_is_finished(spark):
    """All copies of a sender's rows were on disk at once, and all its forests' edges in one task."""
    from herald.operators import hierarchy as H
    x = np.random.default_rng(6).normal(size=(300, 6))
    points = spark.createDataFrame([("s", i, [float(c) for c in v], 3, 1) for i, v in enumerate(x)],
                                   "originator_id string, id long, vec array<float>, min_size int, min_samples int").cache()
    tiling = H.blocks(points, "originator_id", 10)
    all_at_once, turns = (H.tile_forests(tiling, None, 16, turn_rows=n) for n in (10 ** 6, 500))
    assert sorted(map(tuple, all_at_once.collect())) == sorted(map(tuple, turns.collect()))
    assert len({f.rsplit("/", 2)[1] for f in turns.inputFiles()}) >= 5 > \
        len({f.rsplit("/", 2)[1] for f in all_at_once.inputFiles()})

    def tree(edges):
        e = edges.toPandas()
        return sorted(H._lighter([tuple(e[c].to_numpy() for c in "abw")], len(x))[0][2].tolist())

    merged = H._merged(turns, "originator_id", 1000)
    assert merged.count() < turns.count() and tree(merged) == tree(turns) and len(tree(turns)) == len(x) - 1
