"""Exact density hierarchy inside each sender (V6): every merge distance counts, no ladder.

With the mutual reachability distances of :mod:`density`, rounded to ``UNIT``:

1. The minimum spanning tree of a sender holds every merge of its components. A sender that
   fits one tile gets it in its task. For a larger one, every pair of blocks emits the forest of
   the edges between them (a block paired with itself: of those inside), which together hold a
   spanning tree; the pairs are made in turns, so that the copies of rows on disk are bounded.
   Forests of more than ``FINISH`` times ``EDGE_RANGE`` edges together are merged by so many a task while that
   makes them fewer. Up to that number the sender is finished in one task; out of more, Boruvka rounds of
   joins (the lightest edge out of each component, contract, repeat) take the tree first.
2. Going up the tree's distances, components of ``min_cluster_size`` and more are clusters.
   A merge with smaller components continues a cluster, whose members leave it, seen from above,
   at that distance; a merge of two or more clusters ends them and starts a new one.
   Merges at one distance are one merge, so nothing depends on the order of edges. A cluster's
   stability is the sum over its members of 1/(distance at which they leave) less
   1/(distance at which it ends).
3. Of a cluster and the best of those below it, the more stable counts; the topmost that
   are no worse than what is below them are chosen, the one that holds every row only if
   ``allow_single_cluster``. A chosen cluster that ends below ``epsilon`` gives way to
   the first one above it that doesn't (or stands right below the root).

Trees of more than ``EDGE_RANGE`` edges are climbed in ranges of distances: the components of a
range's edges are worked on apart, each in one task, and what they leave (size, open cluster,
sums) is one row a component for the next range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herald import config
from herald.operators.blocks import NORM_FLOOR, unit_matrix
from herald.operators.density import bipartite_forest, connected_components, core_distances, forest, no_cores
from herald.operators.neighbours import TILE_ROWS, Tiling
from herald.session import by_groups, cut_lineage

UNIT = 1e-6
#: No two unit vectors are further apart; components that nothing merges end here.
FARTHEST = 2_000_000
EDGE_RANGE = 1_000_000
FINISH = 4
#: A large sender is dealt to about so many blocks, of one tile at least and so many tiles at most: a
#: row is copied once per block.
BLOCKS = 12
BLOCK_TILES = 16
#: Copies of rows shuffled at once (2 KB each at 512 dimensions); the pairs of blocks are made in so many turns.
TURN_ROWS = 4_000_000
#: Edges merged at once.
MERGE = 1 << 18


def density_of(w: float) -> float:
    """1 / distance, of a distance in units."""
    return 1e6 / max(w, 1)


class Climb:
    """Components going up ascending edges; nodes are components that earlier edges have left.

    ``size``, and for nodes of at least ``min_size`` members the name, sum and best of
    the cluster they are in (name None otherwise). ``ids`` ascend and name new clusters.
    """

    def __init__(self, ids: list, size: list[int], name: list, total: list[float], best: list[float],
                 min_size: int):
        self.ids, self.size, self.name, self.total, self.best = ids, size, name, total, best
        self.min_size, n = min_size, len(ids)
        self.root, self.up = list(range(n)), list(range(n))
        self.joined: list = [None] * n     # the cluster that a small component's members first belong to
        self.first = list(name)
        self.ended: list[tuple] = []       # name, parent, end, own, best below, size

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = x = self.root[self.root[x]]
        return x

    def end(self, node: int, parent, w: float | None) -> float:
        """Close a node's cluster; its value for what is above."""
        own = self.total[node] - (0.0 if w is None else self.size[node] * density_of(w))
        self.ended.append((self.name[node], parent, w, own, self.best[node], self.size[node]))
        return max(own, self.best[node])

    def merge(self, nodes: list[int], w: int) -> None:
        """One component of the components ``nodes``, all meeting at distance ``w``."""
        top, dense = min(nodes), density_of(w)
        clusters = [x for x in nodes if self.name[x] is not None]
        small = [x for x in nodes if self.name[x] is None]
        size, name, total, best = sum(self.size[x] for x in nodes), None, 0.0, 0.0
        if len(clusters) == 1:
            c = clusters[0]
            name, best = self.name[c], self.best[c]
            total = self.total[c] + dense * sum(self.size[x] for x in small)
        elif size >= self.min_size:
            name, total = f"{w:07d}/{self.ids[top]}", dense * size
            best = sum(self.end(x, name, w) for x in clusters)
        if name is not None:
            for x in small:
                self.joined[x] = name
        for x in nodes:
            self.root[x] = self.up[x] = top
        self.size[top], self.name[top], self.total[top], self.best[top] = size, name, total, best

    def run(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> "Climb":
        order = np.argsort(w, kind="stable")
        a, b, w = a[order].tolist(), b[order].tolist(), w[order].tolist()
        i = 0
        while i < len(w):
            level, parts, top = w[i], {}, {}
            while i < len(w) and w[i] == level:
                x, y = self.find(a[i]), self.find(b[i])
                while x in top:
                    x = top[x]
                while y in top:
                    y = top[y]
                if x != y:
                    px, py = parts.pop(x, [x]), parts.pop(y, [y])
                    if len(px) < len(py):
                        x, y, px, py = y, x, py, px
                    px.extend(py)
                    parts[x], top[y] = px, x
                i += 1
            for nodes in parts.values():
                self.merge(nodes, level)
        return self

    def members(self) -> list:
        """Per node the cluster its members first belong to, None while they belong to none."""
        out = []
        for i, parent in enumerate(self.up):
            own = self.joined[i] if self.first[i] is None else self.first[i]
            out.append(own if own is not None or parent == i else out[parent])
        return out

    def finish(self) -> "Climb":
        """End the clusters that are left: the root, or trees that nothing joins."""
        left = [i for i in range(len(self.ids)) if self.root[i] == i]
        for i in left:
            if self.name[i] is not None:
                self.end(i, None, None if len(left) == 1 else FARTHEST)
        return self


def choose(ended: list[tuple], epsilon: float, allow_single_cluster: bool) -> dict:
    """Each cluster's chosen cluster (itself or one above it) or None."""
    parent = {c: p for c, p, *_ in ended}
    end = {c: w for c, _, w, *_ in ended}
    top: dict = {}
    for c, p, w, own, best, _ in reversed(ended):     # from above
        keep = own >= best and (w is not None or allow_single_cluster)
        top[c] = top.get(p) or (c if keep else None)

    def settled(c) -> bool:
        p = parent[c]
        return p is None or end[c] >= epsilon or (end[p] is None and not allow_single_cluster)

    final = set()
    for c in {x for x in top.values() if x is not None}:
        while not settled(c):
            c = parent[c]
        final.add(c)
    out: dict = {}
    for c, p, *_ in reversed(ended):
        out[c] = out.get(p) or (c if c in final else None)
    return out


def _numbers(ids: list, chosen: list) -> np.ndarray:
    """Labels from 0 in the order of clusters' first members, -1 for None."""
    number: dict = {}
    for _, c in sorted((i, c) for i, c in zip(ids, chosen) if c is not None):
        number.setdefault(c, len(number))
    return np.array([number.get(c, -1) for c in chosen], dtype=np.int32)


def reach_units(x: np.ndarray, y: np.ndarray, core_x: np.ndarray, core_y: np.ndarray) -> np.ndarray:
    """Mutual reachability in units (inf where a core distance is)."""
    d = np.sqrt(np.clip(2 - 2 * (x @ y.T), 0, None))
    return np.rint(np.maximum(d, np.maximum(core_x[:, None], core_y[None, :])) / UNIT)


def _block(group: pa.Table, key: str, epsilon: float, allow_single_cluster: bool) -> pa.Table:
    """Labels of a sender that fits one tile."""
    group = group.sort_by("id")
    x, n = unit_matrix(group["vec"]), group.num_rows
    k, core = group["min_samples"][0].as_py() - 1, np.zeros(n)
    if k > 0:
        d = np.sqrt(np.clip(2 - 2 * (x @ x.T), 0, None))
        np.fill_diagonal(d, np.inf)
        core = np.partition(d, k - 1, axis=1)[:, k - 1] if n > k else np.full(n, np.inf)
    w = reach_units(x, x, core, core)
    np.fill_diagonal(w, np.inf)
    ids = group["id"].to_pylist()
    a, b, d = forest(w)
    climb = Climb(ids, [1] * n, [None] * n, [0.0] * n, [0.0] * n, group["min_size"][0].as_py()) \
        .run(a, b, d.astype(np.int64)).finish()
    chosen = choose(climb.ended, epsilon / UNIT, allow_single_cluster)
    return pa.table({key: group[key], "id": group["id"],
                     "cluster_label": pa.array(_numbers(ids, [chosen.get(c) for c in climb.members()]))})


# ---------------------------------------------------------------- senders of many tiles

def blocks(points: DataFrame, key: str, tile_rows: int) -> Tiling:
    """Rows dealt by id and all pairs of blocks: no distance is too far for the hierarchy, so pivots rule out none."""
    rows = F.least(F.lit(BLOCK_TILES * tile_rows), F.greatest(F.lit(tile_rows), F.ceil(F.col("n") / BLOCKS)))
    sizes = cut_lineage(points.groupBy(key).agg(F.count("*").alias("n")).select(key, F.ceil(F.col("n") / rows).alias("blocks")))

    def numbers(of):
        return F.explode(F.sequence(of, F.col("blocks") - 1))

    pairs = sizes.withColumn("a", numbers(F.lit(0).cast("long"))).withColumn("b", numbers(F.col("a"))) \
        .select(key, F.concat_ws("|", "a", "b").alias("pair"), "a", "b")
    return Tiling(points.join(sizes, key).select(key, "id", "vec", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("tile")),
                  cut_lineage(pairs), key)


def _lighter(edges: list[tuple], n: int) -> list[tuple]:
    """One forest of several forests' edges (a, b, w) over ``n`` nodes."""
    a, b, w = (np.concatenate(e) for e in zip(*edges))
    order = np.argsort(w, kind="stable")
    a, b, w = a[order], b[order], w[order]
    root, keep = list(range(n)), []
    for start in range(0, len(a), MERGE):
        for i, (x, y) in enumerate(zip(a[start:start + MERGE].tolist(), b[start:start + MERGE].tolist()), start):
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            if x != y:
                root[x] = y
                keep.append(i)
    return [(a[keep], b[keep], w[keep])]


def _rows_of(group: pa.Table, side: int) -> tuple:
    """Ids in ascending order, vectors as they came and core distances of one side of a pair of blocks."""
    at = np.flatnonzero(group["side"].to_numpy() == side)
    ids = group["id"].to_numpy()[at]
    order = np.argsort(ids, kind="stable")
    at, place, x, start = at[order], np.full(len(group), -1), np.zeros((0, 0), dtype=np.float32), 0
    place[at] = np.arange(len(at))
    for chunk in (c for c in group["vec"].chunks if len(c)):  # no second copy of both sides
        rows = chunk.flatten().to_numpy(zero_copy_only=False).reshape(len(chunk), -1)
        x = x if len(x) or not len(at) else np.empty((len(at), rows.shape[1]), dtype=rows.dtype)
        to = place[start:start + len(chunk)]
        start += len(chunk)
        if len(at):
            x[to[to >= 0]] = rows[to >= 0]
    return ids[order], x, group["core"].fill_null(np.inf).to_numpy()[at]


def _units(x: np.ndarray) -> np.ndarray:
    """:func:`unit_matrix` of some rows: a block is held as it came, only the rows at work are doubles."""
    x = x.astype(np.float64)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), NORM_FLOOR)


def tile_forests(tiling: Tiling, cores: DataFrame | None, step: int = TILE_ROWS, turn_rows: int = TURN_ROWS) -> DataFrame:
    """``key, a, b, w``: the edges of a spanning forest of every pair of blocks, ``step`` by ``step`` rows at a time.

    ``cores`` None: no core distance exceeds an edge's. Some ``turn_rows`` rows are copied at once.
    """
    key, types = tiling.key, dict(tiling.rows.dtypes)

    def run(group: pa.Table) -> pa.Table:
        alone, keys = group["alone"][0].as_py(), group[key].combine_chunks().slice(0, 1)
        left, x, cx = _rows_of(group, 0)
        right, y, cy = (left, x, cx) if alone else _rows_of(group, 1)
        ids, first = left if alone else np.concatenate([left, right]), 0 if alone else len(left)
        del group
        edges = [(np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0))]
        for i in range(0, len(x), step):
            p = _units(x[i:i + step])
            for j in range(i if alone else 0, len(y), step):
                w = reach_units(p, _units(y[j:j + step]), cx[i:i + step], cy[j:j + step])
                if alone and i == j:
                    np.fill_diagonal(w, np.inf)
                    a, b, d = forest(w)
                    edges.append((a + i, b + i, d))
                else:
                    a, b, d = bipartite_forest(w)
                    a, b = (np.where(e < len(w), e + i, e - len(w) + j + first) for e in (a, b))
                    edges.append((a, b, d))
            if len(y) > step:
                edges = _lighter(edges, len(ids))
        a, b, d = _lighter(edges, len(ids))[0] if len(edges) > 2 else edges[-1]
        return pa.table({key: keys.take(pa.array(np.zeros(len(a), dtype=int))), "a": ids[a], "b": ids[b],
                         "w": d.astype(np.int64)})

    schema = f"`{key}` {types[key]}, a {types['id']}, b {types['id']}, w long"
    rows = tiling.rows.withColumn("core", F.lit(0.0)) if cores is None else tiling.rows.join(cores, [key, "id"])
    size = tiling.rows.groupBy(key, "tile").agg(F.count("*").alias("n"))
    pairs = tiling.pairs.join(size.select(key, F.col("tile").alias("a"), F.col("n").alias("na")), [key, "a"]) \
        .join(size.select(key, F.col("tile").alias("b"), F.col("n").alias("nb")), [key, "b"])
    made, copies = pairs.agg(F.count("*"), F.sum(F.when(F.col("a") == F.col("b"), F.col("na")).otherwise(F.col("na") + F.col("nb")))).first()
    turns, edges = -(-(copies or 0) // turn_rows) or 1, None
    turn = F.pmod(F.xxhash64(key, "pair"), F.lit(turns))
    for i in range(turns):
        groups = Tiling(rows, tiling.pairs.filter(turn == i), key).groups(grouped=False)
        part = cut_lineage(by_groups(groups, -(-made // turns), key, "pair").applyInArrow(run, schema))
        edges = part if edges is None else edges.unionByName(part)
    return edges


def _merged(edges: DataFrame, key: str, most: int) -> DataFrame:
    """Forests merged, some ``most`` edges a task, while that makes the edges of a sender fewer."""
    types = dict(edges.dtypes)

    def run(group: pa.Table) -> pa.Table:
        ends = np.concatenate([group[c].to_numpy() for c in ("a", "b")])
        ids, at = np.unique(ends, return_inverse=True)
        a, b, w = _lighter([(at[:len(at) // 2], at[len(at) // 2:], group["w"].to_numpy())], len(ids))[0]
        return pa.table({key: group[key].take(pa.array(np.zeros(len(a), dtype=int))), "a": ids[a], "b": ids[b], "w": w})

    while True:
        sizes = cut_lineage(edges.groupBy(key).agg(F.count("*").alias("e")).select(key, F.ceil(F.col("e") / most).alias("parts"), "e"))
        many, before = sizes.filter("parts > 1").agg(F.sum("parts"), F.sum("e")).first()
        if not many:
            return edges
        dealt = edges.join(sizes.filter("parts > 1").select(key, "parts"), key) \
            .withColumn("part", F.pmod(F.xxhash64("a", "b"), F.col("parts"))).drop("parts")
        less = cut_lineage(by_groups(dealt, many, key, "part").applyInArrow(run, f"`{key}` {types[key]}, a {types['a']}, b {types['b']}, w long"))
        done = 2 * less.count() > before
        edges = edges.join(sizes.filter("parts = 1").select(key), key, "left_semi").unionByName(less)
        if done:
            return edges


def _finished(points: DataFrame, edges: DataFrame, key: str, epsilon: float, allow_single_cluster: bool) -> DataFrame:
    """``key, id, cluster_label`` of senders whose edges (a spanning tree among them) fit one task."""
    types = dict(points.dtypes)

    def run(nodes: pa.Table, links: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("id")
        ids, n = nodes["id"].to_numpy(), nodes.num_rows
        a, b = (np.searchsorted(ids, links[c].to_numpy()) for c in ("a", "b"))
        climb = Climb(ids.tolist(), [1] * n, [None] * n, [0.0] * n, [0.0] * n, nodes["min_size"][0].as_py()) \
            .run(a, b, links["w"].to_numpy()).finish()
        chosen = choose(climb.ended, epsilon / UNIT, allow_single_cluster)
        return pa.table({key: nodes[key], "id": nodes["id"],
                         "cluster_label": pa.array(_numbers(climb.ids, [chosen.get(c) for c in climb.members()]))})

    return points.select(key, "id", "min_size").groupBy(key).cogroup(edges.select(key, "a", "b", "w").groupBy(key)) \
        .applyInArrow(run, f"`{key}` {types[key]}, id {types['id']}, cluster_label int")


def spanning_tree(edges: DataFrame, key: str) -> DataFrame:
    """``key, a, b, w`` of a minimum spanning forest of ``edges``, by Boruvka rounds.

    Edges are ordered by weight and then ends, so all components agree on which is lighter and no
    cycle arises. A round at least halves the components that have an edge out.
    """
    ends = F.least("a", "b"), F.greatest("a", "b")
    e = cut_lineage(edges.select(key, ends[0].alias("a"), ends[1].alias("b"), "w").filter("a <> b")
                    .groupBy(key, "a", "b").agg(F.min("w").alias("w"))
                    .withColumn("ca", F.col("a")).withColumn("cb", F.col("b")))
    tree = None
    while True:
        edge = F.struct("w", "a", "b", "ca", "cb")
        lightest = e.select(key, F.explode(F.array("ca", "cb")).alias("c"), edge.alias("e")) \
            .groupBy(key, "c").agg(F.min("e").alias("e"))
        picked = cut_lineage(lightest.select(key, "e.*").distinct())
        if tree is not None and not picked.limit(1).count():
            return tree
        own = picked.select(key, "a", "b", "w")
        tree = own if tree is None else tree.unionByName(own)
        links = picked.select(key, F.col("ca").alias("a"), F.col("cb").alias("b"))
        nodes = links.select(key, F.explode(F.array("a", "b")).alias("id"))
        at = connected_components(nodes, links, key)
        joined = e.drop("ca", "cb").join(e.select(key, "a", "b", "ca", "cb"), [key, "a", "b"])
        for c in ("ca", "cb"):
            joined = joined.join(at.select(key, F.col("id").alias(c), F.col("comp").alias(f"{c}_new")), [key, c]) \
                .drop(c).withColumnRenamed(f"{c}_new", c)
        # of parallel edges between two components only the lightest can matter
        low, high = F.least("ca", "cb"), F.greatest("ca", "cb")
        e = cut_lineage(joined.filter("ca <> cb").groupBy(key, low.alias("ca"), high.alias("cb"))
                        .agg(F.min(F.struct("w", "a", "b")).alias("e")).select(key, "e.a", "e.b", "e.w", "ca", "cb"),
                        replaces=e)


def _ranges(tree: DataFrame, key: str, edge_range: int) -> DataFrame:
    """``tree`` with ``range``: edges of a sender by ascending distance, about ``edge_range`` a range.

    Edges of one distance share a range. Counts are per distance, of which there are at most
    ``FARTHEST``, so no window sees a sender's edges.
    """
    counts = tree.groupBy(key, "w").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(key).orderBy("w")) - F.col("n")
    return tree.join(counts.select(key, "w", F.floor(before / edge_range).alias("range")), [key, "w"])


def _climb_step(state: DataFrame, edges: DataFrame, key: str, id_type: str, key_type: str) -> DataFrame:
    """What the groups' climbs leave: rows of kind state, alias (node to its component), member and ended."""
    schema = (f"`{key}` {key_type}, kind string, id {id_type}, to {id_type}, name string, parent string, "
              "w long, size long, own double, best double")
    names = [key, "kind", "id", "to", "name", "parent", "w", "size", "own", "best"]

    def run(nodes: pa.Table, links: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("id")
        ids = nodes["id"].to_pylist()
        at = {x: i for i, x in enumerate(ids)}
        c = Climb(ids, *(nodes[f].to_pylist() for f in ("size", "name", "total", "best")),
                  nodes["min_size"][0].as_py() if ids else 1)
        c.run(np.array([at[x] for x in links["a"].to_pylist()], dtype=int),
              np.array([at[x] for x in links["b"].to_pylist()], dtype=int), links["w"].to_numpy())
        out = [("alias", ids[i], ids[c.find(i)], None, None, None, None, None, None) for i in range(len(ids))]
        out += [("state", ids[i], None, c.name[i], None, None, c.size[i], c.total[i], c.best[i])
                for i in range(len(ids)) if c.root[i] == i]
        out += [("member", ids[i], None, m, None, None, None, None, None)
                for i, m in enumerate(c.members()) if m is not None and c.first[i] is None]
        out += [("ended", None, None, name, p, w, s, own, b) for name, p, w, own, b, s in c.ended]
        k = nodes[key][0].as_py() if ids else None
        columns = list(zip(*((k, *r) for r in out))) or [[]] * len(names)
        types = [nodes.schema.field(key).type, pa.string(), *[nodes.schema.field("id").type] * 2, pa.string(),
                 pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(v, t) for v, t in zip(columns, types)], names=names)

    return state.groupBy(key, "g").cogroup(edges.groupBy(key, "eg")).applyInArrow(run, schema)


def _clusters(points: DataFrame, tree: DataFrame, key: str, edge_range: int) -> tuple[DataFrame, DataFrame]:
    """``(ended, members)``: all clusters (key, name, parent, w, own, best) and each point's first one."""
    types = dict(points.dtypes)
    tree = cut_lineage(_ranges(tree, key, edge_range))
    n_ranges = (tree.agg(F.max("range")).first()[0] or 0) + 1
    state = points.select(key, "id", "min_size", F.lit(1).cast("long").alias("size"), F.lit(None).cast("string").alias("name"),
                          F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
    at = points.select(key, F.col("id").alias("point"), "id", F.lit(None).cast("string").alias("cluster"))
    size = points.groupBy(key).agg(F.min("min_size").alias("min_size"))
    ended = None
    for r in range(n_ranges):
        here = tree.filter(F.col("range") == r).select(key, "a", "b", "w")
        for c in ("a", "b"):
            here = here.join(at.select(key, F.col("point").alias(c), F.col("id").alias(f"{c}_at")), [key, c]) \
                .drop(c).withColumnRenamed(f"{c}_at", c)
        here = cut_lineage(here)
        if n_ranges == 1:
            groups = points.select(key, "id", F.lit("").alias("g"))
            here = here.withColumn("eg", F.lit(""))
        else:
            groups = connected_components(here.select(key, F.explode(F.array("a", "b")).alias("id")), here, key) \
                .withColumnRenamed("comp", "g")
            here = here.join(groups.select(key, F.col("id").alias("a"), F.col("g").alias("eg")), [key, "a"])
        step = cut_lineage(_climb_step(state.join(groups, [key, "id"]), here, key, types["id"], types[key]))
        left = step.filter("kind = 'state'").select(key, "id", "size", "name", F.col("own").alias("total"), "best") \
            .join(size, key)
        state = cut_lineage(state.join(groups, [key, "id"], "left_anti").unionByName(left))
        new = step.filter("kind = 'ended'").select(key, "name", "parent", "w", "own", "best")
        ended = new if ended is None else ended.unionByName(new)
        member = step.filter("kind = 'member'").select(key, "id", F.col("name").alias("joins"))
        alias = step.filter("kind = 'alias'").select(key, "id", "to")
        at = cut_lineage(at.join(member, [key, "id"], "left").join(alias, [key, "id"], "left").select(
            key, "point", F.coalesce("to", "id").alias("id"), F.coalesce("cluster", "joins").alias("cluster")))
    alone = state.groupBy(key).agg((F.count("*") == 1).alias("alone"))
    last = state.filter("name is not null").join(alone, key).select(
        key, "name", F.lit(None).cast("string").alias("parent"),
        F.when(~F.col("alone"), F.lit(FARTHEST)).cast("long").alias("w"),
        (F.col("total") - F.when(F.col("alone"), 0.0).otherwise(F.col("size") * F.lit(density_of(FARTHEST)))).alias("own"),
        "best")
    return cut_lineage(ended.unionByName(last)), at.select(key, F.col("point").alias("id"), "cluster")


def _first_above(ended: DataFrame, key: str, hit, topmost: bool) -> DataFrame:
    """``key, name, found``: the topmost or the nearest cluster at or above each that is a ``hit``.

    By pointer doubling, so the rounds grow with the logarithm of the hierarchy's depth.
    """
    jumps = cut_lineage(ended.select(key, "name", F.col("parent").alias("up"), F.when(hit, F.col("name")).alias("found")))
    while jumps.filter("up is not null").limit(1).count():
        above = jumps.select(key, F.col("name").alias("up"), F.col("up").alias("next"), F.col("found").alias("higher"))
        order = ("higher", "found") if topmost else ("found", "higher")
        jumps = cut_lineage(jumps.join(above, [key, "up"], "left").select(
            key, "name", F.col("next").alias("up"), F.coalesce(*order).alias("found")), replaces=jumps)
    return jumps.select(key, "name", "found")


def _chosen(ended: DataFrame, key: str, epsilon: float, allow_single_cluster: bool) -> DataFrame:
    """:func:`choose` over tables: ``key, cluster, chosen``."""
    keep = (F.col("own") >= F.col("best")) & (F.col("w").isNotNull() | F.lit(allow_single_cluster))
    top = _first_above(ended, key, keep, topmost=True).filter("found is not null").select(key, F.col("found").alias("name")) \
        .distinct()
    roots = ended.filter("parent is null and w is null").select(key, F.col("name").alias("parent"), F.lit(True).alias("below_root"))
    known = ended.join(roots, [key, "parent"], "left")
    settled = F.col("parent").isNull() | (F.col("w") >= F.lit(epsilon / UNIT)) | \
        (F.coalesce("below_root", F.lit(False)) & F.lit(not allow_single_cluster))
    final = top.join(_first_above(known, key, settled, topmost=False), [key, "name"]) \
        .select(key, F.col("found").alias("name"), F.lit(True).alias("final")).distinct()
    return _first_above(ended.join(final, [key, "name"], "left"), key, F.col("final"), topmost=True) \
        .filter("found is not null").select(key, F.col("name").alias("cluster"), F.col("found").alias("chosen"))


def _large(points: DataFrame, key: str, epsilon: float, allow_single_cluster: bool, tile_rows: int,
           edge_range: int) -> DataFrame:
    """``key, id, cluster_label`` of senders of any size; rows may be left out as noise."""
    # from here on ids are numbers in the same order
    numbered = cut_lineage(points.select(key, "id").repartitionByRange(key, "id").sortWithinPartitions(key, "id")
                           .withColumn("nr", F.monotonically_increasing_id()))
    points = cut_lineage(points.join(numbered, [key, "id"]).drop("id").withColumnRenamed("nr", "id"), replaces=points)
    tiling = blocks(points, key, tile_rows)
    samples = points.groupBy(key).agg(F.min("min_samples").alias("min_samples"))
    cores = None if no_cores(samples) else cut_lineage(core_distances(tiling, samples, FARTHEST * UNIT))
    edges = _merged(tile_forests(tiling, cores), key, FINISH * edge_range)
    small = cut_lineage(points.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") <= edge_range)
                        .join(edges.groupBy(key).agg(F.count("*").alias("e")), key, "left")
                        .filter(F.coalesce("e", F.lit(0)) <= FINISH * edge_range).select(key))
    labels = _finished(points.join(small, key, "left_semi"), edges.join(small, key, "left_semi"), key, epsilon,
                       allow_single_cluster)
    points, edges = points.join(small, key, "left_anti"), edges.join(small, key, "left_anti")
    if points.limit(1).count():
        labels = labels.unionByName(_ranged(points, spanning_tree(edges, key), key, epsilon, allow_single_cluster, edge_range))
    return labels.withColumnRenamed("id", "nr").join(numbered, [key, "nr"]).select(key, "id", "cluster_label")


def _ranged(points: DataFrame, tree: DataFrame, key: str, epsilon: float, allow_single_cluster: bool,
            edge_range: int) -> DataFrame:
    """``key, id, cluster_label`` (noise left out) by ranges of the tree."""
    ended, members = _clusters(points.select(key, "id", "min_size"), tree, key, edge_range)
    found = cut_lineage(members.join(_chosen(ended, key, epsilon, allow_single_cluster), [key, "cluster"]))
    number = F.dense_rank().over(Window.partitionBy(key).orderBy("first")) - 1
    numbers = found.groupBy(key, "chosen").agg(F.min("id").alias("first")).withColumn("cluster_label", number.cast("int"))
    return found.join(numbers, [key, "chosen"]).select(key, "id", "cluster_label")


# V6
def exact_clusters(df: DataFrame, min_cluster_size=config.PROFILE_MIN_CLUSTER_SIZE, min_samples=config.PROFILE_MIN_SAMPLES,
                   epsilon: float = config.PROFILE_SELECTION_EPSILON, key: str = "originator_id",
                   id_col: str = "template_hash", vec_col: str = "embedding", tile_rows: int = TILE_ROWS,
                   allow_single_cluster: bool = False, edge_range: int = EDGE_RANGE) -> DataFrame:
    """``df`` + ``cluster_label`` (-1 = noise) by excess of mass over the exact hierarchy.

    Clusters are numbered by their first member. ``min_cluster_size`` and ``min_samples`` (the row
    itself counts) are ints or names of per-sender columns; ``id_col`` must be unique in a
    sender. Rows of one distance apart (copies too) merge at once.
    """
    def value(x):
        return (F.col(x) if isinstance(x, str) else F.lit(x)).cast("int")

    points = df.select(key, F.col(id_col).alias("id"), F.col(vec_col).cast("array<float>").alias("vec"),
                       value(min_cluster_size).alias("min_size"), value(min_samples).alias("min_samples"))
    types = dict(points.dtypes)
    large = cut_lineage(points.groupBy(key).count().filter(F.col("count") > tile_rows).select(key))
    labels = points.join(large, key, "left_anti").groupBy(key).applyInArrow(
        lambda group: _block(group, key, epsilon, allow_single_cluster),
        f"`{key}` {types[key]}, id {types['id']}, cluster_label int")
    if large.limit(1).count():
        labels = labels.unionByName(_large(cut_lineage(points.join(large, key, "left_semi")), key, epsilon,
                                           allow_single_cluster, tile_rows, edge_range))
    return df.join(labels.withColumnRenamed("id", id_col), [key, id_col], "left") \
        .withColumn("cluster_label", F.coalesce("cluster_label", F.lit(-1)))
