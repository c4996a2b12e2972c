"""Density clustering of templates inside each sender.

Re-aimed from a single-machine hierarchical density clusterer (distances
``d = sqrt(2 - 2 cos)`` on unit vectors):

1. core distance = distance to the (min_samples - 1)-th other neighbour
   (the point itself counts, as in the published definition);
2. mutual reachability w(a, b) = max(core_a, core_b, d(a, b));
3. a cluster is a connected component of {w <= eps}: at one level (V5), or the
   most stable ones of a ladder of levels (V6, excess of mass);
4. components below the sender's minimum size are noise (-1), the others are
   numbered 0.. by level and smallest member.

A sender that fits one tile is finished in that tile's task, labels included. A
larger one goes through the pivot-pruned tile pairs of :mod:`neighbours`: each
pair emits its nearest distances, then the close tile pairs of two blocks of tiles are
made in one task, which hands on at most one edge per row, and the sender's edges
are merged to its components. At one level, most tile pairs need not be made: two
rows already known to be in one component learn nothing from each other, see
:func:`flat_components`. All ways give the same labels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herald import config
from herald.operators.blocks import unit_matrix
from herald.operators.neighbours import TILE_ROWS, Tiling, cos_to_dist, knn_distances, sides, tile
from herald.session import by_groups, cut_lineage

__all__ = ["cos_to_dist", "core_distances", "connected_components", "density_clusters", "eom_clusters"]

#: The level at which components that no level of the ladder merges are taken to be born: no two unit
#: vectors are further apart.
BIRTH = 2.0
#: Tiles of a block: a row is copied once per block that its own meets.
BLOCK_TILES = 8
#: Senders of up to so many rows and edges between blocks are merged in one task.
MERGE_ROWS = 1_000_000
MERGE_EDGES = 4_000_000


def core_distances(tiling: Tiling, samples: DataFrame, eps_max: float) -> DataFrame:
    """``key, id, core`` (null = farther than ``eps_max``); ``samples``: key, min_samples."""
    key, nodes = tiling.key, tiling.rows.select(tiling.key, "id")
    k = (samples.agg(F.max("min_samples")).first()[0] or 1) - 1
    if k < 1:
        return nodes.withColumn("core", F.lit(0.0))
    knn = knn_distances(tiling.rows, k, eps_max, key, "id", "vec", tiling=tiling)
    return nodes.join(samples, key).join(
        knn.withColumn("min_samples", F.col("nr") + 1), [key, "id", "min_samples"], "left") \
        .select(key, "id", F.when(F.col("min_samples") <= 1, 0.0).otherwise(F.col("d")).alias("core"))


def no_cores(samples: DataFrame) -> bool:
    """Up to two samples, a core distance is at most that to the nearest row: it never exceeds an edge's."""
    return not samples.filter(F.col("min_samples") > 2).limit(1).count()


def forest(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (a, b, weight) of a minimum spanning forest of a dense matrix, ascending (inf: no edge)."""
    m = len(w)
    out_of_tree, best, parent = np.ones(m, dtype=bool), np.full(m, np.inf), np.full(m, -1)
    edges = []
    for _ in range(m):
        reach = np.where(out_of_tree, best, np.inf)
        u = int(reach.argmin())
        if np.isfinite(reach[u]):
            edges.append((parent[u], u, best[u]))
        else:
            u = int(out_of_tree.argmax())
        out_of_tree[u] = False
        closer = out_of_tree & (w[u] < best)
        best[closer], parent[closer] = w[u][closer], u
    if not edges:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0)
    a, b, d = map(np.array, zip(*sorted(edges, key=lambda e: e[2])))
    return a.astype(int), b.astype(int), d


def bipartite_forest(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`forest` of the edges between rows and columns; columns are numbered after the rows."""
    m, n = w.shape
    sides, nodes = (w, np.ascontiguousarray(w.T)), m + n
    outside, best, parent = np.ones(nodes, dtype=bool), np.full(nodes, np.inf), np.full(nodes, -1)
    across, a, b, d, start = (slice(m, nodes), slice(0, m)), [], [], [], 0
    for _ in range(nodes):
        u = int(best.argmin())
        if best[u] != np.inf:
            a.append(parent[u])
            b.append(u)
            d.append(best[u])
        else:
            start += int(outside[start:].argmax())
            u = start
        outside[u], best[u] = False, np.inf
        row, to = (sides[0][u], across[0]) if u < m else (sides[1][u - m], across[1])
        closer = (row < best[to]) & outside[to]
        best[to][closer], parent[to][closer] = row[closer], u
    d = np.array(d, dtype=float)
    order = np.argsort(d, kind="stable")
    return np.array(a, dtype=int)[order], np.array(b, dtype=int)[order], d[order]


def ladder(w: np.ndarray, levels: list[float]) -> list[np.ndarray]:
    """Per ascending level, each node's component: its smallest node."""
    return components_of(len(w), *forest(np.where(w <= levels[-1], w, np.inf)), levels)


def components_of(n: int, a: np.ndarray, b: np.ndarray, d: np.ndarray, levels: list[float]) -> list[np.ndarray]:
    """:func:`ladder` of ``n`` nodes with ascending edges."""
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out, done = [], 0
    for level in levels:
        while done < len(d) and d[done] <= level:
            x, y = find(a[done]), find(b[done])
            root[max(x, y)] = min(x, y)
            done += 1
        out.append(np.array([find(x) for x in range(n)], dtype=int))
    return out


def reachability(x: np.ndarray, y: np.ndarray, core_x: np.ndarray, core_y: np.ndarray) -> np.ndarray:
    d = np.sqrt(np.clip(2 - 2 * (x @ y.T), 0, None))
    return np.maximum(d, np.maximum(core_x[:, None], core_y[None, :]))


def most_stable(comps: list[np.ndarray], levels: list[float], min_size: int,
                allow_single_cluster: bool) -> list[tuple[int, int]]:
    """Excess-of-mass selection: the chosen (level number, component) of one sender.

    A component of at least ``min_size`` members is stable in proportion to its
    size and to how much lower its density level is than its parent's (in
    1/eps); one with a single child continues that child. Bottom-up, the better
    of a component and its children counts; top-down, a component that is no worse is
    chosen, and nothing below it. The component that holds every row is the
    root and is chosen only if ``allow_single_cluster``.
    """
    lam = [1 / max(e, 1e-12) for e in levels] + [1 / BIRTH]
    best, nodes = {}, []
    for li, comp in enumerate(comps):
        sums, level_best = {}, {}
        for own, sub, parent in best.values():
            n, o, s, b = sums.get(parent, (0, 0.0, 0.0, 0.0))
            sums[parent] = (n + 1, o + own, s + sub, b + max(own, sub))
        members, sizes = np.unique(comp, return_counts=True)
        for c, size in zip(members.tolist(), sizes.tolist()):
            if size < min_size:
                continue
            n, child_own, child_sub, child_best = sums.get(c, (0, 0.0, 0.0, 0.0))
            own = size * (lam[li] - lam[li + 1]) + (child_own if n == 1 else 0.0)
            sub = child_sub if n == 1 else child_best
            parent = int(comps[li + 1][c]) if li + 1 < len(comps) else None
            keep = own >= sub and (allow_single_cluster or size < len(comp))
            level_best[c] = (own, sub, parent)
            nodes.append((li, c, parent, keep))
        best = level_best
    chosen, covered = [], set()
    for li, c, parent, keep in sorted(nodes, key=lambda n: -n[0]):
        if (li + 1, parent) in covered:
            covered.add((li, c))
        elif keep:
            covered.add((li, c))
            chosen.append((li, c))
    return sorted(chosen)


def block_labels(vectors: np.ndarray, min_size: int, min_samples: int, levels: list[float],
                 select_stable: bool, allow_single_cluster: bool) -> np.ndarray:
    """Labels of a sender whose rows, in order of id, fit one block."""
    n = len(vectors)
    core = np.zeros(n)
    if min_samples > 1:
        d = np.sqrt(np.clip(2 - 2 * (vectors @ vectors.T), 0, None))
        np.fill_diagonal(d, np.inf)
        core = np.partition(d, min_samples - 2, axis=1)[:, min_samples - 2] if n >= min_samples else \
            np.full(n, np.inf)
    w = reachability(vectors, vectors, core, core)
    np.fill_diagonal(w, np.inf)
    comps = ladder(w, levels)
    if select_stable:
        chosen = most_stable(comps, levels, min_size, allow_single_cluster)
    else:
        members, sizes = np.unique(comps[0], return_counts=True)
        chosen = [(0, int(c)) for c, s in zip(members, sizes) if s >= min_size]
    label = np.full(n, -1, dtype=np.int32)
    for i, (li, c) in enumerate(chosen):
        label[comps[li] == c] = i
    return label


def local_components(tiling: Tiling, cores: DataFrame | None, levels: list[float]) -> DataFrame:
    """``key, level, a, b``: per tile pair and level, each row's component by its first row (rows that
    are their own component are left out). Without ``cores`` the tiling's rows have a column ``core``."""
    key, types = tiling.key, dict(tiling.rows.dtypes)

    def run(group: pa.Table) -> pa.Table:
        left, right, alone = sides(group)
        if not left.num_rows or not right.num_rows:
            return pa.table({key: group[key].slice(0, 0), "level": pa.array([], pa.int32()),
                             "a": group["id"].slice(0, 0), "b": group["id"].slice(0, 0)})
        x, core = unit_matrix(left["vec"]), left["core"].fill_null(np.inf).to_numpy()
        if alone:
            both, w = left, reachability(x, x, core, core)
            np.fill_diagonal(w, np.inf)
            comps = ladder(w, levels)
        else:  # edges inside a tile are those of the tile paired with itself
            both = pa.concat_tables([left, right])
            w = reachability(x, unit_matrix(right["vec"]), core, right["core"].fill_null(np.inf).to_numpy())
            comps = components_of(len(both), *bipartite_forest(np.where(w <= levels[-1], w, np.inf)), levels)
        out = []
        for li, comp in enumerate(comps):
            i = np.flatnonzero(comp != np.arange(len(comp)))
            out.append(pa.table({key: both[key].take(pa.array(i)),
                                 "level": pa.array(np.full(len(i), li, dtype=np.int32)),
                                 "a": both["id"].take(pa.array(i)), "b": both["id"].take(pa.array(comp[i]))}))
        return pa.concat_tables(out)

    return tiling.groups(cores).applyInArrow(
        run, f"`{key}` {types[key]}, level int, a {types['id']}, b {types['id']}")


def join_components(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of the nodes ``a`` and ``b``, pair by pair; ``root``: each node's smallest member."""
    while True:
        low, high = root[a], root[b]
        apart = low != high
        if not apart.any():
            return
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        root[np.maximum(low, high)] = np.minimum(low, high)  # where several meet one holds, the others are left
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def meet_components(root: np.ndarray, p: np.ndarray, q: np.ndarray, close: np.ndarray) -> list[tuple]:
    """Joins the components of the rows ``p`` and columns ``q`` of ``close``; the pairs that did it.

    Every component with a close pair to another one takes part in one of them per round.
    """
    used = []
    while True:
        cp, cq = root[p], root[q]
        most = np.bincount(np.concatenate([cp, cq])).argmax()
        (out_p, in_p), (out_q, _) = ((np.flatnonzero(c != most), np.flatnonzero(c == most)) for c in (cp, cq))
        a, b = [], []
        # what is left: rows outside the largest component with all columns, and columns outside it with rows inside
        for i, j in ((out_p, slice(None)), (in_p, out_q)):
            part = close[i][:, j]
            if not part.size:
                continue
            part = part & (cp[i][:, None] != cq[j])
            rows, cols = np.flatnonzero(part.any(axis=1)), np.flatnonzero(part.any(axis=0))
            a += [p[i][rows], p[i][part[:, cols].argmax(axis=0)]]
            b += [q[j][part[rows].argmax(axis=1)], q[j][cols]]
        a, b = (np.concatenate(x) if x else np.zeros(0, dtype=int) for x in (a, b))
        if not len(a):
            return used
        join_components(root, a, b)
        used.append((a, b))


def block_groups(tiling: Tiling, block_rows: int):
    """Rows grouped by pairs of blocks, with ``side`` and, on the left, the close tiles ``meets`` of the other side.

    A block is a run of a sender's tiles of about ``block_rows`` rows; only blocks with close tiles meet. A block
    that meets itself has the left side alone.
    """
    key, cols = tiling.key, [c for c in tiling.rows.columns if c != tiling.key]
    sizes = tiling.rows.groupBy(key, "tile").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(key).orderBy("tile")) - F.col("n")
    blocks = cut_lineage(sizes.select(key, "tile", F.floor(before / block_rows).alias("block")))
    pairs = tiling.pairs
    for c in ("a", "b"):
        pairs = pairs.join(blocks.select(key, F.col("tile").alias(c), F.col("block").alias(f"of_{c}")), [key, c])
    turned = F.col("of_a") > F.col("of_b")
    pairs = cut_lineage(pairs.select(
        key, F.least("of_a", "of_b").alias("i"), F.greatest("of_a", "of_b").alias("j"),
        F.when(turned, F.col("b")).otherwise(F.col("a")).alias("tile"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("other")))
    left = tiling.rows.join(pairs.groupBy(key, "i", "j", "tile").agg(F.collect_list("other").alias("meets")), [key, "tile"]) \
        .select(key, "i", "j", F.lit(0).alias("side"), "meets", *cols)
    others = pairs.filter("i < j").select(key, "i", "j", F.col("other").alias("tile")).distinct()
    right = tiling.rows.join(others, [key, "tile"]) \
        .select(key, "i", "j", F.lit(1).alias("side"), F.lit(None).cast("array<string>").alias("meets"), *cols)
    return by_groups(left.unionByName(right), pairs.select(key, "i", "j").distinct().count(), key, "i", "j")


def block_components(tiling: Tiling, levels: list[float], block_rows: int) -> DataFrame:
    """``key, level, a, b``: per pair of blocks, edges that join its components at ``level`` and above it, one a row at most.

    The tiling's rows have a column ``core``.
    """
    key, types = tiling.key, dict(tiling.rows.dtypes)

    def run(group: pa.Table) -> pa.Table:
        x, core, ids = unit_matrix(group["vec"]), group["core"].fill_null(np.inf).to_numpy(), group["id"]
        side, tiles = group["side"].to_numpy(), group["tile"].combine_chunks().dictionary_encode()
        number = {t: i for i, t in enumerate(tiles.dictionary.to_pylist())}
        at = tiles.indices.to_numpy()
        right = int(side.max())
        roots = [np.arange(len(x)) for _ in levels]
        for t, i in number.items():
            p = np.flatnonzero((at == i) & (side == 0))
            for other in group["meets"][int(p[0])].as_py() if len(p) else ():
                q = np.flatnonzero((at == number[other]) & (side == right))
                w = reachability(x[p], x[q], core[p], core[q])
                if not right and t == other:
                    np.fill_diagonal(w, np.inf)
                for li, (root, level) in enumerate(zip(roots, levels)):
                    for a, b in meet_components(root, p, q, w <= level):
                        for above in roots[li + 1:]:
                            join_components(above, a, b)
        out, below = [], np.arange(len(x))
        for li, root in enumerate(roots):
            i = np.flatnonzero((below == np.arange(len(x))) & (root != below))  # smallest of their component until here
            out.append(pa.table({key: group[key].take(pa.array(i)), "level": pa.array(np.full(len(i), li, dtype=np.int32)),
                                 "a": ids.take(pa.array(i)), "b": ids.take(pa.array(root[i]))}))
            below = root
        return pa.concat_tables(out)

    return block_groups(tiling, block_rows).applyInArrow(
        run, f"`{key}` {types[key]}, level int, a {types['id']}, b {types['id']}")


def ladder_components(nodes: DataFrame, edges: DataFrame, n_levels: int, key: str, merge_rows: int = MERGE_ROWS,
                      merge_edges: int = MERGE_EDGES) -> DataFrame:
    """``key, level, id, comp`` at every level; ``edges`` (key, level, a, b) hold at their level and above it.

    Senders whose nodes and edges fit one task are merged there, the others by rounds of joins.
    """
    types = dict(nodes.dtypes)
    nodes, edges = nodes.distinct(), cut_lineage(edges)
    few = cut_lineage(nodes.groupBy(key).agg(F.count("*").alias("n")).join(
        edges.groupBy(key).agg(F.count("*").alias("e")), key, "left")
        .filter((F.col("n") <= merge_rows) & (F.coalesce("e", F.lit(0)) <= merge_edges)).select(key))

    def run(own: pa.Table, links: pa.Table) -> pa.Table:
        ids = own["id"].combine_chunks().take(pa.compute.sort_indices(own["id"]))
        a, b = (pa.compute.index_in(links[c], value_set=ids).to_numpy() for c in ("a", "b"))
        level, root, out = links["level"].to_numpy(), np.arange(len(ids)), []
        names = pa.chunked_array([own[key].combine_chunks().slice(0, 1).take(pa.array(np.zeros(len(ids), dtype=int)))])
        for li in range(n_levels):
            join_components(root, a[level == li], b[level == li])
            out.append(pa.table({key: names, "level": pa.array(np.full(len(ids), li, dtype=np.int32)), "id": ids,
                                 "comp": ids.take(pa.array(root))}))
        return pa.concat_tables(out)

    merged = nodes.join(few, key, "left_semi").groupBy(key).cogroup(edges.join(few, key, "left_semi").groupBy(key)) \
        .applyInArrow(run, f"`{key}` {types[key]}, level int, id {types['id']}, comp {types['id']}")
    nodes, edges = nodes.join(few, key, "left_anti"), edges.join(few, key, "left_anti")
    if nodes.limit(1).count():
        every = F.array(*[F.lit(i) for i in range(n_levels)])
        above = edges.withColumn("level", F.explode(F.filter(every, lambda x: x >= F.col("level"))))
        merged = merged.unionByName(connected_components(
            nodes.withColumn("level", F.explode(every)), above, [key, "level"]).select(key, "level", "id", "comp"))
    return cut_lineage(merged)


def connected_components(nodes: DataFrame, edges: DataFrame, key="originator_id") -> DataFrame:
    """``key..., id, comp`` = smallest id of the node's component.

    ``key`` is a column name or a list (e.g. sender and level). Labels start
    at the smallest neighbour; each round propagates the minimum once and
    follows labels twice (pointer jumping). Rounds are written to the shared
    checkpoint folder, the one before is removed, and the loop ends when no
    label changes.
    """
    keys = [key] if isinstance(key, str) else list(key)
    e = edges.select(*keys, "a", "b")
    e = cut_lineage(e.unionByName(e.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    first = e.groupBy(*keys, F.col("a").alias("id")).agg(F.min("b").alias("m"))
    labels = cut_lineage(nodes.select(*keys, "id").distinct().join(first, keys + ["id"], "left")
                         .select(*keys, "id", F.least("id", F.coalesce("m", "id")).alias("comp")))

    def jump(df: DataFrame) -> DataFrame:
        at = df.select(*keys, F.col("id").alias("comp"), F.col("comp").alias("cc"))
        return df.join(at, keys + ["comp"], "left").select(
            *keys, "id", "was", F.least("comp", F.coalesce("cc", "comp")).alias("comp"))

    while True:
        near = e.join(labels.select(*keys, F.col("id").alias("b"), F.col("comp").alias("cb")), keys + ["b"]) \
            .groupBy(*keys, F.col("a").alias("id")).agg(F.min("cb").alias("m"))
        step = labels.join(near, keys + ["id"], "left").select(
            *keys, "id", F.col("comp").alias("was"), F.least("comp", F.coalesce("m", "comp")).alias("comp"))
        labels = cut_lineage(jump(jump(step)), replaces=labels)
        if not labels.filter(F.col("comp") != F.col("was")).limit(1).count():
            return labels.drop("was")


def flat_components(tiling: Tiling, cores: DataFrame | None, eps: float, block_rows: int = TILE_ROWS) -> DataFrame:
    """``key, level, id, comp`` at the one level ``eps`` (numbered 0), without making all tile pairs.

    Tiles meet themselves and one other tile each, which gives preliminary components.
    An edge inside the sender's largest one joins nothing, so only the rows outside it, the rest,
    still meet all rows of the tiles close to theirs: in blocks of about ``block_rows`` of them, so that a
    tile is copied once per block of the rest. A rest row hands on a single edge to the largest
    component, and each pair of rest rows is made once. Without a large component the rest is
    all rows, and every tile pair is made. ``cores`` None: no row's core distance exceeds ``eps`` where it has an edge.
    """
    key, types = tiling.key, dict(tiling.rows.dtypes)
    rows = tiling.rows.withColumn("core", F.lit(0.0)) if cores is None else tiling.rows.join(cores, [key, "id"])
    order = F.row_number().over(Window.partitionBy(key, "b").orderBy("a"))
    one_other = tiling.pairs.filter("a <> b").withColumn("nr", order).filter("nr = 1").drop("nr")
    some = Tiling(rows, tiling.pairs.filter("a = b").unionByName(one_other), key)
    nodes = rows.select(key, "id", F.lit(0).alias("level"))
    comps = connected_components(nodes, local_components(some, None, [eps]), [key, "level"])

    largest = comps.groupBy(key, "comp").count().groupBy(key) \
        .agg(F.max_by("comp", F.struct("count", "comp")).alias("largest"))
    placed = cut_lineage(rows.join(comps.select(key, "id", "comp"), [key, "id"]).join(largest, key)
                         .withColumn("settled", F.col("comp") == F.col("largest")).drop("comp"))
    rest = placed.filter(~F.col("settled"))
    before = F.sum("count").over(Window.partitionBy(key).orderBy("tile").rowsBetween(Window.unboundedPreceding, -1))
    blocks = cut_lineage(rest.groupBy(key, "tile").count().select(
        key, "tile", F.floor(F.coalesce(before, F.lit(0)) / block_rows).alias("block")))
    if not blocks.limit(1).count():
        return comps
    close = tiling.pairs.select(key, F.col("a").alias("tile"), F.col("b").alias("other")).unionByName(
        tiling.pairs.filter("a <> b").select(key, F.col("b").alias("tile"), F.col("a").alias("other")))
    meet = blocks.join(close, [key, "tile"])
    cols = ["id", "vec", "core", "settled", "largest"]
    left = rest.join(meet, [key, "tile"]).select(key, "block", "other", F.lit(0).alias("side"), *cols)
    # two rest rows meet in the block of the lower tile, at least
    lowest = blocks.groupBy(key, "block").agg(F.min("tile").alias("lowest"))
    right = placed.join(meet.select(key, "block", F.col("other").alias("tile")).distinct().join(lowest, [key, "block"]),
                        [key, "tile"]).filter(F.col("settled") | (F.col("tile") >= F.col("lowest"))) \
        .select(key, "block", F.col("tile").alias("other"), F.lit(1).alias("side"), *cols)

    def run(group: pa.Table) -> pa.Table:
        side, settled = group["side"].to_numpy(), group["settled"].to_numpy()
        mine, known, others = (group.filter(pa.array(m)) for m in (
            side == 0, (side == 1) & settled, (side == 1) & ~settled))
        x, core = unit_matrix(mine["vec"]), mine["core"].fill_null(np.inf).to_numpy()
        a, b = [], []
        if len(mine) and len(known):
            w = reachability(x, unit_matrix(known["vec"]), core, known["core"].fill_null(np.inf).to_numpy())
            i = pa.array(np.flatnonzero((w <= eps).any(axis=1)))
            a.append(mine["id"].take(i))
            b.append(mine["largest"].take(i))
        if len(mine) and len(others):
            w = reachability(x, unit_matrix(others["vec"]), core, others["core"].fill_null(np.inf).to_numpy())
            both = pa.concat_tables([mine, others])["id"]
            comp = components_of(len(both), *bipartite_forest(np.where(w <= eps, w, np.inf)), [eps])[0]
            i = np.flatnonzero(comp != np.arange(len(comp)))
            a.append(both.take(pa.array(i)))
            b.append(both.take(pa.array(comp[i])))
        a, b = (pa.chunked_array([c for p in parts for c in p.chunks], type=group["id"].type) for parts in (a, b))
        return pa.table({key: pa.chunked_array([group[key].combine_chunks().slice(0, 1).take(
            pa.array(np.zeros(len(a), dtype=np.int64)))], type=group[key].type), "a": a, "b": b})

    links = left.unionByName(right).groupBy(key, "block", "other").applyInArrow(
        run, f"`{key}` {types[key]}, a {types['id']}, b {types['id']}")
    # the preliminary components are the nodes now
    edges = cut_lineage(
        links.join(comps.select(key, F.col("id").alias("a"), F.col("comp").alias("ca")), [key, "a"])
        .join(comps.select(key, F.col("id").alias("b"), F.col("comp").alias("cb")), [key, "b"])
        .filter("ca <> cb").select(key, F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    ends = edges.select(key, F.col("a").alias("id")).unionByName(edges.select(key, F.col("b").alias("id")))
    roots = connected_components(ends, edges, key).select(key, F.col("id").alias("comp"), F.col("comp").alias("root"))
    return cut_lineage(comps.join(roots, [key, "comp"], "left").select(
        key, "level", "id", F.coalesce("root", "comp").alias("comp")))


def _distributed_labels(pts: DataFrame, levels: list[float], key: str, tile_rows: int,
                        select_stable: bool, allow_single_cluster: bool) -> DataFrame:
    """``key, id, cluster_label`` (noise left out) of senders of any size; ``pts``: key, id, vec,
    min_size, min_samples."""
    tiling = tile(pts, levels[-1], key, "id", "vec", tile_rows)
    samples = pts.groupBy(key).agg(F.min("min_samples").alias("min_samples"))
    cores = None if no_cores(samples) else cut_lineage(core_distances(tiling, samples, levels[-1]))
    if len(levels) == 1:
        comps = flat_components(tiling, cores, levels[0], tile_rows)
    else:
        rows = tiling.rows.withColumn("core", F.lit(0.0)) if cores is None else tiling.rows.join(cores, [key, "id"])
        edges = block_components(Tiling(rows, tiling.pairs, key), levels, BLOCK_TILES * tile_rows)
        comps = ladder_components(pts.select(key, "id"), edges, len(levels), key)
    minimum = pts.groupBy(key).agg(F.min("min_size").alias("min_size"), F.count("*").alias("n"))
    sizes = comps.groupBy(key, "level", "comp").agg(F.count("*").alias("size")).join(minimum, key) \
        .filter(F.col("size") >= F.col("min_size"))
    if select_stable:
        chosen = _stable_components(comps, sizes, levels, key, allow_single_cluster)
    else:
        chosen = sizes.select(key, "level", "comp")
    number = F.dense_rank().over(Window.partitionBy(key).orderBy("level", "comp")) - 1
    return comps.join(chosen.withColumn("cluster_label", number.cast("int")), [key, "level", "comp"]) \
        .select(key, "id", "cluster_label")


def _stable_components(comps: DataFrame, sizes: DataFrame, levels: list[float], key: str,
                       allow_single_cluster: bool) -> DataFrame:
    """:func:`most_stable` over the component tables: ``key, level, comp``."""
    lam = [1 / max(e, 1e-12) for e in levels] + [1 / BIRTH]
    gain = F.element_at(F.array(*[F.lit(a - b) for a, b in zip(lam, lam[1:])]), F.col("level") + 1)
    # the smallest member names a component, so its own component one level up is the parent
    up = comps.select(key, F.col("id").alias("comp"), (F.col("level") - 1).alias("level"),
                      F.col("comp").alias("parent"))
    nodes = cut_lineage(sizes.join(up, [key, "level", "comp"], "left")
                        .withColumn("gain", F.col("size") * gain))
    seen, below = [], None
    for li in range(len(levels)):
        at = nodes.filter(F.col("level") == li)
        if below is None:
            at = at.withColumns({"k": F.lit(0), "child_own": F.lit(0.0), "child_sub": F.lit(0.0),
                                 "child_best": F.lit(0.0)})
        else:
            children = below.groupBy(key, F.col("parent").alias("comp")).agg(
                F.count("*").alias("k"), F.sum("own").alias("child_own"), F.sum("sub").alias("child_sub"),
                F.sum(F.greatest("own", "sub")).alias("child_best"))
            at = at.join(children, [key, "comp"], "left") \
                .fillna({"k": 0, "child_own": 0.0, "child_sub": 0.0, "child_best": 0.0})
        one = F.col("k") == 1
        at = at.withColumn("own", F.col("gain") + F.when(one, F.col("child_own")).otherwise(0.0)) \
            .withColumn("sub", F.when(one, F.col("child_sub")).otherwise(F.col("child_best")))
        root = F.lit(False) if allow_single_cluster else F.col("size") == F.col("n")
        below = cut_lineage(at.withColumn("keep", (F.col("own") >= F.col("sub")) & ~root)
                            .select(key, "level", "comp", "parent", "own", "sub", "keep"))
        seen.append(below)
    chosen = above = None
    for at in reversed(seen):
        if above is not None:
            at = at.join(above, [key, "parent"], "left")
        else:
            at = at.withColumn("covered", F.lit(False))
        at = cut_lineage(at.select(key, "level", "comp", F.coalesce("covered", F.lit(False)).alias("blocked"),
                                   "keep"))
        above = at.select(key, F.col("comp").alias("parent"), (F.col("blocked") | F.col("keep")).alias("covered"))
        picked = at.filter(F.col("keep") & ~F.col("blocked")).select(key, "level", "comp")
        chosen = picked if chosen is None else chosen.unionByName(picked)
    return chosen


def ladder_levels(lowest: float = config.PROFILE_SELECTION_EPSILON, highest: float = 1.0,
                  steps: int = 10) -> list[float]:
    """Evenly spaced eps levels from the selection epsilon up; 1.0 is a cosine of 0.5."""
    return [lowest + (highest - lowest) * i / (steps - 1) for i in range(steps)]


def _cluster(df: DataFrame, min_cluster_size, min_samples, levels, key: str, id_col: str, vec_col: str,
             tile_rows: int, select_stable: bool, allow_single_cluster: bool) -> DataFrame:
    levels = sorted(float(x) for x in levels)

    def value(x):
        return (F.col(x) if isinstance(x, str) else F.lit(x)).cast("int")

    pts = df.select(key, F.col(id_col).alias("id"), F.col(vec_col).cast("array<float>").alias("vec"),
                    value(min_cluster_size).alias("min_size"), value(min_samples).alias("min_samples"))
    types = dict(pts.dtypes)
    large = cut_lineage(pts.groupBy(key).count().filter(F.col("count") > tile_rows).select(key))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        label = block_labels(unit_matrix(group["vec"]), group["min_size"][0].as_py(),
                             group["min_samples"][0].as_py(), levels, select_stable, allow_single_cluster)
        return pa.table({key: group[key], "id": group["id"], "cluster_label": pa.array(label)})

    labels = pts.join(large, key, "left_anti").groupBy(key).applyInArrow(
        run, f"`{key}` {types[key]}, id {types['id']}, cluster_label int")
    if large.limit(1).count():
        labels = labels.unionByName(_distributed_labels(
            cut_lineage(pts.join(large, key, "left_semi")), levels, key, tile_rows, select_stable,
            allow_single_cluster))
    return df.join(labels.withColumnRenamed("id", id_col), [key, id_col], "left") \
        .withColumn("cluster_label", F.coalesce("cluster_label", F.lit(-1)))


# V5
def density_clusters(df: DataFrame, eps: float, min_cluster_size=config.PROFILE_MIN_CLUSTER_SIZE,
                     min_samples=config.PROFILE_MIN_SAMPLES, key: str = "originator_id",
                     id_col: str = "template_hash", vec_col: str = "embedding",
                     tile_rows: int = TILE_ROWS) -> DataFrame:
    """``df`` + ``cluster_label`` (-1 = noise) at the flat level ``eps``.

    ``min_cluster_size`` and ``min_samples`` are ints or names of per-sender columns
    of ``df``; ``id_col`` must be unique within a sender.
    """
    return _cluster(df, min_cluster_size, min_samples, [eps], key, id_col, vec_col, tile_rows, False, False)


# V6
def eom_clusters(df: DataFrame, levels, min_cluster_size=config.PROFILE_MIN_CLUSTER_SIZE,
                 min_samples=config.PROFILE_MIN_SAMPLES, key: str = "originator_id",
                 id_col: str = "template_hash", vec_col: str = "embedding",
                 tile_rows: int = TILE_ROWS, allow_single_cluster: bool = False) -> DataFrame:
    """``df`` + ``cluster_label`` by excess-of-mass selection over the eps ladder ``levels``.

    The lowest level is the selection epsilon: no cluster is split below it. See
    :func:`most_stable`.
    """
    return _cluster(df, min_cluster_size, min_samples, levels, key, id_col, vec_col, tile_rows, True,
                    allow_single_cluster)
