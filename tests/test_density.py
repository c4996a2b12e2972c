"""Exact neighbour search and density clustering on planted data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from herald.operators.density import cos_to_dist, density_clusters, eom_clusters
from herald.operators.neighbours import knn_distances, similar_pairs


def planted(spark, seed=1, dim=16, sizes=(12, 9, 6), noise=5, spread=0.05):
    rng = np.random.default_rng(seed)
    rows = []
    for ci, n in enumerate(sizes):
        c = rng.normal(size=dim)
        c /= np.linalg.norm(c)
        for j in range(n):
            v = c + spread * rng.normal(size=dim)
            rows.append(("s1", f"c{ci}_{j:02d}", [float(x) for x in v]))
    for j in range(noise):
        rows.append(("s1", f"n_{j:02d}", [float(x) for x in rng.normal(size=dim)]))
    # a second sender with one tight group, to check senders stay apart
    for j in range(6):
        rows.append(("s2", f"c0_{j:02d}", [float(x) for x in (np.eye(dim)[0] + 0.01 * rng.normal(size=dim))]))
    return spark.createDataFrame(rows, "originator_id string, template_hash string, embedding array<double>")


def brute_pairs(pdf, min_cos):
    out = set()
    for o, g in pdf.groupby("originator_id"):
        x = np.stack(g.embedding.to_numpy())
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        s = x @ x.T
        ids = g.template_hash.to_numpy()
        for i in range(len(ids)):
            for j in range(len(ids)):
                if ids[i] < ids[j] and s[i, j] >= min_cos:
                    out.add((o, ids[i], ids[j]))
    return out


@pytest.mark.parametrize("tile_rows", [1024, 4])
def test_similar_pairs_exact(spark, tile_rows):
    df = planted(spark)
    got = {(r.originator_id, r.a, r.b) for r in similar_pairs(df, 0.9, tile_rows=tile_rows).collect()}
    assert got == brute_pairs(df.toPandas(), 0.9)


def test_similar_pairs_on_embeddings(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.lit("o").alias("originator_id"), F.col("vec_id").cast("string").alias("template_hash"), "embedding")
    got = {(r.originator_id, r.a, r.b) for r in similar_pairs(e, 0.3, tile_rows=64).collect()}
    assert got == brute_pairs(e.toPandas(), 0.3)


def test_knn_distances(spark):
    df = planted(spark)
    got = {}
    for r in knn_distances(df, 2, 10.0, tile_rows=5).orderBy("nr").collect():
        got.setdefault((r.originator_id, r.id), []).append(r.d)
    pdf = df.toPandas()
    for o, g in pdf.groupby("originator_id"):
        x = np.stack(g.embedding.to_numpy())
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        d = np.sqrt(np.clip(2 - 2 * (x @ x.T), 0, None))
        np.fill_diagonal(d, np.inf)
        for i, h in enumerate(g.template_hash):
            assert np.allclose(sorted(d[i])[:2], got[(o, h)], atol=1e-6)


@pytest.mark.parametrize("tile_rows", [1024, 5])
def test_density_recovers_planted_clusters(spark, tile_rows):
    df = planted(spark)
    out = density_clusters(df, cos_to_dist(0.9), 5, 2, tile_rows=tile_rows).toPandas()
    s1 = out[out.originator_id == "s1"]
    for prefix, size in (("c0_", 12), ("c1_", 9), ("c2_", 6)):
        labs = s1[s1.template_hash.str.startswith(prefix)].cluster_label.unique()
        assert len(labs) == 1 and labs[0] >= 0
    assert (s1[s1.template_hash.str.startswith("n_")].cluster_label == -1).all()
    assert s1[s1.cluster_label >= 0].cluster_label.nunique() == 3
    s2 = out[out.originator_id == "s2"]
    assert s2.cluster_label.nunique() == 1 and s2.cluster_label.iloc[0] == 0


def test_min_cluster_size_makes_noise(spark):
    df = planted(spark)
    out = density_clusters(df, cos_to_dist(0.9), 10, 2).toPandas()
    s1 = out[out.originator_id == "s1"]
    assert s1[s1.template_hash.str.startswith("c0_")].cluster_label.nunique() == 1
    assert (s1[~s1.template_hash.str.startswith("c0_")].cluster_label == -1).all()


def test_eom_prefers_stable_children(spark):
    # two tight groups that merge only at a loose level: EOM keeps the two groups
    rng = np.random.default_rng(5)
    a = np.eye(8)[0]
    b = 0.8 * np.eye(8)[0] + 0.6 * np.eye(8)[1]
    rows = [("s", f"a{i:02d}", [float(x) for x in a + 0.02 * rng.normal(size=8)]) for i in range(10)] + \
           [("s", f"b{i:02d}", [float(x) for x in b + 0.02 * rng.normal(size=8)]) for i in range(10)]
    df = spark.createDataFrame(rows, "originator_id string, template_hash string, embedding array<double>")
    out = eom_clusters(df, [cos_to_dist(c) for c in (0.99, 0.9, 0.5)], 5, 2).toPandas()
    la = out[out.template_hash.str.startswith("a")].cluster_label.unique()
    lb = out[out.template_hash.str.startswith("b")].cluster_label.unique()
    assert len(la) == 1 and len(lb) == 1 and la[0] != lb[0] and la[0] >= 0 and lb[0] >= 0


def three_groups(seed=2, cos=0.75, size=10, dim=40):
    """Three separate groups whose members have about the given cosine to each other."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(3):
        centre = np.zeros(dim)
        centre[g] = np.sqrt(cos)
        for i in range(size):
            own = np.zeros(dim)
            own[3 + g * size + i] = np.sqrt(1 - cos)
            rows.append(("s", f"g{g}_{i:02d}", [float(x) for x in centre + own + 1e-4 * rng.normal(size=dim)]))
    return rows


@pytest.mark.parametrize("tile_rows", [1024, 8])
def test_eom_keeps_several_top_level_components(spark, tile_rows):
    df = spark.createDataFrame(three_groups(), "originator_id string, template_hash string, embedding array<double>")
    out = eom_clusters(df, [cos_to_dist(c) for c in (0.9, 0.8, 0.7)], 5, 1, tile_rows=tile_rows).toPandas()
    sizes = out.groupby("cluster_label").size()
    assert sorted(sizes.index) == [0, 1, 2] and (sizes == 10).all()
    for g in range(3):
        assert out[out.template_hash.str.startswith(f"g{g}_")].cluster_label.nunique() == 1


def test_eom_root_is_no_cluster_unless_allowed(spark):
    rows = [r for r in three_groups() if r[1].startswith("g0")]
    df = spark.createDataFrame(rows, "originator_id string, template_hash string, embedding array<double>")
    levels = [cos_to_dist(c) for c in (0.9, 0.7)]
    assert {r.cluster_label for r in eom_clusters(df, levels, 5, 1).collect()} == {-1}
    assert {r.cluster_label for r in eom_clusters(df, levels, 5, 1, allow_single_cluster=True).collect()} == {0}


@pytest.mark.parametrize("seed", [1, 4, 9])
def test_tiled_and_single_task_labels_agree(spark, seed):
    df = planted(spark, seed=seed, spread=0.2, sizes=(14, 11, 9, 7), noise=9)
    levels = [cos_to_dist(c) for c in (0.9, 0.75, 0.6, 0.4)]
    for samples in (1, 3):
        one, many = (eom_clusters(df, levels, 4, samples, tile_rows=t).toPandas()
                     .sort_values(["originator_id", "template_hash"]).reset_index(drop=True) for t in (1024, 7))
        assert one[["originator_id", "template_hash", "cluster_label"]].equals(
            many[["originator_id", "template_hash", "cluster_label"]])


def test_per_sender_parameters(spark):
    df = planted(spark).withColumn("size", F.when(F.col("originator_id") == "s1", 10).otherwise(3)) \
        .withColumn("samples", F.when(F.col("originator_id") == "s1", 2).otherwise(1))
    out = density_clusters(df, cos_to_dist(0.9), "size", "samples").toPandas()
    assert out[out.originator_id == "s1"].cluster_label.nunique() == 2
    assert (out[out.originator_id == "s2"].cluster_label == 0).all()


def test_pivots_skip_cell_pairs(spark):
    from herald.operators.neighbours import tile
    df = planted(spark, seed=3, sizes=(120, 100, 80, 60), noise=0, spread=0.02)
    tiling = tile(df, cos_to_dist(0.95), tile_rows=20)
    tiles = tiling.rows.filter("originator_id = 's1'").select("tile").distinct().count()
    pairs = tiling.pairs.filter("originator_id = 's1'").count()
    assert tiles > 15 and pairs < 0.5 * tiles * (tiles + 1) / 2
    got = {(r.originator_id, r.a, r.b) for r in similar_pairs(df, 0.95, tiling=tiling).collect()}
    assert got == brute_pairs(df.toPandas(), 0.95)


def test_components_run_to_the_end_of_long_chains(spark):
    from herald.operators.density import connected_components
    n = 300
    nodes = spark.createDataFrame([("s", f"{i:04d}") for i in range(n)], "originator_id string, id string")
    edges = spark.createDataFrame([("s", f"{i:04d}", f"{i + 1:04d}") for i in range(n - 1)],
                                  "originator_id string, a string, b string")
    assert {r.comp for r in connected_components(nodes, edges).collect()} == {"0000"}


def chain_and_group(spark, seed):
    """Per sender: one large loose group, small groups, pairs, a chain of rows and loners, shuffled over the ids."""
    rng = np.random.default_rng(seed)
    rows = []
    for o, large in (("a", 150), ("b", 40), ("c", 0)):
        v = [np.eye(12)[0] + 0.12 * rng.normal(size=12) for _ in range(large)]
        for n in (9, 5, 5, 2, 2, 1, 1, 1, 1):
            c = rng.normal(size=12)
            v += [c / np.linalg.norm(c) + 0.05 * rng.normal(size=12) for _ in range(n)]
        v += [np.cos(t) * np.eye(12)[5] + np.sin(t) * np.eye(12)[6] for t in np.arange(0, 1.6, 0.09)]
        for i, at in enumerate(rng.permutation(len(v))):
            rows.append((o, f"{i:04d}", [float(x) for x in v[at]]))
    return spark.createDataFrame(rows, "originator_id string, template_hash string, embedding array<double>")


@pytest.mark.parametrize("cos, min_size, min_samples, seed", [(0.9, 1, 1, 1), (0.6, 3, 2, 2), (0.9, 2, 4, 3), (0.99, 2, 2, 4)])
def test_flat_labels_agree_with_a_single_task(spark, cos, min_size, min_samples, seed):
    df = chain_and_group(spark, seed)
    one, tiled = ({(r[0], r[1]): r.cluster_label for r in density_clusters(
        df, cos_to_dist(cos), min_size, min_samples, tile_rows=n).collect()} for n in (4096, 12))
    assert one == tiled and len(one) == df.count()


def test_rows_of_the_largest_component_do_not_meet_in_all_tile_pairs(spark, monkeypatch):
    from herald.operators import density
    made = spark.sparkContext.accumulator(0)
    product = density.reachability

    def counted(x, y, *cores):
        made.add(len(x) * len(y))
        return product(x, y, *cores)

    rng = np.random.default_rng(4)
    vectors = np.eye(24)[0] + 0.17 * rng.normal(size=(1200, 24))
    vectors[::400] = 0.86 * np.eye(24)[1:4] - 0.5 * np.eye(24)[0]
    df = spark.createDataFrame([("s", f"{i:04d}", [float(x) for x in v]) for i, v in enumerate(vectors)],
                               "originator_id string, template_hash string, embedding array<double>")
    tiling = density.tile(df, cos_to_dist(0.3), tile_rows=32)
    assert tiling.pairs.count() > 1000  # hardly a pair is ruled out by pivots
    monkeypatch.setattr(density, "reachability", counted)
    comps = density.flat_components(tiling, None, cos_to_dist(0.3), 32).toPandas()
    assert sorted(comps.groupby("comp").size()) == [1, 1, 1, 1197]
    assert 0 < made.value < 1200 * 1200 / 6


def test_ladder_of_a_large_sender_copies_rows_by_blocks_and_hands_on_an_edge_a_row(spark, monkeypatch):
    """A row was copied once per tile that its own meets, and every tile pair handed on an edge per row and level."""
    from herald.operators import density
    rng = np.random.default_rng(2)
    heads = rng.normal(size=(6, 12))
    rows = [("s1", f"{i:04d}", [float(x) for x in heads[i % 6] + rng.normal(size=12) * (0.2 + i % 5 / 8)]) for i in range(400)]
    df = spark.createDataFrame(rows, "originator_id string, template_hash string, embedding array<double>").cache()
    levels = [cos_to_dist(c) for c in (0.9, 0.75, 0.5)]
    met = []
    plain = density.block_groups
    monkeypatch.setattr(density, "block_groups", lambda *a: met.append(plain(*a)) or met[-1])
    made = []
    merge = density.ladder_components
    monkeypatch.setattr(density, "ladder_components", lambda *a: made.append(a) or merge(*a))
    monkeypatch.setattr(density, "knn_distances", lambda *a, **k: pytest.fail("no core distance is needed"))

    def labels(tile_rows):
        return {r.template_hash: r.cluster_label for r in eom_clusters(df, levels, 4, 2, tile_rows=tile_rows).collect()}

    assert labels(10) == labels(1000) and len(set(labels(1000).values())) > 3
    nodes, edges, n_levels, key = made[0]
    groups, tiles = met[0].count().count(), 400 // 10
    assert edges.count() <= groups * 400 and met[0].count().agg(F.sum("count")).first()[0] < 400 * tiles / 3
    by_rounds = merge(nodes, edges, n_levels, key, 0)
    assert sorted(map(tuple, by_rounds.collect())) == sorted(map(tuple, merge(*made[0]).collect()))
