"""Pruned assignment against plain blocks and numpy; the sign index against the exact search."""

import numpy as np
from pyspark.sql import functions as F

from herald.operators.blocks import nearest_center
from herald.operators.near_index import measured_recall, near_pairs_by_signs, sign_tiling, tables_needed
from herald.operators.neighbours import similar_pairs
from herald.operators.pruned import center_cells, nearest_center_pruned, search_cells

ROWS = "originator_id string, template_hash string, embedding array<float>"
CENTERS = "originator_id string, row_index int, centroid array<double>"


def grouped(rng, groups, per_group, dim=12, spread=0.04):
    heads = rng.normal(size=(groups, dim))
    heads /= np.linalg.norm(heads, axis=1, keepdims=True)
    return np.repeat(heads, per_group, axis=0) + spread * rng.normal(size=(groups * per_group, dim))


def frame(spark, vectors, schema, ids, sender="s1"):
    return spark.createDataFrame([(sender, i, [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)], schema)


def test_ten_thousand_centers_are_mostly_not_visited(spark):
    rng = np.random.default_rng(5)
    c = grouped(rng, 200, 50)
    x = (c[rng.integers(0, len(c), 300)] + 0.01 * rng.normal(size=(300, 12))).astype(np.float32)
    centers = frame(spark, c, CENTERS, range(len(c)))
    rows = frame(spark, x, ROWS, [f"r{i}" for i in range(len(x))])
    got = {r.template_hash: r.row_index for r in nearest_center_pruned(
        rows, centers, ["originator_id"], center_rows=128, prune_from=128).collect()}
    u = c / np.linalg.norm(c, axis=1, keepdims=True)
    want = (x.astype(np.float64) @ u.T / np.linalg.norm(x, axis=1, keepdims=True)).argmax(axis=1)
    assert got == {f"r{i}": int(w) for i, w in enumerate(want)}

    few = rows.select("originator_id", F.col("template_hash").alias("id"), F.col("embedding").alias("v"))
    many = centers.select("originator_id", F.col("row_index").alias("c"), F.col("centroid").alias("cv"))
    cells = center_cells(many, ["originator_id"], 128)
    sizes = cells.centers.groupBy("originator_id", "cell").count()
    s = search_cells(few, cells, ["originator_id"], center_rows=128)
    visits = s.first.select("originator_id", "id", "cell").unionByName(s.second.select("originator_id", "id", "cell"))
    products = visits.join(sizes, ["originator_id", "cell"]).agg(F.sum("count")).first()[0] + 300 * cells.pivots.count()
    assert products < 0.15 * 300 * 10_000


def test_pruned_equals_blocks_without_structure_ties_zero_and_null_vectors(spark):
    rng = np.random.default_rng(8)
    c = rng.normal(size=(60, 6))
    c[40:50] = c[0:10]  # equal centres: the lowest id wins
    c[55] = 0
    x = np.concatenate([rng.normal(size=(80, 6)), c[:20], np.zeros((2, 6))]).astype(np.float32)
    centers = frame(spark, c, CENTERS, range(60)).unionByName(frame(spark, c[:3], CENTERS, range(3), "s2"))
    rows = frame(spark, x, ROWS, [f"r{i:03d}" for i in range(len(x))]) \
        .unionByName(frame(spark, x[:9], ROWS, [f"r{i}" for i in range(9)], "s2")) \
        .unionByName(frame(spark, x[:2], ROWS, ["a", "b"], "no centres")) \
        .unionByName(spark.createDataFrame([("s1", "null", None)], ROWS))

    def found(df):
        return sorted((r.originator_id, r.template_hash, r.row_index, round(r.score, 9)) for r in df.collect())

    plain = found(nearest_center(rows, centers, ["originator_id"]))
    assert found(nearest_center_pruned(rows, centers, ["originator_id"], center_rows=8, prune_from=8)) == plain
    assert found(nearest_center_pruned(rows, centers, ["originator_id"])) == plain
    assert len(plain) == len(x) + 9 and ("s1", "r100", 0, 0.0) in plain
    assert not any(40 <= r[2] < 50 for r in plain)


def test_no_rows_and_no_centers(spark):
    rows, centers = spark.createDataFrame([], ROWS), frame(spark, np.eye(12), CENTERS, range(12))
    assert nearest_center_pruned(rows, centers, ["originator_id"], center_rows=4, prune_from=4).count() == 0
    some = frame(spark, np.eye(12), ROWS, [str(i) for i in range(12)])
    assert nearest_center_pruned(some, centers.limit(0), ["originator_id"]).count() == 0


def test_sign_index_recall_hot_buckets_and_single_report(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([grouped(rng, 100, 6, dim=32, spread=0.06), rng.normal(size=(500, 32)),
                        np.tile(rng.normal(size=32), (150, 1))])
    df = frame(spark, x, ROWS, [f"v{i:04d}" for i in range(len(x))]) \
        .unionByName(frame(spark, x[:12], ROWS, [f"v{i}" for i in range(12)], "s2")) \
        .unionByName(spark.createDataFrame([("s1", "null", None)], ROWS)).cache()
    found = near_pairs_by_signs(df, 0.8, recall=0.95, tile_rows=64).cache()
    exact = similar_pairs(df.filter("embedding is not null"), 0.8, tile_rows=4096).cache()
    assert found.count() == found.select("originator_id", "a", "b").distinct().count()
    r = {x.originator_id: x for x in measured_recall(found, exact).collect()}
    assert r["s1"].n_wrong == 0 and r["s1"].recall >= 0.9 and r["s1"].n_exact > 150 * 149 // 2
    assert r["s2"].recall == 1.0 and r["s2"].n_wrong == 0
    copies = {f"v{i:04d}" for i in range(1100, 1250)}  # copies share every bucket
    assert sum(p.a in copies and p.b in copies for p in found.collect()) == 150 * 149 // 2
    # far fewer products than all pairs of tiles
    tiling = sign_tiling(df, 0.8, 0.95, tile_rows=64)
    sizes = tiling.rows.filter("originator_id = 's1'").groupBy("tile").count()
    pairs = tiling.pairs.filter("originator_id = 's1'")
    products = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b") \
        .agg(F.sum(F.col("na") * F.col("nb"))).first()[0]
    assert sizes.agg(F.max("count")).first()[0] < 160 and products < 0.75 * 1250 ** 2


def test_sign_index_empty_and_table_counts(spark):
    assert near_pairs_by_signs(spark.createDataFrame([], ROWS), 0.8).count() == 0
    assert tables_needed(0, 0.8, 0.95) == 1 and tables_needed(9, 1.0, 0.95) == 1
    p = 1 - np.arccos(0.8) / np.pi
    t = tables_needed(8, 0.8, 0.95)
    assert 1 - (1 - p ** 8) ** t >= 0.95 > 1 - (1 - p ** 8) ** (t - 1)


def test_many_tables_copy_rows_by_blocks_and_count_without_pairs(spark, monkeypatch):
    """At a low cosine the index has hundreds of tables; a row must not be shuffled once per table."""
    from herald.operators import near_index
    monkeypatch.setattr(near_index, "BLOCK_ROWS", 100)
    x = grouped(np.random.default_rng(8), 40, 10, dim=16, spread=0.3)
    df = frame(spark, x, ROWS, [f"v{i:04d}" for i in range(len(x))]).cache()
    planned = near_index._planned(df, 0.5, 0.95, "originator_id", "template_hash", "embedding", 4)
    tables, blocks = planned.select("tables", "blocks").first()
    assert tables > 4 * blocks == 16
    assert near_index._in_blocks(planned, "originator_id").count().agg(F.sum("count")).first()[0] == blocks * len(x)
    found = near_pairs_by_signs(df, 0.5, tile_rows=4).cache()
    by_tables = near_index._by_tables(planned, 0.5, "originator_id", 64, near_index.SEED,
                                      "originator_id string, a string, b string, cos double")
    assert {(p.a, p.b) for p in found.collect()} == {(p.a, p.b) for p in by_tables.collect()}
    assert found.count() == found.distinct().count()
    wanted = measured_recall(found, similar_pairs(df, 0.5)).collect()
    assert near_index.recall_by_blocks(df, 0.5, tile_rows=4).collect() == wanted and wanted[0].recall >= 0.9
    twice = df.unionByName(df.limit(30)).cache()  # repeated ids count as the join's rows
    wanted = measured_recall(near_pairs_by_signs(twice, 0.5, tile_rows=4), similar_pairs(twice, 0.5)).collect()
    assert near_index.recall_by_blocks(twice, 0.5, tile_rows=4).collect() == wanted


def test_a_block_pair_makes_few_products_however_many_tables(monkeypatch):
    """A small product per table and bucket made a pair of blocks slower the larger the table was."""
    from herald.operators import near_index

    class Counted(np.ndarray):
        made = 0

        def __matmul__(self, other):
            Counted.made += 1
            return np.asarray(self) @ np.asarray(other)

    rng = np.random.default_rng(4)
    x, y = (unit.view(Counted) for unit in (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (
        rng.normal(size=(n, 8)) for n in (700, 500))))
    for full in (near_index.FULL, 1 << 40):  # by the buckets, by comparing all numbers
        monkeypatch.setattr(near_index, "FULL", full)
        for other, alone in ((y, False), (x, True)):
            Counted.made = 0
            got = set(zip(*(p.tolist() for p in near_index._met(x, other, alone, 6, 12, 0.4, 3))))
            assert Counted.made < 20
            a, b = (near_index.bucket_numbers(np.asarray(v), 6, 12, 3) for v in (x, other))
            close = np.asarray(x) @ np.asarray(other).T >= 0.4
            want = {(i, j) for i, j in zip(*np.nonzero(close)) if (a[i] == b[j]).any() and (not alone or i < j)}
            assert got == want and len(want) < close.sum()
