"""Dedupe, vectors, centroids and assignment: properties and brute force."""

import numpy as np
from pyspark.sql import functions as F

from paths import SF_SMALL
from herald.functions.vectors import dot, norm, unit_normalize
from herald.operators.assign import assign_to_campaigns
from herald.operators.centroids import centroids
from herald.operators.templates import build_templates
from herald.sources.batches import load_messages


def test_dedupe_counts_and_first_row(spark):
    m = load_messages(spark, SF_SMALL)
    t = build_templates(m).toPandas()
    assert t.count_in_window.sum() == m.filter(F.col("raw_text").isNotNull()).count()
    assert not t.duplicated(["originator_id", "template_hash"]).any()
    from herald.operators.templates import normalize_and_hash
    full = normalize_and_hash(m).toPandas()
    first = full.sort_values("seq").drop_duplicates(["originator_id", "template_hash"])
    merged = first.merge(t, on=["originator_id", "template_hash"], suffixes=("", "_t"))
    assert (merged.seq == merged.seq_t).all() and (merged.message_id == merged.message_id_t).all()


def test_row_order_invariance(spark):
    m = load_messages(spark, SF_SMALL)
    a = build_templates(m).toPandas().sort_values(["originator_id", "template_hash"]).reset_index(drop=True)
    b = build_templates(m.repartition(5).orderBy(F.rand(3))).toPandas() \
        .sort_values(["originator_id", "template_hash"]).reset_index(drop=True)
    assert a.equals(b)


def test_unit_normalize_and_dot(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    r = df.select(unit_normalize("v").alias("u"), norm(unit_normalize("v")).alias("n"),
                  dot("v", "v").alias("d")).collect()
    assert r[0].u == [0.6, 0.8] and abs(r[0].n - 1) < 1e-12 and r[0].d == 25.0
    assert r[1].u == [0.0, 0.0]


def test_centroids_against_numpy(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    c = {r.label: np.array(r.centroid) for r in centroids(e, ["label"]).collect()}
    pdf = e.toPandas()
    for lab, g in pdf.groupby("label"):
        x = np.stack(g.embedding.to_numpy()).astype(np.float64)
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        m = x.mean(axis=0)
        m = m / max(np.linalg.norm(m), 1e-12)
        assert np.allclose(c[lab], m, atol=1e-9)
        assert abs(np.linalg.norm(c[lab]) - 1) < 1e-9


def test_assign_ties_and_missing_sender(spark):
    camps = spark.createDataFrame(
        [("s1", 0, 7, "a", [1.0, 0.0]), ("s1", 1, 9, "b", [1.0, 0.0]), ("s1", 2, 3, "c", [0.0, 1.0])],
        "originator_id string, row_index int, cluster_label int, campaign_name string, centroid array<double>")
    tpl = spark.createDataFrame([("s1", "h1", [2.0, 0.0]), ("s1", "h2", [0.0, -1.0]), ("s2", "h3", [1.0, 1.0])],
                                "originator_id string, template_hash string, embedding array<double>")
    out = {r.template_hash: r for r in assign_to_campaigns(tpl, camps, 0.5).collect()}
    assert out["h1"].assigned_campaign_row_index == 0 and out["h1"].status == "Known"
    assert out["h1"].assigned_campaign_label == 7 and out["h1"].assigned_campaign_name == "a"
    assert out["h2"].status == "Unknown"
    assert out["h3"].assigned_campaign_row_index is None and out["h3"].status == "Unknown"


def test_assign_matches_numpy(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    emb = e.select(F.lit("o").alias("originator_id"), F.col("vec_id").cast("string").alias("template_hash"),
                   "embedding", F.col("label").alias("cluster_label"))
    cents = centroids(emb, ["originator_id", "cluster_label"]).withColumn(
        "row_index", F.col("cluster_label")).withColumn("campaign_name", F.lit("n"))
    got = {r.template_hash: (r.assigned_campaign_row_index, r.assigned_campaign_score)
           for r in assign_to_campaigns(emb.drop("cluster_label"), cents, 0.2).collect()}
    C = {r.row_index: np.array(r.centroid) for r in cents.collect()}
    K = np.stack([C[k] for k in sorted(C)])
    for r in e.collect():
        v = np.array(r.embedding, dtype=np.float64)
        v = v / np.linalg.norm(v)
        s = K @ v
        idx = int(np.argmax(s))
        assert got[str(r.vec_id)][0] == idx and abs(got[str(r.vec_id)][1] - s[idx]) < 1e-9
