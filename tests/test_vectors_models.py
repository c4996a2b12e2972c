"""Vectors from a caller's model, TF-IDF vectors and the 2-D map against numpy."""

import numpy as np
from pyspark.sql import functions as F

from paths import SF_SMALL
from herald.operators.embed import embed_templates, embed_with_model
from herald.operators.projection import cluster_centres_2d, fit_projection, project


def test_a_callers_model_gives_the_vectors(spark):
    def make_predict():
        import numpy as np

        def predict(texts):
            return np.array([[len(t), t.count("a"), 1.0] for t in texts], dtype=np.float32)

        return predict

    df = spark.createDataFrame([("x", "banana"), ("y", "kiwi"), ("z", "")], "template_hash string, normalized_text string")
    out = {r.template_hash: r.embedding for r in embed_with_model(df, make_predict, 3, batch_size=2).collect()}
    assert out == {"x": [6.0, 3.0, 1.0], "y": [4.0, 0.0, 1.0], "z": [0.0, 0.0, 1.0]}


def test_tfidf_vectors_are_unit_and_a_batch_shares_the_space(spark):
    df = spark.createDataFrame([("a", "pay your bill now"), ("b", "pay your bill today"), ("c", "goal scored")],
                               "template_hash string, normalized_text string")
    vec, model = embed_templates(df, dim=64)
    v = {r.template_hash: np.array(r.embedding) for r in vec.collect()}
    assert all(abs(np.linalg.norm(x) - 1) < 1e-5 for x in v.values())
    assert v["a"] @ v["b"] > v["a"] @ v["c"] + 0.2
    again, _ = embed_templates(df.filter("template_hash = 'b'"), dim=64, model=model)
    assert np.allclose(again.first().embedding, v["b"], atol=1e-6)


def test_map_spans_the_largest_variance(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.lit("o").alias("originator_id"), F.col("label").alias("cluster_label"), "embedding")
    x = np.stack([r.embedding for r in e.collect()]).astype(float)
    pts = project(e, fit_projection(e))
    got = np.array([(r.x, r.y) for r in pts.collect()])
    top = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)[:2] ** 2 / (len(x) - 1)
    assert np.allclose(sorted(got.var(axis=0, ddof=1), reverse=True), top, rtol=1e-3)
    centres = {r.cluster_label: (r.cx, r.cy) for r in cluster_centres_2d(pts).collect()}
    labels = np.array([r.cluster_label for r in pts.collect()])
    for label, c in centres.items():
        assert np.allclose(got[labels == label].mean(axis=0), c, atol=1e-9)
