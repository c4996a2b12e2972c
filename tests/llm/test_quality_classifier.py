import numpy as np
from helpers import edge_docs, no_docs

from herald.llm import quality_classifier as C

SF = "/root/testdata/sf0.01"
NO_PAGES = "page_id long, url string, html string"
NO_LABELS = "doc_id long, quality int"


def test_held_out_accuracy(spark):
    from herald.llm.queries import op9_quality_classifier
    got = op9_quality_classifier(spark, SF)
    assert got.count() == 1000
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    kept = [r.predicted for r in rows if r.quality == 1]
    assert right > 0.95 and sum(kept) / len(kept) > 0.97
    prior = sum(r.quality for r in rows) / len(rows)
    assert right > prior + 0.05


def test_pseudo_labels_go_to_the_other_view(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 300)
    rows = [(i, [float(v) for v in rng.normal(3 * c, 1, 2)], [float(v) for v in rng.normal(3 * c, 1, 3)])
            for i, c in enumerate(y)]
    df = spark.createDataFrame(rows, "doc_id long, text_view array<float>, meta_view array<float>")
    a = C.Logistic.fit(np.array([r[1] for r in rows]), y.astype(float))
    b = C.Logistic.fit(np.array([r[2] for r in rows]), y.astype(float))
    got = C.confident(df, a, b, 20)
    assert {(r["view"], r["label"]) for r in got} == {(v, k) for v in ("text_view", "meta_view") for k in (0, 1)}
    assert all(len(r["x"]) == (2 if r["view"] == "text_view" else 3) for r in got) and len(got) <= 80
    # the rows handed to the metadata view are the text view's most confident ones
    p = a.prob(np.array([r[1] for r in rows]))
    best = {tuple(np.float32(rows[i][2])) for i in np.argsort(-p)[:20] if p[i] >= C.CONFIDENT}
    assert {tuple(np.float32(r["x"])) for r in got if r["view"] == "meta_view" and r["label"] == 1} == best


def test_cotraining_uses_unlabelled_rows(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 800)
    rows = [(i, [float(v) for v in rng.normal(2 * c, 1, 4)], [float(v) for v in rng.normal(2 * c, 1, 4)])
            for i, c in enumerate(y)]
    df = spark.createDataFrame(rows, "doc_id long, text_view array<float>, meta_view array<float>")
    labels = spark.createDataFrame([(i, int(y[i])) for i in range(80)], NO_LABELS)
    from pyspark.sql import functions as F
    model = C.train(df, labels, F.lit(True), pseudo=100)
    s = model.scores(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))[2]
    assert ((s[80:] >= 0.5) == y[80:]).mean() > 0.95


def test_awkward_rows(spark):
    from pyspark.sql import functions as F
    pages = spark.createDataFrame([(1, "http://a-b.example.org/en/7.html?x=1", "<title>Hi|!</title><p>x"),
                                   (2, "http://a.example.org/en/7", None), (3, None, None), (4, "nonsense", "")],
                                  NO_PAGES)
    meta = {r.doc_id: r.page for r in C.page_metadata(pages).collect()}
    assert set(meta) == {7} and meta[7][0] == 1 and meta[7][-1] == 1
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 0), (7, 1), (8, 1), (9, 0), (None, 1), (12, None)], NO_LABELS)
    out = C.classify(edge_docs(spark), pages, labels, F.lit(True))
    assert out.count() == 15 and all(0 <= r.score <= 1 for r in out.collect())
    none = spark.createDataFrame([], NO_LABELS)
    flat = C.classify(edge_docs(spark), pages, none, F.lit(True))
    assert {r.score for r in flat.collect()} == {0.5}
    assert C.classify(no_docs(spark), spark.createDataFrame([], NO_PAGES), none, F.lit(True)).count() == 0
