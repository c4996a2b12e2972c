from collections import defaultdict

from helpers import edge_docs, no_docs, prose

from herald.llm.source_mixing import mix, mixed_documents


def test_taken_words_come_near_targets(spark):
    rows = [(i, prose(20 + (i * 37) % 200, i), "en", f"s{i % 7}" if i % 3 else "hot", 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mix(df).collect()
    assert len(got) == 2000
    sums, targets = defaultdict(int), {}
    for r in got:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        sums[r.source] += r.taken
        targets[r.source] = r.target
    total = sum(r.size for r in got)
    assert abs(sum(targets.values()) - total) < 1e-6 * total
    for s, target in targets.items():
        assert abs(sums[s] - target) <= 60, s  # far less than half a document
    again = {(r.doc_id, r.copies) for r in mix(df.repartition(5)).collect()}
    assert again == {(r.doc_id, r.copies) for r in got}


def test_targets_stop_at_three_times_the_source(spark):
    rows = [(i, prose(50, i), "en", "a" if i < 4 else "b" if i < 100 else "c", 0) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    targets = {r.source: (r.target, r.source_size) for r in mix(df).collect()}
    assert targets["a"] == (600.0, 200)
    assert abs(targets["b"][0] - 2 * targets["c"][0]) < 1e-6
    assert abs(sum(t for t, _ in targets.values()) - 200 * 50) < 1e-6


def test_chances_differ_by_propensity(spark):
    rows = [(i, prose(50, i), "en", "a" if i % 2 else "b", 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .selectExpr("*", "case when doc_id % 4 < 2 then 3.0 else 1.0 end as p")
    got = {r.doc_id: r.copies for r in mix(df, propensity="p", weights=(1, 3)).collect()}
    likely = sum(c for i, c in got.items() if i % 4 == 1)
    rare = sum(c for i, c in got.items() if i % 4 == 3)
    assert likely > 2 * rare > 0


def test_awkward_rows(spark):
    got = mix(edge_docs(spark)).collect()
    assert len(got) == 15
    by_source = defaultdict(int)
    for r in got:
        by_source[r.source] += r.size
        assert 0 <= r.taken <= 3 * r.size
    assert all(r.source_size == by_source[r.source] for r in got)
    assert mix(no_docs(spark)).count() == 0
    assert mix(spark.createDataFrame([(1, None, "x"), (2, "", "x")], "doc_id long, text string, source string")) \
        .agg({"taken": "sum"}).first()[0] == 0


def test_mixed_documents_repeat_whole_rows(spark):
    df = edge_docs(spark, clashing=False)
    out = mixed_documents(df)
    assert out.columns == df.columns
    counts = defaultdict(int)
    for r in out.collect():
        counts[r.text] += 1
    assert all(n <= 6 for n in counts.values())
    assert mixed_documents(no_docs(spark)).count() == 0
