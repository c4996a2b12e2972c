from helpers import CLASHES, edge_docs, no_docs

import corpus_pipeline as C

SF = "/root/testdata/sf0.001"


def staged(spark, docs, tmp_path):
    """(name, input rows, output rows) of each stage, every result written and reread."""
    for n, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF).write.parquet(path := str(tmp_path / str(n)))
        out = spark.read.parquet(path)
        yield name, docs, out
        docs = out


def test_each_stage_against_its_own_input(spark, tmp_path):
    from test_line_dedup import brute as brute_lines
    from test_packing import check
    from test_simhash_near_dedup import expected as brute_groups

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, before, after in staged(spark, docs, tmp_path):
        rows = sorted(((r.doc_id, r.text) for r in before.collect()), key=repr)
        if name != "packing":
            assert after.columns == columns
        if name == "toxicity":
            assert {r.doc_id for r in after.collect()} < {i for i, _ in rows}
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            gone = {i for i, _ in rows} - {r.doc_id for r in after.collect()}
            clean = [i for i, _ in rows if labels.get(i) == 0]
            assert sum(i in gone for i in clean) / len(clean) < 0.05
        elif name == "line_dedup":
            import hashlib
            want = {i: (n, sha) for i, n, _, sha in brute_lines(rows)}
            for r in after.collect():
                assert hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id][1]
                assert r.n_chars == len(r.text)
        elif name == "simhash_near_dedup":
            assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in brute_groups(rows)})
        elif name == "source_mixing":
            texts = dict(rows)
            assert all(texts[r.doc_id] == r.text for r in after.collect())
            assert after.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 3
        else:
            check(rows, after.collect())


def test_awkward_rows_and_empty_table(spark, tmp_path):
    for n, docs in enumerate((edge_docs(spark, clashing=False), no_docs(spark))):
        (folder := tmp_path / f"t{n}").mkdir()
        for name, before, after in staged(spark, docs, folder):
            after.count()
            if name != "packing":
                assert after.columns == before.columns


def test_extra_columns_pass_untouched(spark, tmp_path):
    for name, before, after in staged(spark, edge_docs(spark), tmp_path):
        if name != "packing":
            assert after.dtypes == before.dtypes
            assert [tuple(r) for r in after.select(*CLASHES).distinct().collect()] == [("?",) * len(CLASHES)]
        else:
            after.count()


def test_run(spark):
    got = C.run(spark, SF)
    assert got.count() > 0 and "sequence_id" in got.columns
