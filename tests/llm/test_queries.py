import pytest
from oracle_compare import canon, duck

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator_and_the_pipeline():
    import __spark_entry__ as E
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op2_source_mixing", "op3_license_scan", "op4_line_dedup", "op8_quality_rules",
                                  "quality_rule_ablation", "op11_hard_negatives", "op12_warc",
                                  "op13_prefix_trie"])
def test_oracle(spark, name):
    import __spark_entry__ as E
    got = E.queries()[name](spark, SF).toPandas()
    want = duck(SF).sql(E.oracle_sql()[name]).df()
    assert canon(got) == canon(want)


@pytest.mark.parametrize("name", ["op1_simhash_near_dedup", "op6_token_counts", "op10_fingerprints"])
def test_one_row_per_document(spark, name):
    import __spark_entry__ as E
    got = E.queries()[name](spark, SF)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == list(range(200))
