"""Steps that read or write their input once where they did so several times."""

import pytest
from pyspark.sql import functions as F

import herald.session
from herald.functions import text as TX
from herald.operators.embed import embed_templates
from herald.operators.naming import name_similarity
from herald.operators.templates import build_templates

KEYS = ["originator_id", "template_hash"]


def test_name_similarity_makes_its_view_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def counted(names):
        seen.add(1)
        return names

    view = spark.createDataFrame(
        [("s1", ["red shoes"], ["red shoes", "loan", "red shoes"]), ("s2", ["tax"], ["?"]), ("s3", None, ["tax"])],
        "originator_id string, onboarding_names array<string>, discovered_names array<string>")
    got = name_similarity(view.withColumn("discovered_names", counted("discovered_names"))).collect()
    assert {(r["originator_id"], r["name"]): r["best"] for r in got} == {
        ("s1", "red shoes"): pytest.approx(1.0), ("s1", "loan"): 0.0, ("s2", "?"): 0.0, ("s3", "tax"): 0.0}
    assert seen.value == 3


def test_vectors_of_a_given_model_are_written_without_texts(spark, monkeypatch):
    rows = [("a", str(i), t, i) for i, t in enumerate(["your parcel is here", "pay 12 now", None, "pay 13 now", ""])]
    tpl = build_templates(spark.createDataFrame(rows, "originator_id string, message_id string, raw_text string, seq long"))
    vec, model = embed_templates(tpl, dim=16)
    assert vec.columns == [*tpl.columns, "embedding"]
    written, cut = [], herald.session.cut_lineage
    monkeypatch.setattr(herald.session, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    alone, _ = embed_templates(tpl, model=model, keep=KEYS)
    assert written == [[*KEYS, "embedding"]]
    assert sorted(alone.collect()) == sorted(vec.select(*KEYS, "embedding").collect())


def test_white_space_after_the_masks_is_collapsed_where_there_is_any(spark, monkeypatch):
    texts = ["Bob, ", "Bob,  \n", " a  b \x1f c ", "Anna Lee,\t call 555 123 4567  now ", "x www.a.de  y", "", "Bob,", None]
    df = spark.createDataFrame([(t,) for t in texts], "raw_text string")
    guarded = [r[1] for r in TX.normalize_messages(df).collect()]
    steps = TX._STEPS_AFTER_URL
    monkeypatch.setattr(TX, "_STEPS_AFTER_URL", (*steps[:-1], (None, TX.collapse_whitespace)))
    assert guarded == [r[1] for r in TX.normalize_messages(df).collect()]
