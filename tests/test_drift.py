"""Planted drift (160 known, 40 new), discovery gates, report and naming."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from herald.operators import naming as NM
from herald.operators.assign import assign_to_campaigns
from herald.operators.density import cos_to_dist, density_clusters
from herald.operators.discover import coverage_by_originator, discover, unknown_for_discovery
from herald.operators.profile import build_profile
from herald.operators.report import drift_summary


def _vecs(rng, centre, n, spread=0.03):
    return [centre + spread * rng.normal(size=centre.size) for _ in range(n)]


def planted_mix(spark):
    rng = np.random.default_rng(11)
    dim = 24
    centres = [np.eye(dim)[i] for i in range(5)]
    ref, new = [], []
    for c in range(4):
        for j, v in enumerate(_vecs(rng, centres[c], 40)):
            ref.append(("s1", f"r{c}_{j:02d}", [float(x) for x in v], f"camp{c} word{c} text", 2))
        for j, v in enumerate(_vecs(rng, centres[c], 40)):
            new.append(("s1", f"k{c}_{j:02d}", [float(x) for x in v], f"camp{c} word{c} text", 3))
    for j, v in enumerate(_vecs(rng, centres[4], 40)):
        new.append(("s1", f"u_{j:02d}", [float(x) for x in v], "brand new offer", 1))
    schema = ("originator_id string, template_hash string, embedding array<double>, "
              "normalized_text string, count_in_window long")
    return spark.createDataFrame(ref, schema), spark.createDataFrame(new, schema)


def test_planted_drift_end_to_end(spark):
    ref, new = planted_mix(spark)
    clustered = density_clusters(ref, cos_to_dist(0.9), 5, 1)
    camps, examples = build_profile(clustered)
    assert camps.count() == 4
    assert examples.count() == 20
    assert camps.agg(F.sum("messages_count")).first()[0] == 160 * 2
    assigned = assign_to_campaigns(new, camps, 0.5)
    st = assigned.groupBy("status").count().toPandas().set_index("status")["count"].to_dict()
    assert st == {"Known": 160, "Unknown": 40}
    cov = coverage_by_originator(assigned).first()
    assert abs(cov.coverage - 0.8) < 1e-12 and cov.n_unknown == 40

    def cluster_fn(u):
        return density_clusters(u, cos_to_dist(0.9), 5, 2)

    upserted, clusters, new_camps = discover(assigned, cluster_fn, run_ts="2024-01-01 00:00:00")
    assert clusters.count() == 1 and new_camps.count() == 1
    nc = new_camps.first()
    assert nc.proto_count == 40 and nc.status == "Unknown" and nc.row_index == 0
    props = upserted.filter(F.col("proposed_cluster_id").isNotNull()).toPandas()
    assert len(props) == 40 and props.template_hash.str.startswith("u_").all()
    assert (props.proposed_campaign_name == nc.campaign_name).all()
    summary = drift_summary(camps, assigned, new_camps).toPandas()
    refs = summary[summary.Ref_Campaign_name != "NA"]
    assert len(refs) == 4 and (refs.New_number_assigned == 120).all() and (refs.Count == 40).all()
    na = summary[summary.Ref_Campaign_name == "NA"]
    assert len(na) == 1 and na.New_number_assigned.iloc[0] == 40 and pd.isna(na.Count.iloc[0])
    assert list(summary.Ref_Campaign_name)[-1] == "NA"


def test_gates_skip_covered_senders(spark):
    df = spark.createDataFrame(
        [("a", "h%d" % i, "Known") for i in range(10)] + [("b", "h%d" % i, "Unknown") for i in range(3)] +
        [("c", "h%d" % i, "unknown") for i in range(6)], "originator_id string, template_hash string, status string")
    got = {r.originator_id for r in unknown_for_discovery(df).select("originator_id").distinct().collect()}
    assert got == {"c"}


def test_default_namer(spark):
    s = spark.createDataFrame(
        [("o", 0, "your otp code is {OTP} for login"), ("o", 0, "otp code {OTP} expires"),
         ("o", 1, "your parcel is out for delivery"), ("o", 1, "parcel delivery today"), ("o", 2, "   ")],
        "originator_id string, cluster_label int, text_sample string")
    names = {r.cluster_label: r.campaign_name for r in NM.name_from_samples(s, ["originator_id", "cluster_label"]).collect()}
    assert names[0].split()[:2] == ["otp", "code"]
    assert names[1].split()[:2] == ["delivery", "parcel"]
    assert names[2] == ""


def test_text_function_hook(spark):
    prompts = spark.createDataFrame([("p1",), ("p2",), ("p1",)], "prompt string")

    def fn(prompt, temperature):
        if prompt == "p2":
            raise RuntimeError("down")
        return {"text": "  Login Codes!!  for  Users. extra words here"}

    out = {r.prompt: r for r in NM.call_text_function(prompts, fn).collect()}
    assert out["p1"].label == "Login Codes for Users extra" and out["p1"].error is None
    assert out["p2"].label == "" and "down" in out["p2"].error


def test_drift_verdict_planted(spark):
    reg = spark.createDataFrame([("o1", 1, "school notifications", "School alerts")],
                                "business_number string, seq long, onboarding_name string, campaign_name string")
    camps = spark.createDataFrame([("o1", "school bus delay notifications"), ("o1", "school events digest"),
                                   ("o1", "football weekend")], "originator_id string, campaign_name string")
    v = NM.drift_verdicts(NM.names_view(reg, camps)).first()
    assert v.status == "anomaly" and v.misfit_names == ["football weekend"]
    assert v.llm_result.startswith(NM.ANOMALY_TEXT)
    done = spark.createDataFrame([("o1", "x")], "business_number string, llm_result string")
    assert NM.drift_verdicts(NM.names_view(reg, camps), done=done).count() == 0


def test_status_from_text(spark):
    df = spark.createDataFrame([(NM.FIT_TEXT,), (NM.ANOMALY_TEXT + "\n- x",), ("No anomalies",)], "llm_result string")
    assert [r.s for r in df.select(NM.status_from_text().alias("s")).collect()] == ["ok", "anomaly", "anomaly"]


def test_prompts(spark):
    ex = spark.createDataFrame([("o", 0, 2, "second"), ("o", 0, 1, "first"), ("o", 0, 3, "  ")],
                               "originator_id string, cluster_label int, rank int, text_sample string")
    p = NM.sample_prompts(ex, ["originator_id", "cluster_label"]).first().prompt
    assert "1. first\n\n2. second\n\n" in p and "3." not in p and "up to 5 words" in p
    own = NM.sample_prompts(ex, ["originator_id", "cluster_label"], template="<{examples}|{max_words}>").first().prompt
    assert own == "<1. first\n\n2. second|5>"


def test_adaptive_parameters(spark):
    from herald.operators.discover import adaptive_parameters
    df = spark.createDataFrame([("a", i) for i in range(900)] + [("b", 1)], "originator_id string, n int")
    got = {r.originator_id: (r.min_cluster_size, r.min_samples) for r in adaptive_parameters(df).collect()}
    assert got == {"a": (9, 30), "b": (5, 3)}
    got = {r.originator_id: r.min_samples for r in adaptive_parameters(df, min_samples=1).collect()}
    assert got == {"a": 1, "b": 1}


def test_pending_are_judged_once_and_failures_stay(spark, tmp_path):
    from herald.plans.onboarding import judge_pending
    view = spark.createDataFrame(
        [("o1", ["bank codes"], ["bank codes"]), ("o2", ["school"], ["football"]), ("o3", ["x"], []),
         ("o4", ["y"], None), ("o5", ["z"], ["z"])],
        "originator_id string, onboarding_names array<string>, discovered_names array<string>")
    done = spark.createDataFrame([("o5", "kept")], "business_number string, llm_result string")

    def fn(prompt, temperature):
        if "football" in prompt:
            raise RuntimeError("down")
        return NM.FIT_TEXT

    got = {r.business_number: r.llm_result for r in judge_pending(view, done, str(tmp_path / "v"), fn).collect()}
    assert got == {"o1": NM.FIT_TEXT, "o5": "kept"}
    asked = NM.asked_verdicts(view, fn, done)
    tally = {r.outcome: r.n for r in NM.run_tally(view, done, asked).collect()}
    assert tally == {"cached": 1, "missing": 1, "empty": 1, "errors": 1, "prepared": 1}


def test_inputs_are_checked(spark):
    from herald.plans.drift import reference_profile
    with pytest.raises(ValueError, match="raw_text"):
        reference_profile(spark.createDataFrame([("a", 1)], "originator_id string, seq long"))
