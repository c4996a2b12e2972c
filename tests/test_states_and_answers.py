"""Profiles merged batch by batch, and answers that outlive a broken run."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from herald.operators import profile_state as PS
from herald.operators.answers import ask, read_answers
from herald.operators.profile import campaign_table

SCHEMA = "originator_id string, template_hash string, cluster_label int, embedding array<float>, count_in_window long, ts string"


def rows(n=60, seed=1):
    rng = random.Random(seed)
    return [(f"s{i % 2}", str(i), rng.randrange(-1, 4), [rng.uniform(-1, 1) for _ in range(4)], rng.randrange(1, 9),
             f"2024-01-{1 + i % 28:02d} 00:00:00" if i % 5 else None) for i in range(n)]


def canon(df):
    out = {}
    for r in df.collect():
        out[r.originator_id, r.cluster_label] = (r.row_index, r.prototypes_count, r.messages_count, r.window_start, r.window_end,
                                                 [round(x, 9) for x in r.centroid])
    return out


def test_merged_states_equal_the_profile_of_all(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA).withColumn("timestamp", F.col("ts").cast("timestamp")).drop("ts")
    want = canon(campaign_table(df))
    # the third batch brings a campaign that the others lack, the last is empty
    parts = [df.filter("cluster_label < 3 and cast(template_hash as int) % 2 = 0"),
             df.filter("cluster_label < 3 and cast(template_hash as int) % 2 = 1"), df.filter("cluster_label = 3"), df.limit(0)]
    for i, part in enumerate(parts):
        state = PS.update_profile(spark, str(tmp_path / "p"), PS.profile_state(part), i)
        again = PS.update_profile(spark, str(tmp_path / "p"), PS.profile_state(part), i)
        assert again.count() == state.count()
    assert canon(PS.state_campaigns(state)) == want
    assert PS.versions(spark, str(tmp_path / "p")) == [0, 1, 2, 3]
    os.remove(tmp_path / "p" / "version=3" / "_SUCCESS")      # an update that was not finished
    assert canon(PS.state_campaigns(PS.update_profile(spark, str(tmp_path / "p"), PS.profile_state(parts[3]), 3))) == want


def test_state_of_assigned_rows(spark):
    df = spark.createDataFrame([("s", "a", 0, [1.0, 0.0], "Known", 3), ("s", "b", 0, [0.0, 1.0], "known", 4),
                                ("s", "c", 1, [0.0, 1.0], "Unknown", 5)],
                               "originator_id string, template_hash string, assigned_campaign_label int, "
                               "embedding array<float>, status string, count_in_window long")
    got = PS.state_of_assigned(df).collect()
    assert [(r.cluster_label, r.vec_sum, r.prototypes_count, r.messages_count) for r in got] == [(0, [1.0, 1.0], 2, 7)]


def asked(folder):
    """A text function that records each call as a byte of a file; ``dies`` kills its worker the first time,
    ``fails`` raises the first time, ``never`` always."""
    folder = str(folder)
    os.makedirs(folder)

    def fn(prompt, temperature):
        time.sleep(0.2)
        before = os.path.exists(f"{folder}/{prompt}-tried")
        open(f"{folder}/{prompt}-tried", "a").close()
        if prompt == "dies" and not before:
            time.sleep(8)                       # the others have ended by then
            os._exit(1)
        open(f"{folder}/{prompt}", "a").write("x")
        if prompt == "fails" and not before:
            raise RuntimeError("busy")
        if prompt == "never":
            raise RuntimeError("refused")
        return f"answer to {prompt}"

    def calls(prompt):
        path = f"{folder}/{prompt}"
        return os.path.getsize(path) if os.path.exists(path) else 0

    return fn, calls


def test_answers_outlive_a_killed_task(spark, tmp_path):
    (fn, calls), path = asked(tmp_path / "calls"), str(tmp_path / "ledger")
    names = [f"p{i:02d}" for i in range(10)] + ["dies"]
    prompts = spark.createDataFrame([(n,) for n in names * 2 + [None]], "prompt string")
    with pytest.raises(Exception):
        ask(prompts, fn, path, attempts=1, prompts_per_task=1)
    assert read_answers(spark, path).count() == 10
    got = {r.prompt: r.raw_text for r in ask(prompts, fn, path, prompts_per_task=1).collect()}
    assert got == {n: f"answer to {n}" for n in names}
    assert all(calls(n) == 1 for n in names)


def test_failures_are_asked_again_a_bounded_number_of_times(spark, tmp_path):
    (fn, calls), path = asked(tmp_path / "calls"), str(tmp_path / "ledger")
    prompts = spark.createDataFrame([("fails",), ("never",), ("fine",)], "prompt string")
    got = {r.prompt: (r.raw_text, r.label, r.error) for r in ask(prompts, fn, path, attempts=3).collect()}
    assert got["fails"] == ("answer to fails", "answer to fails", None) and got["fine"][0] == "answer to fine"
    assert got["never"][0] == "" and "refused" in got["never"][2]
    assert (calls("fine"), calls("fails"), calls("never")) == (1, 2, 3)
    ask(prompts, fn, path, attempts=1).collect()
    assert (calls("fine"), calls("never")) == (1, 4)
