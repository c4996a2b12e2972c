"""Structured Streaming forms equal their batch runs."""

import os
import tempfile

from pyspark.sql import functions as F

from paths import SF_SMALL
from herald.operators.embed import embed_templates
from herald.operators.templates import build_templates
from herald.sources.batches import MESSAGE_SCHEMA, load_messages
from herald.streaming.assign_stream import assign_messages
from herald.streaming.windows import windowed_template_counts
from herald.operators.profile import campaign_table


def _stream_dir(spark, df):
    d = tempfile.mkdtemp(prefix="herald-stream-")
    path = os.path.join(d, "in")
    df.repartition(3).write.parquet(path)
    return d, path


def test_windowed_counts_stream_equals_batch(spark):
    from herald.functions.hashing import template_hash
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = ev.select(F.col("event_type").alias("originator_id"), template_hash("props").alias("template_hash"), "ts")
    d, path = _stream_dir(spark, src)
    stream = spark.readStream.schema(src.schema).parquet(path)
    q = (windowed_template_counts(stream, "1 day", watermark=None).writeStream.format("memory")
         .queryName("r1_counts").outputMode("complete").start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select * from r1_counts").toPandas()
    exp = windowed_template_counts(src, "1 day", watermark=None).toPandas()
    key = ["window_start", "originator_id", "template_hash"]
    assert got.sort_values(key).reset_index(drop=True).equals(exp.sort_values(key).reset_index(drop=True))


def test_late_rows_are_dropped_and_open_windows_wait(spark, tmp_path):
    """Append mode: a window comes out once the watermark passes its end; rows behind the watermark are late."""
    from herald.streaming.windows import append_to, windowed_coverage, windowed_template_counts
    schema = "originator_id string, template_hash string, status string, ts timestamp"
    batches = [[("a", "h", "Known", "2024-01-01 10:00:00"), ("a", "h", "Unknown", "2024-01-01 12:00:00")],
               [("a", "h", "Known", "2024-01-02 09:00:00")],
               # day 1 is over for the watermark (2024-01-02 08:00): this row is late
               [("a", "h", "Known", "2024-01-01 23:00:00"), ("a", "g", "Known", "2024-01-03 05:00:00")]]
    for name, agg in (("r1", windowed_template_counts), ("r3", windowed_coverage)):
        source = tmp_path / f"in_{name}"
        source.mkdir()
        stream = agg(spark.readStream.schema(schema).parquet(str(source)), "1 day", watermark="1 hour")
        for i, rows in enumerate(batches):
            df = spark.createDataFrame(rows, "originator_id string, template_hash string, status string, t string") \
                .selectExpr("originator_id", "template_hash", "status", "cast(t as timestamp) as ts")
            df.coalesce(1).write.mode("append").parquet(str(source))
            append_to(stream, str(tmp_path / f"out_{name}"), str(tmp_path / f"ck_{name}")).awaitTermination()
        got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / f"out_{name}")).drop("window_end").collect())
        days = [str(r[0])[:10] for r in got]
        assert days == ["2024-01-01", "2024-01-02"]
        if name == "r1":
            assert got[0][-1] == 2  # the late row isn't counted
        else:
            assert got[0][2:] == (2, 0.5, 1)


def test_streaming_assignment_equals_batch(spark, tmp_path):
    from herald.streaming.assign_stream import write_assignments
    msgs = load_messages(spark, SF_SMALL)
    tpl = build_templates(msgs)
    vec, model = embed_templates(tpl, dim=128)
    camps = campaign_table(vec.withColumn("cluster_label", F.abs(F.hash("template_hash")) % 3)) \
        .withColumn("campaign_name", F.lit("c"))
    d, path = _stream_dir(spark, msgs)
    cols = ["message_id", "assigned_campaign_row_index", "status"]
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    for _ in range(2):  # started again with nothing new, it adds nothing
        write_assignments(stream, camps, model, str(tmp_path / "out"), str(tmp_path / "ck"), 0.2).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.select("batch").distinct().count() == 3
    got = out.select(*cols).toPandas().sort_values("message_id").reset_index(drop=True)
    exp = assign_messages(msgs, camps, model, 0.2).select(*cols).toPandas().sort_values("message_id").reset_index(drop=True)
    assert got.equals(exp)


def test_a_template_is_embedded_once_per_stream(spark, tmp_path):
    """Over two runs of the stream, repeated templates take their assignment from the ledger."""
    from herald.streaming.assign_stream import template_totals, write_assignments
    camps = spark.createDataFrame([("s", 0, 0, [1.0, 0.0], "x"), ("s", 1, 1, [0.0, 1.0], "y")],
                                  "originator_id string, row_index int, cluster_label int, centroid array<double>, campaign_name string")
    schema = "originator_id string, template_hash string, embedding array<float>, seq long"
    batches = [[("s", "a", [1.0, 0.1], 1), ("s", "a", [1.0, 0.1], 2), ("s", "b", [0.1, 1.0], 3)],
               [("s", "b", [0.1, 1.0], 4), ("s", "c", [1.0, 0.2], 5)], [("s", "a", [1.0, 0.1], 6), ("s", "c", [1.0, 0.2], 7)],
               [("s", "a", [1.0, 0.1], 8), ("s", "b", [0.1, 1.0], 9)]]
    for keep, want in ((None, ["a", "b", "c"]), (1, ["a", "a", "b", "b", "c"])):
        where, embedded = tmp_path / str(keep), []

        def embed(templates):
            embedded.extend(r.template_hash for r in templates.collect())
            return templates

        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(where / "in"))
            stream = spark.readStream.schema(schema).parquet(str(where / "in"))
            write_assignments(stream, camps, None, str(where / "out"), str(where / "ck"), 0.5, keep_batches=keep,
                              prepare=lambda b: b, embed=embed, carry=("embedding",)).awaitTermination()
        assert sorted(embedded) == want
        out = {r.seq: r.assigned_campaign_name for r in spark.read.parquet(str(where / "out")).collect()}
        assert out == {1: "x", 2: "x", 3: "y", 4: "y", 5: "x", 6: "x", 7: "x", 8: "x", 9: "y"}
        totals = {r.template_hash: (r.messages, r.batches) for r in template_totals(spark, str(where / "out-templates")).collect()}
        assert totals == {"a": (4, 3), "b": (3, 3), "c": (2, 2)}


def test_a_batch_run_again_overwrites_itself(spark, tmp_path):
    """The checkpoint loses the last commit: its micro-batch comes again, and nothing is doubled."""
    import os
    from herald.streaming.assign_stream import template_totals, write_assignments
    camps = spark.createDataFrame([("s", 0, 0, [1.0, 0.0], "x")],
                                  "originator_id string, row_index int, cluster_label int, centroid array<double>, campaign_name string")
    schema = "originator_id string, template_hash string, embedding array<float>, seq long"
    args = dict(prepare=lambda b: b, embed=lambda t: t, carry=("embedding",))
    for i in range(3):
        if i < 2:
            spark.createDataFrame([("s", "a", [1.0, 0.0], i), ("s", f"t{i}", [1.0, 1.0], 10 + i)], schema).coalesce(1) \
                .write.mode("append").parquet(str(tmp_path / "in"))
        else:
            for name in ("1", ".1.crc"):
                os.remove(tmp_path / "ck" / "commits" / name)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        write_assignments(stream, camps, None, str(tmp_path / "out"), str(tmp_path / "ck"), 0.5, **args).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    assert {r.template_hash: r.messages for r in template_totals(spark, str(tmp_path / "out-templates")).collect()} \
        == {"a": 2, "t0": 1, "t1": 1}
