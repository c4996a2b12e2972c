"""Envelope parsing, input positions and thinning against plain-Python versions."""

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from herald.operators import thinning as TH
from herald.sources import batches as SB
from herald.sources import envelopes as EV


ENVELOPES = [
    # quoted field with doubled quotes, a line end inside the message
    ('"{""sourceAddress"": ""24273"", ""requestID"": ""r1"", ""shortMessage"": ""hi \\""there\\""\\nline""}"',
     ("24273", "r1", 'hi "there"\nline')),
    ('{"sourceAddress": "24273", "requestID": "r2", "shortMessage": "plain"}', ("24273", "r2", "plain")),
    # no valid JSON: fields by pattern, the message ends at its first quote
    ('{"sourceAddress": "777", "requestID": "r3", "shortMessage": "broken y", }', ("777", "r3", "broken y")),
    ('{"sourceAddress": "777", "shortMessage": "cut \\"x" y", }', ("777", None, "cut \\")),
    # an empty string in an unquoted value
    ('{"sourceAddress":"1","shortMessage":""}', ("1", None, "")),
    # a number, and white space of several kinds around the value
    ('  {"sourceAddress": 42, "requestID": "r5", "shortMessage": "num"}\u00a0\u2003', ("42", "r5", "num")),
    ("nothing like it", (None, None, None)),
]


def test_envelopes_golden(spark):
    df = spark.createDataFrame([(r, i) for i, (r, _) in enumerate(ENVELOPES)], "value string, seq long")
    got = {r.seq: (r.originator_id, r.message_id, r.raw_text) for r in EV.parse_envelopes(df).collect()}
    for i, (raw, want) in enumerate(ENVELOPES):
        assert got[i] == want, raw


def test_no_bound_unless_asked(spark):
    df = spark.createDataFrame([("a", str(i), "t", i) for i in range(1, 21)],
                               "originator_id string, message_id string, raw_text string, seq long")
    assert EV.extract_originator(df, "a", dilute_factor=5).count() == 4
    assert EV.extract_originator(df, "a", max_rows=10, dilute_factor=5).count() == 2


def test_registrations_are_bound_by_header(spark, tmp_path):
    from herald.sources.sinks import read_registrations
    (tmp_path / "sheet.csv").write_text(
        "row_id,campaign_name,business_number,extra,description,content_type,call_to_action,customer_experience\n"
        '1,Camp One,55501,x,"two\nlines, ""quoted""",text,reply,fine\n2,Camp Two,55502,,d2,,,\n')
    got = read_registrations(spark, str(tmp_path / "sheet.csv")).orderBy("seq").collect()
    assert [(r.business_number, r.campaign_name, r.seq) for r in got] == [("55501", "Camp One", 1), ("55502", "Camp Two", 2)]
    assert got[0].description == 'two\nlines, "quoted"'
    (tmp_path / "short.csv").write_text("business_number,description\n1,2\n")
    with pytest.raises(ValueError, match="campaign_name"):
        read_registrations(spark, str(tmp_path / "short.csv"))


def test_documents_envelopes(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cols = ["originator_id", "message_id", "raw_text", "seq"]
    p = EV.parse_envelopes(EV.envelopes_from_documents(d)).select(*cols).toPandas()
    m = SB.messages_from_documents(d).select(*cols).toPandas()
    assert p.sort_values("seq").reset_index(drop=True).equals(m.sort_values("seq").reset_index(drop=True))


def test_input_position_is_dense(spark):
    df = spark.range(0, 1000, numPartitions=7).select(F.col("id").cast("string").alias("value"))
    pos = EV.with_input_position(df).toPandas()
    assert sorted(pos.seq) == list(range(1, 1001))
    assert (pos.sort_values("seq").value.astype(int).diff().dropna() > 0).all()


def _pandas_match_pos(pdf):
    pdf = pdf.sort_values(["originator_id", "seq"]).copy()
    pdf["pos"] = pdf.groupby("originator_id").cumcount() + 1
    return pdf


def test_match_position_across_buckets(spark):
    m = SB.messages_from_documents(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    got = TH.match_position(m, bucket_rows=7).select("message_id", "match_pos").toPandas()
    exp = _pandas_match_pos(m.toPandas())
    merged = exp.merge(got, on="message_id")
    assert len(merged) == len(exp) and (merged.pos == merged.match_pos).all()


def test_adaptive_thinning(spark):
    m = SB.messages_from_documents(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    got = set(TH.adaptive_thin(m, 4).select("message_id").toPandas().message_id)
    pdf = _pandas_match_pos(m.toPandas())
    n = pdf.groupby("originator_id").message_id.transform("count")
    f = (n / 4).apply(lambda x: max(1, int(-(-x // 1))))
    assert got == set(pdf[pdf.pos % f == 0].message_id)


def test_text_column_resolution(spark):
    a = spark.createDataFrame([(1, "x")], "n int, text string")
    b = spark.createDataFrame([(1, "x", "y")], "n int, other string, body string")
    assert SB.resolve_text_column(a) == "text"
    assert SB.resolve_text_column(b) == "other"
    with pytest.raises(ValueError):
        SB.resolve_text_column(spark.createDataFrame([(1,)], "n int"))


def test_required_columns_lists_all(spark):
    a = spark.createDataFrame([(1,)], "n int")
    with pytest.raises(ValueError) as e:
        SB.require_columns(batch=(a, ["raw_text", "message_id"]), campaigns=(None, []))
    assert "batch.raw_text" in str(e.value) and "batch.message_id" in str(e.value) and "campaigns" in str(e.value)


def test_originator_list_filter(spark):
    reg = spark.createDataFrame([("24273",), ("12",), (None,), ("99999",), ("24273",)], "business_number string")
    assert [r.originator_id for r in TH.originator_list_filtered(reg).collect()] == ["24273", "99999"]


def test_envelopes_with_and_without_outer_quotes(spark):
    rows = [('"{""sourceAddress"":""s1"",""requestID"":""1"",""shortMessage"":""a""}"', ("s1", "1", "a")),
            ('{""sourceAddress"":""s1"",""requestID"":""2"",""shortMessage"":""b \\""q\\"" c""}', ("s1", "2", 'b "q" c')),
            ('{"sourceAddress":"s2","requestID":"3","shortMessage":""}', ("s2", "3", "")),
            ('{""sourceAddress"":""s2"",""requestID"":""4"",""shortMessage"":""cut', ("s2", "4", None)),
            ('{""sourceAddress"":""s3"",""requestID"":""5"",""shortMessage"":""no end""', ("s3", "5", "no end"))]
    df = spark.createDataFrame([(v,) for v, _ in rows], "value string")
    got = EV.parse_envelopes(df).collect()
    assert [tuple(r) for r in got] == [w for _, w in rows]
