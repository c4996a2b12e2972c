import hashlib
import re

import pytest
from helpers import edge_docs, edge_rows, no_docs, prose
from pyspark.sql import functions as F

from herald.llm import fingerprints as P
from herald.llm.common import Scratch


def hashes(spark, terms):
    rows = spark.createDataFrame([(t,) for t in sorted(terms)], "t string").selectExpr("t", "xxhash64(t) as h")
    return {r.t: r.h % 2 ** 64 for r in rows.collect()}


def text_terms(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return [f"{a} {b}" for a, b in zip(words, words[1:])] if len(words) > 1 else words


def brute_fp(text, h):
    terms = text_terms(text)
    total = sum(min(len(t), 15) for t in terms)
    return sum(1 << b for b in range(64) if 2 * sum(min(len(t), 15) for t in terms if h[t] >> b & 1) > total)


def brute(spark, rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    edited = []
    for k, (_, t) in enumerate(rows):
        third = len(t) // 3
        edited.append(t[:len(t) - third] + rows[(k + 1) % len(rows)][1][:third])
    h = hashes(spark, {x for t in [t for _, t in rows] + edited for x in text_terms(t)})
    fps = [brute_fp(t, h) for _, t in rows]
    out = []
    for k, (i, t) in enumerate(rows):
        efp, nfp = brute_fp(edited[k], h), fps[(k + 1) % len(rows)]
        near = sum((fps[k] ^ f).bit_count() <= 3 for f in fps) - 1 if i is not None and i % 20 == 0 else None
        out.append((i, len(t), hashlib.sha256(edited[k].encode()).hexdigest(), fps[k], efp,
                    1 - (fps[k] ^ efp).bit_count() / 64, 1 - (fps[k] ^ nfp).bit_count() / 64, near))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fp % 2 ** 64, r.edited_fp % 2 ** 64, r.near_edited,
                    r.near_next, r.n_near) for r in df.collect()), key=repr)


def test_awkward_rows_match_brute_force(spark):
    assert found(P.edited_fingerprints(edge_docs(spark))) == brute(spark, [r[:2] for r in edge_rows()])


def test_neighbours_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(P.in_buckets, "__defaults__", (7,))
    rows = [(3 * i - 50, prose(20 + i % 30, i % 9)) for i in range(90)] + [(None, "late text here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert P.in_buckets(df, "doc_id", Scratch(spark, "test")).select("bucket").distinct().count() > 8
    assert found(P.edited_fingerprints(df)) == brute(spark, rows)


@pytest.mark.parametrize("radius", [1, 3])
def test_search_finds_every_pair_once(spark, radius):
    fps = [0]
    for i in range(120):
        x = fps[(i * 7) % len(fps)]
        for b in range(1 + i % 5):
            x ^= 1 << (i * 11 + b * 17) % 64
        fps.append(x if i % 4 else (x * 0x9E3779B97F4A7C15) % 2 ** 64)
    fps = sorted(set(fps))
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    rows = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = [(r.q, r.fp, r.bits) for r in P.near_pairs(rows.selectExpr("fp as q"), rows, radius).collect()]
    want = [(a, b, ((a ^ b) % 2 ** 64).bit_count()) for a in signed for b in signed
            if ((a ^ b) % 2 ** 64).bit_count() <= radius]
    assert sorted(got) == sorted(want) and len(want) > len(fps) + 20


def test_single_document_and_empty_table(spark):
    one = P.edited_fingerprints(spark.createDataFrame([(7, "abcdef ghi")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdef abc").hexdigest() and one.near_next == 1.0
    assert P.edited_fingerprints(no_docs(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = P.edited_fingerprints(edge_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_buckets_follow_the_rows_however_ids_are_spread(spark):
    far = F.when(F.col("id") == 7, F.lit(10 ** 15)).when(F.col("id") % 3 == 0, F.col("id") * 1000).otherwise(F.col("id"))
    df = spark.range(60000).select(far.alias("doc_id")).unionByName(spark.createDataFrame([(None,)], "doc_id long"))
    rows = P.in_buckets(df, "doc_id", Scratch(spark, "test"), 100).groupBy("bucket").agg(
        F.count("*").alias("n"), F.max("doc_id").alias("high"), F.min("doc_id").alias("low")).orderBy("bucket").collect()
    assert sum(r.n for r in rows) == 60001 and max(r.n for r in rows) < 400 and len(rows) < 1500
    assert rows[-1].high is None and all(a.low > b.high for a, b in zip(rows, rows[1:-1]))
    ties = P.in_buckets(spark.range(500).select((F.col("id") % 2).alias("doc_id")), "doc_id", Scratch(spark, "test"), 10)
    assert ties.groupBy("bucket").count().count() == 2
