import hashlib
from collections import defaultdict

import pytest
from helpers import edge_docs, edge_rows, no_docs

from herald.llm.line_dedup import dedup_lines, kept_digest

SPACE = " \t\n\x0b\x0c\r"
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows):
    holders = defaultdict(set)
    split = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda line: line.strip(SPACE).translate(UPPER)
    for i, lines in split:
        for line in lines:
            if i is not None and len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for i, lines in split:
        gone = [i is not None and len(h := holders[key(x)]) >= 3 and i != max(h) for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((i, len(lines), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_awkward_rows_match_brute_force(spark):
    assert found(kept_digest(edge_docs(spark))) == brute([r[:2] for r in edge_rows()])


def test_shared_lines_match_brute_force(spark):
    shared = ["This line is shared by very many documents.", "  tHIS LINE is shared by very many documents. \r",
              "short line", "exactly twenty chars", "nineteen characters", "ÄÖÜäöü sharp ß twenty one",
              "äöüäöü sharp ß twenty one", "x" * 100, "X" * 100, ""]
    rows = [(i % 37, "\n".join(shared[(i * k) % 10] + ("" if k % 3 else f" {i}") for k in range(1, 9)))
            for i in range(60)]
    rows += [(100, "\n".join([shared[0]] * 4)), (101, shared[0]), (None, shared[0]), (None, shared[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert any(d for _, _, d, _ in want)
    assert found(kept_digest(df)) == want


@pytest.mark.parametrize("share", [0, 12, 40, 10 ** 6])
def test_common_and_other_lines_take_both_ways(spark, monkeypatch, share):
    """No line, some lines, or all of them count as hot."""
    from herald.llm import line_dedup
    monkeypatch.setattr(line_dedup, "HOT_SHARE", share)
    often = ["a line that stands in nearly every document", "another line that is found here and there"]
    rows = [(i, "\n".join([often[0]] * (i % 8 > 0) + [often[1]] * (i % 5 == 0)
                          + [f"a line of a small group of documents {i // 2}", f"rare but repeated line {i // 4}"]))
            for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(kept_digest(df)) == brute(rows)


def test_repeated_rows_are_one_document(spark):
    line = "a line that stands in just two documents"
    df = spark.createDataFrame([(1, line), (1, line), (2, line)], "doc_id long, text string")
    assert dedup_lines(df).agg({"n_dropped": "sum"}).first()[0] == 0


def test_other_columns_pass_and_empty_table(spark):
    df = edge_docs(spark)
    out = dedup_lines(df)
    others = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    assert out.columns == [*others, "n_lines", "n_dropped"] and out.count() == df.count()
    assert dedup_lines(out).columns == out.columns
    kept = dedup_lines(df, counts=("a", "b"))
    assert kept.columns == [*df.columns, "a", "b"] and {r.n_lines for r in kept.collect()} == {"?"}
    assert kept_digest(no_docs(spark)).count() == 0
