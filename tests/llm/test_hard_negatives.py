import math
import random

import pytest
from helpers import CLASHES

from herald.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, positives=5, negatives=10):
    use = {}
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        use[i] = min(use.get(i, (lab, q)), (lab, q))
    out = []
    for a in sorted(use):
        if a % every:
            continue
        lab, q = use[a]
        score = {i: sum(x * y for x, y in zip(q, r)) for i, (_, r) in use.items()}
        order = sorted(use, key=lambda i: (-score[i], i))
        for p in [i for i in order if i != a and use[i][0] == lab][:positives]:
            s = score[p]
            near = [i for i in order if use[i][0] != lab and 30 * s <= 100 * score[i] <= 90 * s]
            out += [(a, p, r + 1, n, s, score[n]) for r, n in enumerate(near[:negatives])]
    return sorted(out)


def table(n, seed=1, dim=6, labels=3, grain=None):
    rng = random.Random(seed)
    def x():
        v = rng.uniform(-1, 1)
        return round(v * grain) / grain if grain else float(f"{v:.3f}")
    import numpy as np
    return [(i, [float(np.float32(x())) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


def run(spark, rows, every=100, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in H.hard_negatives(df, H.F.col("id") % every == 0, **kw).collect())


def test_equals_brute_force(spark):
    rows = table(700)
    assert run(spark, rows) == brute(rows)


def test_ties_copies_and_small_tiles(spark, monkeypatch):
    """Few distinct vectors, a third of them one vector, many tiles and stripes."""
    rows = [(i, rows_v if i % 3 else [1.0, 0.5, 0.0], lab) for i, rows_v, lab in table(400, 2, 3, 2, grain=2)]
    monkeypatch.setattr(H, "ROW_BLOCK", 64)
    monkeypatch.setattr(H, "ANCHOR_BLOCK", 8)
    got = run(spark, rows, every=10)
    assert got == brute(rows, every=10) and len(got) > 500


def test_scores_of_zero_and_below(spark):
    rows = [(0, [0.0, 0.0], 1), (1, [5.0, 5.0], 1), (2, [0.0, 0.0], 2), (3, [1.0, 1.0], 2),
            (100, [1.0, 0.0], 3), (101, [-1.0, 0.0], 3), (102, [-0.5, 0.0], 4)]
    got = run(spark, rows)
    assert got == brute(rows) and (0, 1, 1, 2, 0, 0) in got


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = table(250, 5) + [(None, [1.0] * 6, 1), (300, None, 1), (400, [1.0] * 6, None), (500, [nan] * 6, 1),
                            (600, [inf] * 6, 1), (700, [None] + [1.0] * 5, 1), (800, [], 1), (801, [1.0], 1),
                            (900, [0.5] * 9, 2), (900, [0.5] * 9, 2), (900, [0.25] * 9, 2), (-100, [0.5] * 6, 0),
                            (-101, [0.75] * 6, 0)]
    assert run(spark, rows) == brute(rows)
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("?") for c in (*CLASHES, "id", "q", "anchor", "ab") if c != "label"})
    assert sorted(tuple(r) for r in H.hard_negatives(df, F.col("id") % 100 == 0).collect()) == brute(rows)


def test_long_vectors_and_huge_components(spark):
    rows = table(60, 7, dim=3000, labels=2)
    assert run(spark, rows, every=20) == brute(rows, every=20)
    huge = [(i, [v[0] * 2.0 ** 20, v[1] * 2.0 ** 10], lab) for i, v, lab in table(80, 8, dim=2, labels=2)]
    got = run(spark, huge, every=20)
    assert got == brute(huge, every=20) and max(abs(r[4]) for r in got) > 2 ** 53


def test_no_rows_and_no_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []


def test_tiles_hand_on_a_bounded_number(spark):
    import numpy as np
    scores = np.array([[3, 3, 3, 3], [H.NONE, 1, 2, H.NONE]])
    row, col = H._best(scores, 2)
    assert list(zip(row, col)) == [(0, 0), (0, 1), (1, 2), (1, 1)]


@pytest.mark.parametrize("pair", [((1, 5, 0, 9), (1, 4, 0, 1)), ((1, 5, 0, 9), (1, 5, 1, 1)),
                                  ((-3, 0, 1, 1), (2, 9, 0, 0)), ((1, -1, 1, -2), (1, -2, 0, 0)),
                                  ((1, -1, 1, -2), (1, -1, 1, 5))])
def test_packed_keys_sort_as_stated(spark, pair):
    df = spark.createDataFrame([(a, s, k, i) for a, s, k, i in pair], "a long, s long, k int, i long")
    from pyspark.sql import functions as F
    keys = [r.key for r in df.select(F.when(F.col("k") == 0, H.pack_key("a", "s", 0, "i"))
                                     .otherwise(H.pack_key("a", "s", 1, "i")).alias("key")).collect()]
    assert bytes(keys[0]) < bytes(keys[1])
    assert [H._unpack(bytes(k)) for k in keys] == list(pair)
