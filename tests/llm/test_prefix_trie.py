import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from helpers import CLASHES

from herald.llm import prefix_trie as P
from herald.llm.common import Scratch

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows, rebuild=True):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, key(role, text), role or "", text or ""))
    orig = {c: [x[3:] for x in sorted(ts)] for c, ts in turns.items()}
    convs = {}
    for c, own in orig.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = int(c / 20) * 20 if abs(c) < 2 ** 50 else c - c % 20
        convs[c] = orig.get(base, [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    kids = defaultdict(list)
    for n in members:
        if n:
            kids[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        own = (len(members[n]) - 1) * (len(WORD.findall(n[-1][1])) if n else 0)
        leaves[n] = sum(leaves[k] for k in kids[n]) if kids[n] else 1
        saved[n] = own + sum(saved[k] for k in kids[n])
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items()),
                  key=repr)


def run(spark, rows, rebuild=True, more=None):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).withColumns(more or {})
    args = (F.col("conv") - F.col("conv") % 20, F.crc32(F.col("conv").cast("string")) % 4, 3) if rebuild else ()
    return sorted((tuple(r) for r in P.conversation_trie(df, *args).collect()), key=repr)


def random_rows(n, seed=1, words=3, longest=9):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"]), " ".join(rng.choice("ab") for _ in range(rng.randrange(words))))
            for c in range(n) for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("rebuild", [True, False])
def test_equals_brute_force(spark, rebuild):
    rows = random_rows(120)
    assert run(spark, rows, rebuild) == brute(rows, rebuild)


def test_awkward_rows(spark):
    from pyspark.sql import functions as F
    rows = random_rows(45, 2, longest=4) + [
        (40, None, None, None), (40, None, "user", None), (40, 2, None, "x y"), (41, 2, None, "x y"), (None, 1, "user", "a"),
        (60, 5, "user", "tie one"), (60, 5, "user", "tie two"), (60, 5, "bot", "tie three"), (61, 5, "a", "bc"), (62, 5, "ab", "c"),
        (63, 1, "user", "again"), (63, 1, "user", "again"), (63, 1, "user", "again"), (-7, 1, "user", "neg"), (-27, 1, "user", "neg"),
        (-20, 1, "bot", "base of negatives"), (10 ** 15 + 3, 1, "user", "far"), (64, 1, "user", "word " * 300_000)]
    clashing = {c: F.lit("?") for c in (*CLASHES, "conv", "range", "pos", "nr", "id", "parent", "n_leaves") if c != "role"}
    assert run(spark, rows, more=clashing) == brute(rows)
    assert run(spark, []) == []


def test_one_conversation_and_one_opening_hold_most_rows(spark):
    """A very long chain over several ranges, and many conversations that are equal."""
    rng = random.Random(4)
    rows = [(5, t, "user", f"t{t % 7}") for t in range(700)] + [(c, t, "bot", f"same {t}") for c in range(100, 400) for t in range(3)]
    rows += [(c, 0, "user", "hello") for c in range(500, 800)] + [(c, 1, "bot", f"hi {c % 9}") for c in range(500, 800)]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def random_tree(kind, n, rng):
    if kind == "path":
        return [None, *range(n - 1)]
    if kind == "star":
        return [None] + [0] * (n - 1)
    if kind == "comb":
        return [None] + [i - 1 if i % 2 else max(0, i - 2) for i in range(1, n)]
    if kind == "forest":
        return [None if i % 10 == 0 else rng.randrange(i - i % 10, i) for i in range(n)]
    return [None] + [rng.randrange(max(0, i - 4), i) for i in range(1, n)]


@pytest.mark.parametrize("kind", ["path", "star", "comb", "forest", "bushy"])
def test_tree_contraction(spark, kind):
    """Chains that arise only after leaves have gone, compressed more than once."""
    rng = random.Random(kind)
    parent = random_tree(kind, 130, rng)
    w = [(rng.randrange(-5, 50), 1) for _ in parent]
    want = [list(x) for x in w]
    for i in reversed(range(len(parent))):
        if parent[i] is not None:
            for k in range(2):
                want[parent[i]][k] += want[i][k]
    names = list(range(1000, 1000 + len(parent)))
    rng.shuffle(names)
    df = spark.createDataFrame([(names[i], None if p is None else names[p], *w[i]) for i, p in enumerate(parent)],
                               "id long, parent long, v long, n long")
    got = {r.id: [r.v, r.n] for r in P.subtree_totals(df, ["v", "n"]).collect()}
    assert got == {names[i]: x for i, x in enumerate(want)}


def test_turns_are_numbered_over_ranges(spark):
    rows = [(c, t, "user", str(t)) for c in (1, 2) for t in range(300)]
    random.Random(1).shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = P.numbered_turns(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "t"), "conv_id", "turn", "role", "text").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.range for r in got}) > 3 and max(len({r.range for r in got if r.conv == c}) for c in (1, 2)) > 2
    assert {(r.conv, r.pos): r.key for r in got} == {(c, t + 1): bytearray(key("user", str(t))) for c in (1, 2) for t in range(300)}
