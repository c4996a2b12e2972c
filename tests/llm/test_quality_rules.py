import re
from collections import Counter

from helpers import edge_docs, edge_rows, no_docs, prose

from herald.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = [tuple(words[i:i + 3]) for i in range(n - 2)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    m = dict(n_words=n, word_chars=sum(map(len, words)), n_symbols=len(re.findall(r"[#*$%&|<>]", text)),
             n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(covered), n_text_lines=len(lines),
             n_capitals=len(re.findall("[A-Z]", text)), n_letters=len(re.findall("[A-Za-z]", text)),
             n_exclamations=text.count("!"))
    fails = [n < 50, 100 * len(covered) > 50 * n, 10 * m["n_symbols"] > n, 2 * m["n_dup_lines"] > len(lines),
             m["word_chars"] < 2 * n or m["word_chars"] > 12 * n, 10 * m["n_capitals"] > 6 * m["n_letters"],
             2 * m["n_exclamations"] > n]
    return (*m.values(), sum(1 << b for b, f in enumerate(fails) if f))


HARD = ["a b c a b c", "a b c d a b c", "a a a a a", "a a", "x y z " * 100, prose(200, 1) + "\n" + prose(200, 1),
        "A! B! C!\n" * 40, "w|w|w " * 60, "one\n\n \none\none ", "# $ % " * 30, prose(70, 2).upper(),
        "a b c x a b c y b c x", "\n".join([prose(5, 1)] * 30)]


def test_measurements_match_brute_force(spark):
    rows = [r[:2] for r in edge_rows()] + [(100 + i, t) for i, t in enumerate(HARD)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Q.ledger(df).collect()
    want = sorted(((i, *brute(t)) for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert {b for r in got for b in range(7) if r.fail_bits >> b & 1} == set(range(7))


def test_policies_and_ablation(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(HARD + [prose(80, 3)])], "doc_id long, text string")
    rows = Q.ledger(df)
    bits = {r.doc_id: r.fail_bits for r in rows.collect()}
    for policy, rules in Q.POLICIES.items():
        kept = {r.doc_id for r in Q.apply_policy(rows, policy).collect() if r.kept}
        assert kept == {i for i, b in bits.items() if not b & Q.mask(rules)}
    for r in Q.ablation(rows).collect():
        m, one = Q.mask(Q.POLICIES[r.policy]), Q.mask([r.rule])
        assert r.dropped == sum(b & m != 0 for b in bits.values())
        assert r.failing == sum(b & one != 0 for b in bits.values())
        assert r.dropped_by_it_alone == sum(b & m == one for b in bits.values())


def test_awkward_columns_and_empty_table(spark):
    assert Q.ledger(edge_docs(spark)).count() == 15
    assert Q.ledger(no_docs(spark)).count() == 0 and Q.ablation(Q.ledger(no_docs(spark))).count() == 0


def test_plan_has_no_python(spark):
    plan = Q.apply_policy(Q.ledger(edge_docs(spark)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_windows_whose_short_hashes_clash_are_told_apart(spark):
    """Nearly all bits go to the position here, so most windows share their hash."""
    from pyspark.sql import functions as F
    texts = [prose(300, 3) + " a b c " + prose(50, 2) + " a b c", "p q r s t u v w x", prose(90, 1) * 2]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    words = F.regexp_extract_all("text", F.lit(Q.WORD_PATTERN), F.lit(0))
    for bits in (62, 64):
        hashes = F.transform(Q._windows(words, F.size(words)),
                             lambda h: h if bits == 64 else F.pmod(h, F.lit(3)) * (1 << 61))
        shift = F.lit(62) if bits == 62 else F.lit(20)
        # equal windows keep equal hashes; different ones clash
        got = df.select("doc_id", Q._covered(words, hashes, shift).alias("n")).collect()
        assert {r.doc_id: r.n for r in got} == {i: brute(t)[4] for i, t in enumerate(texts)}


def test_a_text_of_two_million_words(spark):
    long_text = " ".join(f"w{i}" for i in range(2_100_000)) + " w5 w6 w7"
    df = spark.createDataFrame([(1, long_text)], "doc_id long, text string")
    row = Q.ledger(df).collect()[0]
    assert (row.n_words, row.n_repeat_words) == (2_100_003, 6)
