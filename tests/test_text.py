"""Normaliser: golden cases, single masks against character scanners on the test tables."""

import unicodedata

import pytest
from pyspark.sql import functions as F

import scanners
from paths import SF_SMALL
from herald.functions import labels as LB
from herald.functions import text as TX
from herald.functions.hashing import template_hash
from herald.functions.unicode import ascii_fold_host, fold_host

GOLDEN = [
    ("$5000", "${NUM}"),
    ("www.example.com", "{url:example.com}"),
    ("8005551111", "{OTP}"),
    ("+1 (212) 555-0199", "+{phone}"),
    ("Hello, your code is 4821", "{name}, your code is {OTP}"),
    ("Dear, your order shipped", "dear, your order shipped"),
    ("Thanks, Alice", "thanks, {name}"),
    ("Thanks, Alice. Call 2125550199 at 11:06 PM ET gate C18",
     "thanks, {name}. call {phone} at {TIME} {GATE}"),
    ("Mail john.doe@example.com now", "mail {email} now"),
    ("Visit https://WWW.Exämple.co.uk/path?x=1 now", "visit {url:co.uk} now"),
    ("see http://example.com?x=1", "see {url:example.com?x=1}"),   # query kept in the host
    ("see example.com?x=1", "see {url:example.com}?x={NUM}"),
    ("ｃｏｄｅ １２３４", "code {OTP}"),                 # NFKC full-width
    ("pаypal", "paypal"),                               # Cyrillic a folded
    ("zero\u200Bwidth", "zerowidth"),
    ("Wow!!!!! so   good\n\nyes", "wow!! so good yes"),
    ("a single space, \u00a0 then\tothers ", "a single space, then others"),
    ("Customer, your refund of $12.50 is due", "customer, your refund of ${NUM} is due"),
    ("Mary Jane Watson, hi", "{name}, hi"),
    ("Bank: Sydney Nguyen sent you $50", "bank: {name} sent you ${NUM}"),
    ("Best, Bob-Lee", "best, {name}"),
    ("pin 123 or code 123456789", "pin {NUM} or code {phone}"),
    ("Code 12345678.", "code {phone}."),
    ("Go to shop.example.co/a?b=1, or www.a.b.example.org:8080/x", "go to {url:example.co} or {url:example.org}:{OTP}/x"),  # www is ww by then
    ("http:// and https://x", "http:// and {url:x}"),
    ("3.5kg and 1.5 l at 7:30 am", "{NUM}.5kg and {NUM} l at {NUM}:{NUM} am"),
    ("11:06pm ET, Gate b7", "{TIME}, {GATE}"),
    ("{already} {12} x12 12x", "{already} {12} x12 12x"),
    ("soooo loooong 1111", "soo loong {NUM}"),
    ("\u00c9t\u00e9 2024", "\u00e9t\u00e9 {OTP}"),
    ("\u0399\u0397 \u03b9\u03b7", "ih in"),
    ("", ""),
]


@pytest.mark.parametrize("raw,expected", GOLDEN)
def test_golden(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw_text string")
    got = TX.normalize_messages(df).first().normalized_text
    assert got == expected


def test_transfer_notices_one_template(spark):
    rows = [("chase | zelle(r): sydney nguyen sent you $50 & it's ready now. reply stop to cancel these texts.",),
            ("chase | zelle(r): landau tzou sent you $120.75 & it's ready now. reply stop to cancel these texts.",),
            ("chase | zelle(r): jose trevino sent you $9 & it's ready now. reply stop to cancel these texts.",)]
    df = TX.normalize_messages(spark.createDataFrame(rows, "raw_text string"))
    df = df.withColumn("h", template_hash("normalized_text"))
    assert df.select("h").distinct().count() == 1


@pytest.mark.parametrize("table,col", [("documents", "text"), ("conversations", "text"), ("pages", "html"),
                                       ("events", "props"), ("benchmark", "text")])
def test_single_masks_agree_with_scanners(spark, table, col):
    df = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(F.col(col).alias("t"))
    got = df.select("t", TX.mask_numbers("t").alias("n"), TX.mask_phones("t").alias("p"),
                    TX.mask_greeting_name("t").alias("g")).collect()
    assert not [r.t for r in got if r.n != scanners.numbers(r.t)][:2]
    assert not [r.t for r in got if r.p != scanners.phones(r.t)][:2]
    assert not [r.t for r in got if r.g != scanners.greeting(r.t)][:2]


def test_random_strings_agree_with_scanners(spark):
    import random
    rnd = random.Random(7)
    alphabet = list("abXY019 ,.-+(){}\t_") + ["123", "4567", "555-0199", "12.5", "Ann, ", "Dear, ", "Thanks, "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", TX.mask_numbers("t").alias("n"), TX.mask_phones("t").alias("p")).collect():
        assert r.n == scanners.numbers(r.t), r.t
        assert r.p == scanners.phones(r.t), r.t


def test_whitespace_is_collapsed_like_python_split(spark):
    import random
    rnd = random.Random(3)
    spaces = [" ", "  ", "\t", "\n", "\u00a0", "\u2003", "\x1c", "\u3000", "\u200b"]
    texts = ["".join(rnd.choice([*spaces, "a", "b c"]) for _ in range(rnd.randint(0, 12))) for _ in range(1000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", TX.collapse_whitespace("t").alias("c")).collect():
        assert r.c == " ".join(r.t.split())


def test_masks_fire_on_notices(spark):
    from herald.catalog import q_fold_notices, q_mask_notices
    rows = q_mask_notices(spark, SF_SMALL).collect()
    assert rows and all("{NAME} sent you" in r.sent and r.signed.endswith("Thanks, {NAME}") or " " in r.signed
                        for r in rows)
    assert all("{TIME}" in r.timed and "{GATE}" in r.gated and r.has_code and "{OTP}" in r.coded for r in rows)
    assert all(r.folded.isascii() for r in q_fold_notices(spark, SF_SMALL).collect())


def test_host_fold_matches_python(spark):
    chars = [chr(c) for c in list(range(0xC0, 0x250)) + list(range(0x370, 0x500)) + [0xFF21, 0x2460, 0x1D400]
             if unicodedata.normalize("NFKC", chr(c)) == chr(c)]
    df = spark.createDataFrame([("x" + c + ".com",) for c in chars], "h string")
    got = {r.h: r.f for r in df.select("h", ascii_fold_host(F.col("h")).alias("f")).collect()}
    assert all(got[h] == fold_host(h) for h in got)


def test_label_cleanup(spark):
    df = spark.createDataFrame([("  Bank: Login-Codes!!! for you, today and more  ",), (None,)], "t string")
    out = [r.x for r in df.select(LB.clean_label("t", 5).alias("x")).collect()]
    assert out == ["Bank Login-Codes for you today", ""]


def test_display_name(spark):
    df = spark.createDataFrame([("a" * 31,), ("short",)], "t string")
    assert [r.x for r in df.select(LB.display_name("t").alias("x")).collect()] == ["a" * 27 + "...", "short"]


def test_long_runs_of_digits_and_labels_take_no_stack_frame_each(spark):
    """A repeated group took a stack frame per digit or label, and a long run ended the executor."""
    digits, labels = "1 " * 20_000 + "end", "a." * 1_500 + "com/x y"
    rows = [(digits, "{phone} end"), ("x" + digits, None), (labels, "{url:a.com} y"), ("a..b.co 1", "a..{url:b.co} {NUM}")]
    got = [r.normalized_text for r in TX.normalize_messages(spark.createDataFrame(rows, "raw_text string, want string")).collect()]
    assert got[0] == rows[0][1] and got[2:] == [r[1] for r in rows[2:]]


def test_guards_leave_texts_as_the_plain_steps_make_them(spark):
    texts = ["a \t b", "café   x", "аbc", "​z", "ﬁne", "ℓ 1", "á", "\x1c\x1d", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.trim(F.regexp_replace("t", TX.P_SPACES, " "))
    assert df.filter(~plain.eqNullSafe(TX.collapse_whitespace("t"))).count() == 0
    may = ~TX.is_ascii("t") & F.col("t").rlike(TX.P_MAY_FOLD)
    folded = df.filter((TX.fold_confusables("t") != F.col("t")) & ~may)
    assert folded.count() == 0 and df.filter(may).count() == 4
    assert [r.n for r in df.select(TX.unicode_nfkc("t").alias("n")).collect()] == [t and unicodedata.normalize("NFKC", t) for t in texts]
