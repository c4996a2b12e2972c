"""Quality rules as a bitmask ledger, in DataFrame functions only.

:func:`ledger` measures every document once and evaluates every rule once: the
measurements and one failure bit per rule are stored. A *policy* is a named,
versioned set of rules, so applying another version, or asking what a rule alone
removes (:func:`ablation`), is bit arithmetic on the ledger and never reads a
text again.

All measurements are taken inside the row. Repeated three-word windows are found by
sorting the document's own window hashes, each packed into one long with its
position, and comparing the words where hashes agree, so no text is exploded or
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herald.llm.common import WORD_PATTERN

WINDOW = 3

#: Rules by bit; a rule holds the condition under which a document fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_text_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 12 * n_words",
    "capitals": "10 * n_capitals > 6 * n_letters",
    "exclamations": "2 * n_exclamations > n_words",
}
BASE = ("few_words", "repeated_windows")
#: Versioned policies: a document is kept if it fails none of the rules named.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "duplicate_lines"),
    "v2": (*BASE, "symbols", "duplicate_lines", "word_length", "capitals", "exclamations"),
}
CURRENT = "v2"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_text_lines",
            "n_capitals", "n_letters", "n_exclamations")


def mask(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _windows(words: Column, n: Column) -> Column:
    """Hash of each three-word window of ``words``."""
    each = F.transform(F.sequence(F.lit(0), n - WINDOW),
                       lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(n >= WINDOW, each).otherwise(F.array().cast("array<bigint>"))


def _covered(words: Column, hashes: Column, shift: Column) -> Column:
    """How many words lie in a window that occurs twice or more.

    Each hash gives up its low ``shift`` bits to the window's position, so that one
    sorted array of longs brings equal windows together. It only names candidates: those
    are sorted once more by their words themselves and then by position, and only
    neighbours with the same words count.
    """
    def high(x):
        return F.call_function("shiftright", x, shift)

    def beside(sorted_, same):
        return F.filter(sorted_, lambda x, j: F.coalesce(same(x, F.get(sorted_, j + 1)), F.lit(False))
                        | F.coalesce(same(x, F.get(sorted_, j - 1)), F.lit(False)))

    packed = F.sort_array(F.transform(hashes, lambda h, i: F.call_function("shiftleft", high(h), shift)
                                      .bitwiseOR(i.cast("long"))))
    low = F.call_function("shiftleft", F.lit(1).cast("long"), shift) - 1

    def windows(sorted_):
        near = beside(sorted_, lambda x, y: high(x) == high(y))
        return F.sort_array(F.transform(near, lambda x: F.struct(
            *[F.get(words, (x.bitwiseAND(low) + k).cast("int")).alias(f"w{k}") for k in range(WINDOW)],
            x.bitwiseAND(low).alias("at"))))

    def starts(sorted_):
        equal = beside(sorted_, lambda x, y: (x["w0"] == y["w0"]) & (x["w1"] == y["w1"]) & (x["w2"] == y["w2"]))
        return F.sort_array(F.transform(equal, lambda x: x["at"]))

    def union(at):
        gaps = F.transform(at, lambda x, j: F.least(F.lit(WINDOW).cast("long"),
                                                    F.coalesce(F.get(at, j + 1) - x,
                                                               F.lit(WINDOW).cast("long"))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    # transform over a one-element array binds a value that is used more than once
    bound = packed
    for step in (windows, starts, union):
        bound = F.transform(F.array(bound), step)[0]
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(bound)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, the measurements of ``MEASURES`` (long) and ``fail_bits`` (long).

    A null text has no words. Windows, lines and words are compared exactly as
    written. Repeated rows each have a row, a null id stays null, an empty table gives
    an empty one, other columns are not read. Windows are equal if their words are, in
    texts of any length.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    has_word = rf"{WORD_PATTERN}"
    x = docs.select(F.col(id_col), text.alias("t"),
                    F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)).alias("words"),
                    F.filter(F.split(text, "\n"), lambda s: s.rlike(has_word)).alias("lines"))
    x = x.withColumn("n", F.size("words")).withColumn("shift", F.length(F.bin(F.col("n").cast("long")))) \
        .withColumn("hashes", _windows(F.col("words"), F.col("n")))

    def count(other: str) -> Column:
        """Characters that ``other`` doesn't match."""
        return F.length(F.regexp_replace("t", other, "")).cast("long")

    x = x.select(
        F.col(id_col), F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        count("[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("words"), F.col("hashes"), F.col("shift")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_text_lines"),
        count("[^A-Z]+").alias("n_capitals"), count("[^A-Za-z]+").alias("n_letters"),
        count("[^!]+").alias("n_exclamations"))
    bits = F.lit(0).cast("long")
    for bit, condition in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return x.withColumn("fail_bits", bits)


def apply_policy(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Ledger rows with ``kept`` under a policy of :data:`POLICIES`."""
    return rows.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def ablation(rows: DataFrame) -> DataFrame:
    """Per policy and rule: documents dropped, those failing the rule, and those only it drops.

    The ledger is first counted by failure mask (at most one row per mask and task is
    shuffled); everything after works on these few rows.
    """
    masks = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    names = list(RULES)
    cases = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"),
                               F.lit(mask(rules)).cast("long").alias("mask"),
                               F.lit(1 << names.index(r)).cast("long").alias("bit"))
                      for p, rules in POLICIES.items() for r in rules])
    failed = F.col("fail_bits").bitwiseAND(F.col("c.mask"))
    return masks.select("fail_bits", "n", F.explode(cases).alias("c")).groupBy("c.policy", "c.rule").agg(
        F.sum(F.when(failed != 0, F.col("n")).otherwise(0)).alias("dropped"),
        F.sum(F.when(failed.bitwiseAND(F.col("c.bit")) != 0, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(failed == F.col("c.bit"), F.col("n")).otherwise(0)).alias("dropped_by_it_alone"))
