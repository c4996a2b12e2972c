"""The thirteen operators as registered queries over their whole tables.

Each query calls its operator with production parameters and derives the digest
columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herald.llm.common import Scratch, documents, fewer, read_table, rebalanced


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from herald.llm.simhash_near_dedup import hex_digits, near_duplicates
    found = near_duplicates(documents(spark, sf_dir), shingle=3, radius=3)
    return fewer(found.select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from herald.llm.source_mixing import mix
    return fewer(mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken",
                                                      "copies"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id`` of one tree."""
    from herald.llm.license_scan import license_scan
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return fewer(license_scan(documents(spark, sf_dir), "doc_id", path))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from herald.llm.line_dedup import kept_digest
    return fewer(kept_digest(documents(spark, sf_dir)))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from herald.llm.packing import pack_documents
    return fewer(pack_documents(documents(spark, sf_dir), tokenizer="word_bpe_49k.json", end_id=2,
                                capacity=4096))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from herald.llm.token_counts import token_counts
    return token_counts(documents(spark, sf_dir), tokenizer="byte_bpe_50k.json", limit=1024)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from herald.llm.toxicity import fit, held_out, score_documents
    docs, labels = documents(spark, sf_dir), read_table(spark, sf_dir, "labels")
    model = fit(docs, labels.select("doc_id", "toxic"), ~held_out())
    scored = score_documents(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from herald.llm.quality_rules import BASE, apply_policy, ledger, mask
    rows = apply_policy(ledger(documents(spark, sf_dir)))
    failed = F.col("fail_bits").bitwiseAND(F.lit(mask(BASE))) != 0
    return rebalanced(rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                  "n_repeat_words", failed.alias("base_failed"), "kept", "fail_bits"))


def quality_rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy of op8's ledger drops, and what it alone drops."""
    from herald.llm.quality_rules import ablation, ledger
    return ablation(ledger(documents(spark, sf_dir)))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are learned from rows whose crc32(doc_id) mod 3 is not 1; the rest is held out."""
    from herald.llm.quality_classifier import classify
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))
    scored = classify(documents(spark, sf_dir), read_table(spark, sf_dir, "pages"),
                      read_table(spark, sf_dir, "labels").select("doc_id", "quality"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "text_score", "meta_score", "score",
                         "predicted", (F.col("predicted") == 1).alias("kept"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from herald.llm.fingerprints import edited_fingerprints, hex_digits
    found = edited_fingerprints(documents(spark, sf_dir))
    return fewer(found.select("doc_id", "n_chars", "edited_sha256", hex_digits("fp").alias("fingerprint"),
                              hex_digits("edited_fp").alias("edited_fingerprint"), "near_edited",
                              "near_next", "n_near"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 100; every seventh label is turned wrong first."""
    from herald.llm.hard_negatives import hard_negatives
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").withColumn("label", wrong)
    return hard_negatives(rows, F.col("id") % 100 == 0, positives=5, negatives=10, low=30, high=90, scale=256)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from herald.llm.warc import archived_pages
    archive = Scratch(spark, "warc").root
    return rebalanced(archived_pages(read_table(spark, sf_dir, "pages"), f"{archive}/archives", least_bytes=100))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation c starts with the first crc32(c) % 4 turns of conversation c - c % 20."""
    from herald.llm.prefix_trie import conversation_trie
    return rebalanced(conversation_trie(read_table(spark, sf_dir, "conversations"), F.col("conv") - F.col("conv") % 20,
                                        F.crc32(F.col("conv").cast("string")) % 4, most=3))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_license_scan": op3_license_scan,
    "op4_line_dedup": op4_line_dedup,
    "op5_packing": op5_packing,
    "op6_token_counts": op6_token_counts,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "quality_rule_ablation": quality_rule_ablation,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_fingerprints": op10_fingerprints,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_warc": op12_warc,
    "op13_prefix_trie": op13_prefix_trie,
}
