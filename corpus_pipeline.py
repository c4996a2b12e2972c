"""A corpus pipeline: STAGES applied to ``documents``, each stage written and reread.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. In order: toxic documents go; repeated lines go; one
document of each near-duplicate group stays; sources are mixed to their target
weights (documents taken several times become several rows); what is left is
packed into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herald.llm.common import Scratch, documents, fewer, read_table
from herald.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't reject; its labels come from ``labels``."""
    from herald.llm.toxicity import fit, held_out, score_documents
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit(docs, labels, ~held_out())
    scored = score_documents(docs, model, score="__toxicity", predicted="__toxic")
    return scored.filter("__toxic = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its text rebuilt from the kept lines and ``n_chars`` counted anew."""
    from herald.llm.line_dedup import dedup_lines
    ship_package(spark)
    kept = dedup_lines(docs, counts=("__lines", "__dropped"))
    return fewer(kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns), 4)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the smallest doc_id."""
    from herald.llm.simhash_near_dedup import one_of_each
    ship_package(spark)
    return fewer(one_of_each(docs, shingle=3, radius=3), 4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes of a document."""
    from herald.llm.source_mixing import mixed_documents
    ship_package(spark)
    return fewer(mixed_documents(docs), 4)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    from herald.llm.packing import pack_documents
    ship_package(spark)
    return fewer(pack_documents(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("packing", pack),
]

#: Aho-Corasick scores, XXH64 fingerprints and tokenizers are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; each result is written and reread."""
    docs = documents(spark, sf_dir)
    scratch = Scratch(spark, "pipeline")
    for _name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs
