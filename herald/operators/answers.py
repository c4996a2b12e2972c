"""Answers of a caller's text function that outlive a broken run.

A ledger, a table under a path, holds one row per call: the prompt's hash, the answer or the error. Only
prompts without an answer are asked. They are dealt into small tasks, and a task's answers are
in the ledger as soon as the task ends, whatever becomes of the others: a lost task asks
again only what it had not finished.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herald import config
from herald.functions.labels import clean_label
from herald.operators.naming import call_text_function
from herald.session import cut_lineage

LEDGER = "prompt_hash string, prompt string, raw_text string, error string"


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows, or an empty table if there is none yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def ask(prompts: DataFrame, fn, path: str, attempts: int = 3, prompts_per_task: int = 16, temperature: float = 0.0,
        max_words: int | None = config.MAX_WORDS, prompt_col: str = "prompt") -> DataFrame:
    """``prompt, raw_text, label, error`` for every distinct prompt, answered now or before.

    A prompt that fails is asked again, up to ``attempts`` times in a call; its last error
    stays with an empty text, and a later call asks it anew. Null prompts are not asked.
    """
    spark = prompts.sparkSession
    digest = F.sha2(F.col(prompt_col), 256)
    wanted = cut_lineage(prompts.select(F.col(prompt_col).alias("prompt"), digest.alias("prompt_hash"))
                         .filter("prompt is not null").distinct())
    for _ in range(attempts):
        answered = read_answers(spark, path).filter("error is null").select("prompt_hash")
        todo = cut_lineage(wanted.join(answered, "prompt_hash", "left_anti"))
        n = todo.count()
        if not n:
            break
        dealt = todo.repartition(-(-n // prompts_per_task)).select("prompt")
        found = call_text_function(dealt, fn, temperature, max_words=None, distinct=False)
        # version 2 of the committer moves a task's file into place when the task ends
        found.withColumn("prompt_hash", F.sha2("prompt", 256)).select("prompt_hash", "prompt", "raw_text", "error") \
            .write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)
    ledger = read_answers(spark, path).join(wanted.select("prompt_hash"), "prompt_hash", "left_semi")
    # an answer stands before any error
    best = F.min(F.struct(F.col("error").isNotNull().alias("failed"), "raw_text", "error"))
    out = ledger.groupBy("prompt").agg(best.alias("b")).select("prompt", "b.raw_text", "b.error")
    return out if max_words is None else out.withColumn("label", clean_label("raw_text", max_words))
