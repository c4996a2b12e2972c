"""R2: streaming assignment of incoming messages to known campaigns, each template embedded once.

Every micro-batch is deduplicated to templates. A ledger, a table of the templates of all micro-batches
with their assignments and counts, stands for what the stream has seen: templates it holds take
their assignment from there, only the others are embedded and assigned, by the same blocked
product as a batch. Messages then take their template's result. A micro-batch that is run again
after a failure reads the ledger as it was before it and overwrites its own folders, so no
message appears twice and no count is doubled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herald import config
from herald.operators.assign import assign_to_campaigns
from herald.operators.embed import embed_templates
from herald.operators.templates import dedupe_by_hash, normalize_and_hash
from herald.session import cut_lineage, drop_cut

KEYS = ["originator_id", "template_hash"]
ASSIGNED = ["assigned_campaign_row_index", "assigned_campaign_score", "assigned_campaign_label",
            "assigned_campaign_name", "status"]


def assign_messages(messages: DataFrame, campaigns: DataFrame, model,
                    sim_threshold: float = config.SIM_THRESHOLD, seed: int = 0,
                    spread: int | None = None) -> DataFrame:
    """``messages`` (a batch) with their template's assignment."""
    hashed = cut_lineage(normalize_and_hash(messages, seed=seed, spread=spread))
    vec, _ = embed_templates(dedupe_by_hash(hashed), model=model, keep=KEYS)
    return hashed.join(assign_to_campaigns(vec, campaigns, sim_threshold).select(*KEYS, *ASSIGNED), KEYS)


def read_ledger(spark: SparkSession, path: str, before: int, keep_batches: int | None = None) -> DataFrame | None:
    """The ledger's rows of the micro-batches before ``before`` (the last ``keep_batches`` of them); None if there are none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    rows = spark.read.parquet(path).filter(F.col("batch") < before)
    return rows if keep_batches is None else rows.filter(F.col("batch") >= before - keep_batches)


def assign_new(templates: DataFrame, ledger: DataFrame | None, campaigns: DataFrame,
               embed: Callable[[DataFrame], DataFrame], sim_threshold: float = config.SIM_THRESHOLD) -> DataFrame:
    """``KEYS, ASSIGNED`` of every template; only those the ledger doesn't hold are embedded."""
    if ledger is None:
        return assign_to_campaigns(embed(templates), campaigns, sim_threshold).select(*KEYS, *ASSIGNED)
    # the micro-batch's keys are the small side, so the ledger is filtered as it is scanned
    known = cut_lineage(ledger.join(templates.select(*KEYS), KEYS, "left_semi").select(*KEYS, *ASSIGNED).dropDuplicates(KEYS))
    new = cut_lineage(templates.join(known, KEYS, "left_anti"))
    if not new.limit(1).count():
        return known
    return known.unionByName(assign_to_campaigns(embed(new), campaigns, sim_threshold).select(*KEYS, *ASSIGNED))


def write_assignments(stream: DataFrame, campaigns: DataFrame, model, path: str, checkpoint: str,
                      sim_threshold: float = config.SIM_THRESHOLD, trigger_once: bool = True,
                      spread: int | None = None, ledger: str | None = None, keep_batches: int | None = None,
                      prepare: Callable[[DataFrame], DataFrame] | None = None,
                      embed: Callable[[DataFrame], DataFrame] | None = None,
                      carry=("message_id", "normalized_text")):
    """Append each micro-batch's assignments to a Parquet table, one folder a batch.

    ``ledger`` (``<path>-templates`` by default) holds a row per micro-batch and template: its
    assignment and count. It belongs to one set of campaigns. A template that none of
    the last ``keep_batches`` micro-batches had is embedded anew; by default none is forgotten.
    ``prepare`` and ``embed`` replace normalising and embedding, for a stream that brings hashes
    or vectors; ``carry`` names the columns that ``embed`` needs.
    """
    ledger = ledger or path.rstrip("/") + "-templates"
    prepare = prepare or (lambda batch: normalize_and_hash(batch, spread=spread))
    embed = embed or (lambda templates: embed_templates(templates, model=model, keep=KEYS)[0])

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        hashed = cut_lineage(prepare(batch))
        templates = cut_lineage(dedupe_by_hash(hashed, carry=carry))
        found = assign_new(templates, read_ledger(spark, ledger, number, keep_batches), campaigns, embed, sim_threshold)
        mine = f"{ledger}/batch={number}"
        templates.select(*KEYS, "count_in_window").join(found, KEYS).write.mode("overwrite").parquet(mine)
        hashed.join(spark.read.parquet(mine).drop("count_in_window"), KEYS) \
            .write.mode("overwrite").parquet(f"{path}/batch={number}")
        drop_cut(hashed)
        drop_cut(templates)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if trigger_once else w).start()


def template_totals(spark: SparkSession, ledger: str) -> DataFrame:
    """Messages and micro-batches of every template the stream has seen, with its assignment."""
    return spark.read.parquet(ledger).groupBy(*KEYS).agg(
        F.sum("count_in_window").alias("messages"), F.count("*").alias("batches"),
        *[F.first(c).alias(c) for c in ASSIGNED])
