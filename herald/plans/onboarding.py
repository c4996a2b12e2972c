"""Onboarding drift (E3): registered against discovered names, for the senders not judged yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.operators import naming as NM
from herald.sources.batches import require_columns
from herald.sources.sinks import load_verdicts, save_verdicts

VIEW_COLUMNS = ("originator_id", "onboarding_names", "discovered_names")


def judge_pending(view: DataFrame, done: DataFrame, path: str, fn=None, ledger: str | None = None) -> DataFrame:
    """All verdicts, old and new, saved to ``path``: ``business_number, llm_result, status``.

    Pending senders are judged by name similarity (N7), or by the caller's text function ``fn`` (N6), whose
    failures stay pending; its answers outlive a broken run in ``ledger``, a path. The status is read from the saved text (F17).
    """
    require_columns(view=(view, VIEW_COLUMNS), done=(done, ("business_number", "llm_result")))
    if fn is None:
        fresh = NM.drift_verdicts(view, done=done)
    else:
        fresh = NM.asked_verdicts(view, fn, done, ledger=ledger).filter(F.col("error").isNull())
    both = done.select("business_number", "llm_result").unionByName(fresh.select("business_number", "llm_result"))
    save_verdicts(both, path)
    return load_verdicts(view.sparkSession, path).withColumn("status", NM.status_from_text())
