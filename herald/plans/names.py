"""Names for all registered senders (E2): thin, profile, export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from herald import config
from herald.operators import thinning as TH
from herald.plans.drift import DriftParams, reference_profile
from herald.sources.batches import REGISTRATION_COLUMNS, require_columns
from herald.sources.sinks import export_campaign_names, load_table


def export_names(messages: DataFrame, registrations: DataFrame, path: str,
                 target_rows: int = config.TARGET_ROWS, params: DriftParams | None = None,
                 spread: int | None = None) -> DataFrame:
    """Campaign names of every registered sender, written to ``path`` and read back.

    Each sender is thinned towards ``target_rows`` messages by its own factor; senders whose messages form
    no campaign have no row.
    """
    require_columns(messages=(messages, ("originator_id", "message_id", "raw_text", "seq")),
                    registrations=(registrations, REGISTRATION_COLUMNS))
    mine = TH.filter_registered(messages, registrations)
    thinned = TH.adaptive_thin(mine, target_rows)
    _, camps, _, _ = reference_profile(thinned, params or DriftParams(spread=spread))
    export_campaign_names(camps, path)
    return load_table(messages.sparkSession, path)
