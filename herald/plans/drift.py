"""End-to-end drift run (E1) for every sender at once.

reference messages -> templates -> vectors -> density profile (campaigns,
examples, names) -> new batch templates -> assignment -> discovery in the
Unknowns -> new campaigns -> summary. Results are written where they are the
input of several later steps: templates, vectors, labels, assignments.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from herald import config
from herald.operators.assign import assign_to_campaigns
from herald.operators.discover import adaptive_parameters, discover
from herald.operators.embed import DEFAULT_DIM, embed_templates
from herald.operators.hierarchy import exact_clusters
from herald.operators.profile import build_profile
from herald.operators.report import drift_summary
from herald.operators.templates import build_templates
from herald.session import cut_lineage
from herald.sources.batches import require_columns

MESSAGE_COLUMNS = ("originator_id", "message_id", "raw_text", "seq")


@dataclass
class DriftParams:
    dim: int = DEFAULT_DIM
    selection_epsilon: float = config.PROFILE_SELECTION_EPSILON
    discovery_epsilon: float = 0.0
    profile_min_samples: int | None = config.PROFILE_MIN_SAMPLES
    discovery_min_samples: int | None = config.DISCOVERY_MIN_SAMPLES
    sim_threshold: float = config.SIM_THRESHOLD
    min_coverage: float = config.MIN_COVERAGE
    min_unassigned: int = config.MIN_UNASSIGNED
    min_members: int = config.MIN_CLUSTER_MEMBERS
    n_nearest: int = config.N_NEAREST
    n_samples: int = config.N_SAMPLES
    max_words: int = config.MAX_WORDS
    centroid_threshold: float = config.CENTROID_SIM_THRESHOLD
    weighted: bool = True
    seed: int = 0
    run_ts: str | None = None             # None: the time of the run
    spread: int | None = None             # tasks for inputs of few splits


def cluster(vectors: DataFrame, min_samples: int | None, epsilon: float) -> DataFrame:
    """V6 with F18: ``vectors`` + ``cluster_label``; null ``min_samples`` takes the adaptive rule."""
    sized = vectors.join(adaptive_parameters(vectors, min_samples=min_samples), "originator_id")
    return exact_clusters(sized, "min_cluster_size", "min_samples", epsilon)


def reference_profile(ref_messages: DataFrame, p: DriftParams | None = None):
    """Stage 1: ``(templates_with_vectors_and_labels, campaigns, examples, model)``."""
    p = p or DriftParams()
    require_columns(reference=(ref_messages, MESSAGE_COLUMNS))                       # S6 / S7
    tpl = build_templates(ref_messages, seed=p.seed, spread=p.spread)
    vec, model = embed_templates(tpl, dim=p.dim)
    clustered = cut_lineage(cluster(vec, p.profile_min_samples, p.selection_epsilon))
    camps, examples = build_profile(clustered, n_nearest=p.n_nearest, weighted=p.weighted,
                                    max_words=p.max_words)
    return clustered, camps, examples, model


def assign_new_batch(new_messages: DataFrame, camps: DataFrame, model, p: DriftParams | None = None):
    """Stage 2a: new templates embedded in the reference space and assigned."""
    p = p or DriftParams()
    require_columns(batch=(new_messages, MESSAGE_COLUMNS),
                    campaigns=(camps, ("originator_id", "row_index", "cluster_label", "centroid")))
    tpl = build_templates(new_messages, seed=p.seed, spread=p.spread)
    vec, _ = embed_templates(tpl, dim=p.dim, model=model)
    return cut_lineage(assign_to_campaigns(vec, camps, p.sim_threshold))


def discover_new(assigned: DataFrame, p: DriftParams | None = None):
    """Stage 2b/2c: ``(upserted, proposed_clusters, new_campaigns)``."""
    p = p or DriftParams()
    return discover(assigned, lambda unknown: cluster(unknown, p.discovery_min_samples, p.discovery_epsilon),
                    min_coverage=p.min_coverage, min_unassigned=p.min_unassigned, min_members=p.min_members,
                    n_samples=p.n_samples, max_words=p.max_words, threshold=p.centroid_threshold,
                    run_ts=p.run_ts)


def drift_run(ref_messages: DataFrame, new_messages: DataFrame, p: DriftParams | None = None):
    """All stages; returns a dict of the produced tables."""
    p = p or DriftParams()
    clustered, camps, examples, model = reference_profile(ref_messages, p)
    assigned = assign_new_batch(new_messages, camps, model, p)
    upserted, clusters, new_camps = discover_new(assigned, p)
    summary = drift_summary(camps, assigned, new_camps, weighted=p.weighted)
    return {"clustered": clustered, "campaigns": camps, "examples": examples,
            "assigned": assigned, "upserted": upserted, "proposed": clusters,
            "new_campaigns": new_camps, "summary": summary}


def save_run(tables: dict, path: str) -> None:
    """Every table of a run as Parquet under ``path``."""
    from herald.sources.sinks import save_campaign_footprint, save_table
    save_campaign_footprint(tables["campaigns"], tables["examples"], f"{path}/footprint")
    for name in ("clustered", "assigned", "upserted", "new_campaigns", "summary"):
        save_table(tables[name], f"{path}/{name}")
