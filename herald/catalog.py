"""Registered queries: one per operator of the inventory, each reading the
given tables (or what Spark derives from them) in full.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame; computed
columns carry the same names as in :mod:`herald.oracle`. Doubles that come
out of vector arithmetic are rounded to 6 places so that two engines agree.
"""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herald.functions import labels as LB
from herald.functions import text as TX
from herald.functions.hashing import template_hash
from herald.functions.vectors import unit_normalize
from herald.operators import assign as AS
from herald.operators import discover as DI
from herald.operators import naming as NM
from herald.operators import profile as PR
from herald.operators import report as RP
from herald.operators import thinning as TH
from herald.operators.centroids import centroids
from herald.operators.density import cos_to_dist, density_clusters, eom_clusters
from herald.operators.hierarchy import exact_clusters
from herald.operators.near_index import recall_by_blocks
from herald.operators.neighbours import similar_pairs
from herald.operators.pruned import nearest_center_pruned
from herald.session import cut_lineage, ensure_checkpoint_dir, ship_package
from herald.sources import batches as SB
from herald.sources import envelopes as EV
from herald.sources import sinks as SK

# Parameters of the registered queries (part of each query's definition).
EXTRACT_ORIGINATOR = "src3"
EXTRACT_DILUTE = 3
EXTRACT_BOUND = 500
THIN_EVERY = 3
ADAPTIVE_TARGET = 20
REGISTERED_LANG = "de"
EMB_SIM_THRESHOLD = 0.2
EMB_PAIR_MIN_COS = 0.3
EMB_INDEX_TILE = 32
EMB_CELL_CENTERS = 8
EMB_DENSITY_MIN_COS = 0.3
EMB_DENSITY_MIN_SAMPLES = 2
EMB_DENSITY_MIN_SIZE = 3
EMB_LADDER_COS = (0.5, 0.35, 0.28)
EMB_EXACT_MIN_COS = 0.45
SEMANTIC_DIM = 16
EMB_NOISE_DISTANCE = 0.85
RUN_TS = "2024-01-01 00:00:00"
WINDOW = "1 day"
WATERMARK = "1 hour"
#: Tasks that small inputs are dealt to before the normaliser; unset, inputs stay as they are split.
SPREAD_CONF = "spark.herald.input.tasks"


def _r(c, n: int = 6):
    return F.round(c, n)


def spread(spark: SparkSession) -> int | None:
    n = spark.conf.get(SPREAD_CONF, None)
    return int(n) if n else None


def docs(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    df, n = SB.read_table(spark, d, "documents"), spread(spark)
    return df.repartition(n) if n else df


def scratch_path(spark: SparkSession) -> str:
    """A new folder name on the cluster's shared file system, for queries that write and read back."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/herald-query-{uuid.uuid4().hex}"


def messages(spark: SparkSession, d: str) -> DataFrame:
    return SB.messages_from_documents(docs(spark, d))


def registrations(spark: SparkSession, d: str) -> DataFrame:
    return SB.registrations_from_documents(docs(spark, d))


# ---------------------------------------------------------------- sources
def q_envelope_parse(spark, d):
    env = EV.envelopes_from_documents(docs(spark, d))
    return EV.parse_envelopes(env).select("originator_id", "message_id", "raw_text", "seq")


def q_extract_originator(spark, d):
    env = EV.parse_envelopes(EV.envelopes_from_documents(docs(spark, d)))
    return EV.extract_originator(env, EXTRACT_ORIGINATOR, dilute_factor=EXTRACT_DILUTE)


def q_bounded_scan(spark, d):
    """S2 with a bound that the input reaches; without one nothing is left out."""
    return EV.bounded_scan(messages(spark, d), EXTRACT_BOUND)


def q_envelopes_csv(spark, d):
    """A dump written as CSV files and scanned again."""
    path = scratch_path(spark)
    EV.envelopes_from_documents(docs(spark, d)).select(F.col("value").alias("Value")) \
        .write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return EV.parse_envelopes(EV.read_envelope_csv(spark, path)) \
        .select("originator_id", "message_id", "raw_text")


def q_envelope_forms(spark, d):
    """T19, T20 with and without outer quotes, doubled and not."""
    return EV.parse_envelopes(EV.envelope_forms(docs(spark, d))) \
        .select("originator_id", "message_id", "raw_text", "seq")


def q_dump_positions(spark, d):
    """Input positions over files whose texts hold line ends and quotes, each read in splits."""
    path = scratch_path(spark)
    messages(spark, d).select("message_id", "raw_text", "seq").repartitionByRange("seq").sortWithinPartitions("seq") \
        .drop("seq").write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return SB.read_message_csv(spark, path).select("message_id", "raw_text", "seq")


def q_messages_csv(spark, d):
    """S3: a message batch written as CSV and read back."""
    path = scratch_path(spark)
    messages(spark, d).drop("seq").write.option("header", True).option("escape", '"') \
        .option("quoteAll", True).csv(path)
    return SB.read_message_csv(spark, path).select("originator_id", "message_id", "raw_text")


def q_registrations_csv(spark, d):
    """A sheet with further and reordered columns, bound by header."""
    path = scratch_path(spark)
    sheet = registrations(spark, d).orderBy("seq").select(
        F.col("seq").cast("string").alias("row_id"), "customer_experience", "campaign_name",
        F.lit("note").alias("remarks"), "business_number", "content_type", "description", "call_to_action")
    sheet.coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    return SK.read_registrations(spark, path)


def q_per_originator(spark, d):
    """Messages written as one folder per sender, one sender read back."""
    path = scratch_path(spark)
    SK.write_per_originator(messages(spark, d), path)
    return SK.read_originator(spark, path, EXTRACT_ORIGINATOR) \
        .select("originator_id", "message_id", "raw_text", "seq")


def q_null_text_counts(spark, d):
    """Messages whose text is that of the benchmark item with the document's number, if any."""
    from herald.operators.templates import null_text_counts
    b = SB.read_table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"),
                                                    F.col("text").alias("raw_text"))
    return null_text_counts(docs(spark, d).select(F.col("source").alias("originator_id"), "doc_id")
                            .join(b, "doc_id", "left"))


def q_thin_by_match(spark, d):
    return TH.thin_by_match_position(messages(spark, d), THIN_EVERY)


def q_adaptive_thin(spark, d):
    return TH.adaptive_thin(messages(spark, d), ADAPTIVE_TARGET)


def q_dilute_factors(spark, d):
    return TH.dilute_factors(messages(spark, d), ADAPTIVE_TARGET)


def q_registrations(spark, d):
    return registrations(spark, d)


def q_originator_list(spark, d):
    return TH.originator_list_filtered(registrations(spark, d))


def q_registered_messages(spark, d):
    reg = SB.registrations_from_documents(docs(spark, d).filter(F.col("lang") == REGISTERED_LANG))
    return TH.filter_registered(messages(spark, d), reg)


def q_text_column(spark, d):
    """S4/S5 on ``benchmark`` (no ids, text column ``text``)."""
    b = SB.read_table(spark, d, "benchmark")
    return SB.as_message_batch(b, seq_col="item_id")


# ---------------------------------------------------------------- text
def q_fold_confusables(spark, d):
    return docs(spark, d).select("doc_id", TX.fold_confusables("text").alias("folded"))


def q_collapse_whitespace(spark, d):
    return docs(spark, d).select("doc_id", TX.collapse_whitespace("text").alias("collapsed"))


def q_mask_names_contacts(spark, d):
    t = TX.collapse_whitespace("text")
    c = TX.mask_emails(TX.mask_name_before_sent(TX.mask_greeting_name(TX.mask_signoff_name(t))))
    return docs(spark, d).select("doc_id", c.alias("masked"))


def q_mask_codes(spark, d):
    t = F.lower(TX.collapse_whitespace("text"))
    return docs(spark, d).select("doc_id", TX.mask_codes(TX.mask_gates(TX.mask_times(t))).alias("masked"))


def notices(spark, d) -> DataFrame:
    """Texts made of ``part`` that hold what the name, time, gate and code masks look for."""
    k = F.col("p_partkey")
    name = F.initcap("p_name")
    look_alike = F.translate(name, "aeo", "\u0430\u0435\u043e")
    return SB.read_table(spark, d, "part").select(
        "p_partkey", F.concat(
            F.lit("Alert: "), name, F.lit(" sent you $"), F.col("p_retailprice").cast("string"),
            F.lit(" at "), (k % 12 + 1).cast("string"), F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0"),
            F.when(k % 2 == 0, " PM ET").otherwise("am et"), F.lit(", gate C"), (F.col("p_size") % 100).cast("string"),
            F.lit(". Your security code is "), (k + 1000).cast("string"), F.lit(". Thanks, "), look_alike).alias("text"))


def q_fold_notices(spark, d):
    """T1 on texts with look-alike letters in every row."""
    return notices(spark, d).select("p_partkey", TX.fold_confusables("text").alias("folded"))


def q_mask_notices(spark, d):
    """T5, T7, T11-T13 one by one on texts in which each finds something."""
    t = notices(spark, d).withColumn("text", TX.fold_confusables("text")) \
        .withColumn("low", F.lower("text"))
    return t.select("p_partkey", TX.mask_signoff_name("text").alias("signed"),
                    TX.mask_name_before_sent("text").alias("sent"), TX.mask_times("low").alias("timed"),
                    TX.mask_gates("low").alias("gated"), TX.has_otp_context("low").alias("has_code"),
                    TX.mask_codes("low").alias("coded"))


def q_text_masks(spark, d):
    """T3, T9, T15, T22 on the raw texts, each by itself."""
    t = F.col("text")
    return docs(spark, d).select(
        "doc_id", F.length(t).cast("long").alias("n_chars"),
        F.length(TX.collapse_repeats(t)).cast("long").alias("n_after_repeats"),
        TX.mask_phones(TX.collapse_whitespace(t)).alias("phones_masked"),
        TX.mask_numbers(TX.collapse_whitespace(t)).alias("numbers_masked"),
        TX.has_email(t).alias("has_email"))


def q_mask_urls(spark, d):
    p = SB.read_table(spark, d, "pages")
    ship_package(spark)
    x = p.select("page_id", F.col("url").alias("u"), TX.collapse_whitespace("html").alias("h"))
    x = TX.mask_urls_df(x, "u", "url_masked")
    x = TX.mask_urls_df(x, "h", "html_masked")
    return x.select("page_id", "url_masked", "html_masked")


def q_template_hash(spark, d):
    return docs(spark, d).select("doc_id", template_hash("text").alias("template_hash"))


def q_label_cleanup(spark, d):
    b = SB.read_table(spark, d, "benchmark")
    return b.select("item_id", LB.clean_label("text").alias("label"),
                    LB.display_name(LB.name_or_default("text")).alias("display_name"))


# ---------------------------------------------------------------- templates
def q_templates(spark, d):
    """Flagship: normalise + hash + dedupe every message of every sender."""
    from herald.operators.templates import build_templates
    return build_templates(messages(spark, d))


def q_top_templates(spark, d):
    from herald.operators.templates import build_templates, top_templates
    return top_templates(build_templates(messages(spark, d)), 5)


def q_dedupe_exact(spark, d):
    from herald.operators.templates import dedupe_by_hash
    m = messages(spark, d).withColumn(
        "template_hash", template_hash(F.lower(TX.collapse_whitespace("raw_text"))))
    return dedupe_by_hash(m, carry=("message_id",))


# ---------------------------------------------------------------- vectors
def emb(spark, d) -> DataFrame:
    """``embeddings`` as clustered templates of several senders, one of them small, with noise rows,
    weights, times (of the event of the same number) and texts (of the document of the same number)."""
    ship_package(spark)
    e = SB.read_table(spark, d, "embeddings")
    k = F.col("vec_id")
    ts = SB.read_table(spark, d, "events").select(F.col("event_id").alias("vec_id"), F.col("ts").alias("timestamp"))
    text = SB.read_table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"),
                                                       F.col("text").alias("normalized_text"))
    return e.select(F.when(k % 100 == 7, "tiny").otherwise(F.concat(F.lit("e"), (k % 3).cast("string")))
                     .alias("originator_id"),
                    k.cast("string").alias("template_hash"), "vec_id", "embedding",
                    F.when(k % 11 == 0, -1).otherwise(F.col("label")).cast("int").alias("cluster_label"),
                    (1 + k % 4).cast("long").alias("count_in_window")) \
        .join(ts, "vec_id", "left").join(text, "vec_id", "left")


def emb_vectors(spark, d) -> DataFrame:
    return emb(spark, d).drop("cluster_label", "timestamp", "normalized_text")


def emb_campaigns(spark, d) -> DataFrame:
    c = PR.campaign_table(emb(spark, d))
    return cut_lineage(c.withColumn(
        "campaign_name", F.concat(F.lit("label "), F.col("cluster_label").cast("string"))))


def emb_assigned(spark, d, camps: DataFrame | None = None) -> DataFrame:
    camps = emb_campaigns(spark, d) if camps is None else camps
    return cut_lineage(AS.assign_to_campaigns(emb(spark, d).drop("cluster_label"), camps, EMB_SIM_THRESHOLD))


def q_unit_vectors(spark, d):
    e = emb_vectors(spark, d)
    return e.select("vec_id", F.posexplode(unit_normalize("embedding")).alias("pos", "x")) \
            .select("vec_id", F.col("pos").cast("long").alias("pos"), _r(F.col("x")).alias("value"))


def q_centroids(spark, d):
    c = centroids(emb(spark, d), ["originator_id", "cluster_label"])
    return c.select("originator_id", "cluster_label", F.posexplode("centroid").alias("pos", "x")) \
            .select("originator_id", "cluster_label", F.col("pos").cast("long").alias("pos"),
                    _r(F.col("x")).alias("value"))


def q_campaign_table(spark, d):
    return emb_campaigns(spark, d).select(
        "originator_id", "row_index", "cluster_label", "prototypes_count", "messages_count",
        "window_start", "window_end", "campaign_name")


def q_assign(spark, d):
    return emb_assigned(spark, d).select(
        "vec_id", "originator_id", "assigned_campaign_row_index",
        _r(F.col("assigned_campaign_score")).alias("assigned_campaign_score"),
        "assigned_campaign_label", "assigned_campaign_name", "status")


def fine_campaigns(spark, d) -> DataFrame:
    """A campaign per label and weight: forty to a sender."""
    label = F.when(F.col("cluster_label") == -1, -1).otherwise(F.col("cluster_label") * 10 + F.col("count_in_window"))
    return cut_lineage(PR.campaign_table(emb(spark, d).withColumn("cluster_label", label.cast("int"))))


def q_assign_pruned(spark, d):
    """J2 by the inverted file of centroids, in cells of some four centroids."""
    nearest = partial(nearest_center_pruned, center_rows=EMB_CELL_CENTERS, prune_from=EMB_CELL_CENTERS)
    a = AS.assign_to_campaigns(emb(spark, d).drop("cluster_label"), fine_campaigns(spark, d), EMB_SIM_THRESHOLD,
                               nearest=nearest)
    return a.select("vec_id", "originator_id", "assigned_campaign_row_index",
                    _r(F.col("assigned_campaign_score")).alias("assigned_campaign_score"),
                    "assigned_campaign_label", "status")


def q_coverage(spark, d):
    a = emb_assigned(spark, d)
    ok = DI.eligible_originators(a).select("originator_id", F.lit(True).alias("e"))
    return DI.coverage_by_originator(a).join(ok, "originator_id", "left").select(
        "originator_id", "n_total", _r(F.col("coverage")).alias("coverage"), "n_unknown",
        F.coalesce("e", F.lit(False)).alias("eligible"))


def q_unknown_for_discovery(spark, d):
    """rows that pass both gates."""
    return DI.unknown_for_discovery(emb_assigned(spark, d)).select("vec_id", "originator_id")


def q_windowed_coverage(spark, d):
    """R3 in batch form, by the templates' times."""
    from herald.streaming.windows import windowed_coverage
    a = emb_assigned(spark, d).filter(F.col("timestamp").isNotNull())
    w = windowed_coverage(a, WINDOW, ts_col="timestamp", watermark=None)
    return w.withColumn("coverage", _r(F.col("coverage")))


def q_nearest_examples(spark, d):
    camps = emb_campaigns(spark, d)
    ex = PR.nearest_examples(PR.member_similarity(emb(spark, d), camps))
    return ex.select("originator_id", F.col("row_index").alias("campaign_row_index"), "cluster_label",
                     F.col("rank").cast("int").alias("rank"), "template_hash",
                     _r(F.col("sim_score")).alias("sim_score"))


def q_neighbour_pairs(spark, d):
    p = similar_pairs(emb_vectors(spark, d), EMB_PAIR_MIN_COS)
    return p.select("originator_id", "a", "b", _r(F.col("cos")).alias("cos"))


def q_neighbour_recall(spark, d):
    """J9 by random projections against the exact search: pairs found, and whether recall reaches 0.9."""
    r = recall_by_blocks(emb_vectors(spark, d), EMB_PAIR_MIN_COS, tile_rows=EMB_INDEX_TILE)
    return r.select("originator_id", "n_exact", "n_wrong", (F.col("recall") >= 0.9).alias("recall_reached"))


def q_density_clusters(spark, d):
    c = density_clusters(emb_vectors(spark, d), cos_to_dist(EMB_DENSITY_MIN_COS), EMB_DENSITY_MIN_SIZE,
                         EMB_DENSITY_MIN_SAMPLES)
    return c.select("originator_id", "template_hash", "cluster_label")


def q_eom_clusters(spark, d):
    """V6 over a ladder of three levels."""
    c = eom_clusters(emb_vectors(spark, d), [cos_to_dist(c) for c in EMB_LADDER_COS], EMB_DENSITY_MIN_SIZE,
                     EMB_DENSITY_MIN_SAMPLES)
    return c.select("originator_id", "template_hash", "cluster_label")


def q_eom_exact(spark, d):
    """V6 over the exact hierarchy; clusters that end below the selection epsilon give way."""
    c = exact_clusters(emb_vectors(spark, d), EMB_DENSITY_MIN_SIZE, EMB_DENSITY_MIN_SAMPLES,
                       round(cos_to_dist(EMB_EXACT_MIN_COS), 6))
    return c.select("originator_id", "template_hash", "cluster_label")


def q_adaptive_parameters(spark, d):
    """F18 with and without a given min_samples."""
    e = emb_vectors(spark, d)
    given = DI.adaptive_parameters(e, min_samples=2).select("originator_id",
                                                           F.col("min_samples").alias("given_min_samples"))
    return DI.adaptive_parameters(e, frac=0.05).join(given, "originator_id")


def emb_profile(spark, d):
    return PR.build_profile(emb(spark, d))


def q_profile_campaigns(spark, d):
    """V7: the labelled templates' campaigns, named from their nearest examples."""
    camps, _ = emb_profile(spark, d)
    return camps.select("originator_id", "row_index", "cluster_label", "prototypes_count", "messages_count",
                        "window_start", "window_end", "campaign_name")


def q_profile_examples(spark, d):
    """W1, J4."""
    _, ex = emb_profile(spark, d)
    return ex.select("originator_id", "campaign_row_index", "cluster_label", "rank", "template_hash",
                     _r(F.col("sim_score")).alias("sim_score"), "count_in_window", "campaign_name",
                     F.length("text_sample").alias("sample_chars"))


def q_footprint(spark, d):
    """Campaigns and examples saved and loaded."""
    path = scratch_path(spark)
    SK.save_campaign_footprint(*emb_profile(spark, d), path)
    camps = SK.load_table(spark, f"{path}/campaigns")
    return camps.select("originator_id", "row_index", "cluster_label", "prototypes_count", "campaign_name",
                        _r(F.aggregate("centroid", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"))


def q_campaign_examples(spark, d):
    """The examples of the first campaign's name of each sender."""
    camps, ex = emb_profile(spark, d)
    first = camps.filter("row_index = 0").select("originator_id", "campaign_name")
    e = NM.examples_for(ex).join(first, ["originator_id", "campaign_name"], "left_semi")
    return e.select("originator_id", "campaign_row_index", "rank", "template_hash")


def emb_discovery(spark, d):
    """V8 on the Unknown rows, labelled by V5 and named from their samples."""
    camps = emb_campaigns(spark, d)
    a = emb_assigned(spark, d, camps)

    def cluster(unknown):
        return density_clusters(unknown, cos_to_dist(EMB_DENSITY_MIN_COS), EMB_DENSITY_MIN_SIZE,
                                EMB_DENSITY_MIN_SAMPLES)

    return camps, a, *DI.discover(a, cluster, run_ts=RUN_TS)


def q_proposals(spark, d):
    _, _, up, _, _ = emb_discovery(spark, d)
    return up.select("vec_id", "status", "proposed_cluster_id", "proposed_campaign_name",
                     _r(F.col("proposed_campaign_score")).alias("proposed_campaign_score"))


def q_proposed_clusters(spark, d):
    """Kept clusters."""
    _, _, _, cl, _ = emb_discovery(spark, d)
    return cl.select("originator_id", "cluster_label", F.col("cluster_size").cast("long").alias("cluster_size"),
                     "proposed_label")


def q_cluster_members(spark, d):
    """Members of the kept clusters, with their place among the naming samples."""
    _, _, up, _, _ = emb_discovery(spark, d)
    return up.filter(F.col("proposed_cluster_id").isNotNull()).select(
        "originator_id", "proposed_cluster_id", "template_hash",
        _r(F.col("proposed_campaign_score")).alias("sim_score"))


def q_new_campaigns(spark, d):
    _, _, _, _, nc = emb_discovery(spark, d)
    return nc


def q_saved_proposals(spark, d):
    """Assignments and proposals saved, read back and joined."""
    _, assigned, up, _, _ = emb_discovery(spark, d)
    path = scratch_path(spark)
    SK.save_table(assigned, f"{path}/assigned")
    SK.save_table(up, f"{path}/upserted")
    proposals = SK.load_table(spark, f"{path}/upserted").select(
        "originator_id", "template_hash", "proposed_cluster_id", "proposed_campaign_name",
        _r(F.col("proposed_campaign_score")).alias("proposed_campaign_score"))
    return SK.load_table(spark, f"{path}/assigned").select("originator_id", "template_hash", "vec_id", "status") \
        .join(proposals, ["originator_id", "template_hash"]).drop("originator_id", "template_hash")


def q_saved_new_campaigns(spark, d):
    """New campaigns saved over an older run's and read back."""
    _, _, _, _, nc = emb_discovery(spark, d)
    path = f"{scratch_path(spark)}/new_campaigns"
    SK.save_table(nc.withColumn("campaign_name", F.lit("old")), path)
    SK.save_table(nc, path)
    return SK.load_table(spark, path)


def q_merged_profile(spark, d):
    """The states of three batches merged one by one, against the profile of all rows."""
    from herald.operators.profile_state import profile_state, state_campaigns, update_profile
    path, rows = scratch_path(spark), emb(spark, d)
    for i in range(3):
        state = update_profile(spark, path, profile_state(rows.filter(F.col("vec_id") % 5 % 3 == i)), i)
    return state_campaigns(state).select(
        "originator_id", "cluster_label", "row_index", "prototypes_count", "messages_count", "window_start", "window_end",
        F.posexplode("centroid").alias("pos", "x")) \
        .withColumns({"pos": F.col("pos").cast("long"), "value": _r(F.col("x"))}).drop("x")


def q_unknown_labels(spark, d):
    _, _, up, _, _ = emb_discovery(spark, d)
    return DI.unknown_labels(up).select("vec_id", "unknown_label")


def q_drift_summary_labelled(spark, d):
    """V12 with the report's order as a column."""
    camps, a, _, _, nc = emb_discovery(spark, d)
    return RP.with_position(RP.drift_summary(camps, a, nc))


def q_centroid_label(spark, d):
    a = AS.assigned_label_or_noise(emb_assigned(spark, d), EMB_NOISE_DISTANCE)
    return a.select("vec_id", "plot_label")


def q_label_histogram(spark, d):
    return RP.label_histogram(emb(spark, d))


def q_projection_2d(spark, d):
    """Centres of the labelled groups on the plane of the largest variance."""
    from herald.operators.projection import cluster_centres_2d, fit_projection, project
    e = emb(spark, d)
    return cluster_centres_2d(project(e, fit_projection(e))).select(
        "originator_id", "cluster_label", _r(F.col("cx")).alias("cx"), _r(F.col("cy")).alias("cy"))


# ---------------------------------------------------------------- naming
def doc_groups(spark, d) -> DataFrame:
    return docs(spark, d).select(F.col("source").alias("originator_id"), "lang", "doc_id",
                                 F.col("text").alias("text_sample"))


def discovered_from_docs(spark, d) -> DataFrame:
    """Group names of (sender, language), standing in for discovered campaigns."""
    return NM.name_from_samples(doc_groups(spark, d), ["originator_id", "lang"])


def named_registrations(spark, d) -> DataFrame:
    return NM.registration_names(registrations(spark, d))


def q_group_names(spark, d):
    return discovered_from_docs(spark, d)


def _prompts(spark, d, template: str) -> DataFrame:
    """N2 on the examples nearest to each campaign's centroid."""
    _, ex = emb_profile(spark, d)
    return NM.sample_prompts(ex, ["originator_id", "cluster_label"], template=template)


def q_sample_prompts(spark, d):
    return _prompts(spark, d, NM.SAMPLE_PROMPT)


def q_sample_prompts_any_language(spark, d):
    return _prompts(spark, d, NM.SAMPLE_PROMPT_ANY_LANGUAGE)


def q_registration_prompts(spark, d):
    return NM.registration_prompts(registrations(spark, d)).select("business_number", "seq", "prompt")


def q_registration_names(spark, d):
    return named_registrations(spark, d).select("business_number", "seq", "onboarding_name")


def _view(spark, d, how="inner"):
    return NM.names_view(named_registrations(spark, d), discovered_from_docs(spark, d), how)


def q_names_view(spark, d):
    v = _view(spark, d)
    return v.select("originator_id",
                    F.array_join("onboarding_names", "\n").alias("onboarding_names"),
                    F.array_join("registered_campaign_names", "\n").alias("registered_campaign_names"),
                    F.array_join("discovered_names", "\n").alias("discovered_names"))


def q_comparison_prompts(spark, d):
    return NM.comparison_prompts(_view(spark, d)).select("originator_id", "prompt")


def q_drift_verdicts(spark, d):
    v = NM.drift_verdicts(_view(spark, d))
    return v.select("business_number", "llm_result", "status",
                    NM.status_from_text().alias("text_status"),
                    F.array_join("misfit_names", "\n").alias("misfit_names"))


def q_name_similarity(spark, d):
    """N7's scores."""
    return NM.name_similarity(_view(spark, d)).select("originator_id", "name", _r(F.col("best")).alias("best"))


def judged_before(spark, d) -> DataFrame:
    """Saved verdicts of the senders whose name ends in 5, written and loaded again."""
    path = scratch_path(spark)
    old = registrations(spark, d).select("business_number").distinct().filter("business_number like '%5'") \
        .withColumn("llm_result", F.lit(NM.FIT_TEXT))
    SK.save_verdicts(old, path)
    return SK.load_verdicts(spark, path)


def gappy_view(spark, d) -> DataFrame:
    """The names view with senders that lack discovered names (1, 11) or have blank lists (2, 12)."""
    v = _view(spark, d, "left").filter(F.col("onboarding_names").isNotNull())
    names = F.when(F.col("originator_id").rlike("src1?1$"), F.lit(None)) \
        .when(F.col("originator_id").rlike("src1?2$"), F.array().cast("array<string>")) \
        .otherwise(F.col("discovered_names"))
    return v.withColumn("discovered_names", names)


def q_pending_verdicts(spark, d):
    """Verdicts of the senders not judged yet, saved beside the old ones and read back with a status."""
    from herald.plans.onboarding import judge_pending
    return judge_pending(gappy_view(spark, d), judged_before(spark, d), scratch_path(spark))


def _answer(prompt: str, temperature: float) -> str:
    """A caller's text function: by the request's length, it fails, finds a misfit or finds none."""
    if len(prompt) % 4 == 3:
        raise RuntimeError("no answer")
    return NM.ANOMALY_TEXT if len(prompt) % 4 == 1 else NM.FIT_TEXT


def q_asked_verdicts(spark, d):
    """Answers of a caller's function."""
    v = NM.asked_verdicts(gappy_view(spark, d), _answer, judged_before(spark, d))
    return v.select("business_number", "llm_result", "status", F.col("error").isNotNull().alias("failed"))


def q_resumed_answers(spark, d):
    """N6 with a ledger: a first run over the senders of one kind, then one over all."""
    path, view, done = scratch_path(spark), cut_lineage(gappy_view(spark, d)), judged_before(spark, d)
    NM.asked_verdicts(view.filter("originator_id like '%1'"), _answer, done, ledger=path)
    v = NM.asked_verdicts(view, _answer, done, ledger=path)
    return v.select("business_number", "llm_result", "status", F.col("error").isNotNull().alias("failed"))


def q_run_tally(spark, d):
    """A11 with every outcome."""
    view, done = gappy_view(spark, d), judged_before(spark, d)
    return NM.run_tally(view, done, NM.asked_verdicts(view, _answer, done))


def q_names_all_senders(spark, d):
    """Campaign names of every registered sender, exported and read back."""
    from herald.plans.names import export_names
    return export_names(messages(spark, d), registrations(spark, d), scratch_path(spark))


# ---------------------------------------------------------------- streaming (batch form)
def q_windowed_event_counts(spark, d):
    from herald.streaming.windows import windowed_template_counts
    ev = SB.read_table(spark, d, "events")
    ship_package(spark)
    src = ev.select(F.col("event_type").alias("originator_id"),
                    template_hash("props").alias("template_hash"), F.col("ts"))
    return windowed_template_counts(src, WINDOW, watermark=None)


def _stream(spark, d, table: str) -> DataFrame:
    """A given table as a stream of its files (by a pattern, as a table may be one file or a folder)."""
    return spark.readStream.schema(SB.read_table(spark, d, table).schema).parquet(f"{d}/{table}.parque[t]")


def _written(stream_query, spark, path: str) -> DataFrame:
    stream_query.awaitTermination()
    return spark.read.parquet(path)


def event_messages(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("event_type").alias("originator_id"), template_hash("props").alias("template_hash"),
                     F.col("ts").cast("timestamp").alias("ts"))


def q_stream_event_counts(spark, d):
    """R1 as a stream: windows are appended once the watermark has passed them."""
    from herald.streaming.windows import append_to, windowed_template_counts
    ship_package(spark)
    path = scratch_path(spark)
    counts = windowed_template_counts(event_messages(_stream(spark, d, "events")), WINDOW, watermark=WATERMARK)
    return _written(append_to(counts, f"{path}/table", f"{path}/progress"), spark, f"{path}/table")


def q_stream_coverage(spark, d):
    """R3 as a stream over events, an error being an Unknown."""
    from herald.streaming.windows import append_to, windowed_coverage
    path = scratch_path(spark)
    ev = _stream(spark, d, "events").select(
        F.col("event_type").alias("originator_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("value") >= 5, "Known").otherwise("Unknown").alias("status"))
    out = windowed_coverage(ev, WINDOW, watermark=WATERMARK)
    got = _written(append_to(out, f"{path}/table", f"{path}/progress"), spark, f"{path}/table")
    return got.withColumn("coverage", _r(F.col("coverage")))


def language_campaigns(spark, d):
    """Templates of all documents with their language as campaign: (campaigns, fitted vector model)."""
    from herald.operators.embed import embed_templates
    from herald.operators.templates import build_templates
    tpl = build_templates(messages(spark, d))
    vec, model = embed_templates(tpl, dim=256, keep=["originator_id", "template_hash", "message_id", "count_in_window"])
    lang = docs(spark, d).select(F.col("doc_id").cast("string").alias("message_id"), "lang")
    ranked = lang.select("lang").distinct().withColumn("cluster_label", F.abs(F.hash("lang")) % 1000)
    labelled = vec.join(lang.join(ranked, "lang"), "message_id")
    camps = PR.campaign_table(labelled).withColumn("campaign_name", F.lit("language"))
    return cut_lineage(camps), model


def q_stream_assignments(spark, d):
    """R2: documents as a message stream, assigned micro-batch by micro-batch."""
    from herald.streaming.assign_stream import write_assignments
    camps, model = language_campaigns(spark, d)
    path = scratch_path(spark)
    stream = SB.messages_from_documents(_stream(spark, d, "documents"))
    q = write_assignments(stream, camps, model, f"{path}/table", f"{path}/progress", spread=spread(spark))
    got = _written(q, spark, f"{path}/table")
    return got.select("originator_id", "message_id", "template_hash", "assigned_campaign_row_index", "status")


def vector_stream(spark, d, path: str) -> str:
    """R2 on vectors, stopped half-way and started again: even vectors come in both halves, odd ones in one.

    Returns the ledger's path; the assignments are under ``path``/table.
    """
    from herald.streaming.assign_stream import write_assignments
    camps = emb_campaigns(spark, d)
    copies = F.when(F.col("vec_id") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = cut_lineage(emb(spark, d).select("originator_id", "template_hash", "vec_id", "embedding", F.explode(copies).alias("copy"))
                       .withColumn("seq", F.col("vec_id") * 2 + F.col("copy")))
    half = F.pmod(F.floor(F.col("vec_id") / 2) + F.col("copy"), F.lit(2))
    for part in (0, 1):
        rows.filter(half == part).repartition(2, "vec_id").write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        write_assignments(stream, camps, None, f"{path}/table", f"{path}/progress", EMB_SIM_THRESHOLD, prepare=lambda b: b,
                          embed=lambda t: t, carry=("embedding",)).awaitTermination()
    return f"{path}/table-templates"


def q_stream_vector_assignments(spark, d):
    """R2 with its ledger, every message of the interrupted stream."""
    path = scratch_path(spark)
    vector_stream(spark, d, path)
    got = spark.read.parquet(f"{path}/table")
    return got.select("vec_id", "copy", "originator_id", "assigned_campaign_row_index",
                      _r(F.col("assigned_campaign_score")).alias("assigned_campaign_score"), "assigned_campaign_name", "status")


def q_stream_template_totals(spark, d):
    """Counts per template over the interrupted stream, from the ledger."""
    from herald.streaming.assign_stream import template_totals
    return template_totals(spark, vector_stream(spark, d, scratch_path(spark))) \
        .select("originator_id", "template_hash", "messages", "status")


def q_template_vectors(spark, d):
    """V1: every template's vector."""
    from herald.operators.embed import embed_templates
    from herald.operators.templates import build_templates
    return embed_templates(build_templates(messages(spark, d)), dim=256, keep=["originator_id", "template_hash"])[0]


# ---------------------------------------------------------------- whole pipeline (rows-only checks)
def new_batch(spark, d) -> DataFrame:
    """All conversation turns as messages: texts both like and unlike those of their senders."""
    conv = SB.read_table(spark, d, "conversations")
    n = spread(spark)
    return (conv.repartition(n) if n else conv).select(
        F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")).alias("originator_id"),
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("message_id"),
        F.col("text").alias("raw_text"),
        (F.col("conv_id") * 1000 + F.col("turn") + 1).cast("long").alias("seq"))


def drift_tables(spark, d) -> dict:
    """The reference is all documents, the new batch all conversation turns."""
    from herald.plans.drift import DriftParams, drift_run
    return drift_run(messages(spark, d), new_batch(spark, d), DriftParams(run_ts=RUN_TS))


def q_normalize_unicode(spark, d):
    c = TX.collapse_repeats(TX.unicode_nfkc(TX.fold_confusables("text")))
    return docs(spark, d).select("doc_id", c.alias("text_nfkc"))


def q_text_predicates(spark, d):
    t = TX.collapse_whitespace("text")
    return docs(spark, d).select(
        "doc_id", F.length("text").alias("n_chars"), TX.has_email(t).alias("has_email"),
        TX.phone_changed(t).alias("phone_changed"), TX.url_count(t).alias("url_count"),
        TX.has_otp_context(F.lower(t)).alias("has_otp_context"))


def q_drift_assignments(spark, d):
    return drift_tables(spark, d)["upserted"].drop("embedding")


def q_drift_new_campaigns(spark, d):
    return drift_tables(spark, d)["new_campaigns"]


def q_drift_summary(spark, d):
    return drift_tables(spark, d)["summary"]


def q_drift_saved(spark, d):
    """A whole run saved; the proposals read back."""
    from herald.plans.drift import save_run
    path = scratch_path(spark)
    save_run(drift_tables(spark, d), path)
    return SK.load_table(spark, f"{path}/upserted").drop("embedding")


def q_eom_profile(spark, d):
    """V6 with F18 on the vectors of all documents' templates."""
    from herald.operators.embed import embed_templates
    from herald.operators.templates import build_templates
    from herald.plans.drift import DriftParams, cluster
    p = DriftParams()
    vec, _ = embed_templates(build_templates(messages(spark, d)), dim=p.dim)
    return cluster(vec, p.profile_min_samples, p.selection_epsilon).select("originator_id", "template_hash", "cluster_label")


def semantic_model(spark, d):
    from herald.operators.semantic import fit_semantic
    from herald.operators.templates import build_templates
    templates = cut_lineage(build_templates(messages(spark, d)))
    return templates, fit_semantic(templates, SEMANTIC_DIM)


def q_semantic_vectors(spark, d):
    """V1 by a truncated SVD, on the templates of all senders."""
    from herald.operators.semantic import embed_semantic
    return embed_semantic(*semantic_model(spark, d)).select("originator_id", "template_hash", "embedding")


def q_semantic_basis(spark, d):
    """Inner products of the singular vectors over all terms: they are orthonormal."""
    _, model = semantic_model(spark, d)
    x = model.terms.select("vec", F.posexplode("vec").alias("i", "x"))
    products = x.select("i", "x", F.posexplode("vec").alias("j", "y")).groupBy("i", "j") \
        .agg(F.sum(F.col("x") * F.col("y")).alias("s"))
    return products.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"),
                           (_r(F.col("s")) + 0.0).alias("inner_product"))


def q_registered_drift(spark, d):
    """N7 against the campaigns of every sender's whole profile (E3 on real profiles)."""
    from herald.plans.drift import DriftParams, reference_profile
    _, camps, _, _ = reference_profile(messages(spark, d), DriftParams())
    return NM.drift_verdicts(NM.names_view(named_registrations(spark, d), camps)).drop("misfit_names")


#: Name -> query; every ``q_<name>`` of this module.
QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}
