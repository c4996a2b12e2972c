"""Naming and onboarding comparison.

No model service is assumed. The default namer scores the words of a group's
samples by TF-IDF against the other groups of the same sender and joins the
best ``max_words`` words; the default drift verdict compares discovered and
registered names by the cosine of their TF-IDF vectors. A caller may plug in
any text function (:func:`call_text_function`), which runs once per distinct
prompt inside ``mapInPandas`` tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herald import config
from herald.functions.labels import clean_label, non_blank, numbered_list
from herald.session import cut_lineage

# Default request texts. Callers may pass their own: ``{examples}``, ``{record}`` and ``{max_words}``
# are filled in. What later steps rely on is only the marker in an answer that reports a misfit.
SAMPLE_PROMPT = """The numbered texts below were all sent by one sender and resemble each other. The first is the most typical.

Texts:
{examples}

Write one short title (up to {max_words} words) for what these texts are about.
Leave out names of people, phone numbers and codes, and end without a full stop.
Answer with the title alone.
"""
#: The same request for texts of any language.
SAMPLE_PROMPT_ANY_LANGUAGE = SAMPLE_PROMPT.replace("Answer with the title alone.", """Write the title in English. If the texts are in another language, put that language in brackets after it, as in: Parcel on its way (German).
Answer with the title alone.""")
REGISTRATION_PROMPT = """A sender has registered the messages it plans to send. Its entry reads:

{record}

Write one short title (up to {max_words} words) for the purpose of these messages.
Leave out names of people, phone numbers and codes, and end without a full stop.
Answer with the title alone.
"""
FIT_TEXT = "Every title fits the registration."
ANOMALY_TEXT = "Anomaly: some titles do not fit the registration."
COMPARE_INSTRUCTIONS = (
    "Two lists of titles follow. The first list says what a sender registered. The second list was found in the "
    "sender's messages.\n"
    "Decide for each title of the second list whether a reader would count it under any title of the first. Judge by "
    "subject only: another language, more detail or other words are no reason against it, nor is a routine kind of "
    "message such as a code or a reminder. If you are unsure, count it as fitting.\n"
    f"If all fit, answer: {FIT_TEXT}\n"
    f"Otherwise answer: {ANOMALY_TEXT} Then give each title that does not fit on a line of its own, with the reason.\n"
)

# Words the default scorer uses: runs of 3+ letters.
P_TERM = r"\p{L}{3,}"


# N1 (default scorer)
def name_from_samples(samples: DataFrame, group_cols, text_col: str = "text_sample",
                      max_words: int = config.MAX_WORDS, scope_cols=None,
                      out: str = "campaign_name") -> DataFrame:
    """Short label per group from its sample texts, ``""`` for blank samples.

    term score = tf(term, group) * (ln((1 + G) / (1 + df)) + 1) where G is the
    number of groups in the scope (default: the sender) and df the number of
    them using the term; the ``max_words`` best terms (ties: term) in score order.
    """
    group_cols = list(group_cols)
    scope = list(scope_cols) if scope_cols is not None else group_cols[:1]
    terms = samples.select(*group_cols, F.explode(
        F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(P_TERM), 0)).alias("term"))
    tf = terms.groupBy(*group_cols, "term").agg(F.count(F.lit(1)).alias("tf"))
    dfreq = tf.groupBy(*scope, "term").agg(F.count(F.lit(1)).alias("df"))
    ngroups = samples.select(*group_cols).distinct().groupBy(*scope) \
                     .agg(F.count(F.lit(1)).alias("G"))
    scored = (tf.join(dfreq, scope + ["term"]).join(ngroups, scope)
                .withColumn("score", F.col("tf") * (F.log((1 + F.col("G")) / (1 + F.col("df"))) + 1)))
    w = Window.partitionBy(*group_cols).orderBy(F.desc("score"), "term")
    top = scored.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= max_words)
    named = top.groupBy(*group_cols).agg(
        F.array_sort(F.collect_list(F.struct("r", "term"))).alias("__t"))
    named = named.select(*group_cols, clean_label(F.array_join(F.transform("__t", lambda x: x["term"]), " "),
                                                  max_words).alias(out))
    # groups whose samples hold no term still get a (blank) name
    return samples.select(*group_cols).distinct().join(named, group_cols, "left") \
                  .withColumn(out, F.coalesce(F.col(out), F.lit("")))


# N2
def sample_prompts(examples: DataFrame, group_cols, text_col: str = "text_sample",
                   max_words: int = config.MAX_WORDS, template: str = SAMPLE_PROMPT,
                   n_samples: int = config.N_SAMPLES) -> DataFrame:
    """Prompt per group: its non-blank samples among the first ``n_samples``, numbered in rank order."""
    group_cols = list(group_cols)
    g = examples.filter(F.col("rank") <= n_samples).groupBy(*group_cols).agg(
        F.array_sort(F.collect_list(F.struct("rank", text_col))).alias("__s"))
    samples = non_blank(F.transform("__s", lambda x: x[text_col]))
    head, tail = template.split("{examples}")
    tail = tail.replace("{max_words}", str(max_words))
    return g.select(*group_cols, F.when(F.size(samples) > 0, F.concat(
        F.lit(head), numbered_list(samples, "\n\n"), F.lit(tail))).alias("prompt"))


# N3
def registration_prompts(reg: DataFrame, max_words: int = config.MAX_WORDS,
                         template: str = REGISTRATION_PROMPT) -> DataFrame:
    """Prompt per registration row: six ``field: value`` lines in the template."""
    from herald.sources.batches import REGISTRATION_COLUMNS
    lines = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("nan")))
             for c in REGISTRATION_COLUMNS]
    head, tail = template.split("{record}")
    tail = tail.replace("{max_words}", str(max_words))
    return reg.withColumn("prompt", F.concat(F.lit(head), F.concat_ws("\n", *lines), F.lit(tail)))


# N4 (default scorer)
def registration_names(reg: DataFrame, max_words: int = config.MAX_WORDS,
                       key: str = "business_number") -> DataFrame:
    """``onboarding_name`` per registration row from its description and campaign name."""
    text = F.concat_ws(" ", F.col("campaign_name"), F.col("description"))
    rows = reg.withColumn("__text", text)
    named = name_from_samples(rows, [key, "seq"], "__text", max_words, scope_cols=[key],
                              out="onboarding_name")
    return reg.join(named, [key, "seq"], "left")


# N6
def call_text_function(prompts: DataFrame, fn, temperature: float = 0.0,
                       max_words: int | None = config.MAX_WORDS,
                       prompt_col: str = "prompt", distinct: bool = True) -> DataFrame:
    """Run ``fn(prompt=..., temperature=...)`` once per distinct prompt.

    Without ``distinct`` the prompts are taken as they come, in the tasks they are in.

    ``fn`` returns a string or a dict with ``text``; a failure gives ``""`` and
    an error record. Output: ``prompt, raw_text, label, error``; join it back
    on ``prompt``.
    """
    import pandas as pd

    asked = prompts.select(prompt_col).filter(F.col(prompt_col).isNotNull())
    asked = asked.distinct() if distinct else asked
    schema = T.StructType([T.StructField(prompt_col, T.StringType()),
                           T.StructField("raw_text", T.StringType()),
                           T.StructField("error", T.StringType())])

    def run(batches):
        for pdf in batches:
            texts, errors = [], []
            for p in pdf[prompt_col]:
                try:
                    r = fn(prompt=p, temperature=temperature)
                    texts.append(r.get("text") if isinstance(r, dict) else str(r))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - the hook's failure is data
                    texts.append("")
                    errors.append(f"call_failed: {e}")
            yield pd.DataFrame({prompt_col: pdf[prompt_col], "raw_text": texts, "error": errors})

    out = asked.mapInPandas(run, schema)
    if max_words is not None:
        out = out.withColumn("label", clean_label("raw_text", max_words))
    return out


# F17
def status_from_text(col: str = "llm_result"):
    return F.when(F.lower(F.col(col)).contains(config.ANOMALY_MARKER), F.lit("anomaly")) \
            .otherwise(F.lit("ok"))


# A13
def registered_names(reg: DataFrame, name_col: str, key: str = "business_number",
                     order_col: str = "seq", out: str | None = None) -> DataFrame:
    """Non-null names per sender in sheet order."""
    return (reg.filter(F.col(name_col).isNotNull())
               .groupBy(F.col(key).cast("string").alias("originator_id"))
               .agg(F.array_sort(F.collect_list(F.struct(order_col, F.col(name_col).cast("string")
                                                         .alias("n")))).alias("__s"))
               .select("originator_id", F.transform("__s", lambda x: x["n"]).alias(out or name_col)))


# A12
def discovered_names(camps: DataFrame, key: str = "originator_id") -> DataFrame:
    """Distinct non-null campaign names per sender, sorted."""
    return (camps.filter(F.col("campaign_name").isNotNull())
                 .groupBy(key).agg(F.array_sort(F.collect_set(F.col("campaign_name").cast("string")))
                                   .alias("discovered_names")))


# N8 / J7
def names_view(reg_named: DataFrame, camps: DataFrame, how: str = "inner") -> DataFrame:
    """Per sender: registered names, registered campaign names, discovered names."""
    a = registered_names(reg_named, "onboarding_name", out="onboarding_names")
    b = registered_names(reg_named, "campaign_name", out="registered_campaign_names")
    return a.join(b, "originator_id", "full").join(discovered_names(camps), "originator_id", how)


# N5
def comparison_prompts(view: DataFrame, instructions: str = COMPARE_INSTRUCTIONS) -> DataFrame:
    first = F.concat(F.lit("Registered:\n"), numbered_list("onboarding_names", "\n", quote=True))
    second = F.concat(F.lit("Found:\n"), numbered_list("discovered_names", "\n"))
    return view.withColumn("prompt", F.concat(F.lit(instructions), F.lit("\n"), first,
                                              F.lit("\n\n"), second, F.lit("\n")))


def _terms(names: DataFrame, side: str) -> DataFrame:
    """``originator_id, side, name, term``: the distinct words of each name."""
    return names.select("originator_id", F.lit(side).alias("side"), "name", F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower("name"), F.lit(r"\p{L}+|\p{N}+"), 0))).alias("term"))


# N7 (default judge)
def name_similarity(view: DataFrame) -> DataFrame:
    """``originator_id, name, best``: highest TF-IDF cosine (V3) of each discovered name to a registered one.

    A word weighs ``1 + ln((1 + N) / (1 + df))`` over the distinct names of all senders, so words that every
    name shares bring names together less than words of few names do. A name without words scores 0.
    The view's names are written once: both sides and the last join read them, not what they were made from.
    """
    view = cut_lineage(view.select("originator_id", "discovered_names", "onboarding_names"))
    found = view.select("originator_id", F.explode(F.array_distinct("discovered_names")).alias("name"))
    told = view.select("originator_id", F.explode(F.array_distinct("onboarding_names")).alias("name"))
    terms = cut_lineage(_terms(found, "found").unionByName(_terms(told, "told")))
    distinct = terms.select("name", "term").distinct()
    total = distinct.select(F.count_distinct("name")).first()[0]
    idf = distinct.groupBy("term").agg(F.count(F.lit(1)).alias("df")) \
        .select("term", (1 + F.log((1 + F.lit(total)) / (1 + F.col("df")))).alias("w"))
    weighted = terms.join(idf, "term")
    by = ["originator_id", "side", "name"]
    unit = weighted.join(weighted.groupBy(*by).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm")), by) \
        .select(*by, "term", (F.col("w") / F.col("norm")).alias("w"))
    a = unit.filter("side = 'found'").select("originator_id", "name", "term", F.col("w").alias("wa"))
    b = unit.filter("side = 'told'").select("originator_id", F.col("name").alias("other"), "term",
                                            F.col("w").alias("wb"))
    best = a.join(b, ["originator_id", "term"]).groupBy("originator_id", "name", "other") \
        .agg(F.sum(F.col("wa") * F.col("wb")).alias("cos")) \
        .groupBy("originator_id", "name").agg(F.max("cos").alias("best"))
    return found.join(best, ["originator_id", "name"], "left") \
        .withColumn("best", F.coalesce("best", F.lit(0.0)))


# F16 + J6
def pending(view: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Senders with names on both sides that have no saved verdict yet."""
    v = view.filter((F.size("onboarding_names") > 0) & (F.size("discovered_names") > 0))
    return v if done is None else v.join(done.select(
        F.col("business_number").cast("string").alias("originator_id")), "originator_id", "left_anti")


# N7
def drift_verdicts(view: DataFrame, fit_threshold: float = 0.2,
                   done: DataFrame | None = None) -> DataFrame:
    """ok / anomaly per pending sender with the misfit discovered names listed.

    A discovered name fits when its similarity to some registered name (:func:`name_similarity`)
    reaches ``fit_threshold``.
    """
    todo = pending(view, done)
    misfit = F.col("best") < fit_threshold
    reason = F.concat(F.lit("- "), F.col("name"), F.lit(": unlike any registered title"))
    judged = name_similarity(todo).groupBy("originator_id").agg(
        F.sort_array(F.collect_list(F.when(misfit, F.col("name")))).alias("misfit_names"),
        F.sort_array(F.collect_list(F.when(misfit, reason))).alias("lines"))
    fits = F.size("lines") == 0
    text = F.when(fits, F.lit(FIT_TEXT)).otherwise(
        F.concat(F.lit(ANOMALY_TEXT + "\n"), F.array_join("lines", "\n")))
    return judged.select(F.col("originator_id").alias("business_number"), text.alias("llm_result"),
                         F.when(fits, "ok").otherwise("anomaly").alias("status"), "misfit_names")


def asked_verdicts(view: DataFrame, fn, done: DataFrame | None = None,
                   instructions: str = COMPARE_INSTRUCTIONS, ledger: str | None = None) -> DataFrame:
    """N6 in place of N7: the caller's text function answers each pending sender's comparison prompt.

    ``business_number, llm_result, status, error``; an answer that failed has an error and no status.
    With ``ledger``, a path, answers are kept there and no prompt that has one is asked again.
    """
    from herald.operators.answers import ask
    todo = comparison_prompts(pending(view, done), instructions)
    answers = ask(todo, fn, ledger, max_words=None) if ledger else call_text_function(todo, fn, max_words=None)
    return todo.join(answers, "prompt").select(
        F.col("originator_id").alias("business_number"), F.col("raw_text").alias("llm_result"),
        F.when(F.col("error").isNull(), status_from_text("raw_text")).alias("status"), "error")


# A11
def run_tally(view_full: DataFrame, done: DataFrame | None = None,
              verdicts: DataFrame | None = None) -> DataFrame:
    """Outcomes over all registered senders: cached, missing (nothing discovered), empty (a side without
    names), errors (the text function failed) and prepared."""
    v = view_full.filter(F.col("onboarding_names").isNotNull())

    def flag(df: DataFrame | None, name: str) -> DataFrame:
        if df is None:
            return v.withColumn(name, F.lit(False))
        ids = df.select(F.col("business_number").cast("string").alias("originator_id")).distinct()
        return v.join(ids.withColumn(name, F.lit(True)), "originator_id", "left")

    v = flag(done, "__done")
    v = flag(None if verdicts is None else verdicts.filter(F.col("error").isNotNull()), "__failed")
    outcome = (F.when(F.col("__done"), "cached")
                .when(F.col("discovered_names").isNull(), "missing")
                .when((F.size("onboarding_names") == 0) | (F.size("discovered_names") == 0), "empty")
                .when(F.col("__failed"), "errors")
                .otherwise("prepared"))
    return v.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


# N9
def examples_for(examples: DataFrame, campaign_name: str | None = None) -> DataFrame:
    e = examples.filter(F.col("text_sample").isNotNull())
    if campaign_name is not None:
        e = e.filter(F.col("campaign_name").cast("string") == F.lit(campaign_name))
    return e
