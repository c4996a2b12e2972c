"""Names of all registered senders, one of them above its target."""

import random

from pyspark.sql import functions as F

from herald import config
from herald.operators.thinning import adaptive_thin, filter_registered
from herald.plans.names import export_names
from herald.sources.batches import MESSAGE_SCHEMA, REGISTRATION_COLUMNS

TOPICS = (["parcel", "courier", "door", "tracking"], ["invoice", "payment", "account", "balance"])
FILLER = "please note that we have this for you now and soon with our best service team today".split()


def message_rows(sender, n, rng, first):
    for i in range(n):
        topic = rng.choice(TOPICS)
        text = " ".join(rng.sample(topic, 4) + rng.sample(FILLER, 2))
        yield (sender, f"{sender}-{i}", text, first + i)


def test_a_sender_above_the_target_is_thinned_and_named(spark, tmp_path):
    rng = random.Random(3)
    rows = [*message_rows("bigsender", 240, rng, 1), *message_rows("smallone", 40, rng, 1000), *message_rows("stranger", 40, rng, 2000)]
    messages = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    registrations = spark.createDataFrame([(s, "d", "c", "t", "a", "e") for s in ("bigsender", "smallone", "nothing sent")],
                                          ", ".join(f"{c} string" for c in REGISTRATION_COLUMNS))
    thinned = adaptive_thin(filter_registered(messages, registrations), 60)
    assert {r.originator_id: r["count"] for r in thinned.groupBy("originator_id").count().collect()} \
        == {"bigsender": 60, "smallone": 40}
    got = export_names(messages, registrations, str(tmp_path / "names"), target_rows=60)
    names = {s: {r.campaign_name for r in got.filter(F.col("originator_id") == s).collect()} for s in ("bigsender", "smallone", "stranger")}
    assert not names["stranger"]
    for s in ("bigsender", "smallone"):
        words = " ".join(names[s]).lower()
        assert any(w in words for w in TOPICS[0]) and any(w in words for w in TOPICS[1])
    # the default leaves senders below 5,000 messages whole
    assert config.TARGET_ROWS == 5000 and adaptive_thin(messages).count() == len(rows)
