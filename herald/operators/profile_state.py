"""Profiles that grow by batches (A3, A4, A5, S11) without reading old members again.

A campaign's state is the sum of its members' unit vectors, its counts and its date
range. States of disjoint batches add up, and the centroid is the sum brought to length
one, so the profile of A merged with B is the profile of A and B together.
"""

from __future__ import annotations

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from herald.functions.vectors import unit_normalize
from herald.operators.centroids import cluster_counts

KEYS = ["originator_id", "cluster_label"]


def profile_state(members: DataFrame, vec_col: str = "embedding", weighted: bool = True) -> DataFrame:
    """``KEYS, vec_sum, prototypes_count, messages_count, window_start, window_end`` of clustered templates.

    Noise (-1) belongs to no campaign. Rows are summed where they are; a campaign costs one row a task.
    """
    valid = members.filter(F.col("cluster_label") != -1).withColumn("cluster_label", F.col("cluster_label").cast("int"))
    vectors = valid.select(*KEYS, array_to_vector(F.col(vec_col).cast("array<double>")).alias("__v"))
    unit = Normalizer(inputCol="__v", outputCol="__u", p=2.0).transform(vectors)
    sums = unit.groupBy(*KEYS).agg(vector_to_array(Summarizer.sum(F.col("__u"))).alias("vec_sum"))
    return sums.join(cluster_counts(valid, KEYS, weighted=weighted), KEYS)


def state_of_assigned(assigned: DataFrame, vec_col: str = "embedding", weighted: bool = True) -> DataFrame:
    """The state of a new batch's Known templates, under the label of the campaign they were assigned to."""
    known = assigned.filter(F.lower("status") == "known").drop("cluster_label") \
        .withColumn("cluster_label", F.col("assigned_campaign_label"))
    return profile_state(known, vec_col, weighted)


def merge_states(state: DataFrame, *more: DataFrame) -> DataFrame:
    """The state of all batches together; a campaign may be missing from any of them."""
    for other in more:
        state = state.unionByName(other)
    return state.groupBy(*KEYS).agg(
        vector_to_array(Summarizer.sum(array_to_vector("vec_sum"))).alias("vec_sum"),
        F.sum("prototypes_count").alias("prototypes_count"), F.sum("messages_count").alias("messages_count"),
        F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end"))


def state_campaigns(state: DataFrame) -> DataFrame:
    """The campaign table of a state: centroid, counts, date range and ``row_index``."""
    at = F.row_number().over(Window.partitionBy("originator_id").orderBy("cluster_label")) - 1
    return state.withColumn("centroid", unit_normalize("vec_sum")).withColumn("row_index", at.cast("int")).drop("vec_sum")


def versions(spark: SparkSession, path: str) -> list[int]:
    """The finished versions of a stored state, ascending."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def update_profile(spark: SparkSession, path: str, batch: DataFrame, number: int) -> DataFrame:
    """Merge a batch's state into the one stored under ``path`` as version ``number``, and return it.

    Batches are numbered upwards. A batch whose version is there already changes nothing, so an update
    may be run again after a failure; a version that was not finished is overwritten.
    """
    done = versions(spark, path)
    target = f"{path}/version={number}"
    if number not in done:
        earlier = [v for v in done if v < number]
        merged = merge_states(spark.read.parquet(f"{path}/version={earlier[-1]}"), batch) if earlier else merge_states(batch)
        merged.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
