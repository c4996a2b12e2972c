"""2-D map of templates (V9, A14), re-aimed from a non-linear projection to PCA.

The projection is fitted on the reference templates (distributed covariance
in Spark ML) and applied to new Unknown templates; the fitted model can be
saved with ``model.write().save(path)``.
"""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_projection(ref: DataFrame, vec_col: str = "embedding", k: int = 2):
    v = ref.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("__v"))
    return PCA(k=k, inputCol="__v", outputCol="__p").fit(v)


def project(df: DataFrame, model, vec_col: str = "embedding") -> DataFrame:
    out = model.transform(df.withColumn("__v", array_to_vector(F.col(vec_col).cast("array<double>"))))
    p = vector_to_array("__p")
    return out.withColumn("x", p[0]).withColumn("y", p[1]).drop("__v", "__p")


# A14
def cluster_centres_2d(points: DataFrame, label_col: str = "cluster_label",
                       key: str = "originator_id") -> DataFrame:
    return points.groupBy(key, label_col).agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
