"""Template vectors (V1, re-aimed).

No sentence-embedding model ships with the data, so the default is a Spark ML
pipeline: token regex -> feature hashing -> IDF (fitted on the templates of all
senders, one distributed pass) -> L2 norm, output ``embedding ARRAY<FLOAT>``.
A caller can instead pass a model loader for ``predict_batch_udf``, which runs
the model once per executor on Arrow batches.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_DIM = 512
TOKEN_PATTERN = r"\{[^}]*\}|[\p{L}\p{N}]+"


def tfidf_pipeline(text_col: str = "normalized_text", dim: int = DEFAULT_DIM) -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="__tok", pattern=TOKEN_PATTERN, gaps=False,
                       toLowercase=True, minTokenLength=1),
        HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=dim),
        IDF(inputCol="__tf", outputCol="__tfidf"),
        Normalizer(inputCol="__tfidf", outputCol="__vec", p=2.0),
    ])


def embed_templates(templates: DataFrame, text_col: str = "normalized_text",
                    dim: int = DEFAULT_DIM, model=None, keep=None):
    """Add ``embedding`` (unit length). Returns ``(df, fitted_model)``; pass
    ``model`` to embed a new batch in the reference's vector space.

    The vectors are written once to the shared checkpoint folder: they are
    the expensive, reused boundary of the pipeline, and every later stage
    then plans over a small scan instead of the whole normaliser. The templates
    are written too if a model is fitted on them, as they are then read twice.
    ``keep`` names the columns wanted beside the vectors (all by default), so that
    callers who need ids alone don't write every text once more.
    """
    from herald.session import cut_lineage

    if model is None:
        templates = cut_lineage(templates)
        model = tfidf_pipeline(text_col, dim).fit(templates)
    out = model.transform(templates)
    return cut_lineage(out.select(*(templates.columns if keep is None else keep),
                                  vector_to_array("__vec", "float32").alias("embedding"))), model


def embed_with_model(templates: DataFrame, make_predict_fn, dim: int,
                     text_col: str = "normalized_text", batch_size: int = 64) -> DataFrame:
    """Vectors from a caller-supplied model (loaded once per Python worker).

    ``make_predict_fn()`` returns a function from an array of texts to an array (rows, ``dim``).
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql import types as T

    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size)
    return templates.withColumn("embedding", udf(F.col(text_col)))
