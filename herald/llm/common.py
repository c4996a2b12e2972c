"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herald.session import ensure_checkpoint_dir, ship_package

#: The six ASCII white-space characters that separate words everywhere in this package.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"
SLICE_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the package is shipped first so that tasks can import it."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow string column as UTF-8 bytes; a null text is an empty one."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Incoming Arrow batches (64 MB by default) in slices of about ``limit`` bytes.

    What a task holds besides its batch (Python texts, results) is bounded by a slice,
    or by a single text if that is longer.
    """
    for batch in batches:
        rows = max(1, batch.num_rows * limit // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def fewer(df: DataFrame, share: int = 8) -> DataFrame:
    """``df`` in a ``share``-th of the session's shuffle partitions, but two a core at least.

    For results of a few columns, which need far fewer files than the shuffle before them
    has partitions. A task reads its partitions one after another, so none is merged in
    memory; a table in fewer partitions already stays as it is.
    """
    spark = df.sparkSession
    return df.coalesce(max(2 * spark.sparkContext.defaultParallelism,
                           int(spark.conf.get("spark.sql.shuffle.partitions")) // share))


def rebalanced(df: DataFrame) -> DataFrame:
    """Slim rows dealt anew into partitions of the advisory size, however many there were before.

    For results of scans that have far more partitions than their result needs files. The
    stage before keeps all its tasks; adaptive execution merges or splits the rest by bytes.
    """
    return df.hint("rebalance")


class Scratch:
    """Tables written under the cluster's shared checkpoint folder.

    They cut lineage: a lost executor re-reads the table instead of recomputing
    it. ``drop`` removes a superseded one (rounds of an iteration).
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        base = ensure_checkpoint_dir(spark).rstrip("/")
        self.root = f"{base}/llm-{name}-{uuid.uuid4().hex}"
        self._n = 0

    def write(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def few(self, df: DataFrame) -> DataFrame:
        """Write a slim table (ids, keys, counts) as few files, see :func:`fewer`."""
        return self.write(fewer(df))

    def drop(self, df: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def split_join(rows: DataFrame, lookup: DataFrame, key: str, scratch: Scratch, share: int = 1000) -> DataFrame:
    """``rows`` left-joined with ``lookup`` (one row per ``key``), however many rows hold one key.

    Keys that hold more than a ``share``-th of all rows number fewer than ``share``: they and
    what they look up are broadcast. All others are joined by shuffling, where no key can
    fill a task. Rows with a null key match nothing and are not shuffled.
    """
    added = [f for f in lookup.schema.fields if f.name != key]
    keyed = rows.filter(F.col(key).isNotNull())
    counts = keyed.groupBy(key).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n")).first()[0] or 0
    hot = scratch.write(rebalanced(counts.filter(F.col("__n") * share > total).select(key).join(lookup, key, "left")))
    cold = keyed.join(F.broadcast(hot.select(key)), key, "left_anti").join(lookup, key, "left")
    nothing = rows.filter(F.col(key).isNull()).withColumns({f.name: F.lit(None).cast(f.dataType) for f in added})
    out = [*rows.columns, *[f.name for f in added]]
    return keyed.join(F.broadcast(hot), key).select(out).unionByName(cold.select(out)).unionByName(nothing.select(out))
