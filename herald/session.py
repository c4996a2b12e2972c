"""SparkSession construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "herald",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return a session tuned for the operators in this package.

    On a cluster pass ``master=None`` and let spark-submit decide; the settings
    here only switch on adaptive execution, skew handling and Arrow batches.
    Memory and the number of shuffle partitions are left to spark-submit unless
    the caller names them.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
        "spark.ui.showConsoleProgress": "false",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode.

    On a cluster the folder must come from ``spark.checkpoint.dir`` (a shared
    file system); a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="herald-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared "
        "checkpoint folder on a cluster")


#: Removes a statement's shuffle files when it ends, not when the driver's garbage is collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it back.

    Unlike ``DataFrame.checkpoint`` the re-read plan carries the real file
    size as its statistics (a checkpoint keeps the estimate of the plan it
    replaced, which compounds over iterative rounds), so later joins are
    planned from measured sizes. The table lives on the shared file system,
    so a lost executor does not lose it. ``replaces`` names an earlier cut that
    nothing reads any more (the last round of an iteration); its files are
    removed once the new ones are written. What the write shuffled is removed from the executors' disks, too.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/herald-{uuid.uuid4().hex}"
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("error").parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if was is None else spark.conf.set(SHUFFLE_CLEANUP, was)
    out = spark.read.schema(df.schema).parquet(path)
    out._herald_path = path
    if replaces is not None:
        drop_cut(replaces)
    return out


def drop_cut(df: DataFrame) -> None:
    """Remove the files of a table written by :func:`cut_lineage`."""
    spark, path = df.sparkSession, df._herald_path
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


#: Most tasks that groups of heavy work are dealt to.
MAX_GROUP_TASKS = 2000


def by_groups(rows: DataFrame, n_groups: int, *by: str):
    """``rows.groupBy(*by)`` with about a task a group: adaptive execution joins small partitions by
    their bytes, which leaves groups of few bytes and much work to a few tasks."""
    return rows.repartition(max(1, min(n_groups, MAX_GROUP_TASKS)), *by).groupBy(*by)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``herald`` importable in Python workers (Arrow UDFs, applyInPandas).

    Zips the installed package once per SparkContext and adds it with
    ``addPyFile``, which distributes it to every executor; on a cluster,
    ``--py-files`` does the same at submit time.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="herald-pkg-")
    zpath = os.path.join(out_dir, "herald.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)
