"""Sessions one after another; no fixed partition count or memory without being asked for."""

import os
import subprocess
import sys
import time

from paths import ROOT

CODE = """
import sys
sys.path.insert(0, {root!r})
from herald.session import build_session, cut_lineage, ship_package
import herald.session as S
for n in range(2):
    spark = build_session("local[2]")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    assert spark.sparkContext.getConf().get("spark.driver.memory", None) is None
    ship_package(spark)
    assert spark.sparkContext.applicationId in S._SHIPPED and len(S._SHIPPED) == n + 1

    def run(batches):
        import herald.config
        yield from batches

    first = cut_lineage(spark.range(10))
    second = cut_lineage(first.mapInArrow(run, "id long"), replaces=first)
    assert second.count() == 10
    try:
        first.count()
        raise SystemExit("the superseded table is still there")
    except Exception:
        pass
    spark.stop()
print("fine")
"""


def test_two_sessions_in_sequence():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT)], capture_output=True, text=True, env=env,
                         cwd="/", timeout=200)
    assert out.returncode == 0 and "fine" in out.stdout, out.stderr[-2000:]


def test_a_cut_leaves_no_shuffle_files(spark):
    """Shuffle files of every cut stayed on the executors' disks until the driver collected its garbage."""
    from herald.session import SHUFFLE_CLEANUP, cut_lineage

    def files():
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    before, was = files(), spark.conf.get(SHUFFLE_CLEANUP, None)
    rows = spark.range(1000).repartition(7).groupBy("id").count()
    cut = cut_lineage(rows)
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(SHUFFLE_CLEANUP, None) == was
    assert cut.count() == rows.count() == 1000 == cut_lineage(rows).count()
