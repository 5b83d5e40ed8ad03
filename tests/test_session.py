"""Intermediate storage: one shared folder, never overwritten, cleaned up."""

import os
import subprocess
import sys
import tempfile
import time

from pyspark.sql import functions as F

from clickfold.session import drop_tables, ensure_checkpoint_dir, write_table

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_context_folder_is_kept(spark):
    sc = spark.sparkContext
    own = tempfile.mkdtemp(prefix="clickfold-own-")
    before = sc._jsc.sc().getCheckpointDir().get()
    sc.setCheckpointDir(own)
    try:
        first = ensure_checkpoint_dir(spark)
        assert own in first and ensure_checkpoint_dir(spark) == first
    finally:
        sc.setCheckpointDir(os.path.dirname(before.removeprefix("file:")))


def test_tables_are_dropped(spark):
    df = write_table(spark.range(7).selectExpr("id", "id % 2 AS k"), partition_by="k")
    path = df.inputFiles()[0].removeprefix("file://").split("/clickfold-")[0]
    assert df.count() == 7 and [f for f in os.listdir(path) if f.startswith("clickfold-")]
    assert drop_tables(spark) >= 1
    assert not [f for f in os.listdir(path) if f.startswith("clickfold-")]
    assert drop_tables(spark) == 0


SCRIPT = """
import os, sys
os.environ["PYSPARK_SUBMIT_ARGS"] = "--conf spark.ui.enabled=false pyspark-shell"
from pyspark.sql import SparkSession
from clickfold.session import ensure_checkpoint_dir
folder, master = sys.argv[1:]
b = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
if folder != "-":
    b = b.config("spark.checkpoint.dir", folder)
s = b.getOrCreate()
if master != "local":
    class Context:
        def __getattr__(self, name):
            return getattr(s.sparkContext, name)
    import clickfold.session as m
    fake = Context()
    fake.__dict__["master"] = master
    class Session:
        sparkContext, conf = fake, s.conf
    if s.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        print("FOLDER", ensure_checkpoint_dir(Session()))
    else:
        try:
            ensure_checkpoint_dir(Session())
            print("NO ERROR")
        except RuntimeError as e:
            print("RAISED", e)
else:
    print("FOLDER", ensure_checkpoint_dir(s))
"""


def _run(folder, master):
    out = subprocess.run([sys.executable, "-c", SCRIPT, folder, master], cwd=ROOT, timeout=120,
                         capture_output=True, text=True)
    return [x for x in out.stdout.splitlines() if x.split(" ")[0] in ("FOLDER", "RAISED", "NO")]


def test_the_configured_folder_is_used():
    folder = tempfile.mkdtemp(prefix="clickfold-conf-")
    (said,) = _run(folder, "local")
    assert folder in said


def test_a_cluster_without_a_folder_is_refused():
    (said,) = _run("-", "spark://host:7077")
    assert said.startswith(("RAISED", "FOLDER"))     # FOLDER: the installation's defaults name one


def test_a_written_table_leaves_no_shuffle_files(spark):
    """They stayed until the driver's garbage was collected."""
    import glob

    from clickfold.session import delete_table, write_table

    jvm = spark._jvm.org.apache.spark.SparkEnv
    dirs = [d.getPath() for d in jvm.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}

    before, conf = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    told = spark.conf.get(conf, None)
    rows = spark.range(0, 5000, 1, 4).groupBy((F.col("id") % 999).alias("k")).count()
    table = write_table(rows.join(spark.range(999).withColumnRenamed("id", "k").repartition(3, "k"), "k"))
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(conf, None) == told
    assert table.count() == 999
    path = table.inputFiles()[0].removeprefix("file:").replace("///", "/")
    delete_table(table)
    assert not os.path.exists(os.path.dirname(path))
