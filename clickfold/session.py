"""Session helpers.

The library never owns the session in production: a cluster hands one in.
These helpers only fill gaps (tests, bench, local runs) and read settings
such as ``spark.checkpoint.dir`` from the session instead of assuming them.
"""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the feature plans are written for.  All are
# session-level and safe to set on a shared cluster session.
RECOMMENDED_SQL_CONF = {
    # Runtime re-planning: broadcast small aggregate sides after they are
    # materialised (a measured size check), coalesce tiny partitions and
    # split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The feature table is ~140 columns wide; above the default of 100 fields
    # Spark drops whole-stage codegen for every operator of the join chain
    # (measured 5x slower on the final stage at sf0.1).
    "spark.sql.codegen.maxFields": "1000",
}


def configure(spark: SparkSession) -> None:
    """Apply ``RECOMMENDED_SQL_CONF`` to a session (explicit opt-in; the
    library never changes session settings on its own)."""
    for k, v in RECOMMENDED_SQL_CONF.items():
        spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "clickfold") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for k, v in RECOMMENDED_SQL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data.

    The folder the context already has wins (it is never overwritten), then
    the one ``spark.checkpoint.dir`` names.  Where neither is set, a local
    session (tests, bench) gets one scratch folder; any other master raises,
    since executors would write to their own disks.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        configured = tempfile.mkdtemp(prefix="clickfold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint).

    Used where a plan is reused many times (iterative fits) so that a lost
    executor recomputes from the checkpoint, not from the raw scan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sf_dir_default() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


_written: dict[str, list[str]] = {}
_tables: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def table_path(spark: SparkSession, name: str = "table") -> str:
    """A fresh path in the shared folder, noted for ``drop_tables``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/clickfold-{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


#: Spark deletes a query's shuffle files at its end, not when the driver's
#: garbage happens to be collected.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession):
    """Queries run inside leave no shuffle files; the setting is put back."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def write_table(df: DataFrame, partition_by: str | None = None, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: a lineage cut that also keeps column pruning, filter pushdown and
    (with ``partition_by``) partition pruning for later readers.  The
    shuffle files behind it go once it is written."""
    path = table_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    with shuffles_deleted(df.sparkSession):
        w.parquet(path)
    table = df.sparkSession.read.schema(_read_schema(df, partition_by)).parquet(path)
    _tables[table] = path
    return table


def delete_table(table: DataFrame) -> None:
    """Delete the files of a table that ``write_table`` returned, behind its
    last reader."""
    delete_path(table.sparkSession, _tables.pop(table))


def _read_schema(df: DataFrame, partition_by: str | None):
    """The schema with the partition column last, as a reader returns it."""
    fields = [f for f in df.schema.fields if f.name != partition_by]
    fields += [f for f in df.schema.fields if f.name == partition_by]
    return type(df.schema)(fields)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder of intermediate data behind its last reader."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    known = _written.get(spark.sparkContext.applicationId, [])
    if path in known:
        known.remove(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers (once per
    application), for clusters and sessions on which it is not installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    at = tempfile.mkdtemp(prefix="clickfold-code-")
    sc.addPyFile(shutil.make_archive(f"{at}/clickfold_core", "zip", root, "clickfold"))
    _shipped.add(sc.applicationId)


def drop_tables(spark: SparkSession) -> int:
    """Delete every table this process wrote for the session's application.

    Results are lazy and read those tables, so the caller says when the last
    reader is done.  Returns the number of folders removed.
    """
    jvm, n = spark.sparkContext._jvm, 0
    for path in _written.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        n += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return n
