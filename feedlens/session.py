"""Session helpers: the settings every job relies on, and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators assume.  UTC makes day / hour boundaries and the
# oracle comparison independent of the machine; AQE re-plans joins from real
# sizes, coalesces small shuffle partitions and splits skewed ones.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.maxPlanStringLength": "1000000",  # plans with literal tables stay out of the driver's memory
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",  # runs of one sorted file a bucket are merged unsorted
    # a union of bucketed scans would count as bucketed, and lose that when a later rule turns the scans back to plain ones
    "spark.sql.unionOutputPartitioning": "false",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "feedlens", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the defaults above.  For tests and bench;
    on a cluster the launcher owns the session and only ``configure`` is used."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("FEEDLENS_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``feedlens`` importable on the executors' Python workers (the UDFs
    refer to its functions).  The package is zipped once per application on
    the driver and distributed with ``addPyFile``, as ``--py-files`` would."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import feedlens

    root = os.path.dirname(os.path.abspath(feedlens.__file__))
    parent = os.path.dirname(root)
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if sc.master.startswith("local") and (os.path.abspath(os.getcwd()) == parent or parent in on_path):
        _SHIPPED.add(sc.applicationId)  # local workers already import it from here
        return
    zpath = os.path.join(tempfile.mkdtemp(prefix="feedlens-py-"), "feedlens.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to an existing session and ship the
    package to the executors."""
    ship_package(spark)
    for k, v in SESSION_DEFAULTS.items():
        if k != "spark.ui.enabled":  # static: the launcher's choice
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    always used.  Only a local master (tests, bench) may leave it unset and
    gets a scratch folder: on a cluster every executor would write to its own
    disk, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a folder "
                               f"that the driver and all executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="feedlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/feedlens-{label}-{uuid.uuid4().hex}"


def checkpoint(df, label: str = "stage"):
    """Cut lineage by writing ``df`` as a Parquet table in the shared
    checkpoint folder and reading it back.

    Compared with ``DataFrame.checkpoint`` (serialized row blocks) the table is
    columnar and compressed, and later readers get column pruning and filter
    pushdown; like it, the result no longer depends on recomputing the input,
    so non-deterministic columns (ids) are fixed and a lost executor only
    re-reads files.  The shuffle files of the write are removed with it, so
    disk holds the tables and not also every shuffle that made them.
    ``discard`` removes the table when its readers are done.
    """
    spark = df.sparkSession
    path = table_path(spark, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._feedlens_path = path
    return out


def discard(*frames) -> None:
    """Delete the tables behind ``checkpoint`` results that no pending
    DataFrame reads any more."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._feedlens_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
