"""Session settings and the shared folder used for checkpoints and staging."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


# Settings the jobs rely on; they can be set on a running session.
RUNTIME = {
    # Times are stored and compared in UTC.
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods above this size; Spark then splits the code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_settings(spark: SparkSession) -> None:
    """Put the run-time settings on a session made elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)


def build_session(app: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; explicit ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Call-site capture for every column expression slows down the building of large plans.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOT: list[str] = []


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run below the cluster's shared checkpoint folder.

    The cluster names the folder in ``spark.checkpoint.dir``. Only where that is unset and Spark runs
    in one local process (tests, a laptop) one temporary folder is made and used by every job of the process;
    on a cluster each executor would write to a disk of its own, so an unset folder is an error there.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        if not _LOCAL_ROOT:
            _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="shelfwise-"))
        root = _LOCAL_ROOT[0]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df, purpose: str = "stage"):
    """Write ``df`` once to the shared folder and read it back.

    Used where one frame feeds several branches: the work is done once, and a lost executor
    costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
