"""Session construction and the shared scratch / checkpoint folder.

Lineage is cut with Parquet tables written to the folder named by
``spark.checkpoint.dir``, never with ``localCheckpoint``.
The folder is read from the running session; only a local-mode session
without one gets a private folder, as in tests.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "ratecraft",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Order: the SparkContext's current folder, then ``spark.checkpoint.dir``.
    A local session with neither gets a private folder; a cluster session
    without one is an error (a machine-local folder would not survive the
    loss of an executor).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        conf_dir = tempfile.mkdtemp(prefix="ratecraft-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_root(spark: SparkSession) -> str:
    """This application's folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/ratecraft-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, rows_per_file: int = 0) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    One job, whose shuffle files are deleted when it ends; later reads are pruned to
    the columns they use, and their measured size decides about broadcasts.  The table
    stays until ``drop_snapshots``: any later query may still read it.

    ``rows_per_file`` bounds the rows of a file, and so of a task that reads: a
    split counts 4 MB (``spark.sql.files.openCostInBytes``) for each file, so one
    of 128 MB holds 32 files at most, however well their columns are packed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "snapshot")
    with shuffles_dropped(spark):
        df.write.option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def handed_on(df: DataFrame, rows_per_file: int = 0) -> DataFrame:
    """``cut_lineage`` of a table that nothing but ``df`` is made from: the snapshots it was read from are deleted."""
    out = cut_lineage(df, rows_per_file)
    drop_snapshot(df)
    return out


def drop_snapshot(df: DataFrame, keep: Iterable[DataFrame] = ()) -> None:
    """Deletes the files behind a table of ``cut_lineage`` (or what is read from some, but for the tables ``keep``); only
    where nothing reads them any more."""
    spark = df.sparkSession
    behind = lambda t: {f.rsplit("/", 1)[0] for f in t.inputFiles()}
    folders = behind(df).difference(*map(behind, keep))
    for folder in folders:
        if "/snapshot-" in folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _inside = threading.Lock(), {}  # by session: threads inside, the setting before the first of them


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a job are deleted when it ends, not when its plan is collected some day.

    For work that hands its tables on through ``cut_lineage``, one job after
    another; a table that is run twice would be shuffled twice.  The setting is the
    session's: it is put back when the last thread inside leaves.
    """
    with _lock:
        threads, before = _inside.get(id(spark), (0, spark.conf.get(_CLEANUP, None)))
        _inside[id(spark)] = threads + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            threads, before = _inside.pop(id(spark))
            if threads > 1:
                _inside[id(spark)] = threads - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


def drop_shuffles_behind(cached: DataFrame) -> None:
    """Deletes the shuffle files that a persisted table was made from; only where all its blocks are written.  A block that
    is lost with its executor is made again from the inputs, through the shuffle."""
    spark = cached.sparkSession
    held = spark._jsparkSession.sharedState().cacheManager().lookupCachedData(cached._jdf)
    plan = held.get().cachedRepresentation().cacheBuilder().cachedPlan() if held.isDefined() else None
    if plan is None or not plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    for shuffle in list(plan.context().shuffleIds().keySet()):
        env.blockManager().master().removeShuffle(shuffle, True)


def drop_snapshots(spark: SparkSession) -> None:
    """Deletes every table this application wrote to the shared folder; call it when its results are consumed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
