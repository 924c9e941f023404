"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators are planned for. All of them may be changed on
# a live session, so `tune` also works on a session somebody else made.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Spark keeps shuffle files until its driver collects garbage, unless told to delete them when a job ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def tune(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """Apply the settings; on a cluster, start shuffles with enough partitions.

    Adaptive execution merges small partitions but does not add any, so a
    large cluster has to begin with enough of them: `partitions` if given (take
    the input's size over 128 MB where executors come and go), else three per
    core seen now.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    wanted = partitions or (0 if context.master.startswith("local") else 3 * context.defaultParallelism)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; a directory set through
    ``SparkContext.setCheckpointDir`` counts too. A temporary folder is made
    only for a local master, where driver and executors share one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    declared = context._jsc.sc().getCheckpointDir()
    if declared.isDefined():
        return declared.get().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="lineloom-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root, never reused; `drop_scratch` deletes it."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back.

    Cuts the lineage like a checkpoint does, survives lost executors, and gives
    the optimizer the real file size of the result. What the write has shuffled
    is deleted at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables this application has written; gives their number.

    Results computed from them must have been stored by then.
    """
    app = spark.sparkContext.applicationId
    paths = _written.pop(app, [])
    made = _local_scratch.pop(app, None)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in [*paths, *([made] if made else [])]:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(paths)
