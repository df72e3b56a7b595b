"""Spark session defaults shared by jobs, tests and the bench.

Nothing here runs at import time: callers build the session they need.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  UTC keeps timestamps comparable with the
# stored aggregates and the SQL oracle; AQE lets Spark re-plan joins and
# shuffles from measured sizes (split skewed partitions, coalesce tiny ones).
#
# Broadcasts are decided from measured sizes only.  The static planner sizes
# a Parquet scan by its compressed file size and, without table statistics,
# estimates a join's output as the product of its inputs; with those numbers
# it broadcast the line-item table and streamed the 5-row region scan, so
# the whole star join ran in one task.  With the static threshold off, every
# join starts as a shuffled join; once a side's shuffle is written, AQE sees
# its real size and broadcasts it if it is below the adaptive threshold.
BROADCAST_BYTES = "10m"
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": BROADCAST_BYTES,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of operators (quantile rounds, late-event keys, salted
    # join-backs) are deleted once nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# The runtime SQL settings the query plans depend on (a subset of BASE_CONF
# that can be changed on a running session).
PLAN_CONF = (
    "spark.sql.session.timeZone",
    "spark.sql.autoBroadcastJoinThreshold",
    "spark.sql.adaptive.autoBroadcastJoinThreshold",
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
)


def apply_plan_conf(spark: SparkSession) -> None:
    """Apply :data:`PLAN_CONF` to a session built elsewhere (a launcher, a notebook)."""
    for k in PLAN_CONF:
        spark.conf.set(k, BASE_CONF[k])


def build_session(
    master: str | None = None,
    app_name: str = "shiplens",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def cluster_conf(input_bytes: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Shuffle sizing for a cluster run over ``input_bytes`` of input.

    AQE can merge small shuffle partitions but cannot split a normal one, so
    the initial count must be large enough that each partition of the
    largest shuffle fits a task (~``target_partition_bytes``); AQE then
    coalesces down to the advisory size.  ``parallelismFirst`` is turned off:
    on a shared cluster AQE should merge toward the advisory size rather than
    keep 1 MB partitions for parallelism (many tiny tasks).  Pass the result
    as ``extra_conf``.
    """
    n = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def checkpoint_dir(spark: SparkSession, local_prefix: str = "shiplens-ckpt-") -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is local (tests) is a local
    folder created here, named with ``local_prefix``; on a cluster the setting
    names shared storage that survives executor loss, and a session without
    it is refused: each machine's own disk would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder when the master is {master}")
    path = tempfile.mkdtemp(prefix=local_prefix)
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def stage_table(df, name: str, rows_per_file: int = 0):
    """Write ``df`` once to Parquet in the shared folder; return (scan of it, path).

    For an input that several passes read (a model fit), this replaces
    ``persist``: the rows are computed once, stored compressed and columnar,
    each pass reads only its columns, and a lost executor costs a re-read
    of files rather than a recompute of the upstream joins.  Remove the
    table with :func:`remove_path` once no pass needs it; what is left goes
    when the driver ends.  With ``rows_per_file`` no file holds more rows (0: no bound).
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    remove_at_exit(spark, path)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.parquet(path), path


def scan_by_file(spark: SparkSession, path: str):
    """Scan of a Parquet folder with one partition per file, in a session of its own.

    A scan packs small files together up to ``spark.sql.files.maxPartitionBytes``
    of *stored* bytes; where rows compress well, such a partition holds many
    millions.  Counting each file as a full partition's bytes keeps them apart; the caller's settings stay.
    """
    own = spark.newSession()
    for k in (*PLAN_CONF, "spark.sql.shuffle.partitions"):
        own.conf.set(k, spark.conf.get(k))
    own.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return own.read.parquet(path)


def rename_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` at ``target`` of the same storage, whole at once; ``target`` must not exist."""
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = b.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise FileExistsError(f"{source} could not be renamed to {target}")


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver's file system delete ``path`` when the driver ends."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the shared storage (any Hadoop file system) recursively."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(jpath, True))
