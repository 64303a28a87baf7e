"""SparkSession construction with the settings the operators are tuned for."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (AQE) broadcast: a join side is broadcast only after its shuffle
    # stage has been measured below this size, so the broadcast is size-checked.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# Runtime SQL settings the operators rely on; safe to apply to any session.
SQL_CONF = {
    # Zone-less Parquet timestamps stay TIMESTAMP_NTZ, so no result depends on
    # the session time zone.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "clinframe",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return the active session, or build one with :data:`DEFAULTS`.

    On a cluster, call this without ``master`` and the deploy settings win.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **SQL_CONF, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Folders of open :func:`checkpoints_below` blocks.
_below: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names (HDFS, S3, ...).

    There is no default: executors could not read a folder of the driver.
    """
    path = spark.conf.get(CHECKPOINT_SETTING, None) or (_below[-1] if _below else None)
    if not path:
        raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
    return path.rstrip("/")


#: Paths of stored tables: one list per open :func:`scratch` block, the first for tables outside any.
_owned: list[list[str]] = [[]]


def store(df: DataFrame, name: str, partition_by: str | None = None, lasting: bool = False) -> DataFrame:
    """``df`` written once to the checkpoint folder and read back.

    For results that are used more than once (a rank needs its rows and their
    counts): they are computed once, and a lost executor does not repeat them.
    This runs a job when the frame is built.  The table belongs to the innermost
    open :func:`scratch` block, or else (and if ``lasting``) lives until
    :func:`release_stored`.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/clinframe-{name}-{uuid.uuid4().hex}"
    _owned[0 if lasting else -1].append(path)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes the tables that :func:`store` writes inside the block when it ends, also by an error.

    Run the actions inside: a frame that reads such a table can't be used later.
    Yields the list of their paths.
    """
    mine: list[str] = []
    _owned.append(mine)
    try:
        yield mine
    finally:
        _owned.remove(mine)
        for path in mine:
            delete_folder(spark, path)


@contextmanager
def checkpoints_below(spark: SparkSession, folder: str) -> Iterator[None]:
    """Stored tables go below ``folder``, a shared one, where ``spark.checkpoint.dir`` is unset; it is deleted at the end."""
    _below.append(folder)
    try:
        yield
    finally:
        _below.remove(folder)
        if not spark.conf.get(CHECKPOINT_SETTING, None):
            delete_folder(spark, folder)


def release_stored(spark: SparkSession) -> int:
    """Delete the tables stored outside any :func:`scratch` block, once no frame that reads them is needed; their number."""
    paths, _owned[0][:] = list(_owned[0]), []
    for path in paths:
        delete_folder(spark, path)
    return len(paths)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store holds it; a missing one is no error."""
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it doesn't exist."""
    p, fs = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def apply_sql_conf(spark: SparkSession) -> SparkSession:
    """Apply :data:`SQL_CONF` to an existing session (e.g. one a driver built)."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def cluster_settings(input_bytes: int, target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Shuffle/scan sizing for a cluster run over ``input_bytes`` of Parquet.

    Starts shuffles with enough partitions for ~``target_partition_bytes``
    each (AQE then coalesces small ones and splits skewed ones), and reads
    files in splits of the same size, so a task's working set stays well
    inside executor memory.  Pass the result as ``get_spark(**settings)``.
    """
    n = max(200, input_bytes // target_partition_bytes + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
    }
