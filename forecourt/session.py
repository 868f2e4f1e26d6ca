"""Session settings the library relies on.

* ``session.timeZone=UTC``: epoch-millisecond parsing and ``timestamp_ntz``
  casts must not depend on the machine zone.
* ANSI mode stays on; cleaning uses ``try_*`` functions so bad text becomes
  NULL plus a flag instead of aborting the job.
* AQE with skew-join splitting: a single hot order or customer may hold a
  large share of the rows.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where its rows must then be dealt once more
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Wide cleaning projections generate big methods; above 8000 bytes of
    # bytecode the JVM will not JIT them, so fall back to per-operator codegen.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "forecourt", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's required settings.

    On a cluster ``master`` is left to ``spark-submit``; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # a call site for every Column node is a third of the time to build a wide plan
    conf["spark.python.sql.dataFrameDebugging.enabled"] = "false"
    # let the JIT compile large generated methods (driver JVM launched here)
    conf["spark.driver.extraJavaOptions"] = "-XX:-DontCompileHugeMethods"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Pin the runtime settings on an existing session (e.g. the driver's)."""
    for k, v in CORE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, as ``spark.checkpoint.dir`` names
    it.  Executors and driver must see the same files, so there is no fallback
    to a machine's own folder: a local session sets the folder itself."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="forecourt-ckpt-")  # one machine, one process
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder (never machine-local
    on a cluster, because the folder comes from ``spark.checkpoint.dir``)."""
    return os.path.join(checkpoint_dir(spark), name)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table that ``write_scratch`` made and nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system that Spark knows."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, on any file system that Spark knows; none if it is missing."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    return "\n".join(r.value for r in spark.read.text(path).collect())


def publish_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text file that readers see whole or not at all; an existing one is an error."""
    jvm = spark.sparkContext._jvm
    target, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{os.path.dirname(path)}/_draft-{os.path.basename(path)}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        raise FileExistsError(path)


#: Whether a query's shuffle files go when it ends, and not when the driver's JVM happens to collect garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_scratch(df, name: str, free: bool = False) -> str:
    """Write ``df`` as Parquet under the shared checkpoint folder; its path.  ``free``
    deletes the shuffle files of the write as soon as the table is there."""
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")
    before = spark.conf.get(SHUFFLES_GO, "false")
    if free:
        spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    return path


def cluster_conf(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.3,
                 target_partition_bytes: int = 200 << 20) -> dict:
    """Sizing for a large run (e.g. 100 TB on 1000 executors).

    Shuffle partitions are sized so one reduce task handles about
    ``target_partition_bytes`` of the expected shuffle volume (inputs are
    mostly pruned to a few columns before a shuffle, hence
    ``shuffle_fraction``) and never fewer than two per core; AQE then
    coalesces small partitions and splits skewed ones at run time.
    """
    import math

    parts = max(2 * total_cores, math.ceil(input_bytes * shuffle_fraction / target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    }
