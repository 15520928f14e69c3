"""Spark session settings the engine relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every stage depends on for correct results.
#  - UTC session zone: naive source timestamps mean UTC, and TIMESTAMP <-> NTZ casts
#    are done in the session zone.
#  - duplicate JSON keys keep the last value, like Python's json.loads.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings for throughput at scale; a cluster may override them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Applied only when a session (and its JVM) is created here, e.g. local tests.
LOCAL_LAUNCH_CONF = {
    "spark.driver.memory": "8g",
}


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's required settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    launch = LOCAL_LAUNCH_CONF if (master or "").startswith("local") else {}
    for key, value in {**launch, **DEFAULT_CONF, **REQUIRED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the operators assume (safe on a shared session)."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of statements run inside go as each ends, not when the driver happens to collect its garbage.

    For writes whose result is read back: nothing runs their plan again.
    """
    was = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, was)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object store) folder there; it is never
    overridden. Only when nothing is set (a test session) is ``fallback`` used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    target = configured or fallback
    if target:
        sc.setCheckpointDir(target)
        return sc.getCheckpointDir()
    return None


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share; a local session may do without the setting."""
    base = ensure_checkpoint_dir(spark)
    if base is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set")
        base = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tidemark-work-"))
    require_shared(spark, base)
    return f"{base.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


_SHARED: set[tuple[str, str]] = set()  # (application, folder) found to be shared


def require_shared(spark: SparkSession, base: str) -> None:
    """Fail unless what tasks write below ``base`` can be read back.

    A ``file:`` folder of a cluster may be a mount that all machines have, or each machine's own disk, where rows would be
    lost without an error. Its name does not tell, so the first use in an application writes and counts a row per task.
    """
    sc = spark.sparkContext
    if not base.startswith("file:") or sc.master.startswith("local") or (sc.applicationId, base) in _SHARED:
        return
    path, tasks = f"{base.rstrip('/')}/tidemark/probe-{uuid.uuid4().hex}", 4 * sc.defaultParallelism
    spark.range(0, tasks, 1, tasks).write.parquet(path)
    seen = spark.read.schema("id long").parquet(path).count()
    delete_folder(spark, path)
    if seen != tasks:
        raise RuntimeError(f"spark.checkpoint.dir must be a folder that all executors share, not {base}")
    _SHARED.add((sc.applicationId, base))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, asked of its own file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop))


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of the entries directly below a folder; empty if it does not exist."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return [(e.getPath().toString(), e.getModificationTime()) for e in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of our own, such as a hand-over table that has been consumed."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
