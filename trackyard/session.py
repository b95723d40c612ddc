"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on. ANSI mode makes bad casts and
# decimal overflow raise, as the SQL the layers are modelled on does.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "trackyard", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster leave ``master`` unset so spark-submit decides; locally pass
    ``local[N]``. Shuffle partitions default to 4x the cores locally; on a
    cluster AQE coalesces from whatever the deployment sets.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("TRACKYARD_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it only when unset.

    A cluster must name a shared folder in ``spark.checkpoint.dir``; that value
    is always preferred. Only a local-mode session (tests, the single-node
    bench) without one gets a private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    # driver and executors share one machine's folders here, and only here
    if sc.master == "local" or sc.master.startswith("local["):
        local_dir = tempfile.mkdtemp(prefix="trackyard-ckpt-")
        sc.setCheckpointDir(local_dir)
        return sc.getCheckpointDir() or local_dir
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a shared folder (HDFS/S3/ABFS) "
        "so lineage cuts survive executor loss")


_SCOPES: list[list[str]] = []


def freeze(df):
    """Cut lineage by writing ``df`` as Parquet under the checkpoint folder and reading it back.

    One job computes and writes the data (an eager ``checkpoint()`` computes
    it twice unless persisted), the copy lives on the shared checkpoint
    storage so it survives executor loss, and later scans of it get column
    pruning. Used where a recomputation could change the result (sampled range
    bounds, monotonically increasing ids). Inside a ``frozen_scope`` the copy goes when the scope ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/frozen-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def frozen_scope(spark: SparkSession):
    """What is frozen inside is deleted at the end; results that read it must have been written by then."""
    _SCOPES.append(paths := [])
    try:
        yield
    finally:
        _SCOPES.pop()
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


JIT_LIMIT = "8000"  # bytecodes; the JVM never compiles a longer method and interprets it row by row


@contextmanager
def short_methods(spark: SparkSession):
    """Wide projections inside are generated as split functions where one method would be too long to be compiled.

    Spark joins a stage's expressions in one method of up to 64 KB of bytecode; a table's parse exceeds ``JIT_LIMIT``.
    A session's own lower limit stays.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    if before is not None and int(before) < int(JIT_LIMIT):
        yield
        return
    with _setting(spark, key, JIT_LIMIT):
        yield


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_let_go(spark: SparkSession):
    """Inside, a query's shuffle files go when the query ends, not when the driver happens to collect its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def same_splits(spark: SparkSession):
    """Inside, scans of the same files have the same splits, also if executors come or go meanwhile."""
    key = "spark.sql.files.minPartitionNum"
    least = spark.conf.get(key, None) or spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    return _setting(spark, key, str(least or spark.sparkContext.defaultParallelism))


def run_concurrently(tasks, max_workers: int | None = None) -> list:
    """Run independent driver-side job builders (one table each) on threads.

    Spark schedules jobs submitted from several threads side by side, so small
    tables fill cores a large one leaves idle. Results come back in task order;
    the first exception is re-raised after all tasks finished.
    """
    from concurrent.futures import ThreadPoolExecutor

    tasks = list(tasks)
    if len(tasks) <= 1:
        return [t() for t in tasks]
    workers = max_workers or int(os.environ.get("TRACKYARD_TABLE_THREADS", "8"))
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
        errors = [f.exception() for f in futures]
    for e in errors:
        if e is not None:
            raise e
    return [f.result() for f in futures]


_SHIPPED: set[str] = set()
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors once per application.

    Python functions of an operator are pickled by reference, so the workers
    must be able to import the package. Only code travels this way, never data.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(root):  # else: already running from a shipped archive
        archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="trackyard-code-")),
                               f"trackyard_{uuid.uuid4().hex[:8]}.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _dirs, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("trackyard", os.path.relpath(full, root)))
        spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold ``BATCH_BYTES`` at most, unless the session says otherwise.

    A batch is held several times over at once: in the JVM's buffers, in the worker, and as what is made of it.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema) -> DataFrame:
    """``mapInArrow`` with the package on the workers."""
    ship_package(df.sparkSession)
    bounded_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)
