"""Session helpers and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "fleetpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for. Any of them can be overridden."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.checkpoint.compress": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of the executors, once per application.

    Functions that run in tasks are sent by name, so a worker imports the package, and what a
    module caches serves all tasks of that worker.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    if package.is_dir():  # inside an archive it has been shipped already
        archive = Path(tempfile.mkdtemp(prefix="fleetpulse-")) / "fleetpulse.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, Path("fleetpulse") / source.relative_to(package))
        sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables, taken from ``spark.checkpoint.dir``.

    Only a session whose master is ``local`` or ``local[N]`` gets a temporary folder when it
    names none: anywhere else that folder would exist on one machine only, so the setting is
    required.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fleetpulse-"))
    return sc.getCheckpointDir().rstrip("/")


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/fleetpulse/{label}-{uuid.uuid4().hex}"
    if _scratch.get() is not None:
        _scratch.get().append(path)
    return path


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = filesystem(spark, path)
    fs.delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables made inside the block when it ends.

    For jobs that write their results before they end. A stream would otherwise leave a few
    tables behind with every batch.
    """
    token = _scratch.set([])
    try:
        yield
    finally:
        made = _scratch.get()
        _scratch.reset(token)
        for path in made:
            remove(spark, path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages start from the stored rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Write to a parquet table in the shared folder and read it back.

    Used where a wide intermediate is read more than once with different columns: the copy is
    compressed, prunable, and the same on every read however the task that made it was placed.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each query inside the block when it ends, not when memory is collected."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def write_alone(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """``write_once`` of the rows that ``make`` returns, without what was stored on the way to them.

    For steps of several intermediate tables, which nothing reads later.
    """
    path = work_path(spark, label)
    with scratch(spark), _shuffles_removed(spark):
        df = make()
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, keys: list[str], buckets: int, label: str) -> Iterator[DataFrame]:
    """The rows as a table bucketed on ``keys``, for as long as the block runs.

    Joins on the keys read the buckets in place: the rows are shuffled once, however many
    joins follow. Results must be stored before the block ends, the files go with it. There
    are at least as many buckets as shuffle partitions, because Spark would shuffle fewer of
    them again to reach that parallelism.
    """
    spark = df.sparkSession
    n = max(buckets, shuffle_partitions(spark))
    path, table = work_path(spark, label), f"fleetpulse_{label}_{uuid.uuid4().hex}"
    (
        df.repartition(n, *keys)
        .write.format("parquet")
        .option("path", path)
        .bucketBy(n, *keys)
        .saveAsTable(table)
    )
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(spark, path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
