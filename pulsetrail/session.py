"""Session settings and the shared folder every job stages its intermediate tables in."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


CLUSTER_PARTITIONS = "4000"  # adaptive execution merges small shuffle partitions, but adds none


def build_session(
    app: str = "pulsetrail", master: str | None = None, hive: bool = False, **conf
) -> SparkSession:
    """A session with the settings the library is written for.

    ``conf`` overrides or adds settings, with ``__`` for the dots; ``hive`` reads and writes the
    tables of a Hive catalog. Without ``master`` (on a cluster) shuffles start with many partitions.
    """
    settings = {
        **({} if master else {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": CLUSTER_PARTITIONS}),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without the setting; it then gets a folder of its own. On a cluster
    a folder of the machine is refused, as other executors do not see it.
    """
    local = spark.sparkContext.master.startswith("local")
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path and not local and path.startswith("file:"):
        raise RuntimeError(f"{path} is a folder of one machine")
    if path:
        return path.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pulsetrail-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_SCOPES: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


@contextmanager
def staged(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, when the result of the job is written.

    Only the tables of this scope go; other jobs of the application keep theirs.
    """
    token = _SCOPES.set((*_SCOPES.get(), f"job-{uuid.uuid4().hex}"))
    try:
        yield
    finally:
        folder = _own_folder(spark)
        _SCOPES.reset(token)
        _delete(spark, folder)


def _own_folder(spark: SparkSession) -> str:
    return "/".join([shared_dir(spark), spark.sparkContext.applicationId, *_SCOPES.get()])


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, in the folder of the job that is running."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# A task reads a row group of up to 4096 rows at once: of rows as long as a megabyte there must be few in it.
LONG_ROWS = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 64}


def stage(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    This cuts the lineage, survives the loss of any executor, computes the rows exactly once (so a
    value that depends on the partition layout keeps its meaning), and gives the following joins the
    real size of the table. Shuffle files of the write are deleted when it ends, not when the driver
    happens to collect its garbage. ``options`` are those of the writer; see ``LONG_ROWS``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table that no later step reads any more."""
    spark = df.sparkSession
    own = f"/{spark.sparkContext.applicationId}/"
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if own in folder:
            _delete(spark, folder)


def clear_staged(spark: SparkSession) -> None:
    """Delete all staged tables of this application, once its results are written."""
    _delete(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


_SHIPPED: set[str] = set()
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once for each application.

    Batches between Spark and the workers hold ``BATCH_BYTES`` at most, or one row; a setting that is
    lower is left as it is.
    """
    if int(spark.conf.get(BATCH_SETTING).removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="pulsetrail-"), "pulsetrail-code.zip")
        with zipfile.ZipFile(path, "w") as target:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        file = os.path.join(folder, name)
                        target.write(file, os.path.relpath(file, os.path.dirname(package)))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
