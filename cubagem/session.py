"""Session helpers: a tuned builder and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


SPREAD = "cubagem.scan.spread"


def build_session(app: str = "cubagem", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs of this package were tuned with."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # The JVM does not compile methods of more bytecode than this; split them instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    """Partitions for a shuffle whose output grows after it, so AQE must not merge it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of an input file whose rows one task of a fine shuffle takes, about.
FINE_BYTES = 1 << 20
#: Up to so many partitions a shuffle writes rows as they come; for more, a task holds and sorts all it has read.
UNSORTED = 200
#: Bytes of an input file from which a task of a fine shuffle is too large, so there are more than ``UNSORTED``.
COARSE_BYTES = 1 << 25


def fine_width(spark: SparkSession, path: str | None = None) -> int:
    """Partitions for a shuffle before rows that multiply and are grouped: several for each core.

    With the ``path`` of the input there are more for a larger one, so what a task holds does not grow with it. They stay
    at ``UNSORTED`` over a wide range of sizes, in which writing them takes no memory.
    """
    least = max(shuffle_width(spark), 4 * spark.sparkContext.defaultParallelism)
    if path is None:
        return least
    size = file_bytes(spark, path)
    return max(least, min(UNSORTED, -(-size // FINE_BYTES)), -(-size // COARSE_BYTES))


def file_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(found).getLength()


def spread_scan(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of a scan to all tasks, if the session asks for it.

    That suits tables of few row groups, whose scans would be few tasks. It costs a shuffle of
    what was read, so it is off unless ``cubagem.scan.spread`` is true, whatever the size.
    """
    if df.sparkSession.conf.get(SPREAD, "false") != "true":
        return df
    return df.repartition(shuffle_width(df.sparkSession), *keys)


#: Settings of :func:`own_step`.
STEP = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Rows that are dealt by one key of a join, like the cube, are not dealt again by all of them.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
#: Rows of a Parquet file that a task reads at once, where a row is a text of a thousand lines.
LONG_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "64"}


@contextlib.contextmanager
def own_step(spark: SparkSession, settings: dict[str, str] | None = None) -> Iterator[None]:
    """What is written within is a step of its own: its shuffles leave the disk as soon as it ends.

    Otherwise they stay until the driver happens to collect the DataFrames that made them, beside those of the next steps.
    ``settings`` are further ones for this step.
    """
    wanted = STEP | (settings or {})
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors can reach.

    Only a local master may do without the setting: it gets a folder in ``/tmp``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of :func:`shared_dir` after its last reader."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
