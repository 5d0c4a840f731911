"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on. AQE coalesces small shuffles, splits skewed join
# partitions (also where that costs one more exchange) and picks broadcast joins by the
# sizes it has measured.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
CLEANED = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


# Partitions that a large query's shuffle starts with: AQE merges small ones, but does not cut large ones of an aggregate.
# It merges up to a size as it was shuffled, packed: a task that sorts and aggregates it takes about 25 times that.
PARTITIONS = 256
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MERGED, MERGED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m"
# What a task reads of packed files that were stored between two steps.
READ = "spark.sql.files.maxPartitionBytes"
# How the files are packed.
PACKED, CODEC = "spark.sql.parquet.compression.codec", "zstd"


def tune(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """Apply the runtime settings to a session someone else has built.

    `partitions` is what a shuffle starts with at least, and AQE merges them, and a task reads, up to MERGED_BYTES,
    and files are packed with CODEC, unless the session has its own settings.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if partitions and spark.conf.get(INITIAL, None) is None:
        spark.conf.set(INITIAL, str(max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    for name, value in ((MERGED, MERGED_BYTES), (READ, MERGED_BYTES), (PACKED, CODEC)):
        if partitions and spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


@contextlib.contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings for what is planned or started meanwhile; the session keeps its own."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def build_session(app_name: str = "orderloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the settings above; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    builder = builder.config("spark.sql.ansi.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **CLEANED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from spark.checkpoint.dir.

    Only a local session may go without the setting; it then gets a temporary folder. That the
    folder is shared is for whoever sets it: a file: path may be a mounted share or not.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="orderloom-"))
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def store(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder as Parquet and read back: lineage ends here."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
