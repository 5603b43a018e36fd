"""Session helpers: the settings this package relies on, and durable intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.sinks import paths

# Wall-clock columns are UTC and JSON readers keep the last of a repeated key; both are session
# settings, so they can be applied to a session somebody else started.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    # Tables by pull and day have thousands of folders; a task lists many of them.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "curbline", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt evenly over the cores, by a hash of ``by`` if given. A file or a topic comes in few parts, too few
    for work that is bound by CPU."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *by)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: str) -> Iterator[None]:
    """Arrow batches of what runs inside have at most so many rows and bytes: a task holds a batch several times, in the
    JVM and in Python. The session's own settings hold again afterwards."""
    given = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {key: spark.conf.get(key) for key in given}
    try:
        for key, value in given.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for durable intermediates, else one beside the warehouse tables."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"


def through_files(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read from there. Files have no columns of nulls without a type, so those stay out."""
    untyped = [f.name for f in df.schema.fields if f.dataType.typeName() == "void"]
    typed = df.drop(*untyped)
    typed.write.parquet(path)
    rows = df.sparkSession.read.schema(typed.schema).parquet(path)
    return rows.withColumns({name: F.lit(None) for name in untyped}).select(df.columns) if untyped else rows


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Lineage ends at files every executor can re-read, later scans prune columns, and the file size
    is a real statistic: Catalyst broadcasts the table only if it is below the session's threshold
    and shuffles it otherwise, so no call site needs a broadcast hint.
    """
    return through_files(df, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}")


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder in the shared one for what runs inside, deleted afterwards.

    Rows that several jobs read go through it rather than being persisted. A persisted partition goes through Java's
    serialiser even where it ends on disk, which holds 100 batches of 10,000 rows for each task; a file takes one row group.
    """
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        paths.remove(spark, folder)
