"""Session helpers: settings, the shared scratch folder, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows of a small fitted table that may travel to the driver.
SMALL_STATE_ROWS = 100_000


def session(app: str = "staymill", master: str | None = None, **conf: str) -> SparkSession:
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster. Only a local session may make its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="staymill-")
    spark.sparkContext.setCheckpointDir(root)
    return scratch_root(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# Whole texts handed to Python at once: Arrow buffers on both sides hold a batch, in every running task.
TEXT_ROWS = 1000


@contextmanager
def arrow_rows(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """At most `rows` rows in an Arrow batch of what runs inside; None leaves the session's own number."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if rows is not None:
        spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialise(df: DataFrame, name: str = "table", batch_rows: int | None = None, codec: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    with arrow_rows(df.sparkSession, batch_rows):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
