"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "tabsmith") -> SparkSession:
    """Local session used by tests and the benchmark; a cluster passes its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` from the session (on a cluster this names a shared
    file system). When it is unset a folder is created for a local master only, as in
    tests; on a cluster a machine-local folder would not be shared, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tabsmith-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tabsmith-{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


#: removes the shuffle files of a query as soon as it has ended
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: bytecode of a generated function beyond which its operators run one by one; HotSpot
#: compiles no function of more than 8,000
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
WHILE_WRITING = {SHUFFLE_CLEANUP: "true", METHOD_LIMIT: "8000"}


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Settings of the session that hold inside the block; what was set comes back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def materialize(df, name: str = "stage"):
    """Cut the lineage of a frame that several later branches reuse: write it once as
    a parquet table in the shared checkpoint folder and read it back. One pass (a
    ``checkpoint()`` of an unpersisted frame computes it twice), survives executor
    loss, and the read-back scan still prunes columns and pushes filters.

    Nothing reads the write's shuffle files again, so they go with its end and don't
    wait, on every executor's disk, for the driver to collect its garbage. Long
    projections run operator by operator, in functions that the JVM compiles."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with session_settings(spark, WHILE_WRITING):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
