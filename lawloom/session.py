"""Session defaults for these jobs and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Many small XML files: pack them into full tasks instead of one task per few files.
    "spark.sql.files.openCostInBytes": str(256 * 1024),
}


def build_session(app_name: str = "lawloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings these jobs are tuned for; `conf` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's checkpoint setting.

    Only a local session without the setting gets a folder of its own; on a cluster a
    machine-local folder would lose data with its machine, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = spark.conf.get("spark.lawloom.localDir", None)
        if not root:
            root = tempfile.mkdtemp(prefix="lawloom-")
            spark.conf.set("spark.lawloom.localDir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/lawloom/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Write `df` once to the shared folder and go on from the written copy."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an action go when it has ended, not when the driver next collects its garbage.

    For steps that write large tables one after another and do not use a frame's shuffles twice.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
