"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "textloom") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, which need not have it on their path. Once per session."""
    context = spark.sparkContext
    if getattr(context, "_textloom_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="textloom-"), "textloom_package"), "zip",
                                          os.path.dirname(package), os.path.basename(package)))
    context._textloom_shipped = True


@contextmanager
def by_value() -> Iterator[None]:
    """Within it, functions and classes of the package are pickled whole.

    The process that sets up the state of a stream is not given what `ship` sends.
    """
    import textloom
    cloudpickle.register_pickle_by_value(textloom)
    try:
        yield
    finally:
        cloudpickle.unregister_pickle_by_value(textloom)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder the session names.

    `spark.checkpoint.dir` must be a folder all executors see. Only a local session that leaves
    it unset gets a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="textloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared scratch folder and read back, so that later passes do not repeat it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
