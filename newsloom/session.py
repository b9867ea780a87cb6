"""Session settings and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def build_session(app_name: str = "newsloom", **settings: str) -> SparkSession:
    """Session for spark-submit; the cluster's own settings stay in force.

    Keyword names use ``__`` for dots, as in ``spark__sql__shuffle__partitions="400"``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where it is unset, a local run uses one in its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_newsloom"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for the files of one run."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    The same as passing it with ``--py-files``, for sessions started without.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="newsloom-")) / package.name
    context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
    _shipped.add(context.applicationId)
