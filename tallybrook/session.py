"""Session settings and the shared folder that jobs write into."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# State on local disk with a bounded share of an executor's memory, uploaded as changes; the
# join format keeps both sides of a stream join in one store per partition.
STREAM_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

BASE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **STREAM_STATE,
}

_local_root: tempfile.TemporaryDirectory | None = None


def build_session(
    app: str = "tallybrook",
    master: str | None = None,
    settings: dict[str, str] | None = None,
    metastore_uris: str | None = None,
) -> SparkSession:
    """Start a session. With ``metastore_uris`` the Hive catalog is used, else Spark's own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**BASE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    if metastore_uris:
        builder = builder.config("hive.metastore.uris", metastore_uris).enableHiveSupport()
    return builder.getOrCreate()


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply SQL settings inside the block and put the former ones back afterwards."""
    former = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in former.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one named by ``spark.checkpoint.dir``.

    Every executor must reach it, so a machine-local folder is made only for a local
    session that names none.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_root is None:
            _local_root = tempfile.TemporaryDirectory(prefix="tallybrook-")
        root = _local_root.name
    return f"{root.rstrip('/')}/tallybrook/{label}-{uuid.uuid4().hex}"
