"""Where jobs put the tables they write between steps, and how these go away."""

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

_SCOPE: ContextVar[str | None] = ContextVar("scratch scope", default=None)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``, in a folder of this application.

    Without that setting it lies under the warehouse, if all executors share that: it is no local folder, or the session is local.
    """
    return f"{_SCOPE.get() or application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/{spark.conf.get('spark.app.id', 'session')}"


def scratch_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if urlsplit(warehouse).scheme in ("", "file") and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"{warehouse}/_scratch"
    return f"{shared.rstrip('/')}/tallybook"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a job run inside has shuffled goes from the disks when it ends, and not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def scratch_scope(spark: SparkSession, label: str) -> Iterator[None]:
    """Scratch paths taken inside lie in one folder, which is removed at the end, also after a failure.

    What is read later must have been written elsewhere by then.
    """
    folder = scratch_dir(spark, label)
    token = _SCOPE.set(folder)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        remove_folder(spark, folder)


def sweep_scratch(spark: SparkSession, own: bool = True, older_than_hours: float = 72) -> list[str]:
    """Remove the scratch folder of this application, and those of others in which nothing was written for so long.

    Call it when no result that reads scratch tables is needed any more; returns what was removed.
    """
    mine, before = application_folder(spark), (time.time() - 3600 * older_than_hours) * 1000
    gone = []
    for name, changed in list_folder(spark, scratch_root(spark)):
        folder = f"{scratch_root(spark)}/{name}"
        if folder == mine:
            old = own
        else:
            old = max([changed, *(at for _, at in list_folder(spark, folder))]) < before
        if old:
            remove_folder(spark, folder)
            gone.append(folder)
    return gone


def list_folder(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, time of change) of what lies in a folder, nothing if there is no such folder."""
    store, path = _store(spark, folder)
    return [(s.getPath().getName(), s.getModificationTime()) for s in store.listStatus(path)] if store.exists(path) else []


def remove_folder(spark: SparkSession, folder: str) -> None:
    store, path = _store(spark, folder)
    store.delete(path, True)


def _store(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path
