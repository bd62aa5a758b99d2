"""Where jobs keep tables they need for themselves."""

from __future__ import annotations

import atexit
import gc
import shutil
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Without the setting it is a folder below the session's warehouse, which all
    executors share too. A local session, as in tests, removes it in the end.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        _own[app] = f"{warehouse}/celloom-work/{app}"
        if spark.sparkContext.master.startswith("local"):
            atexit.register(_remove, _own[app])
    return _own[app]


def _remove(folder: str) -> None:
    shutil.rmtree(folder.removeprefix("file:"), ignore_errors=True)


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name not used before, below the shared one; nothing is created."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of ended work removed.

    Spark does so when the driver has collected what stood for them, which it may
    not for as long as its heap has room.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
