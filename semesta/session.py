"""Spark session and shared scratch location."""

from __future__ import annotations

import posixpath
import re
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock
from uuid import uuid4

from pyspark.sql import SparkSession

_HELD: ContextVar[list[str] | None] = ContextVar("semesta_scratch", default=None)
_FOLDERS: dict[str, str] = {}
_LOCK = Lock()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_TIDY: list[str] = []


def build_session(app: str = "semesta", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the warehouse jobs are written for.

    Small computed sides are written and read back by ``operators.settled``; all joins are left to
    Catalyst's size statistics and AQE. Joins with a hot key are split by AQE, also where the split costs
    one more shuffle later on.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "Asia/Jakarta",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # HotSpot does not compile methods beyond 8000 bytes; without this such stages run interpreted.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and staged tables.

    It is named in ``spark.checkpoint.dir``; tests and bench set it too. Only a session whose tasks all
    run in this process (``local[..]``) gets a temporary folder where it is unset; everywhere else a
    machine-local folder would be lost with its executor, so there it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="semesta-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name for results that nobody needs after the work they belong to.

    It lies in a folder of this application, which the file system removes when the application ends, whether
    its work succeeded or not. Inside ``temporary`` the folder goes as soon as that block ends.
    """
    application = spark.sparkContext.applicationId
    with _LOCK:
        if application not in _FOLDERS:
            _FOLDERS[application] = posixpath.join(shared_dir(spark), f"semesta-{uuid4().hex}")
            system, path = _file_system(spark, _FOLDERS[application])
            system.mkdirs(path)
            system.deleteOnExit(path)
    folder = posixpath.join(_FOLDERS[application], f"{name}-{uuid4().hex}")
    held = _HELD.get()
    if held is not None:
        held.append(folder)
    return folder


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action in the block go with the action, not when the driver next collects garbage.

    So the block's disk is that of its largest action, not of all.
    """
    with _LOCK:
        _TIDY.append(spark.conf.get(_CLEANUP, "false"))
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            spark.conf.set(_CLEANUP, _TIDY.pop())


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What the block puts into scratch folders is removed at its end, also after an error; its actions are ``tidy``.

    Nothing that is computed later may read it, so the block has to write its results itself.
    """
    held: list[str] = []
    token = _HELD.set(held)
    try:
        with tidy(spark):
            yield
    finally:
        _HELD.reset(token)
        remove(spark, held)


def remove(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        system, path = _file_system(spark, folder)
        system.delete(path, True)


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    """The folders in ``folder``, none where it does not exist; spelled as below ``folder``."""
    system, path = _file_system(spark, folder)
    if not system.exists(path):
        return []
    return [posixpath.join(folder, entry.getPath().getName()) for entry in system.listStatus(path) if entry.isDirectory()]
