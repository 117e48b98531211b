"""Session settings and places on shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "patronscope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine; on a cluster a
    missing setting is an error, because executors could not read each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        folder = tempfile.mkdtemp(prefix="patronscope-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_settled: dict[str | None, list[str]] = {}
_scope: ContextVar[str | None] = ContextVar("scope", default=None)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back; its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _settled.setdefault(_scope.get(), []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def current_scope() -> str | None:
    return _scope.get()


@contextmanager
def scope(name: str) -> Iterator[None]:
    """Tables that ``settle`` writes inside belong to ``name``; ``release`` frees them and no others."""
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)


def release(spark: SparkSession, name: str | None = None) -> None:
    """Free what ``settle`` has written in a scope, by default outside of any; call it once results that read it are written.

    The paths are overwritten with no rows, so this works on any storage that Spark writes to.
    """
    paths = _settled.get(name, [])
    while paths:
        spark.range(0).write.mode("overwrite").parquet(paths.pop())
