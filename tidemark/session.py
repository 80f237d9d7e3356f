"""Session settings, shared scratch space and table loading."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; a cluster's own settings win over ours."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Stored timestamps carry no zone, so every comparison is made in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]):
    """Session settings for the jobs started inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app in _local_dirs:
        return _local_dirs[app]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    _local_dirs[app] = path
    return path


_folder: ContextVar[str | None] = ContextVar("scratch_folder", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder, or below the folder of the ``scratch_folder`` around."""
    below = _folder.get() or f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"
    return f"{below}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession, name: str):
    """Gather the tables stored inside the block in one folder, so that they can be deleted together; yields its path."""
    path = scratch_path(spark, name)
    token = _folder.set(path)
    try:
        yield path
    finally:
        _folder.reset(token)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing a table to the shared folder and reading it back.

    Used where several passes must see the very same rows; unlike a local
    checkpoint it survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df``, stored first if its plan holds an expression that may give other rows at every read, such as ``rand()``."""
    return df if df._jdf.queryExecution().analyzed().deterministic() else materialize(df, name)


class Tables:
    """Lazy access to the Parquet tables below one directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = pin_utc(spark)
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)
