"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Scratch folders of this process's applications.
_FOLDERS: set[str] = set()


def build_session(app_name: str = "vigilspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tested under; cluster settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``, else one in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing else uses. All of an application's paths go when its driver ends."""
    own = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    if own not in _FOLDERS:
        _FOLDERS.add(own)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
    return f"{own}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` and the tree learners at the shared folder when nothing has yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


@contextmanager
def compilable_code(spark: SparkSession) -> Iterator[None]:
    """Within it, plans run without whole-stage code where that has methods that HotSpot only interprets (over 8,000 bytes)."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
