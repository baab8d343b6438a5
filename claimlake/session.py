"""A session with the settings that this library relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build(app: str = "claimlake", **conf: str) -> SparkSession:
    """Session with adaptive execution, skew-join handling and UTC; ``conf`` adds to or replaces these."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    } | conf
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors share; without one, on one machine, a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="claimlake-")
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session (dots as ``__``) that hold inside and are put back afterwards."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def freed(spark: SparkSession):
    """Inside, the shuffle files of a job are removed when it ends, not when the driver next collects garbage."""
    return setting(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")
