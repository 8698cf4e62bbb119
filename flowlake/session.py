"""Session settings and the shared work folder.

No module in this package starts a SparkSession; callers pass theirs in.
``configure`` only pins what the results depend on (UTC wall clock), keeps AQE on
and keeps generated code small enough to be compiled.  ``work_root`` returns the shared folder used for written
tables and lineage cuts: it is derived from ``spark.checkpoint.dir`` so a
cluster's shared storage is used; a private folder is set only when the
session has none (local runs and tests).
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM leaves methods of over 8,000 bytes uncompiled.  A wide fact's stage would become one such
    # method; above this limit its operators are generated each on their own, in small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextlib.contextmanager
def overridden(spark: SparkSession, settings: dict[str, str] | None) -> Iterator[None]:
    """Session settings for one run; the former ones come back after it, also when it fails."""
    before = {k: spark.conf.get(k, None) for k in settings or {}}
    try:
        for k, v in (settings or {}).items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.  Where none is set, a local session gets a
    private one; on a cluster that is an error, as executors share no local folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="flowlake-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def work_root(spark: SparkSession) -> str:
    return checkpoint_dir(spark).rstrip("/") + "/flowlake"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared work root."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
