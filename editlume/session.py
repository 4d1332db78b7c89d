"""Session settings and the shared scratch area for cut plans."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "editlume", **conf: str) -> SparkSession:
    """A session with the settings the plans assume (UTC, AQE, Arrow); `conf` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()
_local_roots: dict[str, str] = {}
_scratch: dict[str, set[str]] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    home = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="editlume-code-")) / "editlume.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, Path("editlume") / p.relative_to(home))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Where it is unset, as in tests, a folder of this machine serves a local master; on a cluster the
    executors could not read each other's files there, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="editlume-")
    return _local_roots[sc.applicationId]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a parquet table in the shared folder and read it back.

    Cuts the lineage and survives the loss of any executor. The last stage is computed once
    (an eager checkpoint() would compute it twice). `drop_materialized` removes the table.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/editlume/{name}-{uuid.uuid4().hex}"
    with transient_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._editlume_path = path  # type: ignore[attr-defined]
    _scratch.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return out


@contextmanager
def transient_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside leave no shuffle files: else these stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def drop_materialized(df: DataFrame | None) -> None:
    """Delete the table behind a frame returned by `materialize`; other frames are left alone."""
    path = getattr(df, "_editlume_path", None)
    if path is not None:
        _delete(df.sparkSession, path)


def release_scratch(spark: SparkSession) -> int:
    """Delete all tables `materialize` has written in this application and that still stand; returns how many.

    For when the results made so far have been consumed: frames that read these tables end to work.
    """
    paths = list(_scratch.get(spark.sparkContext.applicationId, ()))
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _scratch.get(spark.sparkContext.applicationId, set()).discard(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
