"""Shared storage for intermediate tables, and shipping this package to executors."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_LEFT: dict[str, SparkSession] = {}


def ship(spark: SparkSession) -> None:
    """Send this subpackage to the Python workers once per application (as ``--py-files`` does).

    It also turns ``spark.sql.unionOutputPartitioning`` off for the session, without which the
    operators' plans can fail; the operators need that setting, so they make it.
    """
    # adaptive plans can pair a union's children of unequal partition counts under this setting, and fail
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="ship"), "cantorel_llm.zip")
    with zipfile.ZipFile(target, "w") as z:
        z.writestr("cantorel/__init__.py", "")
        for p in sorted(top.glob("*.py")):
            z.write(p, f"cantorel/llm/{p.name}")
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset a temporary one is set, but only on a local master (tests): other machines
    would not see it, so on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="shared")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder; what is left there goes when the driver ends."""
    path = f"{shared_dir(spark)}/cantorel/{uuid.uuid4().hex[:12]}/{tag}"
    if not _LEFT:
        atexit.register(_clear)
    _LEFT[path] = spark
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet to the shared folder and read it again.

    Unlike a local checkpoint the table survives lost executors, and unlike an RDD
    checkpoint it keeps column statistics for the planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(df: DataFrame | None) -> None:
    """Delete a materialized table that nothing reads any more."""
    path = getattr(df, "_scratch", None)
    if path:
        delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path of ``scratch_path``."""
    _delete(spark, path)
    _LEFT.pop(path, None)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path).getParent()
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _clear() -> None:
    for path, spark in list(_LEFT.items()):
        try:
            _delete(spark, path)
        except Exception:  # the JVM may have ended before; the folder is scratch space anyway
            return
