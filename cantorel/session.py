"""Session defaults and stable identifiers."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "cantorel", **conf: str) -> SparkSession:
    """A session with the settings that results depend on (UTC, ANSI) and adaptive execution."""
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true"}
    return SparkSession.builder.appName(app).config(map=base | conf).getOrCreate()


def work_id(page: Column, revision: Column) -> Column:
    return F.concat(F.lit("work:p"), page.cast("string"), F.lit("@r"), revision.cast("string"))


def source_id(file: Column, revision: Column) -> Column:
    return F.concat(F.lit("source:f"), file.cast("string"), F.lit("@r"), revision.cast("string"))


def membership_id(category: Column, source: Column) -> Column:
    return F.concat(F.lit("membership:"), F.substr(F.sha2(category, 256), F.lit(1), F.lit(10)), F.lit(":"), source)


def object_path(sha256: Column) -> Column:
    return F.concat(F.lit("objects/"), F.substr(sha256, F.lit(1), F.lit(2)), F.lit("/"), sha256, F.lit(".pdf"))


def is_decimal_id(c: Column) -> Column:
    """A positive number in canonical decimal form, as text."""
    return c.rlike(r"^[1-9][0-9]*\z")


def is_sha(c: Column, bits: int) -> Column:
    return c.rlike(rf"^[0-9a-f]{{{bits // 4}}}\z")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as ``spark.checkpoint.dir`` names it.

    Where it is unset a temporary one is set, but only on a local master: on a cluster other
    machines would not see it, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[[^-]|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="shared")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


_LEFT: dict[str, SparkSession] = {}


def kept(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder: it cuts the plan, stays the same when it is read
    again and survives lost executors. Such tables are deleted when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cantorel/{uuid.uuid4().hex[:12]}"
    if not _LEFT:
        atexit.register(_clear)
    _LEFT[path] = spark
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _clear() -> None:
    for path, spark in _LEFT.items():
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may have ended before; the folder is scratch space anyway
            return


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's functions and operators to the Python workers once per application."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")  # adaptive plans can pair unequal children under it
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="ship"), "cantorel_base.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in [top / "__init__.py", top / "session.py", *(q for d in ("functions", "operators", "sources", "streaming") for q in sorted((top / d).glob("*.py")))]:
            z.write(p, f"cantorel/{p.relative_to(top)}")
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
