"""File sources of the catalogue: JSON documents and manifests, CSV logs, cached pages, object trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class ManifestError(ValueError):
    """A document that isn't what its reader expects."""


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON objects, strictly of the schema."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def unexpected_keys(spark: SparkSession, path: str, expected: set[str]) -> DataFrame:
    """(path, unknown, missing) of documents whose top-level keys aren't exactly the expected ones."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.json_object_keys("value").alias("keys"))
    want = F.array(*[F.lit(k) for k in sorted(expected)])
    rows = raw.select("path", F.array_except("keys", want).alias("unknown"), F.array_except(want, F.coalesce("keys", F.array())).alias("missing"))
    return rows.filter((F.size("unknown") > 0) | (F.size("missing") > 0))


def read_manifest(spark: SparkSession, path: str, model_type: str, item: str, version: int = 1) -> DataFrame:
    """Items of a typed manifest {schema_version, model_type, items}; another type or version is an error."""
    rows = read_json(spark, path, f"schema_version int, model_type string, items array<struct<{item}>>")
    bad = rows.filter(~F.col("model_type").eqNullSafe(model_type) | ~F.col("schema_version").eqNullSafe(version)).take(1)
    if bad:
        raise ManifestError(f"{path} holds {bad[0].model_type} version {bad[0].schema_version}")
    return rows.select(F.inline("items"))


def read_catalogues(spark: SparkSession, pattern: str, item: str) -> DataFrame:
    """Union of per-category catalogue files, the category being the name of the directory."""
    rows = spark.read.schema(item).option("multiLine", True).json(pattern).select("*", F.col("_metadata.file_path").alias("__path"))
    return rows.withColumn("category", F.url_decode(F.regexp_extract("__path", r"([^/]+)/(?:metadata/)?[^/]+$", 1))).drop("__path")


def read_status_log(spark: SparkSession, path: str) -> DataFrame:
    """A CSV log with header, with or without a byte-order mark."""
    rows = spark.read.option("header", True).option("multiLine", True).csv(path)
    return rows.toDF(*[c.lstrip("﻿") for c in rows.columns])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, wikitext) of cached page texts named by their ids."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.regexp_extract("_metadata.file_name", r"^([0-9]+)", 1).alias("page_id"), F.col("value").alias("wikitext"))


def missing(requested: DataFrame, cached: DataFrame, key: str) -> DataFrame:
    """Requested keys that no cache holds."""
    return requested.join(cached, key, "left_anti")


def file_links(pages: DataFrame) -> DataFrame:
    """(page_id, file_id, image_path) pairs scraped from HTML (page_id, html), in order."""
    ids = F.regexp_extract_all("html", F.lit(r"Special:ImagefromIndex/([0-9]+)"), F.lit(1))
    paths = F.regexp_extract_all("html", F.lit(r'href="[^"]*/images/([^"]+\.pdf)"'), F.lit(1))
    n = F.least(F.size("i"), F.size("p"))
    rows = pages.select("page_id", F.array_distinct(ids).alias("i"), F.array_distinct(paths).alias("p"))
    return rows.select("page_id", F.inline(F.arrays_zip(F.slice("i", 1, n).alias("file_id"), F.slice("p", 1, n).alias("image_path"))))


def scan_tree(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, size, modified) of files below a folder; their content isn't read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return rows.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def hashed_tree(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Files with their SHA-1, SHA-256 and whether they begin as PDF."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return rows.select("path", F.col("length").alias("size"), F.sha1("content").alias("sha1"), F.sha2("content", 256).alias("sha256"), (F.substring("content", 1, 5) == F.lit(b"%PDF-")).alias("is_pdf"))


def read_catalogue(spark: SparkSession, path: str, item: str, version: int = 1) -> DataFrame:
    """Works of a public catalogue document {schema_version, works}; a catalogue that is missing or of another version is an error."""
    rows = read_json(spark, path, f"schema_version int, works array<struct<{item}>>")
    other = rows.filter(~F.col("schema_version").eqNullSafe(version)).take(1)
    if other:
        raise ManifestError(f"{path} is of schema version {other[0].schema_version}")
    return rows.select(F.inline("works"))


def read_aliases(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(composer, alias) and (id, alias) of an alias document {composers, works}; without one, or with a broken one, there are none."""
    from pyspark.errors import AnalysisException

    kind = "composers map<string,array<string>>, works map<string,array<string>>"
    try:
        rows = spark.read.schema(kind).option("multiLine", True).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], kind)
    pairs = lambda column, name: rows.select(F.explode(column).alias(name, "a")).select(name, F.explode("a").alias("alias"))
    return pairs("composers", "composer"), pairs("works", "id")


def optional(read, empty: DataFrame) -> DataFrame:
    """What ``read`` gives, or the empty table where its path doesn't exist."""
    from pyspark.errors import AnalysisException

    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND",):
            raise
        return empty
