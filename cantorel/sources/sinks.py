"""Sinks: canonical JSON, manifests, CSV catalogues, and rendered pages."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cantorel.functions.text import html_escape
from cantorel.sources.files import ManifestError


def canonical(document: Mapping) -> str:
    """JSON with sorted keys and an ending newline; numbers must be finite."""
    return json.dumps(document, ensure_ascii=False, sort_keys=True, indent=2, allow_nan=False) + "\n"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str, once: bool = False) -> None:
    """One small file, written beside its place and renamed; ``once`` refuses to replace."""
    fs, p = _fs(spark, path)
    if once and fs.exists(p):
        raise FileExistsError(path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not once:
        fs.delete(p, False)
    if not fs.rename(part, p):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def write_json(spark: SparkSession, path: str, document: Mapping, once: bool = False) -> None:
    """A canonical document; one with a lower schema_version doesn't replace one with a higher."""
    old = None if once else read_text(spark, path)
    if old and json.loads(old).get("schema_version", 0) > document.get("schema_version", 0):
        raise ManifestError("a newer document is there")
    write_text(spark, path, canonical(document), once)


def write_manifest(df: DataFrame, path: str, model_type: str, version: int = 1) -> None:
    """Items as one typed manifest, its lines written in parallel into a folder; another type isn't replaced."""
    old = read_text(df.sparkSession, f"{path}/_manifest.json")
    if old and json.loads(old)["model_type"] != model_type:
        raise ManifestError(f"{path} holds {json.loads(old)['model_type']}")
    df.write.mode("overwrite").json(f"{path}/items")
    write_text(df.sparkSession, f"{path}/_manifest.json", canonical({"schema_version": version, "model_type": model_type}))


def catalogue_document(works: DataFrame, categories: DataFrame, summary: DataFrame) -> DataFrame:
    """The public catalogue as one row of minified JSON.

    The document is one object by definition and is put together in one task, so this is for catalogues
    that a browser can load (some 10,000 works make 3 MB); larger ones are written as tables.
    """
    w = works.agg(F.array_sort(F.collect_list(F.struct("ord", F.struct(*[c for c in works.columns if c != "ord"]).alias("w")))).alias("w"))
    c = categories.agg(F.array_sort(F.collect_list(F.struct("id", "name", "name_zh", "family", "kind"))).alias("categories"))
    row = w.join(c).join(summary)
    return row.select(F.to_json(F.struct(F.lit(1).alias("schema_version"), F.struct(*summary.columns).alias("summary"), "categories", F.transform("w", lambda x: x["w"]).alias("works"))).alias("value"))


def csv_catalogue(works: DataFrame, manifest: DataFrame, columns: list[str]) -> DataFrame:
    """Works with their files' paths joined by " | ", and the fixed columns."""
    paths = manifest.groupBy("work_id").agg(F.array_join(F.array_sort(F.collect_list("relative_path")), " | ").alias("paths"), F.count("*").alias("files"))
    return works.join(paths, "work_id", "left").withColumn("files", F.coalesce("files", F.lit(0))).select(*columns)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def search_rows(works: DataFrame, files: DataFrame, most: int = 8) -> DataFrame:
    """Works with at most ``most`` files each, in order, and how many there are."""
    f = files.groupBy("work_id").agg(F.array_sort(F.collect_list(F.struct("ord", "path"))).alias("f"))
    rows = works.join(f, "work_id", "left").withColumn("f", F.coalesce("f", F.array().cast("array<struct<ord:int,path:string>>")))
    return rows.withColumn("file_total", F.size("f")).withColumn("files", F.transform(F.slice("f", 1, most), lambda x: x["path"])).drop("f")


def embedded_json(df: DataFrame) -> DataFrame:
    """Rows as JSON that can stand in an HTML script."""
    return df.select(F.replace(F.to_json(F.struct(*df.columns)), F.lit("</"), F.lit("<\\/")).alias("value"))


def grouped_html(works: DataFrame) -> DataFrame:
    """One HTML section a composer: works (composer, title, url) in order, all text escaped."""
    item = F.concat(F.lit('<li><a href="'), html_escape(F.col("url")), F.lit('">'), html_escape(F.col("title")), F.lit("</a></li>"))
    rows = works.select("composer", "title", item.alias("item")).groupBy("composer").agg(F.array_sort(F.collect_list(F.struct("title", "item"))).alias("x"))
    return rows.select("composer", F.concat(F.lit("<section><h2>"), html_escape(F.col("composer")), F.lit("</h2><ul>"), F.array_join(F.transform("x", lambda i: i["item"]), ""), F.lit("</ul></section>")).alias("html"))


def store_objects(files: DataFrame) -> DataFrame:
    """Content-addressed objects of files (path, content): one row a distinct content, with its path and sources."""
    rows = files.select("path", F.sha2("content", 256).alias("sha256"), F.length("content").alias("size"))
    one = rows.groupBy("sha256", "size").agg(F.array_sort(F.collect_set("path")).alias("sources"))
    return one.withColumn("object_path", F.concat(F.lit("objects/"), F.substring("sha256", 1, 2), F.lit("/"), "sha256", F.lit(".pdf")))


# What a log of finished downloads tells of each.
STATUS_COLUMNS = ("timestamp", "composer", "title_en", "filename", "relative_path", "status", "detail", "observed_size", "observed_sha1", "source_url")


def append_status(rows: DataFrame, path: str) -> None:
    """Append finished downloads to a status table; each call is one commit, so a batch is whole or absent."""
    rows.select(*STATUS_COLUMNS).write.mode("append").parquet(path)


def write_objects(files: DataFrame, root: str, expected: str | None = None) -> DataFrame:
    """Write files (path, content) to content-addressed objects below ``root``: (sha256, size, object_path, outcome).

    One row for each distinct content. A content that is there already is ``kept``; what stands in
    its place with another hash is moved to ``quarantine/`` and the content is ``repaired``; others
    are ``stored``. A file is written beside its place and moved, so a task that runs again finds
    either nothing or all of it. ``expected`` are the bytes each content must begin with; others are
    ``refused``. The result is a plan: contents are written when it is read.
    """
    begin = (expected or "").encode()
    one = files.select(F.sha2("content", 256).alias("sha256"), "content").groupBy("sha256").agg(F.any_value("content").alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            rows = []
            for digest, content in zip(batch.column("sha256").to_pylist(), batch.column("content").to_pylist()):
                path = f"objects/{digest[:2]}/{digest}.pdf"
                outcome = "stored"
                if not content.startswith(begin):
                    rows.append((digest, len(content), None, "refused"))
                    continue
                if fs.get_file_info(f"{base}/{path}").type != pafs.FileType.NotFound:
                    with fs.open_input_stream(f"{base}/{path}") as f:
                        outcome = "kept" if hashlib.sha256(f.read()).hexdigest() == digest else "repaired"
                    if outcome == "repaired":
                        fs.create_dir(f"{base}/quarantine", recursive=True)
                        fs.move(f"{base}/{path}", f"{base}/quarantine/{digest}-{uuid.uuid4().hex[:8]}.pdf")
                if outcome != "kept":
                    part = f"{base}/objects/{digest[:2]}/.{uuid.uuid4().hex}.part"
                    fs.create_dir(f"{base}/objects/{digest[:2]}", recursive=True)
                    with fs.open_output_stream(part) as f:
                        f.write(content)
                    fs.move(part, f"{base}/{path}")
                rows.append((digest, len(content), path, outcome))
            yield pa.RecordBatch.from_pylist([dict(zip(_OBJECT.names, r)) for r in rows], schema=_OBJECT)

    return one.mapInArrow(run, "sha256 string, size long, object_path string, outcome string")


_OBJECT = pa.schema([("sha256", pa.string()), ("size", pa.int64()), ("object_path", pa.string()), ("outcome", pa.string())])


def grouped_markdown(works: DataFrame) -> DataFrame:
    """One Markdown section a composer: works (composer, title, url) in order, all text escaped."""
    plain = lambda c: F.regexp_replace(F.regexp_replace(F.col(c), r"([\\`*_{}\[\]<>#|])", r"\\$1"), r"\s+", " ")
    item = F.concat(F.lit("- ["), plain("title"), F.lit("](<"), F.regexp_replace("url", r"[<>\s]", ""), F.lit(">)"))
    rows = works.select("composer", "title", item.alias("item"), F.concat(F.lit("### "), plain("composer")).alias("head"))
    rows = rows.groupBy("composer", "head").agg(F.array_sort(F.collect_list(F.struct("title", "item"))).alias("x"))
    return rows.select("composer", F.concat(F.col("head"), F.lit("\n\n"), F.array_join(F.transform("x", lambda i: i["item"]), "\n"), F.lit("\n")).alias("markdown"))


def category_view(memberships: DataFrame, objects: DataFrame) -> DataFrame:
    """Active memberships with the object that each category path shows; no file is linked."""
    rows = memberships.filter("active").join(objects.select(F.col("sha256"), "object_path"), "sha256")
    first = Window.partitionBy("category_name", "planned_local_path").orderBy("membership_id")
    return rows.withColumn("__r", F.row_number().over(first)).withColumn("conflict", F.col("__r") > 1).drop("__r")
