"""Paged JSON sources: a Python data source with retries, and the relations in its pages."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cantorel.functions import rules

#: Answers that are worth another try, and the longest wait between tries.
RETRYABLE, MAX_WAIT = (429, 503), 60.0


class PagedError(RuntimeError):
    """A paged scan that cannot be trusted."""


def fetch(url: str, tries: int = 5, opened: Callable = urllib.request.urlopen, sleep: Callable = time.sleep) -> dict:
    """One JSON object, with bounded exponential backoff or the wait the server asks for."""
    for k in range(tries):
        wait = min(MAX_WAIT, 2.0**k)
        try:
            with opened(url, timeout=30) as r:
                found = json.loads(r.read())
            if not isinstance(found, dict) or "error" in found:
                raise PagedError(f"unexpected answer from {url}")
            return found
        except urllib.error.HTTPError as e:
            if e.code not in RETRYABLE or k == tries - 1:
                raise
            asked = e.headers.get("Retry-After") if e.headers else None
            wait = min(MAX_WAIT, float(asked)) if asked and asked.isdigit() else wait
        except urllib.error.URLError:
            if k == tries - 1:
                raise
        sleep(wait)
    raise PagedError("no tries left")


def pages(url: str, query: dict[str, str], get: Callable[[str], dict] = fetch, most: int = 10_000) -> Iterator[dict]:
    """All pages of a query, by the current or the legacy continuation; a repeated token or too many pages are errors."""
    seen: set[str] = set()
    more: dict[str, str] = {}
    for _ in range(most):
        page = get(f"{url}?{urllib.parse.urlencode(query | more)}")
        yield page
        legacy = page.get("query-continue") or {}
        more = page.get("continue") or {k: v for part in legacy.values() for k, v in part.items()}
        if not more:
            return
        token = json.dumps(more, sort_keys=True)
        if token in seen:
            raise PagedError("repeated continuation token")
        seen.add(token)
    raise PagedError("more pages than allowed")


class _Category(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)
        self.name = name


class PagedJsonReader(DataSourceReader):
    """One partition a category (or other title); each yields (key, page, body)."""

    def __init__(self, options: dict[str, str]):
        self.url, self.query = options["url"], json.loads(options.get("query", "{}"))
        self.parameter, self.keys = options.get("parameter", "cmtitle"), json.loads(options["keys"])

    def partitions(self) -> list[InputPartition]:
        return [_Category(k) for k in self.keys]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for n, page in enumerate(pages(self.url, self.query | {self.parameter: partition.name})):
            yield partition.name, n, json.dumps(page, ensure_ascii=False)


class PagedJson(DataSource):
    """``spark.read.format("paged_json").option("url", ...).option("keys", json list)``."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "key string, page int, body string"

    def reader(self, schema) -> DataSourceReader:
        return PagedJsonReader(self.options)


def members(bodies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(category, page_id, title) of category-member pages (key, body), and ids with two titles."""
    kind = "query struct<categorymembers: array<struct<ns: int, pageid: bigint, title: string>>>"
    rows = bodies.select(F.col("key").alias("category"), F.inline(F.from_json("body", kind)["query"]["categorymembers"]))
    one = rows.groupBy("category", F.col("pageid").alias("page_id")).agg(F.min("title").alias("title"), F.count_distinct("title").alias("n"))
    return one.select("category", "page_id", "title"), rules.violation(one.filter("n > 1"), "conflicting_title", F.col("page_id"), F.col("category"))


def all_categories(bodies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Listed categories (name, size, page_count, file_count, subcategory_count), and conflicting listings.

    Rows with a negative count are tombstones; of equal names the one with members counts.
    """
    kind = "query struct<allcategories: array<struct<category: string, size: bigint, pages: bigint, files: bigint, subcats: bigint>>>"
    rows = bodies.select(F.inline(F.from_json("body", kind)["query"]["allcategories"]))
    rows = rows.filter("least(size, pages, files, subcats) >= 0").withColumn("name", F.url_decode("category"))
    counts = F.struct("size", "pages", "files", "subcats")
    one = rows.groupBy("name").agg(F.max(counts).alias("c"), F.count_distinct(F.when(F.col("size") > 0, counts)).alias("n"))
    out = one.select("name", "c.size", F.col("c.pages").alias("page_count"), F.col("c.files").alias("file_count"), F.col("c.subcats").alias("subcategory_count"))
    return out, rules.violation(one.filter("n > 1"), "conflicting_listing", F.col("name"), F.col("n"))


def category_info(requested: DataFrame, bodies: DataFrame) -> DataFrame:
    """Counts of requested categories (name); one that is missing isn't one that is empty."""
    kind = "query struct<pages: array<struct<title: string, missing: boolean, categoryinfo: struct<pages: bigint, files: bigint, subcats: bigint>>>>"
    rows = bodies.select(F.inline(F.from_json("body", kind)["query"]["pages"]))
    rows = rows.select(F.regexp_replace("title", "^Category:", "").alias("name"), F.coalesce("missing", F.lit(False)).alias("gone"), "categoryinfo.*")
    out = requested.join(rows, "name", "left")
    none = F.col("gone").isNull() | F.col("gone") | F.col("pages").isNull()
    return out.select("name", none.alias("missing"), *[F.when(~none, F.col(a)).alias(b) for a, b in (("pages", "page_count"), ("files", "file_count"), ("subcats", "subcategory_count"))])


def revisions(bodies: DataFrame) -> DataFrame:
    """(page_id, title, revision_id, wikitext) of revision pages."""
    kind = "query struct<pages: array<struct<pageid: bigint, title: string, revisions: array<struct<revid: bigint, slots: struct<main: struct<content: string>>>>>>>"
    rows = bodies.select(F.inline(F.from_json("body", kind)["query"]["pages"]))
    return rows.select(F.col("pageid").alias("page_id"), "title", F.inline("revisions")).select("page_id", "title", F.col("revid").alias("revision_id"), F.col("slots.main.content").alias("wikitext"))


def file_metadata(bodies: DataFrame) -> DataFrame:
    """(file_id, filename, url, description_url, size, sha1, mime, license) of image-information pages."""
    kind = (
        "query struct<pages: array<struct<pageid: bigint, title: string, imageinfo: array<struct<url: string, descriptionurl: string, size: bigint, sha1: string, mime: string, "
        "extmetadata: struct<LicenseShortName: struct<value: string>>>>>>>"
    )
    rows = bodies.select(F.inline(F.from_json("body", kind)["query"]["pages"])).select("pageid", "title", F.inline("imageinfo"))
    return rows.select(
        F.col("pageid").cast("string").alias("file_id"), F.regexp_replace("title", "^File:", "").alias("filename"), "url", F.col("descriptionurl").alias("description_url"), "size", "sha1", "mime",
        F.col("extmetadata.LicenseShortName.value").alias("license"),
    )


def batches(keys: DataFrame, key: str, size: int = 50) -> DataFrame:
    """(batch, keys): keys in groups of at most ``size`` for one request each."""
    from cantorel.operators.ordering import numbered

    rows = numbered(keys.select(key).distinct(), key, "__n").withColumn("batch", F.floor(F.col("__n") / size))
    return rows.groupBy("batch").agg(F.array_sort(F.collect_list(key)).alias("keys"))
