"""Frozen snapshots: binding pages to revisions and files to metadata, reviews of decisions, selections of categories."""

from __future__ import annotations

import hashlib
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, StringType

from cantorel.functions import rules
from cantorel.functions.text import percent_encoded
from cantorel.operators.classify import FAMILY_ZH


@pandas_udf(StringType())
def canonical_sha256(s: pd.Series) -> pd.Series:
    """SHA-256 of a JSON text in canonical form: sorted keys, no blanks."""
    form = lambda x: json.dumps(json.loads(x), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)
    return s.map(lambda x: None if x is None else hashlib.sha256(form(x).encode()).hexdigest())


def freeze(members: DataFrame, revisions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pages, categories, violations) from members (category, page_id, title) and current revisions (page_id, title, revision_id, wikitext).

    A page has the sorted names of all its categories and the hash of its text; a category its
    sorted member ids.
    """
    pages = members.groupBy("page_id").agg(F.array_sort(F.collect_set("category")).alias("category_names"), F.min("title").alias("m_title"))
    both = pages.join(revisions, "page_id")
    bad = rules.report([
        rules.violation(pages.join(revisions, "page_id", "left_anti"), "revision_missing", F.col("page_id"), F.lit("")),
        rules.violation(revisions.join(pages, "page_id", "left_anti"), "revision_unexpected", F.col("page_id"), F.lit("")),
        rules.violation(both.filter("not (title <=> m_title)"), "title_differs", F.col("page_id"), F.col("title")),
        rules.duplicates(revisions, "two_revisions", "page_id"),
    ])
    frozen = both.select("page_id", "revision_id", F.col("title").alias("page_title"), "category_names", "wikitext", F.sha2("wikitext", 256).alias("wikitext_sha256"))
    cats = members.groupBy(F.col("category").alias("name")).agg(F.array_sort(F.collect_set("page_id")).alias("member_page_ids"))
    return frozen, cats.withColumn("member_count", F.size("member_page_ids")), bad


def thawed(frozen: DataFrame, exact: DataFrame) -> DataFrame:
    """Violations of frozen pages against a later fetch of their exact revisions."""
    e = exact.select("revision_id", F.col("page_id").alias("e_page"), F.col("title").alias("e_title"), F.sha2("wikitext", 256).alias("e_hash"))
    both = frozen.join(e, "revision_id", "left")
    return rules.report([
        rules.violation(both.filter("e_page is null"), "revision_missing", F.col("revision_id"), F.lit("")),
        rules.violation(both.filter("e_page <> page_id or e_title <> page_title"), "revision_of_other_page", F.col("revision_id"), F.col("e_title")),
        rules.violation(both.filter("e_hash <> wikitext_sha256"), "text_differs", F.col("revision_id"), F.col("e_hash")),
    ])


def binding_violations(pages: DataFrame, categories: DataFrame) -> DataFrame:
    """Pages' categories and categories' pages must be the same pairs."""
    a = pages.select("page_id", F.explode("category_names").alias("name"))
    b = categories.select(F.explode("member_page_ids").alias("page_id"), "name")
    return rules.report([
        rules.violation(a.exceptAll(b), "only_in_pages", F.col("page_id"), F.col("name")), rules.violation(b.exceptAll(a), "only_in_categories", F.col("page_id"), F.col("name")),
        rules.violation(categories.filter("member_count <> size(member_page_ids)"), "member_count_differs", F.col("name"), F.col("member_count")),
    ])


def score_files(files: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attachments (page_id, revision_id, filename, file_id?) with their metadata by file name, and violations."""
    m = metadata.select("filename", F.col("file_id").alias("m_id"), "url", "size", "sha1", "mime", F.col("license").alias("copyright_label"))
    both = files.join(m, "filename", "left")
    bad = rules.report([
        rules.violation(both.filter("m_id is null"), "metadata_missing", F.col("filename"), F.lit("")), rules.violation(both.filter("file_id is not null and file_id <> m_id"), "file_id_differs", F.col("filename"), F.col("m_id")),
        rules.violation(metadata.join(files, "filename", "left_anti"), "metadata_unexpected", F.col("filename"), F.lit("")),
    ])
    rows = both.filter("m_id is not null").withColumn("file_id", F.col("m_id")).drop("m_id")
    return rows.withColumn("source_hash_missing", F.col("sha1").isNull()), bad


def apply_reviews(decisions: DataFrame, reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decisions with exclusions by review, bound to the digest of the decision reviewed.

    reviews (category_name, page_id, revision_id, source_id, decision, extraction_decision_sha256, reason).
    """
    fields = ["source_id", "filename", "disposition", "reason_code", "selection_reason", "evidence"]
    rows = decisions.withColumn("__sha", canonical_sha256(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})))
    key = ["category_name", "page_id", "revision_id"]
    r = reviews.select(*key, F.col("source_id").alias("__source"), F.col("extraction_decision_sha256").alias("__want"), F.col("decision").alias("__decision"), F.lit(True).alias("__reviewed"))
    same = rows.join(r, [*[rows[k] == r[k] for k in key], rows.source_id.eqNullSafe(r["__source"]), rows.disposition == "manual_review"], "left").select(*[rows[c] for c in rows.columns], "__want", "__decision", "__reviewed")
    open_ = rows.filter("disposition = 'manual_review'")
    bad = rules.report([
        rules.violation(reviews.join(open_, [*[reviews[k] == open_[k] for k in key], reviews.source_id.eqNullSafe(open_.source_id)], "left_anti"), "review_without_decision", F.col("page_id"), F.col("category_name")),
        rules.violation(same.filter("__want <> __sha"), "decision_changed_since_review", F.col("page_id"), F.col("__sha")),
        rules.violation(reviews.filter("decision <> 'exclude'"), "review_not_exclusion", F.col("page_id"), F.col("decision")),
        rules.duplicates(reviews, "duplicate_review", *key, "source_id"),
    ])
    done = F.col("__reviewed") & (F.col("__want") == F.col("__sha"))
    out = same.withColumn("disposition", F.when(done, "excluded").otherwise(F.col("disposition"))).withColumn("reason_code", F.when(done, "manual_review_excluded").otherwise(F.col("reason_code")))
    return out.select(*decisions.columns), bad


def config_violations(config: DataFrame, site: str) -> DataFrame:
    """What is wrong in an allowlist (name, url, kind, guitar_count text, instrumentation_patterns, heading_patterns, annotation_reject_tokens)."""
    anchored = F.forall(F.concat("instrumentation_patterns", "heading_patterns"), lambda p: p.startswith("^") & p.endswith("$"))
    url = F.concat(F.lit(f"{site}/wiki/Category:"), F.replace("name", F.lit(" "), F.lit("_")))
    count = F.col("guitar_count").rlike(r"^([1-9]|1[0-6])\z") | F.col("guitar_count").isin("ensemble", "[2,3]")
    arr = (F.col("kind") == "arrangement") == F.col("name").endswith("(arr)")
    name = F.col("name")
    return rules.report([
        rules.duplicates(config, "duplicate_category", "name"), rules.violation(config.filter(~anchored), "pattern_not_anchored", name, F.lit("")),
        rules.violation(config.filter(~F.col("kind").isin("original", "arrangement") | ~arr), "kind_differs_from_name", name, F.col("kind")),
        rules.violation(config.filter(F.col("url") != url), "url_differs_from_name", name, F.col("url")), rules.violation(config.filter(~count), "invalid_guitar_count", name, F.col("guitar_count")),
        rules.violation(config.filter(F.size("instrumentation_patterns") == 0), "no_instrumentation_pattern", name, F.lit("")),
    ])


def choose(config: DataFrame, kind: str | None = None, names: list[str] | None = None, manifests: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Categories (ord, name, kind) by kind, then names (an unknown one is an error), then empty manifests with works, then the limit."""
    rows = config.filter(F.col("kind") == kind) if kind else config
    if names:
        asked = config.sparkSession.createDataFrame([(n,) for n in names], "name string")
        rules.assert_empty(rules.violation(asked.join(rows, "name", "left_anti"), "unknown_category", F.col("name"), F.lit("")))
        rows = rows.join(asked.distinct(), "name", "left_semi")
    if manifests is not None:
        rows = rows.join(manifests.filter("files = 0 and works > 0"), "name", "left_semi")
    if limit is not None and limit < 1:
        raise ValueError("the limit must be positive")
    rows = rows.orderBy("ord")
    return rows.limit(limit) if limit is not None else rows


def retried(manifest: DataFrame, log: DataFrame) -> DataFrame:
    """Files of a manifest that failed in the previous log."""
    return manifest.join(log.filter("status <> 'ok'").select("filename"), "filename", "left_semi")


def split_by_section(rows: DataFrame, tokens: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, split off): rows whose section names one of the tokens are split off."""
    hit = F.lit(False)
    for t in tokens:
        hit = hit | F.contains(F.lower("section"), F.lit(t.lower()))
    return rows.filter(~F.coalesce(hit, F.lit(False))), rows.filter(F.coalesce(hit, F.lit(False)))


def merged_removals(previous: DataFrame, new: DataFrame) -> DataFrame:
    """Removed categories (name, ...), the newer entry of each name."""
    both = previous.withColumn("__p", F.lit(0)).unionByName(new.withColumn("__p", F.lit(1)))
    whole = F.struct(*previous.columns)
    return both.groupBy(F.col("name").alias("__n")).agg(F.max_by(whole, "__p").alias("r")).select("r.*").orderBy("name")


def forbidden(keys: set[str], patterns: list[str]):
    """A function of JSON text columns: whether a forbidden key or value is anywhere inside."""
    bad = [re.compile(p) for p in patterns]

    def inside(x: object) -> bool:
        if isinstance(x, dict):
            return any(k in keys or inside(v) for k, v in x.items())
        if isinstance(x, list):
            return any(map(inside, x))
        return isinstance(x, str) and any(p.search(x) for p in bad)

    @pandas_udf(BooleanType())
    def check(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x is not None and inside(json.loads(x)))

    return check


# Names of pure guitar categories after "For" (without the mark of arrangements), what they are
# shown as, their family, and their place among the categories; $1 and $2 are the numbers of the name.
DISPLAY = (
    ("guitar|0*1 guitars?", "1把吉他", "独奏吉他", "1 0"),
    ("0*2 guitars?", "2把吉他", "吉他二重奏", "2 0"),
    ("0*3 guitars?", "3把吉他", "吉他三重奏", "3 0"),
    ("0*4 guitars?", "4把吉他", "吉他四重奏", "4 0"),
    (r"0*(\d+) guitars?", "$1把吉他", "多把吉他", "$1 0"),
    (r"0*(\d+)[ -]string guitar", "$1弦吉他", "扩展弦制独奏", "1 1 $1"),
    (r"0*(\d+) and 0*(\d+) guitars", "$1或$2把吉他", "灵活编制", "$1 2 $2"),
    ("guitar ensemble", "吉他合奏", "吉他合奏与乐团", "90 0"),
    ("guitar orchestra", "吉他乐团", "吉他合奏与乐团", "91 0"),
)
# What any other name is shown as, and the places of mixed families.
OTHER_DISPLAY = ("纯吉他分类", "其他分类", "99 0")
MIXED_PLACES = {"strings": 100, "woodwinds": 110, "brass": 120, "keyboard_reed": 130, "plucked": 140, "percussion": 150, "mixed_chamber": 160}
_OTHER_MIXED_PLACE = 199


def category_display(name: Column, mixed_zh: Column | None = None, mixed_group: Column | None = None) -> Column:
    """(zh, family, sort) of a category name for the offline index; sort is one comparable text.

    ``mixed_zh`` and ``mixed_group`` are the Chinese name and the display group where the name is
    a mixed category (null elsewhere), as the classifier gives them; they come before the table.
    """
    arranged = F.lower(name).endswith("(arr)")
    body = F.regexp_replace(F.regexp_replace(name, r"(?i) \(arr\)\z", ""), r"(?i)^For ", "")
    kind = F.when(arranged, "·改编").otherwise("·原作")

    def shown(zh: Column, family: Column, numbers: Column) -> Column:
        places = F.transform(F.split(numbers, " "), lambda x: F.lpad(x, 4, "0"))
        sort = F.concat_ws("/", F.array_join(places, "/"), arranged.cast("int").cast("string"), F.lower(name))
        return F.struct(zh.alias("zh"), family.alias("family"), sort.alias("sort"))

    zh, family, numbers = (F.lit(x) for x in OTHER_DISPLAY)
    for pattern, text, group, place in reversed(DISPLAY):
        whole = rf"(?i)^(?:{pattern})\z"
        hit = name.rlike("(?i)^For ") & body.rlike(whole)
        zh = F.when(hit, F.concat(F.regexp_replace(body, whole, text), kind)).otherwise(zh)
        family = F.when(hit, F.lit(group)).otherwise(family)
        numbers = F.when(hit, F.regexp_replace(body, whole, place)).otherwise(numbers)
    if mixed_zh is not None and mixed_group is not None:
        names, at = ({k: F.lit(v) for k, v in t.items()} for t in (FAMILY_ZH, MIXED_PLACES))
        pick = lambda table, other: F.coalesce(*[F.when(mixed_group == k, v) for k, v in table.items()], other)
        mixed = mixed_zh.isNotNull()
        zh = F.when(mixed, mixed_zh).otherwise(zh)
        family = F.when(mixed, pick(names, mixed_group)).otherwise(family)
        numbers = F.when(mixed, pick(at, F.lit(_OTHER_MIXED_PLACE)).cast("string")).otherwise(numbers)
    return shown(zh, family, numbers)


def master_rank(query: Column, title: Column, blob: Column) -> Column:
    """Rank of a row of the offline index: null unless all terms occur; 0 equal, 1 prefix, 2 other."""
    terms = F.filter(F.split(F.lower(query), r"\s+"), lambda t: t != "")
    rank = F.when(F.lower(title) == F.lower(query), 0).when(F.startswith(F.lower(title), F.lower(query)), 1).otherwise(2)
    return F.when(F.forall(terms, lambda t: F.contains(F.lower(blob), t)), rank)


def url_state(query: Column, family: Column, kind: Column, category: Column) -> Column:
    """A search as a query string, without what is "all"."""
    part = lambda name, c: F.when(c.isNotNull() & ~F.trim(c).isin("", "all"), F.concat(F.lit(f"{name}="), F.url_encode(F.trim(c))))
    return F.concat_ws("&", part("q", query), part("family", family), part("kind", kind), part("category", category))


def read_url_state(state: Column, families: list[str], kinds: list[str], categories: list[str]) -> Column:
    """(text, family, kind, category) of a query string; unknown values are "all"."""
    get = lambda name: F.try_url_decode(F.regexp_extract(state, rf"(?:^|[?&]){name}=([^&]*)", 1))
    known = lambda name, values: F.when(get(name).isin(values), get(name)).otherwise("all")
    return F.struct(get("q").alias("text"), known("family", families).alias("family"), known("kind", kinds).alias("kind"), known("category", categories).alias("category"))


def page_url(title: Column, site: str) -> Column:
    """The address of a page of a wiki site."""
    return F.concat(F.lit(f"{site}/wiki/"), percent_encoded(F.replace(title, F.lit(" "), F.lit("_"))))
