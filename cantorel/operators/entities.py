"""Work-level dedup into a public catalogue, its counts, and its constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantorel.functions import rules
from cantorel.functions.text import allowed_url, casefold
from cantorel.operators.ordering import numbered, with_previous

IDENTITY = ("title_en", "title_zh", "composer_en", "composer_zh", "source_url")
# Families in the order in which they are shown.
FAMILY_ORDER = ("guitar", "strings", "woodwinds", "brass", "keyboard_reed", "plucked", "percussion", "mixed_chamber")


def categories(rows: DataFrame) -> DataFrame:
    """Categories (name, name_zh, family, kind) with ids by family order, originals first, then name."""
    place = F.coalesce(F.array_position(F.array(*map(F.lit, FAMILY_ORDER)), F.col("family")), F.lit(0)).cast("int")
    keyed = rows.withColumn("__k", F.struct(F.when(place == 0, len(FAMILY_ORDER) + 1).otherwise(place).alias("p"), (F.col("kind") == "arrangement").alias("a"), casefold("name").alias("n"), F.col("name").alias("x")))
    return numbered(keyed, "__k", "id").withColumn("id", F.col("id").cast("int")).drop("__k")


def works(bridge: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (id, category_id, IDENTITY...) to one row a work with its category_ids, and identity drift.

    A work whose identity differs between categories is a violation; its row then has the
    identity of its first category.
    """
    identity = F.struct(*IDENTITY)
    one = bridge.groupBy("id").agg(
        F.min_by(identity, "category_id").alias("i"), F.array_sort(F.collect_set("category_id")).alias("category_ids"), F.count_distinct(identity).alias("n")
    )
    drift = rules.violation(one.filter("n > 1"), "identity_drift", F.col("id"), F.col("n"))
    return one.select("id", "i.*", "category_ids"), drift


def ordered(rows: DataFrame) -> DataFrame:
    """Works in public order: folded composer, folded title, id as text."""
    return rows.orderBy(casefold("composer_en"), casefold("title_en"), "id")


def composer_conflicts(rows: DataFrame, overrides: DataFrame) -> DataFrame:
    """Composers with more than one translation and no override (composer_en, composer_zh)."""
    many = rows.groupBy("composer_en").agg(F.array_sort(F.collect_set("composer_zh")).alias("variants")).filter(F.size("variants") > 1)
    return many.join(overrides.select("composer_en"), "composer_en", "left_anti")


def with_overrides(rows: DataFrame, overrides: DataFrame) -> DataFrame:
    o = overrides.select("composer_en", F.col("composer_zh").alias("__zh"))
    return rows.join(o, "composer_en", "left").withColumn("composer_zh", F.coalesce("__zh", "composer_zh")).drop("__zh").select(*rows.columns)


def summary(cats: DataFrame, done: DataFrame) -> DataFrame:
    n = F.size("category_ids")
    return done.agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("memberships"), F.count("*").alias("unique_works"), F.count_if(n > 1).alias("shared_works")
    ).join(F.broadcast(cats.agg(F.count("*").alias("categories"))))


def violations(cats: DataFrame, done: DataFrame, domain: str) -> DataFrame:
    """What is wrong in a public catalogue: ids, references, counts, order, links, empty fields."""
    bridge = done.select("id", F.explode("category_ids").alias("category_id"))
    counted = bridge.groupBy("category_id").agg(F.count("*").alias("n"))
    both = cats.join(counted, cats.id == counted.category_id, "full").filter(~F.coalesce("work_count", F.lit(0)).eqNullSafe(F.coalesce("n", F.lit(0))))
    key = done.select(F.col("id").alias("k"), F.struct(casefold("composer_en").alias("c"), casefold("title_en").alias("t"), "id").alias("v"), "ord")
    unsorted = with_previous(key, "ord", "v").filter("previous > v")
    empty = F.exists(F.array(*IDENTITY), lambda x: F.trim(x) == "") | F.exists(F.array(*IDENTITY), lambda x: x.isNull())
    gaps = cats.agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).filter("n > 0 and (a <> 0 or b <> n - 1)")
    own = F.transform("category_ids", lambda x: x)
    return rules.report([
        rules.duplicates(done, "duplicate_work", "id"), rules.duplicates(cats, "duplicate_category", "id"), rules.orphans(bridge, "category_id", cats, "id", "unknown_category"),
        rules.violation(both, "work_count_differs", F.coalesce("id", "category_id"), F.col("n")), rules.violation(unsorted, "not_sorted", F.col("v.id"), F.lit("")),
        rules.violation(done.filter(empty), "empty_field", F.col("id"), F.lit("")), rules.violation(done.filter(~allowed_url(F.col("source_url"), domain, "/wiki/")), "link_not_allowed", F.col("id"), F.col("source_url")),
        rules.violation(gaps, "category_ids_not_contiguous", F.col("b"), F.col("n")),
        rules.violation(done.filter((F.size("category_ids") == 0) | (F.array_sort(F.array_distinct("category_ids")) != own)), "category_ids_not_sorted", F.col("id"), F.lit("")),
    ])


def alias_violations(aliases: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Aliases (key, alias) must name known identities, be non-empty and unique."""
    return rules.report([
        rules.orphans(aliases, key, known, key, "unknown_identity"), rules.duplicates(aliases, "duplicate_alias", key, "alias"),
        rules.violation(aliases.filter("alias is null or trim(alias) = ''"), "empty_alias", F.col(key), F.lit("")),
    ])


def first_per_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in an explicit order."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(F.min_by(whole, F.struct(*order)).alias("r")).select("r.*")


def seed_map(rows: DataFrame) -> DataFrame:
    """(key, value): of rows (path, key, value) the first that isn't blank, in order of path."""
    return rows.filter(F.trim("value") != "").groupBy("key").agg(F.min_by("value", "path").alias("value"))


def lookup(rows: DataFrame, names: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """Rows with a looked-up value, or the default."""
    n = names.select(key, F.col(value).alias("__v"))
    return rows.join(n, key, "left").withColumn(value, F.coalesce("__v", F.lit(default))).drop("__v")


def override(rows: DataFrame, cached: DataFrame, overrides: DataFrame, key: list[str], by: str, columns: list[str]) -> DataFrame:
    """Columns from overrides (by ``by``), else the row, else the cache (by ``key``)."""
    c = cached.select(*key, *[F.col(x).alias(f"__c_{x}") for x in columns])
    o = overrides.select(by, *[F.col(x).alias(f"__o_{x}") for x in columns])
    out = rows.join(c, key, "left").join(o, by, "left")
    for x in columns:
        out = out.withColumn(x, F.coalesce(f"__o_{x}", x, f"__c_{x}"))
    return out.select(*rows.columns)


def reconcile(config: DataFrame, local: DataFrame) -> DataFrame:
    """(name, status): config (name, page_count) against local (name, members): keep, adjust, remove, unverified."""
    rows = config.join(local, "name", "left")
    m = F.col("members")
    status = rules.first_match([(m.isNull(), "unverified"), (m == 0, "remove"), (m != F.col("page_count"), "adjust")], "keep")
    return rows.select("name", "page_count", "members", status.alias("status"))


def exact_match(requested: DataFrame, received: DataFrame, key: str) -> DataFrame:
    """Violations of a request's and its response's keys being the same set."""
    a, b = requested.select(key).distinct(), received.select(key).distinct()
    return rules.report([rules.violation(a.join(b, key, "left_anti"), "missing", F.col(key), F.lit("")), rules.violation(b.join(a, key, "left_anti"), "unexpected", F.col(key), F.lit(""))])


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two sets, 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def verification(records: DataFrame, files: DataFrame) -> DataFrame:
    """Per category: expected, valid, missing, wrong size, wrong hash and unexpected files.

    records (category, path, size, sha1), files (category, path, size, sha1, is_pdf).
    """
    f = files.select("category", "path", F.col("size").alias("f_size"), F.col("sha1").alias("f_sha1"), "is_pdf")
    both = records.join(f, ["category", "path"], "full").withColumn("listed", F.col("size").isNotNull() | F.col("sha1").isNotNull())
    here = F.col("is_pdf").isNotNull()
    size_ok, hash_ok = F.coalesce(F.col("size") == F.col("f_size"), F.lit(True)), F.coalesce(F.col("sha1") == F.col("f_sha1"), F.lit(True))
    return both.groupBy("category").agg(
        F.count_if("listed").alias("expected"), F.count_if(F.col("listed") & here & F.col("is_pdf") & size_ok & hash_ok).alias("valid"),
        F.count_if(F.col("listed") & ~here).alias("missing"), F.count_if(F.col("listed") & here & ~size_ok).alias("wrong_size"),
        F.count_if(F.col("listed") & here & size_ok & ~hash_ok).alias("wrong_hash"), F.count_if(~F.col("listed")).alias("unexpected"),
        F.coalesce(F.sum(F.when(F.col("listed") & ~here, F.coalesce("size", F.lit(0)))), F.lit(0)).alias("remaining_bytes"),
    )


def needed_space(remaining: Column) -> Column:
    """Bytes that must be free before a download: a fifth more than remains, and one GiB."""
    return F.floor(remaining * 1.2) + (1 << 30)


def round_robin_window(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Place of each row among those of its key."""
    return rows.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(order)))


def recovered_aliases(quarantined: DataFrame, manifest: DataFrame) -> DataFrame:
    """Quarantined files (path, work_id, size, sha1) that are exactly one other record of their work, whose own file is absent."""
    m = manifest.select(F.col("path").alias("target"), "work_id", "size", "sha1", "present")
    pairs = quarantined.join(m, ["work_id", "size", "sha1"]).filter("path <> target and not present")
    return pairs.groupBy("path").agg(F.count("*").alias("n"), F.min("target").alias("target")).filter("n = 1").drop("n")


def rescued(mismatched: DataFrame, manifest: DataFrame) -> DataFrame:
    """Mismatched files that another record on the same physical path matches."""
    return mismatched.join(manifest.select("path", F.col("size").alias("f_size"), F.col("sha1").alias("f_sha1")), ["path", "f_size", "f_sha1"], "left_semi")
