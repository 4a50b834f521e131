"""Deterministic paths without collisions."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType, StructField, StructType

from cantorel.functions import rules
from cantorel.functions.text import casefold, nfc_casefold, safe_component
from cantorel.session import kept

# Kinds of sources with the letter of their suffix, the bytes of a path component, what stands for
# an empty one, and the reasons of a suffix.
KINDS = {"composer": "c", "work": "p", "file": "f"}
COMPONENT_BYTES = 180
UNTITLED = "Untitled"
REASONS = ("clean_or_casefold_collision", "truncation_collision", "suffix_collision")
#: Hexadecimal digits of the suffixes that ``unique_paths`` tries, one after the other.
_DIGITS = (8, 12, 16, 24, 40)


class PathCollisionError(ValueError):
    """Suffixes did not separate all paths."""


def _cleaned(name: str) -> str:
    plain = "".join("_" if c == "/" or unicodedata.category(c) == "Cc" else c for c in unicodedata.normalize("NFC", name))
    return plain.rstrip(" .") or UNTITLED


def _fitted(name: str, tail: str) -> str:
    """A name cut so that it and its tail fit a component."""
    room = COMPONENT_BYTES - len(tail.encode())
    return name.encode()[:room].decode(errors="ignore").rstrip(" .") or UNTITLED


_NAMED = StructType([StructField(n, StringType()) for n in ("cleaned", "plain", "marked", "identity")])


@pandas_udf(_NAMED)
def _names(kind: pd.Series, original: pd.Series, stable_id: pd.Series) -> pd.DataFrame:
    """A source's clean name, its component without and with its suffix, and what tells it apart."""
    out = []
    for k, name, key in zip(kind, original, stable_id):
        clean, composed = _cleaned(name), unicodedata.normalize("NFC", name)
        stem, ext = (clean[:-4], clean[-4:]) if k == "file" and clean.casefold().endswith(".pdf") else (clean, "")
        mark = hashlib.sha256(composed.encode()).hexdigest()[:10] if k == "composer" else key.removeprefix(KINDS[k])
        mark = f"__{KINDS[k]}{mark}"
        out.append((clean, _fitted(stem, ext) + ext, _fitted(stem, mark + ext) + mark + ext, composed if k == "composer" else f"{key}\0{name}"))
    return pd.DataFrame(out, columns=["cleaned", "plain", "marked", "identity"])


def source_violations(sources: DataFrame) -> DataFrame:
    """What is wrong in sources (kind, original, stable_id): unknown kinds, repeated sources, ids that aren't positive numbers."""
    name = F.col("original")
    number = F.regexp_replace("stable_id", "^[pf]", "").rlike(r"^[1-9][0-9]*\z") & ~F.when(F.col("kind") == "work", F.col("stable_id").startswith("f")).otherwise(F.col("stable_id").startswith("p"))
    known = F.col("kind").isin(*KINDS)
    return rules.report([
        rules.violation(sources.filter(~F.coalesce(known, F.lit(False))), "unknown_kind", name, F.col("kind")),
        rules.violation(sources.filter(known & (F.col("kind") != "composer") & ~F.coalesce(number, F.lit(False))), "stable_id_not_numeric", name, F.col("stable_id")),
        rules.violation(sources.filter(F.col("original").isNull() | F.coalesce(F.trim("stable_id") == "", F.lit(True))), "source_incomplete", F.col("kind"), F.col("stable_id")),
        rules.duplicates(sources, "duplicate_source", "kind", "original", "stable_id"),
    ])


def path_map(sources: DataFrame) -> DataFrame:
    """Sources (kind, original, stable_id) with ``mapped`` and ``collision_reason``.

    Names are cleaned and cut to 180 bytes. Where names of one kind are equal when folded but
    stand for different things, all of them get their stable id (a composer a hash) as suffix. A
    suffixed name can meet another name; that one is then suffixed too, until nothing collides:
    each round suffixes at least one more source, and one that can't is an error. Rows of one
    composer are one thing. The result doesn't depend on the order of the rows. Each round is two
    aggregates and an equi-join over the names.
    """
    rules.assert_empty(source_violations(sources))
    rows = sources.select("kind", "original", "stable_id", _names("kind", "original", "stable_id").alias("n")).select("kind", "original", "stable_id", "n.*")
    rows = rows.withColumn("key", casefold("plain")).withColumn("full", casefold("cleaned"))
    groups = rows.groupBy("kind", "key").agg(F.countDistinct("identity").alias("things"), F.countDistinct("full").alias("names"))
    reason = F.when(F.col("things") > 1, F.when(F.col("names") == 1, REASONS[0]).otherwise(REASONS[1]))
    rows = rows.join(groups, ["kind", "key"]).withColumn("collision_reason", reason).drop("key", "full", "things", "names")
    while True:
        now = rows.withColumn("mapped", F.when(F.col("collision_reason").isNull(), F.col("plain")).otherwise(F.col("marked"))).withColumn("key", casefold("mapped"))
        groups = now.groupBy("kind", "key").agg(F.countDistinct("identity").alias("things"), F.count_if(F.col("collision_reason").isNull()).alias("open")).filter("things > 1")
        found = groups.agg(F.count("*").alias("n"), F.sum("open").alias("open")).first()
        if not found["n"]:
            return now.select("kind", "original", "stable_id", "mapped", "collision_reason")
        if not found["open"]:
            raise PathCollisionError("suffixes can't separate all paths: two stable ids are equal")
        hit = now.join(groups.select("kind", "key", F.lit(True).alias("hit")), ["kind", "key"], "left")
        rows = kept(hit.withColumn("collision_reason", F.coalesce("collision_reason", F.when(F.col("hit"), REASONS[2]))).drop("key", "mapped", "hit"))


def manifest(mapped: DataFrame) -> DataFrame:
    """A path map as one JSON document (column ``value``), its items in order.

    The document is one value by its format, so this is for maps of a size to be kept in one file.
    """
    item = F.struct("kind", "stable_id", "original", "mapped", "collision_reason")
    whole = F.struct(F.array_sort(F.collect_list(item)).alias("items"), F.lit("PathMapManifest").alias("model_type"), F.lit(1).alias("schema_version"))
    return mapped.agg(F.to_json(whole, {"ignoreNullFields": "false"}).alias("value"))


def manifest_violations(documents: DataFrame) -> DataFrame:
    """What is wrong in path map documents (column ``value``) as ``manifest`` writes them."""
    kind = "schema_version int, model_type string, items array<struct<kind: string, stable_id: string, original: string, mapped: string, collision_reason: string>>"
    d = documents.select(F.from_json("value", kind).alias("d"), F.xxhash64("value").cast("string").alias("key")).select("key", "d.*")
    items = d.select("key", F.explode("items").alias("i")).select("key", "i.*")
    text = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    good = F.col("kind").isin(*KINDS) & F.col("original").isNotNull() & text("stable_id") & text("mapped") & (F.octet_length("mapped") <= COMPONENT_BYTES)
    good = good & (F.col("collision_reason").isNull() | F.col("collision_reason").isin(*REASONS))
    envelope = (F.col("schema_version") == 1) & (F.col("model_type") == "PathMapManifest") & F.col("items").isNotNull()
    return rules.report([
        rules.violation(d.filter(~F.coalesce(envelope, F.lit(False))), "invalid_envelope", F.col("key"), F.col("model_type")),
        rules.violation(items.filter(~F.coalesce(good, F.lit(False))), "invalid_item", F.col("key"), F.col("mapped")),
    ])


def unresolved(mapped: DataFrame) -> DataFrame:
    """Groups of paths that are still equal when folded."""
    return mapped.groupBy("kind", nfc_casefold("mapped").alias("key")).agg(F.count("*").alias("n")).filter("n > 1")


def suffixed(rows: DataFrame, path: str, identity: str, fold: Callable[[str], Column] = nfc_casefold, digits: int = _DIGITS[0]) -> DataFrame:
    """One round of ``unique_paths``: all but the first of a colliding group (by identity) get so many digits of a hash as suffix.

    Such suffixes can be equal too, or meet another path; only ``unique_paths`` goes on until nothing collides.
    """
    group = Window.partitionBy("__key").orderBy(identity)
    rows = rows.withColumn("__key", fold(path)).withColumn("__r", F.row_number().over(group))
    mark = F.concat(F.lit("__"), F.substr(F.sha1(F.col(identity).cast("string")), F.lit(1), F.lit(digits)))
    ext = F.regexp_extract(path, r"\.[A-Za-z0-9]{1,5}$", 0)
    marked = F.concat(F.regexp_replace(path, r"\.[A-Za-z0-9]{1,5}$", ""), mark, ext)
    return rows.withColumn(path, F.when(F.col("__r") > 1, marked).otherwise(F.col(path))).drop("__key", "__r")


def unique_paths(rows: DataFrame, path: str, identity: str, fold: Callable[[str], Column] = nfc_casefold) -> DataFrame:
    """Paths where all but the first of a colliding group (by identity) get a hash suffix, longer while any collide."""
    for digits in _DIGITS:
        rows = suffixed(rows, path, identity, fold, digits)
        if rows.groupBy(fold(path).alias("key")).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
            return rows
    raise PathCollisionError("suffixes can't separate all paths: two identities are equal")


def work_directory(rows: DataFrame, title: str, composer: str) -> DataFrame:
    """``relative_directory`` of each work: composer, then title, each a safe component."""
    return rows.withColumn("relative_directory", F.concat_ws("/", safe_component(F.col(composer)), safe_component(F.col(title))))
