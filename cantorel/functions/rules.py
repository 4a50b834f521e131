"""Ordered rules as data: cascades, flag sets and constraint reports."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Rule = tuple[Column, str]


def first_match(rules: Iterable[Rule], default: str | None = None) -> Column:
    """The name of the first rule that holds; conditions that are null don't hold."""
    chain = None
    for condition, name in rules:
        chain = F.when(condition, name) if chain is None else chain.when(condition, name)
    return chain.otherwise(F.lit(default)) if chain is not None else F.lit(default)


def flags(rules: Iterable[Rule]) -> Column:
    """Names of all rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(condition, name) for condition, name in rules]))


def plain_unions(spark: SparkSession) -> None:
    """Unions that claim no partitioning: with it, adaptive plans can pair children of unequal partition counts and fail."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def sorted_map(c: Column) -> Column:
    """A map with its entries in the order of the keys."""
    return F.map_from_entries(F.array_sort(F.map_entries(c)))


def overridden(base: Column, over: Column) -> Column:
    """The entries of both maps, those of ``over`` where both have a key, in the order of the keys."""
    return sorted_map(F.map_zip_with(base, over, lambda _, a, b: F.coalesce(b, a)))


VIOLATION = ("rule", "key", "detail")


def violation(rows: DataFrame, rule: str, key: Column, detail: Column) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def report(parts: list[DataFrame]) -> DataFrame:
    """All violations of several rules; empty exactly if the data is valid."""
    plain_unions(parts[0].sparkSession)
    return reduce(DataFrame.unionByName, parts)


def duplicates(rows: DataFrame, rule: str, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    many = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return violation(many, rule, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.col("n"))


def orphans(rows: DataFrame, key: str, parents: DataFrame, parent_key: str, rule: str) -> DataFrame:
    """Distinct keys without a parent."""
    p = parents.select(F.col(parent_key).alias("__parent"))
    lost = rows.select(key).distinct().join(p, F.col(key) == F.col("__parent"), "left_anti")
    return violation(lost, rule, F.col(key), F.lit("no parent"))


def variants(rows: DataFrame, key: str, value: str, rule: str) -> DataFrame:
    """Keys with more than one distinct value."""
    many = rows.groupBy(key).agg(F.countDistinct(value).alias("n")).filter("n > 1")
    return violation(many, rule, F.col(key), F.col("n"))


class ViolationError(ValueError):
    """Strict mode found data that breaks a rule."""


def assert_empty(violations: DataFrame, shown: int = 5) -> None:
    """Raise if there is any violation; only the first few come to the driver."""
    found = violations.take(shown)
    if found:
        raise ViolationError("; ".join(str(r.asDict()) for r in found))


def histogram(rows: DataFrame, reason: Column, name: str = "reason") -> DataFrame:
    """How many rows have each reason."""
    return rows.groupBy(reason.alias(name)).agg(F.count("*").alias("n"))
