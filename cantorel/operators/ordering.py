"""Global numbering and neighbours in an order, without gathering the rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantorel.session import kept


def numbered(rows: DataFrame, key: str, name: str = "n") -> DataFrame:
    """``rows`` with their position (from 0) in the order of ``key``, which must be unique.

    Rows are range-partitioned and sorted; a position is the row's place in its partition
    plus the sizes of the partitions before, of which there is one number each. The ranges are
    kept as a table, so that sizes and rows come from the same ones.
    """
    ranged = kept(rows.repartitionByRange(F.col(key)).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__size"))
    before = F.coalesce(F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sizes.select("__part", before.alias("__base"))  # one row a partition
    place = F.row_number().over(Window.partitionBy("__part").orderBy(key))
    out = ranged.withColumn("__place", place).join(F.broadcast(base), "__part")
    return out.withColumn(name, F.col("__base") + F.col("__place") - 1).drop("__part", "__base", "__place")


def id_key(c: Column) -> Column:
    """Ids in the order of their numbers, equal numbers by their text; ids that are no number come first."""
    return F.struct(c.try_cast("bigint").alias("number"), c.alias("text"))


def with_previous(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(value, previous): each row's value beside that of the row before it in the order of ``key``.

    Rows are range-partitioned, a neighbour within a range is a lag, and one row of each range,
    its last, travels to the range after it (over ranges that are empty).
    """
    ranged = kept(rows.select(key, value).repartitionByRange(F.col(key)).withColumn("__part", F.spark_partition_id()))
    order = Window.partitionBy("__part").orderBy(key)
    held = ranged.withColumn("__before", F.lag(F.struct(F.col(value).alias("v"))).over(order))
    last = ranged.groupBy("__part").agg(F.max_by(F.struct(F.col(value).alias("v")), key).alias("__last"))
    last = last.select("__part", F.lag("__last").over(Window.orderBy("__part")).alias("__last"))  # one row a partition
    rows = held.join(F.broadcast(last), "__part").withColumn("__before", F.coalesce("__before", "__last")).filter("__before is not null")
    return rows.select(value, F.col("__before.v").alias("previous"))
