"""Numbers of rows in an order, over all rows or within groups, without one task that holds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..store import written


def numbered(rows: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``rows`` with their place, from 1, in an order that should be total.

    Rows are cut into sorted ranges of the order; the ranges' sizes, a row each, give the place at
    which each begins. The ranged rows are written once, as the numbers rest on how they were cut.
    """
    ranges = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    cut = written(cut, "ranges")
    part = F.shiftright("_at", 33)
    sizes = cut.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return cut.withColumn("_part", part).join(starts, "_part").select(*rows.columns, place.alias(name))


def numbered_within(rows: DataFrame, group: str, *order: Column, name: str = "rank") -> DataFrame:
    """``rows`` with their place, from 1, within their group; a large group is spread over several ranges.

    A place within the group is the place among all rows, group by group, less what comes before the group.
    """
    placed = numbered(rows, F.col(group).asc_nulls_first(), *order, name="_place")
    first = placed.groupBy(F.col(group).alias("_group")).agg(F.min("_place").alias("_first"))
    joined = placed.join(first, placed[group].eqNullSafe(first["_group"]))
    return joined.select(*rows.columns, (F.col("_place") - F.col("_first") + 1).alias(name))
