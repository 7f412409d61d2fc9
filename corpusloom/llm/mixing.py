"""Mixing sources to target weights.

Every document gets a hash-random key. Each source is cut into key ranges of known bounds (the
keys are uniform, so no sampling is needed), each range is sorted, and prefix sums of token
counts come from the sums of the ranges before plus a running sum within the range. The documents
before a source's exact budget are taken, the one on the border in part; a budget above the
source's size repeats whole epochs first.

Scale: the text is read once for its size; everything else works on rows of about 60 bytes. A hot
source is spread over ``RANGES`` tasks' worth of key ranges, so no task ever holds a source.

Defined results: a null text has size 0 and takes 0; null is a source of its own, the last; a
null key hashes like the empty string; rows that tie in the key are ordered by their size; a
source without words has target 0; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import materialize

#: Hexadecimal digits of the hash-random key that name its range: 16**RANGE_DIGITS ranges a source.
RANGE_DIGITS = 3
MAX_EPOCHS = 3
SALT = "mix-1:"


def token_count(text):
    """Words of a text, as a Column: runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target): budgets that share the total by weight, none above ``max_epochs`` times its source.

    The excess over a bound is shared again by weight. Sources ordered by bound over weight reach
    their bounds one after the other, so one running sum finds how many do: with the first k at
    their bounds the level is (total - their bounds) / (weight of the others).
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")
    weighed = by_source.withColumn("weight", cycle).withColumn("bound", F.lit(max_epochs) * F.col("source_size"))
    rank = W.orderBy((F.col("bound") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = rank.rowsBetween(W.unboundedPreceding, -1)
    after = rank.rowsBetween(W.currentRow, W.unboundedFollowing)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing).orderBy(F.lit(1))
    levels = weighed.select(
        "source", "source_size", "weight", "bound",
        ((F.sum("source_size").over(every) - F.coalesce(F.sum("bound").over(before), F.lit(0))).cast("double") / F.sum("weight").over(after).cast("double")).alias("level"),
    )
    # the level at the first source that stays below its bound holds for all that follow
    free = F.when(F.col("level") * F.col("weight") < F.col("bound"), F.col("level"))
    final = F.min(F.when(free.isNotNull(), F.struct((F.col("bound") / F.col("weight")).alias("r"), "source", "level"))).over(every)["level"]
    return levels.withColumn("final", final).select(
        "source", "source_size",
        F.when(F.col("final").isNull(), F.col("bound").cast("double")).otherwise(F.least(F.col("bound").cast("double"), F.col("final") * F.col("weight"))).alias("target"),
    )


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=(1, 2, 3), max_epochs: int = MAX_EPOCHS, salt: str = SALT) -> DataFrame:
    """(key, source, size, source_size, target, taken) for every row."""
    sized = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), token_count(F.col(text)).alias("size")).withColumn("code", code_of("key", salt))
    sized = materialize(sized, "mix-sizes").withColumn("span", F.substring("code", 1, RANGE_DIGITS))
    targets = materialize(source_targets(sized, weights, max_epochs), "mix-targets")
    spans = sized.groupBy("source", "span").agg(F.sum("size").alias("span_size"))
    ahead = F.coalesce(F.sum("span_size").over(W.partitionBy("source").orderBy("span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select("source", "span", ahead.alias("ahead"))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    spans = spans.join(t, F.col("source").eqNullSafe(F.col("t_source"))).select(F.col("source").alias("s_source"), F.col("span").alias("s_span"), "ahead", "source_size", "target")
    placed = sized.join(spans, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("span") == F.col("s_span")))
    within = W.partitionBy("source", "span").orderBy("code", "key", "size").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("ahead") + F.coalesce(F.sum("size").over(within), F.lit(0))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return placed.withColumn("start", start).select(F.col("key").alias(key), "source", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def code_of(column: str, salt: str):
    """The hash-random key, as hexadecimal digits whose order is the order of keys."""
    return F.md5(F.concat(F.lit(salt), F.coalesce(F.col(column).cast("string"), F.lit(""))))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat('mix-1:', coalesce(doc_id::VARCHAR, ''))) AS code FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::BIGINT AS weight, 3 * source_size AS bound FROM s),
l AS (SELECT *, bound / weight AS ratio,
        (sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(weight) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
f AS (SELECT level FROM l WHERE level * weight < bound ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size,
        CASE WHEN (SELECT count(*) FROM f) = 0 THEN bound::DOUBLE ELSE least(bound::DOUBLE, (SELECT level FROM f) * weight) END AS target FROM l),
p AS (SELECT doc_id, size, source_size, target, round(target)::BIGINT AS budget,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY code, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END) * size
   + greatest(0, least(size, budget - (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END) * source_size - ahead)))::BIGINT AS taken
FROM p
"""
