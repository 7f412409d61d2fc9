"""Target-distribution importance resampling.

Words are hashed into a fixed number of buckets. From the counts of all documents and of all target
texts every bucket gets a gain, and an array of the gains scores the texts: a document's weight is
the floored mean over its features. Gumbel noise from a hash of the id makes drawing the highest
scores the same as drawing without replacement by importance. The scored rows are persisted; the
score of the last row that is drawn, and among rows of that score its id, are found by bisection,
each step one exact count over the persisted rows. Only the drawn rows are then cut into ranges and
numbered: the ranges' sizes give the rank at which each range begins.

Scale: a text never leaves the task that reads it; tasks emit at most ``buckets`` counts. The array
of gains has ``buckets`` numbers, whatever the input. Nothing is sorted but the drawn rows, and
those in ranges whose keys are unique, so that neither one score nor one id makes a range hot.

Defined results: a null text has no features, weight 0, and is drawn only if ``min_words`` is 0; a
null id is hashed as the empty string and comes after all ids; rows that tie in score and id are
ordered by their number of features, and such as are equal in all these are interchangeable;
repeated rows each count and may each be drawn; without documents the result is empty, without
targets all target counts are 0. Long texts are split slice by slice. The id must be integral.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import _bytes as B
from ._store import materialize

BUCKETS = 10_000
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
#: Features are runs of 1 to so many words.
ORDER = 1
#: Thresholds that one counting job tries.
CUTS = 15
#: Bytes of a text that are split into words at once, and words whose bucket a task remembers.
SLICE_BYTES, KNOWN_WORDS = 4 << 20, 200_000

#: ASCII letters in lower case, digits and all bytes above ASCII; everything else is a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_MASK = (1 << 33) - 1


def _features(raw: bytes, order: int, size: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(words, features) of each slice of a text, cut between words; runs reach over the cuts."""
    folded, at, before = raw.translate(_FOLD), 0, []
    while at < len(folded):
        cut = folded.find(b" ", at + size)
        cut = len(folded) if cut < 0 else cut
        words = folded[at:cut].split()
        found = list(words)
        joined = before + words
        for n in range(2, order + 1):
            first = max(0, len(before) - n + 1)
            found += (b" ".join(joined[i : i + n]) for i in range(first, len(joined) - n + 1))
        before = joined[len(joined) - order + 1 :] if order > 1 else []
        yield len(words), found
        at = cut


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = B.buffers(column)
    view = memoryview(data)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield bytes(view[a:b])


def bucket_counts(rows: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(buckets, np.int64), Counter()

        def settle() -> None:
            for word, n in seen.items():
                total[zlib.crc32(word) % buckets] += n
            seen.clear()

        for batch in batches:
            for raw in _texts(batch.column(0)):
                for _, found in _features(raw, order):
                    seen.update(found)
                if len(seen) > KNOWN_WORDS:
                    settle()
        settle()
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return rows.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(documents: DataFrame, targets: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket, from two tables (bucket, n): thousandths of the logarithm of the smoothed ratio."""
    spark = documents.sparkSession
    own = spark.range(buckets).select(F.col("id").alias("bucket"))
    own = own.join(documents.select("bucket", F.col("n").alias("s")), "bucket", "left").join(targets.select("bucket", F.col("n").alias("t")), "bucket", "left").na.fill(0)
    every = own.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    real = lambda c: c.cast("double")
    ratio = real(F.col("t") + 1) * real(F.lit(every.S + buckets)) / (real(F.col("s") + 1) * real(F.lit(every.T + buckets)))
    gains = [0] * buckets
    for row in own.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain")).collect():  # `buckets` rows
        gains[row.bucket] = row.gain
    return gains


class _Gain(dict):
    """The gain of a word; the buckets of the first KNOWN_WORDS are remembered."""

    def __init__(self, gains: list[int]) -> None:
        self.gains = gains

    def __missing__(self, word: bytes) -> int:
        gain = self.gains[zlib.crc32(word) % len(self.gains)]
        if len(self) < KNOWN_WORDS:
            self[word] = gain
        return gain


def weights(docs: DataFrame, gains: list[int], key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """(key, n_words, n_features, weight) of every row."""
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = _Gain(gains)
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, raw in enumerate(_texts(batch.column(1))):
                total = 0
                for n, found in _features(raw, order):
                    out[0, i] += n
                    out[1, i] += len(found)
                    total += sum(map(gain.__getitem__, found))
                out[2, i] = total // int(out[1, i]) if out[1, i] else 0
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], names=["key", "n_words", "n_features", "weight"])

    return narrow.mapInArrow(run, "key long, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise, from the first 32 bits of SHA-256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def cutoff(rows: DataFrame, value: Column, wanted: int, cuts: int = CUTS) -> tuple[int, int]:
    """(v, above): the highest v that at least ``wanted`` values reach, and how many are above it.

    Bisection by ``cuts`` thresholds a job; ``rows`` should be persisted and hold ``wanted`` values.
    """
    ends = rows.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    low, high, above = ends.low, ends.high, 0
    while low < high:  # `wanted` values reach low, fewer reach high + 1, namely `above`
        step = -(-(high - low) // (cuts + 1))
        marks = range(low + step, high + 1, step)
        counts = rows.agg(*(F.count_if(value >= F.lit(m)).alias(f"c{i}") for i, m in enumerate(marks))).first()
        for mark, n in zip(marks, counts):
            if n < wanted:
                high, above = mark - 1, n
                break
            low = mark
    return low, above


def resample(
    docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT, min_words: int = MIN_WORDS, order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED, cuts: int = CUTS,
) -> DataFrame:
    """(key, n_features, weight, score, rank) of every row; rank is null for rows that are not drawn."""
    gains = bucket_gains(bucket_counts(docs, text, order, buckets), bucket_counts(targets, target_text, order, buckets), buckets)
    scored = weights(docs, gains, key, text, order).withColumn("score", F.col("weight") + gumbel(F.col("key"), seed))
    scored = materialize(scored.withColumn("place", F.monotonically_increasing_id()), "resample-scores")
    able = F.col("n_words") >= min_words
    pool = scored.where(able)
    wanted = percent * pool.count() // 100
    if wanted:
        score, above = cutoff(pool, F.col("score"), wanted, cuts)
        late = F.coalesce(F.bitwise_not("key"), F.lit(-1 << 63))  # falls as the id grows, null at the end
        last, _ = cutoff(pool.where(F.col("score") == score), late, wanted - above, cuts)
        drawn = able & ((F.col("score") > score) | ((F.col("score") == score) & (late >= last)))
    else:
        drawn = F.lit(False)
    order_by = [F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("n_features").asc(), F.col("place").asc()]
    ranges = max(1, int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = scored.where(drawn).repartitionByRange(ranges, *order_by).sortWithinPartitions(*order_by).withColumn("at", F.monotonically_increasing_id())
    ranged = materialize(ranged, "resample-drawn")
    part = F.shiftright("at", 33)
    sizes = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("start"))  # one row a range
    rank = F.col("start") + F.col("at").bitwiseAND(F.lit(_MASK)) + 1
    ranked = ranged.withColumn("part", part).join(starts, "part").withColumn("rank", F.when(rank <= wanted, rank))
    columns = [F.col("key").alias(key), "n_features", "weight", "score"]
    return ranked.select(*columns, "rank").union(scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))


def op12_resample(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word FROM d), bw AS (SELECT unnest(w) AS word FROM b),
tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
words AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
crc AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(h)::BIGINT + 1, 2), lambda p: CAST(concat('0x', substr(h, p, 2)) AS BIGINT))),
          lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket FROM words, tab),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN crc USING (word) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
          / ((s + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
f AS (SELECT doc_id, sum(gain) AS total FROM dw JOIN crc USING (word) JOIN g USING (bucket) GROUP BY doc_id),
x AS (SELECT d.doc_id, len(w)::BIGINT AS n_features, CASE WHEN len(w) = 0 THEN 0 ELSE floor(total::DOUBLE / len(w))::BIGINT END AS weight,
        CAST(concat('0x', substr(sha256(concat('2024:', d.doc_id)), 1, 8)) AS BIGINT) AS h FROM d LEFT JOIN f USING (doc_id)),
y AS (SELECT doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296::DOUBLE))))::BIGINT AS score FROM x),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM y WHERE n_features >= 20)
SELECT y.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * (SELECT count(*) FROM r) // 100 THEN rank END AS rank FROM y LEFT JOIN r USING (doc_id)
"""
