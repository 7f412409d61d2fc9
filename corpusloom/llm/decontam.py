"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A benchmark item is cut into windows of ``WINDOW`` words (a shorter item is one window). Words are
ordered by rarity over all documents. A document can only contain a window if it contains the
window's rarest word, so for exact containment the necessary prefix is that one word: documents
join windows on it. The word's position and the window's length bound where the window would have
to stand; there the words are compared one by one.

Scale: one plan for any number of windows. Words of documents are filtered inside the scan by the
hashed words of the benchmark, a set of at most ``BUCKETS`` numbers, whatever the benchmark's size;
what passes by chance is told apart behind the exchange. So rows beyond the scan are places of the
rarest words only, each with the words around it; they meet the windows by word, hot words by word
and salt. A word is hot if more than one in ``HOT_SHARE`` of these places are its own, so there are
fewer than that. Windows carry a number; the items that have a window are joined to the numbers
found, not carried along. Frequencies are counted over all documents, per task before the exchange.

Defined results: a null text has no words and no hits; an item without words has no window; an
item id that occurs twice counts once; repeated documents get one result each; empty tables give
empty tables. Results do not depend on which of several equally rare words is the prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import materialize

WINDOW = 10
#: Numbers that hashed words are reduced to: a bound of what is broadcast, some 16 bytes each.
BUCKETS = 1 << 22
#: A word with more than this part of all places is dealt out by so many salts.
HOT_SHARE, SALTS = 1024, 64
#: All ASCII characters but digits and letters part words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text in order, their case as it is; no word for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def folded(word: Column) -> Column:
    """A-Z in lower case; other letters keep their case."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def item_windows(items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, words): every window of every item, each once."""
    words = items.select(F.col(item).cast("string").alias("id"), F.transform(words_of(F.col(text)), folded).alias("all")).where(F.size("all") > 0)
    begins = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - window + 1))
    return words.select("id", F.explode(F.transform(begins, lambda i: F.slice("all", i, window))).alias("words")).distinct()


def _among(spoken: DataFrame, words: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``spoken`` (said) whose word may be one of ``words`` (word): all that are, and few others."""
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets))
    known = words.select(bucket("word").alias("bucket")).distinct()  # no more than `buckets` rows
    return spoken.join(F.broadcast(known), bucket("said") == F.col("bucket"), "left_semi")


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents with a key that tells rows of one id but different texts apart."""
    return docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("tag"), F.col(text).alias("text"))


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, buckets: int = BUCKETS, hot_share: int = HOT_SHARE) -> DataFrame:
    """(key, tag, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``; ``tag`` is the text's hash."""
    held = materialize(item_windows(items, item, item_text, window), "benchmark-items")
    windows = materialize(held.select("words").distinct().withColumn("w", F.monotonically_increasing_id()), "benchmark-windows")
    own = _keyed(docs, key, text)

    # rarity of the benchmark's words over all documents
    # (outer explodes keep the optimizer from splitting every text once more to drop empty ones)
    vocabulary = materialize(windows.select(F.explode("words").alias("word")).distinct(), "benchmark-words")
    spoken = own.select(F.explode_outer(words_of(F.col("text"))).alias("raw")).select(folded(F.col("raw")).alias("said"))
    counted = _among(spoken, vocabulary, buckets).groupBy("said").agg(F.count(F.lit(1)).alias("n"))
    rarity = materialize(counted.join(vocabulary, F.col("said") == F.col("word")).select("word", "n"), "benchmark-rarity")
    placed = windows.select("w", "words", F.posexplode("words").alias("at", "word")).join(rarity, "word")
    # a window with a word that no document has cannot occur
    prefix = placed.groupBy("w").agg(F.first("words").alias("words"), F.min(F.struct("n", "word", "at")).alias("rarest"), F.count(F.lit(1)).alias("known"))
    prefix = prefix.where(F.col("known") == F.size("words")).select("w", "words", F.col("rarest.word").alias("word"), F.col("rarest.at").alias("at"), F.col("rarest.n").alias("n"))
    prefix = materialize(prefix, "benchmark-prefixes")
    rarest = prefix.select("word", "n").distinct()
    places = rarest.agg(F.sum("n")).first()[0] or 0
    hot = rarest.where(F.col("n") * hot_share > places).select(F.col("word").alias("hot_word"))  # fewer than `hot_share` rows
    salts = F.when(F.col("hot_word").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    patterns = prefix.join(F.broadcast(hot), F.col("word") == F.col("hot_word"), "left").select("w", "words", "word", "at", F.explode(salts).alias("p_salt"))

    # candidates: places of a rarest word, with the words around it among which its window would stand
    split = own.select("key", "tag", F.transform(words_of(F.col("text")), folded).alias("all"))
    each = split.select("key", "tag", "all", F.posexplode_outer("all").alias("pos", "said"))
    first = F.greatest(F.lit(0), F.col("pos") - (window - 1))
    spots = _among(each, rarest, buckets).select("key", "tag", "pos", "said", first.alias("first"), F.slice("all", first + 1, 2 * window - 1).alias("near"))
    salt = F.when(F.col("hot_word").isNull(), 0).otherwise(F.pmod(F.xxhash64("key", "tag", "pos"), F.lit(SALTS))).cast("int")
    spots = spots.join(F.broadcast(hot), F.col("said") == F.col("hot_word"), "left").withColumn("salt", salt).drop("hot_word")
    start = F.col("pos") - F.col("at")
    there = (start >= F.col("first")) & (F.slice("near", F.greatest(F.lit(0), start - F.col("first")) + 1, F.size("words")) == F.col("words"))
    met = spots.join(patterns, (F.col("said") == F.col("word")) & (F.col("salt") == F.col("p_salt")) & there)
    found = materialize(met.select("key", "tag", start.alias("start"), F.size("words").alias("len"), "w").distinct(), "benchmark-hits")

    # words hit: the union of the occurrences
    spans = found.groupBy("key", "tag").agg(F.array_sort(F.collect_set(F.struct("start", "len"))).alias("spans"))
    names = held.join(windows, "words").select(F.col("w").alias("h_w"), "id")
    named = found.select(F.col("key").alias("i_key"), F.col("tag").alias("i_tag"), "w").distinct().join(names, F.col("w") == F.col("h_w"))
    named = named.groupBy("i_key", "i_tag").agg(F.array_sort(F.collect_set("id")).alias("hit_ids"))
    spans = spans.join(named, F.col("key").eqNullSafe(F.col("i_key")) & (F.col("tag") == F.col("i_tag")))
    union = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["start"] + s["len"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(acc["end"], s["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    hits = spans.select(F.col("key").alias("k"), F.col("tag").alias("t"), union.alias("hit"), "hit_ids")
    every = own.select("key", "tag", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return every.join(hits, F.col("key").eqNullSafe(F.col("k")) & (F.col("tag") == F.col("t")), "left").select(
        F.col("key").alias(key), "tag", "n_words",
        F.coalesce("hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(F.coalesce("hit_ids", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("hit_ids", none), ","), 256).alias("items_sha256"),
        (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents in which no window of an item occurs."""
    hit = contamination(docs, items, key, text, **options).where("contaminated").select(F.col(key).alias("hit_key"), F.col("tag").alias("hit_tag")).distinct()
    hit = materialize(hit, "contaminated")
    return docs.join(hit, docs[key].eqNullSafe(hit["hit_key"]) & (F.xxhash64(docs[text]) == hit["hit_tag"]), "left_anti")


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, items).drop("tag")


OP9_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + 9], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT dw.doc_id, dw.n, dw.k, iw.item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
p AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)
"""
