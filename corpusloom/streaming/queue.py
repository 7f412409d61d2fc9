"""A persistent queue of pending work, and collection in two passes over it.

The queue is mutable state across batches, kept as a log of small tables: a batch adds a table of
what it enqueues, or of what is done, and never changes one. What is pending follows from the log: a
key that was enqueued after it was last done, since its first enqueuing. A batch's table is written
under a number that its name keeps, so a batch that is repeated after a failure replaces its own
table and no other; a table without Spark's mark of success doesn't count. Every so many tables the
pending rows are written as a base, and older tables are removed when the next base is complete.

One writer at a time. Rows without a URL are never enqueued, as there is nothing to fetch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_LOG = "dedup_key string, source string, source_url string, arrival long, done boolean, seq long"


def url_key(source: str = "source", url: str = "source_url") -> Column:
    """The key of a collected document; null without a URL."""
    return F.when(F.coalesce(F.col(url), F.lit("")) != "", F.concat_ws("::", source, url))


class PendingQueue:
    """Pending keys in the folder ``root``, which all executors share."""

    def __init__(self, spark: SparkSession, root: str, compact_after: int = 16) -> None:
        self.spark, self.root, self.compact_after = spark, root.rstrip("/"), compact_after

    # ------------------------------------------------------------------------------ tables of the log

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _tables(self, kind: str) -> dict[int, tuple[str, bool]]:
        """Number -> (name, complete) of the tables of a kind; there are never more than some compact_after."""
        folder = self._path(kind)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return {}
        found = {}
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            found[int(name.partition("-")[0])] = (name, fs.exists(self._path(f"{kind}/{name}/_SUCCESS")))
        return found

    def _number(self, batch: str) -> int:
        """The number of a batch: its own if it was begun before, else the next."""
        log = self._tables("log")
        for number, (name, _) in log.items():
            if name.partition("-")[2] == batch:
                return number
        return max([0, *log, *self._tables("base")]) + 1

    def _append(self, rows: DataFrame, batch: str) -> None:
        number = self._number(batch)
        rows.withColumn("seq", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{self.root}/log/{number:012d}-{batch}")

    def _log(self) -> DataFrame:
        base = max((n for n, (_, complete) in self._tables("base").items() if complete), default=0)
        paths = [f"{self.root}/log/{name}" for n, (name, complete) in sorted(self._tables("log").items()) if complete and n > base]
        if base:
            paths.append(f"{self.root}/base/{base:012d}-base")
        return self.spark.read.schema(_LOG).parquet(*paths) if paths else self.spark.createDataFrame([], _LOG)

    # -------------------------------------------------------------------------------------- operations

    def enqueue(self, rows: DataFrame, batch: str, arrival: str = "arrival") -> None:
        """Add rows (source, source_url, arrival); a key that is pending stays as it is."""
        keyed = rows.select(url_key().alias("dedup_key"), "source", "source_url", F.col(arrival).cast("long").alias("arrival"), F.lit(False).alias("done"))
        self._append(keyed.where("dedup_key IS NOT NULL"), f"{batch}.enqueue")

    def finish(self, keys: DataFrame, batch: str) -> None:
        """Take keys (dedup_key) out of the queue; unknown keys change nothing."""
        none = F.lit(None)
        done = keys.select("dedup_key", none.cast("string").alias("source"), none.cast("string").alias("source_url"), none.cast("long").alias("arrival"), F.lit(True).alias("done"))
        self._append(done.distinct(), f"{batch}.finish")

    def pending(self, source: str | None = None) -> DataFrame:
        """(dedup_key, source, source_url, seq, arrival): seq and arrival give the order of creation."""
        log = self._log()
        # keys that are done carry no source, so the choice of one comes after them
        done = log.where("done").groupBy("dedup_key").agg(F.max("seq").alias("ended"))
        added = log.where("NOT done" if source is None else (~F.col("done") & (F.col("source") == source)))
        alive = added.join(done, "dedup_key", "left").where("ended IS NULL OR seq > ended")
        first = alive.groupBy("dedup_key").agg(F.min(F.struct("seq", "arrival", "source", "source_url")).alias("x"))
        return first.select("dedup_key", "x.source", "x.source_url", "x.seq", "x.arrival")

    def listed(self, source: str) -> DataFrame:
        """(dedup_key, source_url) of a source in the order of creation."""
        return self.pending(source).orderBy("seq", "arrival", "dedup_key").select("dedup_key", "source_url")

    def compact(self, force: bool = False) -> bool:
        """Write the pending rows as a new base when the log has grown; drop what the base before it had replaced."""
        log, bases = self._tables("log"), self._tables("base")
        last = max((n for n, (_, complete) in bases.items() if complete), default=0)
        fresh = [n for n, (_, complete) in log.items() if complete and n > last]
        if not fresh or (len(fresh) < self.compact_after and not force):
            return False
        alive = self.pending().select("dedup_key", "source", "source_url", "arrival", F.lit(False).alias("done"), "seq")
        alive.write.mode("overwrite").parquet(f"{self.root}/base/{max(fresh):012d}-base")
        fs = self._path("base").getFileSystem(self.spark._jsc.hadoopConfiguration())
        for kind, tables in (("log", log), ("base", bases)):
            for n, (name, _) in tables.items():
                if n < last or (n == last and kind == "log"):  # readers may still hold the base before
                    fs.delete(self._path(f"{kind}/{name}"), True)
        return True


def collect(found: DataFrame, queue: PendingQueue, checkpoint: str, name: str = "collect") -> StreamingQuery:
    """First pass: a stream of rows (source, source_url, arrival) is enqueued, batch by batch, as far as the stream goes.

    The position is in ``checkpoint``; a run that ended in the middle goes on from there, and
    repeats at most the batch that it was in.
    """

    def batch(rows: DataFrame, number: int) -> None:
        queue.enqueue(rows, f"{name}.{number}")
        queue.compact()

    return found.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def backfill(queue: PendingQueue, fetch: Callable[[DataFrame], DataFrame], batch: str, source: str | None = None) -> DataFrame:
    """Second pass: (dedup_key, path) of what ``fetch`` got of the pending rows; null paths are failures and stay pending.

    Paths are stored before their keys leave the queue, so a run that ends between the two fetches
    again and loses nothing.
    """
    path = f"{queue.root}/fetched/{batch}"
    fetch(queue.pending(source)).select("dedup_key", "path").write.mode("overwrite").parquet(path)
    got = queue.spark.read.schema("dedup_key string, path string").parquet(path)
    queue.finish(got.where("path IS NOT NULL").select("dedup_key"), batch)
    return got
