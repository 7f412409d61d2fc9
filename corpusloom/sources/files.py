"""Readers and writers with contracts: explicit schemas, header checks, publish with a manifest last."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: The table that tells what was published below a root.
MANIFEST = "_manifest"


class ContractError(ValueError):
    """A source lacks what its contract promises."""


def read_csv(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """A CSV file whose header has all required columns; every value is a string."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {missing}")
    return df


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, run_id: str | None = None, rows: int | None = None) -> DataFrame:
    """JSON lines (also gzip) of one run, with the number of rows that its manifest tells."""
    df = spark.read.schema(schema).json(path)
    if run_id is not None and not df.where(~F.col("run_id").eqNullSafe(F.lit(run_id))).isEmpty():
        raise ContractError(f"rows of another run than {run_id}")
    if rows is not None and (found := df.count()) != rows:
        raise ContractError(f"{found} rows, the manifest tells {rows}")
    return df


def discover(spark: SparkSession, root: str, suffixes: Sequence[str] = ("pdf", "hwp", "xlsx")) -> DataFrame:
    """(path, length, source, doc_type, doc_id, format) of files below ``root``; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}").load(root).select("path", "length")
    parts = F.split(F.regexp_replace("path", f"^(file:)?/*{root.removeprefix('file:').strip('/')}/", ""), "/")
    name = F.element_at(parts, -1)
    deep = F.size(parts)
    return found.select("path", "length", F.when(deep > 1, parts[0]).otherwise("_unclassified").alias("source"), F.when(deep > 2, parts[1]).otherwise("_unclassified").alias("doc_type"), F.regexp_extract(name, r"^([^_.]+)", 1).alias("doc_id"), F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1)).alias("format"))


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Write tables and their manifest (name, rows, content_sha), so that either all of them are seen below ``root`` or nothing.

    Everything is written to a folder beside ``root`` with a name of its own, the manifest last, and
    that folder is then renamed, which is one step of the file system and refuses a root that
    exists. A run that fails removes its folder, one that is killed leaves it behind, where nobody
    reads it; ``root`` isn't there in either case. Where a store can't rename in one step, the manifest
    still tells whether a root is whole: :func:`published` asks for it.

    The digest of a table does not depend on the order of its rows: hashes of rows are added up.
    """
    spark = next(iter(tables.values())).sparkSession
    root = root.rstrip("/")
    target, fs = _hadoop(spark, root)
    if fs.exists(target):
        raise ContractError(f"{root} is published already")
    parent, _, name = root.rpartition("/")
    staging = f"{parent}/.{name}.{uuid.uuid4().hex}.tmp"
    beside, _ = _hadoop(spark, staging)
    try:
        lines = None
        for table, df in tables.items():
            df.write.parquet(f"{staging}/{table}")
            stored = spark.read.parquet(f"{staging}/{table}")
            total = F.sum(F.xxhash64(*stored.columns).cast("decimal(38,0)"))
            line = stored.agg(F.lit(table).alias("name"), F.count(F.lit(1)).alias("rows"), F.sha2(F.coalesce(total, F.lit(0)).cast("string"), 256).alias("content_sha"))
            lines = line if lines is None else lines.unionByName(line)
        lines.coalesce(1).write.parquet(f"{staging}/{MANIFEST}")
        none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(beside, target, none)
    except Exception as failed:
        fs.delete(beside, True)
        if "FileAlreadyExists" in str(failed):
            raise ContractError(f"{root} is published already") from failed
        raise
    return published(spark, root)


def published(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of a published root; an error where there is none."""
    manifest, fs = _hadoop(spark, f"{root.rstrip('/')}/{MANIFEST}/_SUCCESS")
    if not fs.exists(manifest):
        raise ContractError(f"{root} is not published")
    return spark.read.parquet(f"{root.rstrip('/')}/{MANIFEST}")


def accept_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows under one schema: columns that either lacks are null."""
    return old.select("*").unionByName(new, allowMissingColumns=True)


#: Suffixes of documents, and of files that are nobody's business here.
KEPT, SKIPPED, SKIPPED_NAMES = ("pdf", "hwp", "hwpx"), ("json", "jsonl"), (".DS_Store",)


def deletion_targets(found: DataFrame, root: str, own: str = "extracted") -> DataFrame:
    """``found`` (path, content: the first bytes at least) with ``reason``, only what should be deleted: another *suffix* than documents have, or a *stub*, a web page under a document's name.

    Files below ``root``/``own`` are this library's outputs and are never named.
    """
    name = F.element_at(F.split("path", "/"), -1)
    suffix = F.lower(F.regexp_extract(name, r".\.([^.]+)$", 1))
    ours = F.contains("path", F.lit(f"{root.rstrip('/')}/{own}/"))
    head = F.lower(F.decode(F.substring("content", 1, 256), "iso-8859-1"))
    reason = F.when(~suffix.isin(*KEPT), "suffix").when(F.contains(head, F.lit("<html")) | F.contains(head, F.lit("<!doctype html")), "stub")
    return found.where(~ours & ~name.isin(*SKIPPED_NAMES) & ~suffix.isin(*SKIPPED)).withColumn("reason", reason).where("reason IS NOT NULL")


def parse_weights(text: str | None, categories: Sequence[str]) -> dict[str, float]:
    """Weights of all categories from a JSON object; equal ones without a text. Missing or unknown categories are an error."""
    if text is None:
        return {c: 1.0 / len(categories) for c in categories}
    weights = json.loads(text)
    if not isinstance(weights, dict):
        raise ContractError("weights must be a JSON object")
    for what, stray in (("missing", set(categories) - set(weights)), ("unknown", set(weights) - set(categories))):
        if stray:
            raise ContractError(f"{what} categories: {sorted(stray)}")
    return {k: float(v) for k, v in weights.items()}
