"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text, and perplexities.

The model is over characters, five in a row, spelled out in its tables: counts of trusted texts are
added up by n-gram, continuation counts, discounts, context sums and lower orders are joined on
n-grams, and what is gathered grows with the trusted texts. To score, the texts go to blocks of about
``BLOCK_BYTES``; each block asks once for every n-gram that occurs in it, the questions of all blocks
meet the probability and back-off tables by n-gram, and the answers go back to the blocks, where they
give each text its perplexity. So no document's n-grams travel one by one, and no task holds the model.

One strange word in hundreds moves a mean little. So the most surprising run of ``PEAK`` characters
is judged as well (``peak``, its perplexity). As the texts a model was trained on look better to it
than others do, one in ``HELD_OUT`` of the trusted texts, picked by their hashes, is kept out of the
counts, and thresholds are quantiles of those. A document is kept if its perplexity and its peak are
both within the quantiles of its language.

Blocks are cut by a hash of key and text, so copies with ids of their own and any language spread evenly.

Defined results: runs of white space count as one space, and a space ends a text; a text without
words has no perplexity and is not kept; null is a language of its own; a language without held-out
texts takes the thresholds of all; with fewer than ``HELD_OUT_FROM`` trusted texts all are trained
on, and give the thresholds; a label that occurs twice counts once; without any trusted document
nothing has a threshold and all texts with words are kept; repeated rows are judged one by one; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from ._store import materialize

ORDER = 5
#: Characters of the run that gives the peak; not more than ORDER.
PEAK = 4
#: Stands before a text, ORDER - 1 times.
START = "\x02"
QUANTILE = 0.995
BLOCK_BYTES = 32 << 20
#: Bytes of text unpacked and counted at once, which bounds a task's temporaries; a longer text stands alone, whole.
SLICE_BYTES = 1 << 19
#: Ids of trusted documents are broadcast up to this number (8 bytes each), else joined by exchange.
BROADCAST_IDS = 2_000_000
#: Thresholds are broadcast up to this number of languages, else joined under ``SALTS`` salts.
BROADCAST_LANGS, SALTS = 100_000, 32
#: One in so many trusted texts gives the thresholds and isn't trained on, if there are so many trusted texts.
HELD_OUT, HELD_OUT_FROM = 4, 200


# ------------------------------------------------------------------------------------- characters


def points_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(points, size): code points of the texts in normal form, each behind its starts; and their numbers, starts not counted."""
    normal = [" ".join((t or "").split()) for t in texts]
    whole = "".join(f"{START * (ORDER - 1)}{t} " for t in normal if t)
    return np.frombuffer(whole.encode("utf-32-le"), np.uint32), np.array([len(t) + 1 if t else 0 for t in normal], np.int64)


def places(size: np.ndarray) -> np.ndarray:
    """Where the characters of the texts stand, starts left out."""
    some = size[size > 0]
    return np.arange(int(some.sum())) + np.repeat((ORDER - 1) * np.arange(1, len(some) + 1), some)


def _codes(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the n-gram that ends at each place."""
    n = max(0, len(points) - ORDER + 1)
    factor = B.mix(np.arange(1, ORDER + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.zeros(n, np.uint64)
    for back in range(ORDER):
        out += points[ORDER - 1 - back : ORDER - 1 - back + n] * factor[back]
    return out[ends - ORDER + 1]


def _slots(code: np.ndarray, bits: int, turn: int) -> np.ndarray:
    return ((code * (B.mix(np.array([turn + 1], np.uint64)) | np.uint64(1))) >> np.uint64(64 - bits)).astype(np.int64)


def _alike(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the n-grams that end at places ``x`` of ``a`` and ``y`` of ``b`` are the same characters."""
    same = a[x] == b[y]
    for back in range(1, ORDER):
        same &= a[x - back] == b[y - back]
    return same


def distinct(points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, n): where each distinct n-gram ends once, and how often. Slots are dealt by hashes, and characters compared."""
    places, counts, code, turn = [ends[:0]], [np.zeros(0, np.int64)], _codes(points, ends), 0
    while len(ends):
        bits = max(8, len(ends).bit_length())
        slot, held = _slots(code, bits, turn), np.zeros(1 << bits, np.int64)
        held[slot] = np.arange(len(ends))
        like = held[slot]
        same = _alike(points, ends, points, ends[like])
        n = np.bincount(like[same], minlength=len(ends))
        places.append(ends[n > 0])
        counts.append(n[n > 0])
        ends, code, turn = ends[~same], code[~same], turn + 1  # whoever lost its slot tries another
    return np.concatenate(places), np.concatenate(counts)


class Table:
    """Finds n-grams among known ones, by slots and comparison of characters."""

    def __init__(self, known: np.ndarray, ends: np.ndarray) -> None:
        self.known, self.ends, self.turns = known, ends, []
        rest, code = np.arange(len(ends)), _codes(known, ends)
        while len(rest):
            bits = max(8, (4 * len(rest)).bit_length())
            held = np.full(1 << bits, -1, np.int32)
            slot = _slots(code, bits, len(self.turns))
            held[slot] = rest
            self.turns.append((bits, held))
            lost = held[slot] != rest
            rest, code = rest[lost], code[lost]

    def find(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The index of the known n-gram that ends at each place; all are known."""
        out, rest, code = np.zeros(len(ends), np.int64), np.arange(len(ends)), _codes(points, ends)
        for turn, (bits, held) in enumerate(self.turns):
            which = held[_slots(code, bits, turn)]
            same = (which >= 0) & _alike(points, ends[rest], self.known, self.ends[which])
            out[rest[same]] = which[same]
            rest, code = rest[~same], code[~same]
        if len(rest):
            raise ValueError("an n-gram was not asked for")
        return out


def spelled(points: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    """The n-grams that end at the places, as strings."""
    flat = points[ends[:, None] - np.arange(ORDER - 1, -1, -1)].reshape(-1)
    size = 1 + (flat >= 0x80) + (flat >= 0x800) + (flat >= 0x10000)
    offsets = np.append(0, np.cumsum(size.reshape(-1, ORDER).sum(axis=1))).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(flat.tobytes().decode("utf-32-le").encode()))


_PACKED = "block long, key array<long>, lang array<string>, doc array<long>, bytes array<int>, packed binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by block, their texts compressed together, which is what is exchanged; a null text is empty."""
    codec = pa.Codec("zstd", compression_level=3)
    for batch in batches:
        block = batch.column(0).to_numpy()
        order = np.argsort(block, kind="stable")
        batch = batch.take(pa.array(order))
        data, offsets = B.buffers(batch.column("text"))
        edges = np.append(np.flatnonzero(np.append(True, np.diff(block[order]) != 0)), len(block)) if len(block) else np.zeros(1, np.int64)
        packed = [codec.compress(data[a:b].tobytes(), asbytes=True) for a, b in zip(offsets[edges[:-1]], offsets[edges[1:]])]
        lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), x) for x in (*batch.columns[1:4], pa.array(np.diff(offsets), pa.int32()))]
        yield pa.RecordBatch.from_arrays([pa.array(block[order][edges[:-1]]), *lists, pa.array(packed, pa.binary())], names=["block", "key", "lang", "doc", "bytes", "packed"])


def _columns(table: pa.Table) -> list[pa.ChunkedArray]:
    """Key, lang and doc of a block's texts."""
    return [pc.list_flatten(table.column(c)) for c in ("key", "lang", "doc")]


def _texts(table: pa.Table) -> Iterator[pa.LargeStringArray]:
    """A block's texts in the order of its rows, about ``SLICE_BYTES`` of them unpacked at a time."""
    sizes, parts, held = [], [], 0
    for size, packed in zip(table.column("bytes"), table.column("packed")):
        sizes.append(size.values.to_numpy().astype(np.int64))
        n = int(sizes[-1].sum())
        if n:
            parts.append(pa.decompress(packed.as_buffer(), n, "zstd", asbytes=True))
        held += n
        if held >= SLICE_BYTES:
            yield _joined(sizes, parts)
            sizes, parts, held = [], [], 0
    if sizes:
        yield _joined(sizes, parts)


def _joined(sizes: list[np.ndarray], parts: list[bytes]) -> pa.LargeStringArray:
    size = np.concatenate(sizes)
    offsets = np.append(0, np.cumsum(size)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(b"".join(parts)))


def _slices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points and sizes of the texts, some hundred kilobytes at a time."""
    for i, j in B.slices(B.buffers(column)[1], SLICE_BYTES):
        yield points_of(column.slice(i, j - i).to_pylist())


def _sliced(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """:func:`_slices` of a block's texts."""
    for texts in _texts(table):
        yield from _slices(texts)


# ------------------------------------------------------------------------------------------ model


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for points, size in _slices(batch.column(0)):
            at, n = distinct(points, places(size))
            yield pa.RecordBatch.from_arrays([spelled(points, at), pa.array(n)], names=["gram", "n"])


@dataclass(frozen=True)
class Model:
    """By order: (gram, p) of n-grams seen, and (context, weight) of what their contexts leave to the lower order; ``unknown`` is the probability of a character never seen."""

    seen: dict[int, DataFrame]
    weight: dict[int, DataFrame]
    unknown: float


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """D1, D2, D3+ from the numbers of n-grams that occur once, twice, three and four times."""
    n1, n2, n3, n4 = (max(1, x) for x in (n1, n2, n3, n4))
    y = n1 / (n1 + 2 * n2)
    return [min(max(d, 0.05), k) for k, d in enumerate((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3), 1)]


def train(trusted: DataFrame, text: str = "text") -> Model:
    counts = {ORDER: materialize(trusted.select(text).mapInArrow(_count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")), "ngram-counts")}
    for k in range(ORDER - 1, 0, -1):  # different characters to the left, in the place of occurrences
        counts[k] = materialize(counts[k + 1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("n")), f"ngram-counts-{k}")
    seen, weight, unknown = {}, {}, 1.0
    for k in range(1, ORDER + 1):
        d = discounts(*counts[k].agg(*(F.count_if(F.col("n") == j) for j in (1, 2, 3, 4))).first())
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        if k == 1:
            total, saved, size = counts[1].agg(F.sum("n"), F.sum(cut), F.count(F.lit(1))).first()
            unknown = (saved / total if total else 1.0) / (size + 1)
            full = counts[1].select("gram", ((F.col("n") - cut) / F.lit(total or 1) + F.lit(unknown)).alias("p"))
        else:
            context = F.substring("gram", 1, k - 1)
            sums = counts[k].groupBy(context.alias("context")).agg(F.sum("n").alias("total"), (F.sum(cut) / F.sum("n")).alias("weight"))
            sums = materialize(sums, f"ngram-contexts-{k}")
            weight[k] = sums.select("context", "weight")
            own = counts[k].select("gram", "n", context.alias("context"), F.substring("gram", 2, k - 1).alias("suffix")).join(sums, "context")
            below = seen[k - 1].select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
            full = own.join(below, "suffix").select("gram", ((F.col("n") - cut) / F.col("total") + F.col("weight") * F.col("below")).alias("p"))
        seen[k] = materialize(full, f"ngram-model-{k}")
    return Model(seen, weight, unknown)


def probabilities(grams: DataFrame, model: Model) -> DataFrame:
    """(gram, p) for every row of ``grams``, distinct n-grams of the highest order; only what isn't seen goes on to the lower order."""
    asked = {}
    for k in range(ORDER, 0, -1):
        asked[k] = materialize(grams.join(model.seen[k], "gram", "left"), f"ngram-asked-{k}")
        grams = asked[k].where("p IS NULL").select(F.substring("gram", 2, k - 1).alias("gram")).distinct()
    found = asked[1].select("gram", F.coalesce("p", F.lit(model.unknown)).alias("p"))
    for k in range(2, ORDER + 1):
        missing = asked[k].where("p IS NULL").select("gram", F.substring("gram", 1, k - 1).alias("context"), F.substring("gram", 2, k - 1).alias("suffix"))
        below = found.select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
        lower = missing.join(model.weight[k], "context", "left").join(below, "suffix")
        found = asked[k].where("p IS NOT NULL").unionByName(lower.select("gram", (F.coalesce("weight", F.lit(1.0)) * F.col("below")).alias("p")))
    return found


# ------------------------------------------------------------------------------------------ score


def _ask(table: pa.Table) -> pa.Table:
    """A block's texts -> (block, gram), each n-gram once."""
    grams = []
    for points, size in _sliced(table):
        grams.append(spelled(points, distinct(points, places(size))[0]))
    every = pc.unique(pa.chunked_array(grams, pa.string()))
    return pa.table({"block": pa.repeat(table.column("block")[0], len(every)), "gram": every})


_SCORED = "key long, lang string, doc long, n_symbols long, perplexity double, peak double"


def _answer(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """A block's texts and the probabilities of its n-grams -> perplexities."""
    known = np.frombuffer(B.buffers(answers.column("gram"))[0].tobytes().decode().encode("utf-32-le"), np.uint32)
    table, cost = Table(known, np.arange(ORDER - 1, len(known), ORDER)), -np.log(answers.column("p").to_numpy())
    sizes, perplexity, peak = [], [], []
    for points, size in _sliced(texts):
        at = places(size)
        spent = np.zeros(len(points))
        spent[at] = cost[table.find(points, at)]
        total = np.append(0.0, np.cumsum(spent))
        run = spent.copy()
        for back in range(1, PEAK):  # never beyond the starts of its text
            run[back:] += spent[:-back]
        some = size > 0
        stop = np.cumsum(size[some] + ORDER - 1)
        start = stop - size[some]
        for out, values in ((perplexity, (total[stop] - total[start]) / size[some]), (peak, np.maximum.reduceat(run, start) / PEAK if len(start) else start)):
            column = np.full(len(size), np.nan)
            column[some] = np.exp(values)
            out.append(column)
        sizes.append(size)
    floats = [pa.array(np.concatenate(x), from_pandas=True) if x else pa.array([], pa.float64()) for x in (perplexity, peak)]
    n = pa.array(np.concatenate(sizes) if sizes else [], pa.int64())
    return pa.table([*_columns(texts), n, *floats], names=["key", "lang", "doc", "n_symbols", "perplexity", "peak"])


def score(docs: DataFrame, model: Model, key: str = "doc_id", lang: str = "lang", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, lang, doc, n_symbols, perplexity, peak) for every row; ``doc`` is the hash of the text, ``n_symbols`` its characters and the end."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    own = docs.select(F.col(key).cast("long").alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    texts = own.select(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)).alias("block"), "key", "lang", F.xxhash64("text").alias("doc"), "text")
    texts = texts.mapInArrow(_pack, _PACKED)
    asked = materialize(texts.groupBy("block").applyInArrow(_ask, "block long, gram string"), "ngram-questions")
    known = materialize(probabilities(asked.select("gram").distinct(), model), "ngram-answers")
    answers = asked.join(known, "gram").select("block", "gram", "p")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_answer, _SCORED)


def classify(docs: DataFrame, trusted_ids: DataFrame, quantile: float = QUANTILE, key: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """(key, lang, n_symbols, perplexity, peak, threshold, peak_threshold, kept); ``trusted_ids`` has the column ``key``."""
    ids = materialize(trusted_ids.select(F.col(key).cast("long").alias("trusted")).where("trusted IS NOT NULL").distinct(), "trusted-ids")
    n = ids.count()
    ids = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    held = F.pmod(F.col("doc"), F.lit(HELD_OUT)) == 0 if n >= HELD_OUT_FROM else F.lit(False)
    trusted = docs.join(ids, docs[key] == ids["trusted"], "left_semi").select(docs[text].alias("text"))
    model = train(trusted.withColumn("doc", F.xxhash64("text")).where(~held))
    scored = materialize(score(docs, model, key, lang, text), "perplexities")
    known = scored.join(ids, scored["key"] == ids["trusted"], "left_semi").where("perplexity IS NOT NULL")
    if n >= HELD_OUT_FROM:
        known = known.where(held)
    bounds = [F.percentile_approx(c, quantile, 10_000).alias(t) for c, t in (("perplexity", "threshold"), ("peak", "peak_threshold"))]
    by_lang = known.groupBy(F.col("lang").alias("l")).agg(*bounds)
    overall = known.agg(*bounds).first()
    limits = scored.select(F.col("lang").alias("g")).distinct().join(by_lang, F.col("g").eqNullSafe(F.col("l")), "left")
    limits = materialize(limits.select("g", *(F.coalesce(t, F.lit(overall[t]).cast("double")).alias(t) for t in ("threshold", "peak_threshold"))), "thresholds")
    same = F.col("lang").eqNullSafe(F.col("g"))
    if limits.count() <= BROADCAST_LANGS:
        judged = scored.join(F.broadcast(limits), same)
    else:
        spread = limits.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        judged = scored.withColumn("salt", F.pmod(F.xxhash64("key", "doc"), F.lit(SALTS)).cast("int")).join(spread, same & (F.col("salt") == F.col("s")))
    within = [F.col(t).isNull() | (F.col(c) <= F.col(t)) for c, t in (("perplexity", "threshold"), ("peak", "peak_threshold"))]
    return judged.select(
        F.col("key").alias(key), "lang", "n_symbols", "perplexity", "peak", "threshold", "peak_threshold",
        F.coalesce(F.col("perplexity").isNotNull() & within[0] & within[1], F.lit(False)).alias("kept"),
    )


def op8_kneser_ney(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, labels.where("quality = 1 AND toxic = 0").select("doc_id"))
