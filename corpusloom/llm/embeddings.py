"""Near-duplicate vectors through PCA-ordered tiled comparison.

Equal vectors are one class. The second moments of all classes give the axes, largest energy first.
Planes across the leading axes cut the space into tiles; a vector is compared in its own tile and
sent to the other tiles that it can reach, that is, whose box is not farther from it than linked
vectors can be. In a tile, blocks of vectors are multiplied over the leading axes first. What the
other axes can still add to a cosine is at most the product of the two vectors' norms over them, so
a pair is dropped as soon as its sum plus this product stays below the threshold; few pairs are
left for the last axes. Sums close to the threshold are taken anew on the given vectors.

Scale: work is dealt out as (block of a tile, slice of its visitors); a task holds one block and
reads the visitors as a stream, so a dense region makes more tasks, not larger ones. A block
returns a number of links for each vector, and links to one root for each, never its pairs: only
these rows travel on. The driver holds the moments (by number of axes), at most SAMPLE vectors for
placing the planes, and at most MAX_TILES boxes and counts. Planes and axes steer the work; the
rows don't depend on them.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link
with nothing; so do vectors of different lengths with each other. Copies link with each other, as
do multiples. A row with a null id takes part, but gives its component an id only if no member has
one. Repeated rows count as separate vectors. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._graph import components
from ._store import materialize

THRESHOLD = 0.95
#: Vectors of a block; visitors that one task compares with it, at least.
TILE, VISITORS = 2048, 1 << 18
#: Tiles at most (a larger one has several blocks), and vectors that place the planes.
MAX_TILES, SAMPLE = 1024, 20_000
#: Axes that planes may cross, and axes of the first product; every later step doubles them.
LEADING, FIRST = 16, 16
#: Sums this close to the threshold are taken anew.
MARGIN = 1e-9
#: Visitors compared at once.
ROWS = 512


def _matrix(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors): the usable vectors of a list column, those of equal length together; -0.0 becomes 0.0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(lists.value_lengths().fill_null(0))
    values = lists.flatten()  # nulls have no values here
    flat = values.to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for n in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == n)
        x = flat[start[rows][:, None] + np.arange(n)] + flat.dtype.type(0)
        fine = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)  # a null component reads as NaN
        yield rows[fine], x[fine]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _read(column: pa.Array, kind: str, axes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(given, unit, size): vectors from their bytes, filled up with zeros to ``axes``."""
    given, size = np.zeros((len(column), axes)), np.zeros(len(column), np.int64)
    for i, raw in enumerate(column):
        v = np.frombuffer(raw.as_buffer(), kind)
        given[i, : len(v)], size[i] = v, len(v)
    return given, _unit(given), size


def _coded(vectors: DataFrame, key: str, embedding: str) -> tuple[DataFrame, str]:
    """(key, digest, raw) of every row, digest and raw null for unusable vectors; and the type of raw."""
    element = vectors.schema[embedding].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    column = F.col(embedding) if kind == "<f4" else F.col(embedding).cast("array<double>")
    narrow = vectors.select(F.col(key).alias("key"), column.alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw: list[bytes | None] = [None] * batch.num_rows
            for rows, x in _matrix(batch.column(1)):
                for i, v in zip(rows.tolist(), x.astype(kind)):
                    raw[i] = v.tobytes()
            digest = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digest, pa.binary()), pa.array(raw, pa.binary())], names=["key", "digest", "raw"])

    schema = T.StructType([narrow.schema[0], T.StructField("digest", T.BinaryType()), T.StructField("raw", T.BinaryType())])
    return narrow.mapInArrow(run, schema), kind


def principal_axes(classes: DataFrame, kind: str, axes: int) -> np.ndarray:
    """Orthonormal columns by falling energy, from the second moments of all unit vectors."""
    upper = np.triu_indices(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((axes, axes))
        for batch in batches:
            _, unit, _ = _read(batch.column(0), kind, axes)
            total += unit.T @ unit
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], names=["cell", "s"])

    moments = np.zeros((axes, axes))
    for row in classes.select("raw").mapInArrow(run, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect():
        i, j = upper[0][row.cell], upper[1][row.cell]
        moments[i, j] = moments[j, i] = row.s
    return np.linalg.eigh(moments)[1][:, ::-1].copy()


class _Tiles:
    """A binary tree of planes across leading axes; every leaf is a tile with a box."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        self.depth, axes = depth, sample.shape[1]
        self.axis, self.at = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
        self.low, self.high = np.full((1 << depth, axes), -np.inf), np.full((1 << depth, axes), np.inf)
        nodes = {1: (sample, self.low[0].copy(), self.high[0].copy())}
        for node in range(1, 1 << depth):
            rows, low, high = nodes.pop(node)
            spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(axes)
            axis = int(spread.argmax())
            at = float(np.median(rows[:, axis])) if len(rows) else 0.0
            self.axis[node], self.at[node] = axis, at
            right = rows[:, axis] >= at
            below, above = high.copy(), low.copy()
            below[axis], above[axis] = min(high[axis], at), max(low[axis], at)
            nodes[2 * node], nodes[2 * node + 1] = (rows[~right], low, below), (rows[right], above, high)
        for node, (_, low, high) in nodes.items():
            self.low[node - (1 << depth)], self.high[node - (1 << depth)] = low, high

    def home(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.ones(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + (x[rows, self.axis[node]] >= self.at[node])
        return node - (1 << self.depth)

    def reach(self, x: np.ndarray, square: float) -> np.ndarray:
        """Whether each vector can come within a distance, given by its square, of each tile."""
        away = np.zeros((len(x), len(self.low)))
        for axis in range(x.shape[1]):
            v = x[:, axis : axis + 1]
            gap = np.maximum(np.maximum(self.low[:, axis] - v, v - self.high[:, axis]), 0)
            away += gap * gap
        return away <= square


def _visits(home: np.ndarray, tiles: _Tiles, lead: np.ndarray, square: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, tile): the other tiles that each vector visits; of two tiles, the members of one visit the other."""
    n = len(tiles.low)
    ahead = (np.arange(n)[None, :] - home[:, None]) % n
    turn = (ahead > 0) & ((2 * ahead < n) | ((2 * ahead == n) & (home[:, None] < np.arange(n)[None, :])))
    return np.nonzero(turn & tiles.reach(lead, square))


class _Block:
    """The vectors of a block or of a group of visitors, along the principal axes, with their norms over the axes behind each step."""

    def __init__(self, column: pa.Array, kind: str, turn: np.ndarray, steps: list[int]) -> None:
        self.given, unit, self.size = _read(column, kind, len(turn))
        self.turned = unit @ turn
        self.behind = [np.sqrt((self.turned[:, s:] ** 2).sum(axis=1)) for s in steps]


def _linked(a: _Block, b: _Block, rows: slice, steps: list[int], threshold: float, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): pairs of a[rows] and b with a cosine of at least ``threshold``; ``within`` a block only i < j."""
    first = a.turned[rows]
    sums = first[:, : steps[0]] @ b.turned[:, : steps[0]].T
    hopeful = sums + np.multiply.outer(a.behind[0][rows], b.behind[0]) >= threshold - MARGIN
    i, j = np.nonzero(hopeful)
    at = rows.start or 0
    if within:
        i, j = (x[i + at < j] for x in (i, j))
    total = sums[i, j]
    for k in range(1, len(steps)):
        for part in range(0, len(i), 1 << 18):  # bounds what is gathered at once
            p = slice(part, part + (1 << 18))
            total[p] += np.einsum("ij,ij->i", first[i[p], steps[k - 1] : steps[k]], b.turned[j[p], steps[k - 1] : steps[k]])
        keep = total + a.behind[k][rows][i] * b.behind[k][j] >= threshold - MARGIN
        i, j, total = i[keep], j[keep], total[keep]
    i = i + at
    keep = a.size[i] == b.size[j]
    for n in np.flatnonzero(np.abs(total - threshold) <= MARGIN):
        x, y = a.given[i[n]], b.given[j[n]]
        keep[n] &= x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold
    return i[keep], j[keep]


def _roots(a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component, after the links a-b have joined the trees ``root``."""
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def _compared(turn: np.ndarray, kind: str, threshold: float, steps: list[int]):
    """Rows (unit, visitor, node, n, raw), sorted by unit, members before visitors -> (node, links, root)."""

    def rows_of(node: np.ndarray, links: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
        told = links > 0
        return pa.RecordBatch.from_arrays([pa.array(node[told]), pa.array(links[told]), pa.array(root[told])], names=["node", "links", "root"])

    def solved(members: list[pa.RecordBatch], visitors: Iterator[pa.RecordBatch], own: bool) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(members).combine_chunks()
        block = _Block(table["raw"].combine_chunks(), kind, turn, steps)
        node, n = (table[c].to_numpy() for c in ("node", "n"))
        links, root = np.zeros(len(node), np.int64), np.arange(len(node))
        for at in range(0, len(node) if own else 0, ROWS):
            i, j = _linked(block, block, slice(at, at + ROWS), steps, threshold, True)
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            root = _roots(i, j, root)
        for batch in visitors:
            other = _Block(batch.column("raw"), kind, turn, steps)
            o_node, o_n = (batch.column(c).to_numpy() for c in ("node", "n"))
            o_links = np.zeros(len(o_node), np.int64)
            wide = np.concatenate([root, len(root) + np.arange(len(o_node))])
            for at in range(0, len(o_node), ROWS):
                i, j = _linked(other, block, slice(at, at + ROWS), steps, threshold, False)
                np.add.at(o_links, i, n[j])
                np.add.at(links, j, o_n[i])
                wide = _roots(len(root) + i, j, wide)
            root = wide[: len(root)]
            yield rows_of(o_node, o_links, node[np.where(o_links > 0, wide[len(root) :], 0)])
        yield rows_of(node, links, node[root])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools

        def pieces() -> Iterator[tuple[int, bool, pa.RecordBatch]]:
            for batch in batches:
                unit, late = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
                edges = np.flatnonzero((unit[1:] != unit[:-1]) | (late[1:] != late[:-1])) + 1
                for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(unit)]):
                    if b > a:
                        yield int(unit[a]), bool(late[a]), batch.slice(a, b - a)

        for unit, group in itertools.groupby(pieces(), key=lambda p: p[0]):
            members, visitors = [], iter(())
            for _, late, batch in group:
                if late:
                    visitors = itertools.chain([batch], (b for _, _, b in group))
                    break
                members.append(batch)
            if members:  # a block without members links nothing
                yield from solved(members, visitors, members[0].column("own")[0].as_py())

    return run


def near_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE, visitors: int = VISITORS, max_tiles: int = MAX_TILES) -> DataFrame:
    """(key, n_links, component_id, kept) of every row: the vectors linked with it, and the smallest key reachable."""
    coded, kind = _coded(vectors, key, embedding)
    members = materialize(coded.select("key", "digest"), "vector-members")
    grouped = coded.where("digest IS NOT NULL").groupBy("digest").agg(F.min("key").alias("first_key"), F.count(F.lit(1)).alias("n"), F.any_value("raw").alias("raw"))
    classes = materialize(grouped.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    known = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("raw")).alias("bytes")).first()
    links = _links(classes, kind, known.n, (known.bytes or 0) // int(kind[-1]), threshold, tile, visitors, max_tiles)
    if links is None:
        joined = classes.select("digest", "first_key", (F.col("n") - 1).alias("n_links"), F.col("first_key").alias("component_id"))
    else:
        roots = components(links.where("node <> root").select(F.col("node").alias("src"), F.col("root").alias("dst")))
        others = links.groupBy("node").agg(F.sum("links").alias("links"))
        rooted = classes.select("digest", "first_key", "n", "node").join(roots.select("node", F.col("root").alias("top")), "node", "left").join(others, "node", "left")
        rooted = rooted.select("digest", "first_key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("top", "node").alias("top"))
        rooted = materialize(rooted, "vector-roots")
        least = rooted.groupBy("top").agg(F.min("first_key").alias("component_id"))
        joined = rooted.join(least, "top").select("digest", "n_links", "component_id")
    linked = members.where("digest IS NOT NULL").join(joined, "digest").select("key", "n_links", "component_id")
    every = linked.union(members.where("digest IS NULL").select("key", F.lit(0).cast("long"), "key"))
    return every.select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def _links(classes: DataFrame, kind: str, count: int, axes: int, threshold: float, tile: int, most: int, max_tiles: int) -> DataFrame | None:
    """(node, links, root): for every class with links how many vectors of other classes it links with here, and a member of its component."""
    if count < 2:
        return None
    turn = principal_axes(classes, kind, axes)
    lead, square = turn[:, :LEADING], 2 - 2 * threshold + MARGIN
    steps = [min(axes, FIRST)]
    while steps[-1] < axes:
        steps.append(min(axes, 2 * steps[-1]))
    sample = classes.select("raw").orderBy(F.xxhash64("digest"), "digest").limit(SAMPLE).toArrow()["raw"]
    depth = min(max(0, -(-count // tile) - 1).bit_length(), max_tiles.bit_length() - 1)
    tiles = _Tiles(_read(sample.combine_chunks(), kind, axes)[1] @ lead, depth)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tiles.low), np.int64)
        for batch in batches:
            total += np.bincount(tiles.home(_read(batch.column(0), kind, axes)[1] @ lead), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["tile", "n"])

    sizes = {r.tile: r.n for r in classes.select("raw").mapInArrow(homes, "tile long, n long").groupBy("tile").agg(F.sum("n").alias("n")).collect()}  # one row a tile
    blocks = np.array([max(1, -(-sizes.get(i, 0) // tile)) for i in range(len(tiles.low))])
    start, slices = np.cumsum(blocks) - blocks, max(1, -(-count // most))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                node, near = batch.column(0).to_numpy(), _read(batch.column(2), kind, axes)[1] @ lead
                home, every = tiles.home(near), np.arange(len(node))
                code = (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
                own = code % blocks[home].astype(np.uint64)
                own, cut = own.astype(np.int64), (code // np.uint64(1 << 20) % np.uint64(slices)).astype(np.int64)
                # members stand in every slice of their block
                row, part = np.repeat(every, slices), np.tile(np.arange(slices), len(node))
                found = [(row, (start[home[row]] + own[row]) * slices + part, np.zeros(len(row), bool), part == 0)]
                # visitors stand in one slice of every block of the tiles that they visit
                row, to = _visits(home, tiles, near, square)
                # and of the later blocks of their own tile
                many = np.flatnonzero(blocks[home] > 1)
                row, to = np.concatenate([row, many]), np.concatenate([to, home[many]])
                times = blocks[to]
                row, to = np.repeat(row, times), np.repeat(to, times)
                block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                keep = (to != home[row]) | (block > own[row])
                row, to, block = row[keep], to[keep], block[keep]
                found.append((row, (start[to] + block) * slices + cut[row], np.ones(len(row), bool), np.zeros(len(row), bool)))
                row, unit, late, first = (np.concatenate(x) for x in zip(*found))
                for k in range(0, len(row), 1 << 14):
                    p = slice(k, k + (1 << 14))
                    taken = batch.take(pa.array(row[p]))
                    yield pa.RecordBatch.from_arrays([pa.array(unit[p]), pa.array(late[p]), pa.array(first[p]), *taken.columns], names=["unit", "late", "own", "node", "n", "raw"])

    dealt = classes.select("node", "n", "raw").mapInArrow(deal, "unit long, late boolean, own boolean, node long, n long, raw binary")
    width = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(blocks.sum()) * slices)
    met = dealt.repartition(width, "unit").sortWithinPartitions("unit", "late")
    return materialize(met.mapInArrow(_compared(turn, kind, threshold, steps), "node long, links long, root long"), "vector-links")


def op13_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP13_SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS src, b.vec_id AS dst FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      AND list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95),
r AS (SELECT vec_id AS node, vec_id AS seen FROM v UNION SELECT r.node, l.dst FROM r JOIN l ON r.seen = l.src),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.src = v.vec_id) AS n_links, component_id, v.vec_id = component_id AS kept FROM v JOIN c ON c.node = v.vec_id
"""
