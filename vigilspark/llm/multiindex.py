"""Near-duplicate vectors by an inverted multi-index: two codebooks, a grid of cells, and a probe of the nearest ones."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Forest, kept
from .components import components

THRESHOLD = 0.98
# Vectors of the bounded sample on which codebooks and the reach of the probes are fitted.
SAMPLE = 8192
TARGET_RECALL = 0.9995
# Vectors that share a cell on average; a grid has as many codes as give that, whatever the number of vectors.
CELL = 512
# Residents of a cell that one task holds at once, and queries that it streams past them.
RESIDENTS, QUERIES = 2048, 16384
STEP = 1024


class Grid:
    """Codebooks for the two halves of unit vectors, and how far from the border a neighbouring cell is still probed."""

    def __init__(self, left: np.ndarray, right: np.ndarray, reach: float = 0.0):
        self.books = (left, right)
        self.reach = reach

    @staticmethod
    def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = x.shape[1] // 2
        return x[:, :cut], x[:, cut:]

    def _margins(self, half: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest code, and for every code the distance to the plane that parts it from the nearest one."""
        d = ((half**2).sum(1)[:, None] - 2 * half @ book.T) + (book**2).sum(1)
        home = d.argmin(1)
        size = (book**2).sum(1)
        apart = np.sqrt(np.maximum(size[home][:, None] + size - 2 * book[home] @ book.T, 1e-30))
        margin = (d - d[np.arange(len(d)), home][:, None]) / (2 * apart)
        margin[np.arange(len(d)), home] = 0
        return home, np.maximum(margin, 0)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return self._margins(a, self.books[0])[0] * len(self.books[1]) + self._margins(b, self.books[1])[0]

    def distance(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Of each vector to one cell: the length of the two halves' distances to the cell's borders."""
        a, b = self.halves(x)
        row, (left, right) = np.arange(len(x)), np.divmod(cell, len(self.books[1]))
        return np.hypot(self._margins(a, self.books[0])[1][row, left], self._margins(b, self.books[1])[1][row, right])

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vectors' own cells, and pairs of vector and cell in the order of a multi-sequence traversal: nearest cells
        first, until the reach that gives the target recall.

        The codes of either half are walked outwards from the nearest one, to the reach at most; of their pairs those
        within the reach are cells to visit. Cells beyond are never looked at, so the work does not grow with the grid.
        """
        a, b = self.halves(x)
        (home_a, p), (home_b, q) = self._margins(a, self.books[0]), self._margins(b, self.books[1])
        row_a, code_a = np.nonzero(p <= self.reach)
        row_b, code_b = np.nonzero(q <= self.reach)
        count = np.bincount(row_b, minlength=len(x))
        start = np.cumsum(count) - count
        many = count[row_a]  # codes of the right half that each one of the left half is paired with
        first = np.repeat(np.arange(len(row_a)), many)
        second = start[row_a][first] + np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)
        row = row_a[first]
        far = np.hypot(p[row, code_a[first]], q[row, code_b[second]])
        near = far <= self.reach
        order = np.lexsort((far[near], row[near]))
        cell = code_a[first] * len(self.books[1]) + code_b[second]
        return home_a * len(self.books[1]) + home_b, row[near][order], cell[near][order]


def _book(points: np.ndarray, codes: int, rng: np.random.Generator) -> np.ndarray:
    book = points[rng.choice(len(points), codes, replace=False)].copy()
    for _ in range(12):
        d = (book**2).sum(1) - 2 * points @ book.T
        near = d.argmin(1)
        sums = np.zeros_like(book)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=codes)
        book[n > 0] = sums[n > 0] / n[n > 0, None]
    return book


def fit(sample: np.ndarray, codes: int, threshold: float, target: float = TARGET_RECALL) -> Grid:
    """Codebooks by k-means, and the least reach at which a neighbour at exactly the threshold, in a random direction
    from a sampled vector, lies in a probed cell with the target probability."""
    rng = np.random.default_rng(7)
    codes = max(1, min(codes, len(sample)))
    grid = Grid(*(_book(h, codes, rng) for h in Grid.halves(sample)))
    x = sample[rng.integers(0, len(sample), 20_000)] if len(sample) else sample
    needed = []
    for at in range(0, len(x), STEP):
        u = x[at : at + STEP]
        w = rng.standard_normal(u.shape)
        w -= (w * u).sum(1)[:, None] * u
        w /= np.linalg.norm(w, axis=1, keepdims=True)
        other = threshold * u + math.sqrt(1 - threshold**2) * w
        needed.append(grid.distance(u, grid.cells(other)))
    grid.reach = float(np.quantile(np.concatenate(needed), target)) if needed else 0.0
    return grid


def _unit(column: pa.Array, width: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# Roles of a vector in a cell: it lives there, it asks in its own cell, or in one that it probes.
LIVES, ASKS_HOME, ASKS = 0, 1, 2


def _assigned(grids: dict[int, Grid]):
    """Each vector's node in its own cell, as resident and as query, and as query in the later cells of its probe. Of two
    vectors in different cells the one in the earlier cell asks. The vectors themselves stay where they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = pc.list_value_length(b.column("embedding")).to_numpy()
            for width in np.unique(sizes):
                at = np.flatnonzero(sizes == width)
                part = b.take(pa.array(at))
                grid = grids[int(width)]
                x = _unit(part.column("embedding"), int(width))
                names = ["node", "label_id"]
                for start in range(0, len(x), STEP):
                    piece = part.slice(start, STEP).select(names)
                    home, row, cell = grid.probes(x[start : start + STEP])
                    later = cell > home[row]
                    row, cell, own = row[later], cell[later], np.arange(len(home))
                    take = np.concatenate([own, own, row])
                    yield pa.RecordBatch.from_arrays(
                        [*piece.take(pa.array(take)).columns, pa.array(np.full(len(take), int(width), np.int32)),
                         pa.array(np.concatenate([home, home, cell]).astype(np.int64)),
                         pa.array(np.repeat([LIVES, ASKS_HOME, ASKS], [len(home), len(home), len(row)]).astype(np.int32))],
                        names=[*names, "width", "cell", "role"])

    return run


def _verified(threshold: float):
    """Cosines of the queries with the residents of each block. Counts and a spanning forest leave the task, no pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, held_arrays = None, [], None

        def compare(home: bool, ids: np.ndarray, x: np.ndarray, n: np.ndarray, r_ids: np.ndarray, r_x: np.ndarray, r_n: np.ndarray):
            hit = x @ r_x.T >= threshold
            if home:  # every pair of a cell comes twice, and every vector with itself
                hit &= ids[:, None] < r_ids[None]
            q, r = np.nonzero(hit)
            if not len(q):
                return None
            nodes, place = np.unique(np.concatenate([ids[q], r_ids[r]]), return_inverse=True)
            links = np.bincount(place, weights=np.concatenate([r_n[r], n[q]]), minlength=len(nodes)).astype(np.int64)
            forest = Forest(len(nodes))
            forest.join(place[: len(q)], place[len(q) :])
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(nodes[forest.roots()]), pa.array(links)], names=["node", "other", "n"])

        def among_themselves():
            """Residents of a cell that is one block; they do not come again as queries of their own cell."""
            if alone and held:
                ids, x, n = arrays = tuple(np.concatenate(c) for c in zip(*held, strict=True))
                for start in range(0, len(x), STEP):
                    some = slice(start, start + STEP)
                    got = compare(True, ids[some], x[some], n[some], *arrays)
                    if got is not None:
                        yield got

        alone = False
        for b in batches:
            keys = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("label_id", "width", "cell", "rs", "qs")], 1)
            role, single = b.column("role").to_numpy(), b.column("alone").to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(keys, axis=0) != 0).any(1) | (np.diff(role) != 0)) + 1
            for a, z in zip([0, *change], [*change, b.num_rows], strict=True):
                if a == z:
                    continue
                key, part = tuple(keys[a]), b.slice(a, z - a)
                x = _unit(part.column("embedding"), int(keys[a][1]))
                ids, n = part.column("node").to_numpy(), part.column("copies").to_numpy()
                if key != block:
                    yield from among_themselves()
                    # Each of a cell's groups of queries meets its residents, which compare themselves in the first.
                    block, held, held_arrays, alone = key, [], None, bool(single[a]) and keys[a][4] == 0
                if role[a] == LIVES:
                    held.append((ids, x, n))
                    continue
                if not held:
                    continue
                if held_arrays is None:
                    held_arrays = tuple(np.concatenate(c) for c in zip(*held, strict=True))
                for start in range(0, len(x), STEP):
                    some = slice(start, start + STEP)
                    got = compare(role[a] == ASKS_HOME, ids[some], x[some], n[some], *held_arrays)
                    if got is not None:
                        yield got
        yield from among_themselves()

    return run


def usable(embedding: str) -> Column:
    """Whether a vector can be compared: not null, not zero, all components finite numbers."""
    return F.coalesce(
        F.col(embedding).isNotNull() & F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (
            F.abs(v) < float("inf"))) & F.exists(embedding, lambda v: v != 0), F.lit(False))


def near_vectors(vectors: DataFrame, *, key: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD, codes: int | None = None, sample: int = SAMPLE,
                 residents: int = RESIDENTS, queries: int = QUERIES) -> DataFrame:
    """One row per vector: key, ``n_links``, ``component_id`` and ``kept``.

    Vectors are compared within equal labels, of whatever type, and equal dimensions. Null labels or keys and vectors that
    are null, zero or not finite link with nothing. Equal vectors of a label are one node with a number of copies, so they
    cost no pairs; rows that repeat a key, within a label or across labels, each count by their own vector and label.
    Every node lies in the cell of its two nearest codes and is compared with the residents of its cell and of the later
    cells it probes; pairs that link are all verified by cosine. Cells with many residents or queries are split into blocks,
    each compared with each, so no task holds more than ``residents`` vectors.
    """
    kind = vectors.schema[embedding].dataType
    exact = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"),
                          (F.col(embedding) if exact else F.col(embedding).cast("array<double>")).alias("embedding"))
    good = rows.where(usable("embedding") & F.col("label").isNotNull() & F.col("id").isNotNull())
    merged = good.groupBy("label", "embedding").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    nodes = kept(merged.withColumn("node", F.monotonically_increasing_id()), "vectors")
    labels = nodes.groupBy("label").agg(F.min("node").alias("label_id"))
    widths = [(r.w, r.n) for r in nodes.groupBy(F.size("embedding").alias("w")).agg(F.count("*").alias("n")).collect()]
    grids = {}
    for width, n in widths:
        same = nodes.where(F.size("embedding") == width)
        got = same.orderBy(F.xxhash64("node")).limit(sample).select("embedding").toArrow().column(0).combine_chunks()
        grids[width] = fit(_unit(got, width), codes or max(1, round((n / CELL) ** 0.5)), threshold)
    plain = nodes.join(labels, "label").select("node", "label_id", "embedding")
    placed = kept(plain.mapInArrow(_assigned(grids), "node long, label_id long, width int, cell long, role int"), "cells")
    cell = ["label_id", "width", "cell"]
    asks = F.col("role") != LIVES
    sizes = placed.groupBy(*cell).agg(F.count_if(~asks).alias("r"), F.count_if(F.col("role") == ASKS).alias("q")).where(
        "r > 0").withColumn("rn", F.ceil(F.col("r") / residents).cast("int"))
    sizes = sizes.select(*cell, "rn", (F.col("rn") == 1).alias("alone"), F.greatest(F.lit(1), F.ceil(
        (F.col("q") + F.when(F.col("rn") > 1, F.col("r")).otherwise(0)) / queries)).cast("int").alias("qn"))
    dealt = placed.join(sizes, cell).where(~(F.col("alone") & (F.col("role") == ASKS_HOME))).withColumns({
        "rs": F.when(~asks, F.array(F.pmod(F.xxhash64("node"), F.col("rn")).cast("int"))).otherwise(
            F.sequence(F.lit(0), F.col("rn") - 1)),
        "qs": F.when(asks, F.array(F.pmod(F.xxhash64(F.lit(1), "node"), F.col("qn")).cast("int"))).otherwise(
            F.sequence(F.lit(0), F.col("qn") - 1))})
    blocks = dealt.withColumn("rs", F.explode("rs")).withColumn("qs", F.explode("qs")).drop("rn", "qn").join(
        nodes.select("node", "embedding", "copies"), "node").select(
        "node", "embedding", "copies", *cell, "rs", "qs", "role", "alone")
    by = [*cell, "rs", "qs"]
    found = kept(blocks.repartition(*by).sortWithinPartitions(*by, "role").mapInArrow(
        _verified(threshold), "node long, other long, n long"), "vector-links")
    links = found.groupBy("node").agg(F.sum("n").alias("links"))
    parts = components(found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    ids = nodes.select("node", "least")
    smallest = parts.join(ids, "node").groupBy("component").agg(F.min("least").alias("smallest"))
    known = nodes.join(links, "node", "left").join(parts.join(smallest, "component"), "node", "left").select(
        "label", "embedding", "copies", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("smallest", "least").alias("component"))
    joined = rows.withColumn("_ok", usable("embedding") & F.col("label").isNotNull() & F.col("id").isNotNull()).join(
        known.withColumn("_ok", F.lit(True)), ["label", "embedding", "_ok"], "left")
    return joined.select(
        F.col("id").alias(key), F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept"))


def op8_vectors(spark, vectors: DataFrame) -> DataFrame:
    """Links and components of all vectors at the threshold; columns but vec_id, embedding and label are ignored."""
    return near_vectors(vectors.select("vec_id", "embedding", "label"))
