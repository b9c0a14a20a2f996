"""Centroid clustering of integer vectors over a VA-file.

Vectors are kept in blocks. A block holds an approximation of each vector (the number of an
equally wide cell, BITS bits per dimension) and, behind them, the whole vectors; the blocks of a
task are one file in the shared folder, and a table says where each block begins. For a set of
centroids, tables over (dimension, cell) give the least and the most that a vector in that cell can
add to its distance from each centroid; sums over the dimensions are the distance's interval. Only
vectors for which intervals of several centroids overlap are fetched by their place in the file.

What all centroids share cannot tell them apart, so intervals leave it out: with o the middle of
the centroids, |x - c|^2 - |x - o|^2 = |c - o|^2 - 2 (c - o)(x - o) is linear in x, and its interval
in a cell is much narrower than that of the distance.

Sums of clusters are kept from round to round: a block tells what the vectors that changed their
cluster add and take away, and only those are fetched for it. All sums and distances are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelist.llm.common import file_system, lean, scratch, spread, written

BITS = 8
BLOCK_ROWS = 4096
LARGEST = 1 << 27  # integers below it: sums of squares of 256 dimensions then fit 64 bits
NEAR = 16  # wanted vectors that are at most so far apart are read at once
NONE = 255  # no cluster yet; there are at most so many centroids
PLACE = "path string, at long, n long"


@dataclass(frozen=True)
class Grid:
    """Cells of equal width between the extremes of each dimension."""

    low: np.ndarray
    width: np.ndarray

    @classmethod
    def between(cls, low: np.ndarray, high: np.ndarray) -> Grid:
        return cls(low, (high - low >> BITS) + 1)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """Dimension by vector."""
        return ((vectors - self.low) // self.width).astype(np.uint8).T.copy()

    def tables(self, centroids: np.ndarray) -> np.ndarray:
        """Dimension by cell by (least for each centroid, most for each centroid)."""
        origin = centroids.sum(axis=0) // len(centroids)
        away = (centroids - origin).T  # dimension by centroid
        first = self.low[:, None] + self.width[:, None] * np.arange(1 << BITS) - origin[:, None]
        last = first + (self.width - 1)[:, None]
        at = [away[:, None] ** 2 - 2 * away[:, None] * x[:, :, None] for x in (first, last)]
        return np.concatenate([np.minimum(*at), np.maximum(*at)], axis=2)


class Block:
    """A block in its file: ids, which of them are not null, cells, vectors."""

    def __init__(self, path: str, at: int, n: int, dimensions: int):
        store, root = file_system(path)
        self.file, self.at, self.n, self.dimensions = store.open_input_file(root), at, n, dimensions

    @staticmethod
    def packed(ids: pa.Array, vectors: np.ndarray, grid: Grid) -> bytes:
        known = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
        numbers = ids.fill_null(0).to_numpy().astype("<i8")
        parts = numbers, known, grid.cells(vectors), vectors.astype("<i4")
        return b"".join(p.tobytes() for p in parts)

    def ids(self) -> pa.Array:
        data = self.file.read_at(9 * self.n, self.at)
        known = np.frombuffer(data, np.uint8, self.n, 8 * self.n)
        return pa.array(np.frombuffer(data, "<i8", self.n), mask=known == 0)

    def cells(self) -> np.ndarray:
        data = self.file.read_at(self.n * self.dimensions, self.at + 9 * self.n)
        return np.frombuffer(data, np.uint8).reshape(self.dimensions, self.n)

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        """The vectors of some rows, which are in ascending order."""
        width = 4 * self.dimensions
        base = self.at + (9 + self.dimensions) * self.n
        out = np.empty((len(rows), self.dimensions), np.int64)
        cuts = np.flatnonzero(np.diff(rows) > NEAR) + 1
        done = 0
        for run in np.split(rows, cuts) if len(rows) else []:
            first, last = int(run[0]), int(run[-1])
            data = self.file.read_at((last + 1 - first) * width, base + first * width)
            read = np.frombuffer(data, "<i4").reshape(-1, self.dimensions)
            out[done : done + len(run)] = read[run - first]
            done += len(run)
        return out


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, vector by centroid."""
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def assigned(block: Block, tables: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest centroid of each vector, rows that were fetched, their vectors)."""
    k = len(centroids)
    bounds = np.zeros((block.n, 2 * k), np.int64)
    for cell, table in zip(block.cells(), tables):
        bounds += table[cell]
    least, most = bounds[:, :k], bounds[:, k:]
    nearest = most.argmin(axis=1)
    unsure = np.flatnonzero((least <= most.min(axis=1)[:, None]).sum(axis=1) > 1)
    vectors = block.vectors(unsure)
    if len(unsure):
        nearest[unsure] = distances(vectors, centroids).argmin(axis=1)  # ties: the first
    return nearest, unsure, vectors


def usable(rows: DataFrame, dimensions: int) -> DataFrame:
    """(vec_id, vector array<double>) of rows with exactly so many components, all finite."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    return vectors.where(F.col("vector").isNotNull() & (F.size("vector") == dimensions) & finite)


def scaled(batch: pa.RecordBatch, scale: int) -> np.ndarray:
    """Whole numbers of a batch's vectors, still as floats."""
    flat = batch.column(1).flatten().to_numpy()
    return np.floor(flat * scale).reshape(batch.num_rows, -1)


class VaFile:
    """Vectors floor(scale * x), filed in blocks.

    Rows take part that have exactly ``dimensions`` components, none null or non-finite; each is a
    vector of its own, also those that share an id or have none. ``blocks`` holds one row per block:
    its place. Integers must lie below LARGEST in size (a ValueError tells), so that all arithmetic
    is exact.
    """

    def __init__(self, rows: DataFrame, dimensions: int, scale: int):
        self.taken, self.dimensions, self.scale = usable(rows, dimensions), dimensions, scale
        self.folder = scratch(rows.sparkSession, "vafile")
        self.grid = self._grid()
        self.blocks = self._write() if self.grid else rows.sparkSession.createDataFrame([], PLACE)

    def _grid(self) -> Grid | None:
        scale = self.scale

        def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low = high = None
            for batch in batches:
                if batch.num_rows:
                    own = scaled(batch, scale)
                    low = own.min(axis=0) if low is None else np.minimum(low, own.min(axis=0))
                    high = own.max(axis=0) if high is None else np.maximum(high, own.max(axis=0))
            if low is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(low))), pa.array(low), pa.array(high)], ["d", "low", "high"]
                )

        found = self.taken.mapInArrow(lean(extremes), "d long, low double, high double")
        ends = found.groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
        if not ends:
            return None
        low, high = (np.array([r[c] for r in sorted(ends)]) for c in ("low", "high"))
        if max(-low.min(), high.max()) >= LARGEST:
            raise ValueError(f"components times {self.scale} must be below {LARGEST} in size")
        return Grid.between(low.astype(np.int64), high.astype(np.int64))

    def _write(self) -> DataFrame:
        store, root = file_system(self.folder)
        store.create_dir(root, recursive=True)
        folder, grid, scale = self.folder, self.grid, self.scale

        def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # A name of its own for each attempt: only files in the table count.
            path, out, at = f"{folder}/{uuid4().hex}", None, 0
            places, ids, vectors, held = [], [], [], 0

            def end_block() -> None:
                nonlocal out, at, ids, vectors, held
                if out is None:
                    own, name = file_system(path)
                    out = own.open_output_stream(name, compression=None)
                data = Block.packed(pa.concat_arrays(ids), np.concatenate(vectors), grid)
                out.write(data)
                places.append((path, at, held))
                at, ids, vectors, held = at + len(data), [], [], 0

            for batch in batches:
                if batch.num_rows:
                    ids.append(batch.column(0))
                    vectors.append(scaled(batch, scale).astype(np.int64))
                    held += batch.num_rows
                    if held >= BLOCK_ROWS:
                        end_block()
            if held:
                end_block()
            if out is not None:
                out.close()
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*places)], ["path", "at", "n"])

        return spread(written(self.taken.mapInArrow(lean(save), PLACE), "vafile-blocks"), "path", "at")

    def over_blocks(self, rows: DataFrame, task: Callable, schema: str) -> DataFrame:
        """``task(block, other columns of its row)`` gives the columns of a record batch."""
        names = [part.split()[0] for part in schema.split(", ")]
        dimensions = self.dimensions

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for path, at, n, *more in zip(*(c.to_pylist() for c in batch.columns)):
                    columns = task(Block(path, at, n, dimensions), path, at, n, *more)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        return rows.mapInArrow(lean(run), schema)

    def assign(self, before: DataFrame, centroids: np.ndarray) -> DataFrame:
        """One row per block: its place, each vector's cluster, what changed, how many were fetched.

        ``before`` holds (place, clusters) of the round before. ``change`` is a row per cluster of
        what it gains in vectors and in the sum of each dimension.
        """
        tables, k = self.grid.tables(centroids), len(centroids)

        def task(block: Block, path: str, at: int, n: int, old: bytes | None):
            nearest, rows, vectors = assigned(block, tables, centroids)
            was = np.full(n, NONE, np.uint8) if old is None else np.frombuffer(old, np.uint8)
            moved = np.flatnonzero(nearest != was)
            own = np.empty((len(moved), block.dimensions), np.int64)
            have = np.isin(moved, rows, assume_unique=True)
            own[have] = vectors[np.searchsorted(rows, moved[have])]
            own[~have] = block.vectors(moved[~have])
            change = np.zeros((k, 1 + block.dimensions), np.int64)
            for sign, cluster in ((1, nearest[moved]), (-1, was[moved])):
                for c in np.unique(cluster[cluster != NONE]):
                    of = own[cluster == c]
                    change[c] += sign * np.concatenate([[len(of)], of.sum(axis=0)])
            fetched = len(rows) + int((~have).sum())
            return [path], [at], [n], [nearest.astype(np.uint8).tobytes()], [change.ravel()], [fetched]

        schema = f"{PLACE}, clusters binary, change array<long>, fetched long"
        return written(self.over_blocks(before, task, schema), "vafile-round")

    def distances(self, centroids: np.ndarray) -> DataFrame:
        """(vec_id, cluster, distance) of every vector: its nearest centroid, squared distance."""
        tables = self.grid.tables(centroids)

        def task(block: Block, path: str, at: int, n: int):
            nearest, _, _ = assigned(block, tables, centroids)
            distance = ((block.vectors(np.arange(n)) - centroids[nearest]) ** 2).sum(axis=1)
            return block.ids(), nearest.astype(np.int32), distance

        return self.over_blocks(self.blocks, task, "vec_id long, cluster int, distance long")


@dataclass(frozen=True)
class Clusters:
    """``members``: (vec_id, cluster, distance); the final centroids; vectors fetched per round."""

    members: DataFrame
    centroids: np.ndarray
    fetched: list[int]


def cluster(rows: DataFrame, order: Column, k: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024) -> Clusters:
    """Lloyd's rounds over a VA-file of ``rows`` (vec_id, embedding), in exact integers.

    Centroids start as the k kept vectors that come first in ``order``, ties by id and vector,
    nulls last; there are fewer if fewer vectors are kept. Each round assigns every vector to its
    nearest centroid (ties: the smaller number) and replaces centroids that have vectors by the
    floor of their mean; the last centroids then get the vectors once more. Rounds that would
    change nothing are left out. Which rows are kept is told in ``VaFile``. An empty table gives no
    member. k, at most 254, and the dimensions bound what reaches the driver.
    """
    if not 0 < k < NONE:
        raise ValueError(f"k must be between 1 and {NONE - 1}")
    file = VaFile(rows, dimensions, scale)
    keyed = file.taken.withColumn("_order", order)
    first = keyed.orderBy(F.col("_order").asc_nulls_last(), F.col("vec_id").asc_nulls_last(), "vector").limit(k).collect()
    centroids = np.array([np.floor(np.array(r["vector"]) * scale) for r in first]).astype(np.int64)
    if not first:
        nothing = rows.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long")
        return Clusters(nothing, centroids, [])
    state = file.blocks.withColumn("clusters", F.lit(None).cast("binary"))
    total = np.zeros((len(first), 1 + dimensions), object)
    fetched = []
    for _ in range(rounds):
        state = file.assign(state.select("path", "at", "n", "clusters"), centroids)
        changes = state.select(F.posexplode("change").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("x"))
        for i, x in changes.collect():
            total[divmod(i, 1 + dimensions)] += int(x)
        fetched.append(state.agg(F.sum("fetched")).first()[0])
        new = centroids.copy()
        for c, (count, *sums) in enumerate(total.tolist()):
            if count:
                new[c] = [s // count for s in sums]
        if (new == centroids).all():
            break
        centroids = new
        state = spread(state, "path", "at")
    return Clusters(written(file.distances(centroids), "vafile-members"), centroids, fetched)


def with_inertia(found: Clusters) -> DataFrame:
    """Members with the sum of distances of their cluster and of all, and a digest of the centroid."""
    by_cluster = found.members.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    every = sum(int(r["s"]) for r in by_cluster)
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    rows = [(r["cluster"], int(r["s"]), every, digest[r["cluster"]]) for r in by_cluster]
    of = found.members.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # One row per centroid, at most 254 of them.
    return found.members.join(F.broadcast(of), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
