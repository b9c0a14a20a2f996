"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of PIVOTS pivots by their distance to it, and posted in the
inverted files of its POST nearest pivots. A query visits the files of its PROBE nearest pivots,
ranks what is posted there by the footrule distance of the two orders, and computes the true
distance for the best SHARE of each file. Files are cut into blocks of bounded size, queries too,
so the files of pivots in dense regions are worked on by many tasks.

The pivots are a sample of PIVOTS distinct vectors; every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelist.llm.common import spread, written
from tidelist.llm.vectors import best, block_of, in_blocks, unpacked, usable

PIVOTS = 128
POST = 8
PROBE = 32
SHARE = 0.2
LEAST = 64  # of a block at least so many are reranked
FILE_BLOCK = 8192
QUERY_BLOCK = 256


def orders(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Pivots by distance, nearest first, of each vector; ties to the earlier pivot."""
    distance = (pivots**2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.argsort(distance, axis=1, kind="stable")


def places(order: np.ndarray) -> np.ndarray:
    """The place of each pivot in each order."""
    return np.argsort(order, axis=1).astype(np.int16)


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - query) ** 2).sum(axis=1))


def searched(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, distances): the k nearest in a block among the best by footrule."""
    place = places(orders(vectors, pivots))
    asked = places(orders(queries, pivots))
    for query_id, query, own in zip(query_ids.tolist(), queries, asked):
        footrule = np.abs(place - own).sum(axis=1, dtype=np.int32)
        footrule[ids == query_id] = np.iinfo(np.int32).max
        take = max(LEAST, int(SHARE * len(ids)))
        near = np.argsort(footrule, kind="stable")[:take]
        near = near[ids[near] != query_id]
        exact = distances(vectors[near], query)
        first = np.lexsort((ids[near], exact))[:k]
        yield query_id, ids[near[first]], exact[first]


def nearest(rows: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found by Euclidean distance.

    Queries are the rows of ``rows`` that ``is_query`` picks; candidates are all rows but the
    query's own id. Which rows take part is told in ``vectors.usable``; zero vectors don't. Ties
    go to the smaller vec_id; an empty table gives no row. Distances are in double precision on
    the original vectors.
    """
    spark = rows.sparkSession
    taken = written(usable(rows, zero=False), "vectors")
    # A sample of PIVOTS vectors: the smallest hashes of distinct vectors.
    sample = taken.select("vector").distinct().withColumn("h", F.xxhash64("vector"))
    chosen = sample.orderBy("h", "vector").limit(PIVOTS).collect()
    pivots = spark.sparkContext.broadcast(np.array([r["vector"] for r in chosen], float))

    def posted(count: int):
        def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                order = orders(vectors, pivots.value)[:, :count].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(list(order), pa.list_(pa.int32()))],
                    ["vec_id", "vector", "pivots"],
                )

        return post

    schema = "vec_id long, vector array<double>, pivots array<int>"

    def files(vectors: DataFrame, count: int, size: int, block: str) -> DataFrame:
        """Blocks of the inverted files: (pivot, block, ids, values)."""
        near = vectors.mapInArrow(posted(count), schema)
        listed = near.select("vec_id", "vector", F.explode("pivots").alias("pivot"))
        counts = listed.groupBy("pivot").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
        dealt = listed.join(counts, "pivot").withColumn(block, block_of(F.col("blocks")))
        return in_blocks(dealt, ["pivot", block])

    index = written(files(taken, POST, FILE_BLOCK, "block"), "files")
    asked = files(taken.where(is_query), PROBE, QUERY_BLOCK, "asked").withColumnsRenamed(
        {"ids": "query_ids", "values": "queries"}
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, vectors = unpacked(row["ids"], row["values"])
                query_ids, queries = unpacked(row["query_ids"], row["queries"])
                query, found, score = [], [], []
                for q, near, exact in searched(query_ids, queries, ids, vectors, pivots.value, k):
                    query.append(np.full(len(near), q))
                    found.append(near)
                    score.append(exact)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (query, found, score)],
                    ["query_id", "vec_id", "score"],
                )

    met = index.join(written(asked, "asked"), "pivot")
    found = spread(met).mapInArrow(search, "query_id long, vec_id long, score double")
    return best(found, k, F.col("score"))

