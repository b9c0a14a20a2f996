"""Exact top-k inner products by a bit-sliced index.

Components are quantised to integers. A shard of the index holds, for each attribute and bit, one
bitmap over the shard's rows. A query's score is a sum of slices at the weights of its own digits
(signed digits, few of which are not zero; a negative digit adds the complement of the slice):
carry-save adders on whole bitmaps bring it to one bitmap per bit of the sum. From the most
significant sum slice downward the rows are then divided into those sure to be among the first k,
those still tied and the others; rows tied to the end have equal scores and are taken in order of
vec_id. All scores are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelist.llm.common import written
from tidelist.llm.vectors import best, block_of, number_of_blocks, usable

SHARD_ROWS = 1 << 14
QUERY_BLOCK = 1 << 10
SCALE = 256


def bitmap(flags: np.ndarray) -> np.ndarray:
    """Flags (the last axis) as 64-bit words, the first flag in the lowest bit."""
    spare = -flags.shape[-1] % 64
    padded = np.pad(flags, [(0, 0)] * (flags.ndim - 1) + [(0, spare)])
    return np.packbits(padded, axis=-1, bitorder="little").view("<u8")


class Slices:
    """The bit slices of one shard: rows by attributes, in order of vec_id."""

    def __init__(self, values: np.ndarray):
        self.rows = len(values)
        self.low = values.min(axis=0)
        above = (values - self.low).T
        self.bits = max(1, int(above.max()).bit_length())
        bit = np.arange(self.bits)[None, :, None]
        plain = bitmap((above[:, None, :] >> bit & 1).astype(np.uint8))
        # Attribute by bit by word; the complements stand behind the slices.
        self.slices = np.concatenate([plain.reshape(-1, plain.shape[-1]), ~plain.reshape(-1, plain.shape[-1])])
        self.every = bitmap(np.ones(self.rows, np.uint8))

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of the sum, least significant first, and the constant to be added to it."""
        digit = signed_digits(query)  # attribute by weight
        offset = int(query @ self.low) - int(((1 << self.bits) - 1) * sum(
            int((digit[:, p] < 0).sum()) << p for p in range(digit.shape[1])
        ))
        half = len(self.slices) // 2
        wanted: list[list[np.ndarray]] = [[] for _ in range(digit.shape[1] + self.bits)]
        for p in range(digit.shape[1]):
            own = np.flatnonzero(digit[:, p])
            first = own * self.bits + np.where(digit[own, p] < 0, half, 0)
            for b in range(self.bits):
                wanted[p + b].append(first + b)
        result, carried = [], []
        weight = 0
        while weight < len(wanted) or carried:
            rows = wanted[weight] if weight < len(wanted) else []
            stack = self.slices[np.concatenate(rows)] if rows else self.slices[:0]
            if carried:
                stack = np.concatenate([stack, *carried])
            carried = []
            while len(stack) > 1:
                third = len(stack) // 3
                if third:
                    a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                    either = a ^ b
                    carried.append((a & b) | (c & either))
                    stack = np.concatenate([either ^ c, stack[3 * third :]])
                else:
                    carried.append((stack[:1] & stack[1:]))
                    stack = stack[:1] ^ stack[1:]
            result.append(stack[0] if len(stack) else np.zeros_like(self.every))
            weight += 1
        return result, offset

    def top(self, sums: list[np.ndarray], k: int, without: np.ndarray) -> np.ndarray:
        """The rows with the k largest sums, ties to the smaller row; ``without`` are left out."""
        sure, tied = np.zeros_like(self.every), self.every.copy()
        for row in without.tolist():
            tied[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        have = 0
        for slice_ in reversed(sums):
            upper = tied & slice_
            count = int(np.bitwise_count(upper).sum())
            if have + count > k:
                tied = upper
            else:
                sure, have = sure | upper, have + count
                tied = tied & ~slice_
                if have == k:
                    break
        return np.concatenate([set_rows(sure, k), set_rows(tied, k - have)])


def set_rows(words: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` rows whose bit is set."""
    used = np.flatnonzero(words)[:most]
    flags = np.unpackbits(words[used].view(np.uint8).reshape(len(used), 8), axis=1, bitorder="little")
    at, bit = np.nonzero(flags)
    return (used[at] * 64 + bit)[:most]


def signed_digits(numbers: np.ndarray) -> np.ndarray:
    """Digits -1, 0, 1 of each number by weight, no two neighbours both not 0."""
    rest, digits = numbers.astype(np.int64).copy(), []
    while rest.any():
        odd = (rest & 1).astype(bool)
        digit = np.where(odd, 2 - (rest & 3), 0)
        digits.append(digit)
        rest = (rest - digit) >> 1
    return np.stack(digits, axis=1) if digits else np.zeros((len(numbers), 0), np.int64)


def largest(rows: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest integer inner products.

    Components x count as floor(SCALE * x). Queries are the rows that ``is_query`` picks;
    candidates are all rows but the query's own id; ties go to the smaller vec_id. Which rows take
    part is told in ``vectors.usable``; zero vectors do. Scores must fit 64 bits. An empty table
    gives no row.
    """
    whole = F.transform("vector", lambda x: F.floor(x * SCALE).cast("long"))
    taken = written(usable(rows, zero=True).select("vec_id", whole.alias("vector")), "quantised")
    asked = taken.where(is_query)
    shards = number_of_blocks(taken.count(), SHARD_ROWS)
    blocks = number_of_blocks(asked.count(), QUERY_BLOCK)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    # Every block of queries meets every shard: the stated queries against all rows, in tasks
    # whose rows are bounded on both sides.
    keys = ["shard", "block"]
    index = taken.withColumn("shard", block_of(shards)).withColumn("block", every(blocks))
    queries = asked.withColumn("block", block_of(blocks)).withColumn("shard", every(shards))

    def search(own: pa.Table, queries: pa.Table) -> pa.Table:
        query, found, score = ([np.zeros(0, np.int64)] for _ in range(3))
        if own.num_rows and queries.num_rows:
            ids, vectors = _matrix(own)
            slices = Slices(vectors)
            for query_id, vector in zip(*_matrix(queries)):
                sums, offset = slices.scores(vector)
                top = slices.top(sums, k, np.flatnonzero(ids == query_id))
                total = np.full(len(top), offset, np.int64)
                for weight, bits in enumerate(sums):
                    set_ = bits[top >> 6] >> (top & 63).astype(np.uint64) & np.uint64(1)
                    total += set_.astype(np.int64) << weight
                query.append(np.full(len(top), query_id))
                found.append(ids[top])
                score.append(total)
        columns = zip(("query_id", "vec_id", "score"), (query, found, score))
        return pa.table({name: np.concatenate(x) for name, x in columns})

    found = (
        index.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInArrow(search, "query_id long, vec_id long, score long")
    )
    return best(found, k, F.col("score").desc())


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) in order of vec_id."""
    rows = rows.sort_by("vec_id").combine_chunks()
    flat = rows["vector"].combine_chunks().flatten().to_numpy()
    return rows["vec_id"].to_numpy(), flat.reshape(rows.num_rows, -1)
