"""Vectors in blocks: many of a group in one row, for numpy to work on at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(rows: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, vector array<double>) of the rows that take part.

    Left out are null ids, vectors that are null, empty or hold null or non-finite components,
    zero vectors unless ``zero``, and vectors of another length than the most frequent one (of
    equally frequent ones the smallest). An id that several rows share is taken once, with the
    smallest of its vectors. Other columns are ignored.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = (
        rows.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
        .where(finite)
    )
    if not zero:
        good = good.where(F.exists("vector", lambda x: x != 0))
    lengths = good.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    one = good.where(F.size("vector") == (lengths["d"] if lengths else 0))
    return one.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("vector").alias("vector"))


def number_of_blocks(count: int, size: int) -> int:
    return max(1, -(-count // size))


def block_of(blocks: Column | int) -> Column:
    return F.pmod(F.xxhash64("vec_id"), F.lit(blocks) if isinstance(blocks, int) else blocks)


def in_blocks(rows: DataFrame, keys: list[str], kind: str = "<f8") -> DataFrame:
    """One row per group: its keys, ``ids`` and ``values`` as numpy bytes, in order of vec_id.

    The caller's keys bound the rows of a group.
    """
    fields = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys]

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id").combine_chunks()
        ids = group["vec_id"].to_numpy().astype("<i8")
        flat = group["vector"].combine_chunks().flatten().to_numpy().astype(kind)
        named = {k: group[k].slice(0, 1) for k in keys}
        return pa.table({**named, "ids": [ids.tobytes()], "values": [flat.tobytes()]})

    wide = rows.select(*keys, "vec_id", "vector")
    return wide.groupBy(*keys).applyInArrow(pack, ", ".join([*fields, "ids binary", "values binary"]))


def unpacked(ids: bytes, values: bytes, kind: str = "<f8") -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, "<i8")
    return own, np.frombuffer(values, kind).reshape(len(own), -1)


def best(found: DataFrame, k: int, order: Column) -> DataFrame:
    """(query_id, rank, vec_id, score): the first k of each query, ties to the smaller vec_id."""
    ranked = Window.partitionBy("query_id").orderBy(order, "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
