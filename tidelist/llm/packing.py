"""Packing into fixed windows by lexical retrieval.

Documents are dealt to shards by lexical likeness: their BM25 impacts, projected to a few random
axes, go down a tree of cuts that was fitted on a sample until a shard holds a bounded number of
ids. Like documents meet, however many shards there are; copies that no cut tells apart and that
fill a shard by themselves are dealt by hash. A shard holds an inverted index of its documents
with BM25 impacts; document frequencies and the mean length are those of all documents. A seed
is searched within its shard, by all of its ids. A seed document opens a window, and its unused neighbours, best first, fill it. A
document that crosses the end of a window goes on in the next, whose seed it is. Where no
neighbour is left, the next unused document fills the window and becomes the seed.

Windows are cut from one row of ids, so only a shard's last window is not full; it is cut into
sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelist.llm.common import lean, written
from tidelist.llm.tokens import id_type, token_table

WINDOW = 2048
SHARD_IDS = 4 << 20  # ids of a shard: bounds the memory and the time of a task
AXES = 64  # of the projection by which documents are dealt
SAMPLE = 128  # documents of a shard that the tree is fitted on
LEAST_SAMPLE = 4096  # documents for a small tree
COMMON = 1 / 8  # share of a shard's documents from which an id has a row instead of a list
K1, B = 1.2, 0.75


def _impacts(
    docs: list[np.ndarray], idf: np.ndarray, mean_length: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, BM25 impacts, bounds): the distinct ids of each document in order, without its end.

    Those of document k lie from ``bounds[k]`` to ``bounds[k + 1]``.
    """
    if not docs:
        return np.zeros(0, np.uint16), np.zeros(0, np.float32), np.zeros(1, np.int64)
    length = np.array([len(ids) for ids in docs])
    row = np.concatenate([ids[:-1] for ids in docs])
    ends = np.cumsum(np.maximum(length - 1, 0))
    start = 0
    for end in ends.tolist():
        row[start:end].sort(kind="stable")
        start = end
    first = np.ones(len(row), bool)
    np.not_equal(row[1:], row[:-1], out=first[1:])
    first[ends[ends < len(row)]] = True
    at = np.flatnonzero(first)
    term, tf = row[at], np.diff(np.append(at, len(row)))
    bounds = np.concatenate([[0], np.searchsorted(at, ends)])
    norm = np.repeat(K1 * (1 - B + B * length / mean_length), np.diff(bounds))
    return term, (idf[term] * tf * (K1 + 1) / (tf + norm)).astype(np.float32), bounds


@lru_cache(1)  # a worker draws them once
def _axes(ids: int) -> np.ndarray:
    return np.random.default_rng(AXES).standard_normal((ids, AXES), np.float32)


class Likeness:
    """Documents as unit vectors; the angles are about those of their impacts."""

    def __init__(self, idf: np.ndarray, mean_length: float):
        self.idf, self.mean_length = idf, mean_length
        self.axes = _axes(len(idf))

    def vectors(self, docs: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(docs), AXES), np.float32)
        rows = np.empty_like(self.axes)  # kept, as new memory for every document costs more than filling it
        term, impact, bounds = _impacts(docs, self.idf, self.mean_length)
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            vector = impact[a:b] @ np.take(self.axes, term[a:b], axis=0, out=rows[: b - a], mode="clip")
            out[i] = vector / max(float(np.linalg.norm(vector)), 1e-9)
        return out


class Tree:
    """Cuts of the space into shards of at most ``limit`` in weight, as the sample has it.

    A node is cut across its main axis, at the widest gap between its first and last quarter. What
    cannot be cut is a leaf of several shards.
    """

    GAP = 1e-5  # vectors that are closer are equal

    def __init__(self, vectors: np.ndarray, weight: np.ndarray, limit: float):
        self.axis, self.cut, self.child, self.first, self.parts = [], [], [], [], []
        shards = 0
        todo = [(np.arange(len(vectors)), None)]
        while todo:
            some, above = todo.pop()
            node = len(self.cut)
            if above:
                self.child[above[0]][above[1]] = node
            heavy = weight[some].sum()
            found = self._cut(vectors[some], weight[some]) if heavy > limit else None
            axis, cut = found or (np.zeros(vectors.shape[1], np.float32), 0.0)
            self.axis.append(axis)
            self.cut.append(cut)
            self.child.append([node, node])
            self.first.append(shards)
            self.parts.append(0 if found else max(1, int(-(-heavy // limit))))
            shards += self.parts[-1]
            if found:
                right = vectors[some] @ axis > cut
                todo += [(some[right], (node, 1)), (some[~right], (node, 0))]
        self.shards = shards
        self.axis = np.array(self.axis, np.float32)
        self.cut = np.array(self.cut, np.float32)
        self.child, self.first, self.parts = map(np.array, (self.child, self.first, self.parts))

    def _cut(self, vectors: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float] | None:
        mean = np.average(vectors, axis=0, weights=weight)
        apart = (vectors - mean).astype(np.float64)
        axis = np.linalg.eigh((apart * weight[:, None]).T @ apart)[1][:, -1].astype(np.float32)
        place = vectors @ axis
        order = np.argsort(place, kind="stable")
        gap = np.diff(place[order])
        share = np.cumsum(weight[order])[:-1] / weight.sum()
        inner = np.where((share >= 0.25) & (share <= 0.75), gap, 0)
        if not len(gap) or gap.max() <= self.GAP:
            return None
        # Where equal documents fill the middle, next to them.
        at = inner.argmax() if inner.max() > self.GAP else np.where(gap > self.GAP, abs(share - 0.5), 1).argmin()
        return axis, float((place[order[at]] + place[order[at + 1]]) / 2)

    def shard(self, vectors: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The shard of each document; ``hashes`` deal those of a leaf of several shards."""
        node = np.zeros(len(vectors), np.int64)
        while True:
            right = np.einsum("ij,ij->i", vectors, self.axis[node]) > self.cut[node]
            below = self.child[node, right.astype(np.int64)]
            if (below == node).all():
                return self.first[node] + hashes % self.parts[node]
            node = below


class Shard:
    """The inverted index of some documents. ``idf`` by id, of all documents.

    A seed is searched by all of its distinct ids. Ids of many documents have their impacts in a
    row over all documents, so that rows are added up; the others have lists. What is used leaves
    the index as soon as it is an eighth of it.
    """

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.used = np.zeros(len(docs), bool)
        self.ids = len(idf)
        term, impact, bounds = _impacts(docs, idf, mean_length)
        self.queries = [term[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        doc = np.repeat(np.arange(len(docs), dtype=np.int64), np.diff(bounds))
        order = np.argsort(term, kind="stable")
        self._index(np.arange(len(docs)), term[order], doc[order], impact[order])

    def _index(self, docs: np.ndarray, term: np.ndarray, doc: np.ndarray, impact: np.ndarray) -> None:
        """Postings in order of ids; ``doc`` is a place in ``docs``."""
        self.docs, self.term, self.doc, self.impact = docs, term, doc, impact
        count = np.bincount(term, minlength=self.ids)
        self.start = np.concatenate([[0], np.cumsum(count)])
        common = np.flatnonzero(count > max(len(docs) * COMMON, 1))
        self.row = np.full(self.ids, -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), len(docs)), np.float32)
        for k, t in enumerate(common.tolist()):
            span = slice(self.start[t], self.start[t + 1])
            self.rows[k, doc[span]] = impact[span]

    def _without_used(self) -> None:
        left = ~self.used[self.docs]
        if 8 * np.count_nonzero(left) <= 7 * len(left):
            place = np.cumsum(left) - 1
            kept = left[self.doc]
            self._index(self.docs[left], self.term[kept], place[self.doc[kept]], self.impact[kept])

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every document of the index, by all ids of the seed."""
        row = self.row[self.queries[seed]]
        held = np.zeros(len(self.rows), np.float32)
        held[row[row >= 0]] = 1
        score = (held @ self.rows).astype(np.float64)
        spans = [slice(self.start[t], self.start[t + 1]) for t in self.queries[seed][row < 0].tolist()]
        if spans:
            score += np.bincount(
                np.concatenate([self.doc[s] for s in spans]),
                np.concatenate([self.impact[s] for s in spans]),
                minlength=len(self.docs),
            )
        return score

    def neighbours(self, seed: int) -> Iterator[int]:
        """Unused documents that share an id with the seed, best score first."""
        self._without_used()
        docs, score = self.docs, self.scores(seed)
        score[self.used[docs]] = 0
        take = 16
        best = np.argpartition(-score, take)[:take] if len(score) > take else np.arange(len(score))
        yield from self._ranked(docs, score, best)
        if len(score) > take:
            score[best] = 0
            yield from self._ranked(docs, score, np.flatnonzero(score))

    def _ranked(self, docs: np.ndarray, score: np.ndarray, some: np.ndarray) -> Iterator[int]:
        for k in some[np.lexsort((some, -score[some]))].tolist():
            if score[k] > 0 and not self.used[docs[k]]:
                yield int(docs[k])


def pack_shard(
    docs: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW
) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard's documents."""
    index = Shard(docs, idf, mean_length)
    pieces: list[tuple[int, int, int, int, int]] = []
    following = iter(range(len(docs)))
    near: Iterator[int] = iter(())
    seed = None
    offset = sequence = 0
    while True:
        doc = None
        if offset:
            if seed is not None:
                near, seed = index.neighbours(seed), None
            doc = next(near, None)
        if doc is None:
            doc = next((d for d in following if not index.used[d]), None)
            if doc is None:
                break
            seed = doc
        index.used[doc] = True
        start = 0
        while start < len(docs[doc]):
            length = min(len(docs[doc]) - start, window - offset)
            pieces.append((doc, start, length, sequence, offset))
            start, offset = start + length, offset + length
            if offset == window:
                sequence, offset = sequence + 1, 0
                seed = doc
    if offset:
        last = [p for p in pieces if p[3] == sequence]
        pieces[len(pieces) - len(last) :] = _powers(last, offset, sequence)
    return pieces


def _powers(pieces: list, total: int, sequence: int) -> list:
    """The pieces of an unfilled window, cut into sequences of the powers of two in ``total``."""
    bounds, at = [], 0
    for k in reversed(range(total.bit_length())):
        if total >> k & 1:
            bounds.append((at, at + (1 << k)))
            at += 1 << k
    cut = []
    for i, (a, b) in enumerate(bounds):
        for doc, start, length, _, offset in pieces:
            low, high = max(a, offset), min(b, offset + length)
            if low < high:
                cut.append((doc, start + low - offset, high - low, sequence + i, low - a))
    return cut


def document_frequencies(counts: DataFrame) -> DataFrame:
    """(id, n): in how many documents each id occurs, from the ``counts`` of a token table's tasks."""

    @lean
    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                seen, n = np.frombuffer(raw, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n)], ["id", "n"])

    rows = counts.select("counts").where("counts IS NOT NULL")
    return rows.mapInArrow(apart, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _dealt(tokens: DataFrame, dtype: str, idf, mean: float, count: int, total: int) -> DataFrame:
    """``tokens`` with the shard of each document."""
    if total <= SHARD_IDS:
        return tokens.withColumn("shard", F.lit(0).cast("long"))

    def vectors(batch: pa.RecordBatch, by: Likeness) -> np.ndarray:
        return by.vectors([np.frombuffer(x, dtype) for x in batch["ids"].to_pylist()])

    @lean
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Likeness(idf.value, mean)
        for batch in batches:
            raw = pa.array([v.tobytes() for v in vectors(batch, by)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["n"], batch["h"], raw], ["n", "h", "vector"])

    hashed = tokens.withColumn("h", F.xxhash64("doc_id", "ids"))
    share = min(1.0, max(LEAST_SAMPLE, SAMPLE * -(-total // SHARD_IDS)) / count)
    some = hashed.where(F.pmod("h", F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    # The sample grows by SAMPLE vectors of AXES numbers a shard, 32 KB for 4 million ids.
    sample = some.select("n", "h", "ids").mapInArrow(project, "n long, h long, vector binary").toPandas()
    sample = sample.sort_values(["h", "n"])
    points = np.frombuffer(b"".join(sample["vector"]), np.float32).reshape(-1, AXES)
    weight = sample["n"].to_numpy(np.float64)
    weight *= total / max(weight.sum(), 1)
    tree = tokens.sparkSession.sparkContext.broadcast(Tree(points, weight, SHARD_IDS))

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Likeness(idf.value, mean)
        for batch in batches:
            # Other bits than those that chose the sample.
            hashes = batch["h"].to_numpy() >> 20 & 0xFFFFFFFF
            shard = tree.value.shard(vectors(batch, by), hashes)
            names = [n for n in batch.schema.names if n != "h"]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(shard)], [*names, "shard"])

    schema = T.StructType([*tokens.schema.fields, T.StructField("shard", T.LongType())])
    return hashed.mapInArrow(deal, schema)


def pack(docs: DataFrame, vocabulary: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): every id in one piece.

    ``start`` counts a document's ids before the piece, ``offset`` the ids before it in its
    sequence, without gaps; ``ids`` are little-endian unsigned 32-bit integers. A null or empty
    text is the end id alone. Equal doc_ids, null ones too, are separate documents. Other columns
    are ignored; an empty table gives no piece.
    """
    spark = docs.sparkSession
    dtype = id_type(vocabulary)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stored = written(token_table(docs, vocabulary, end_id, counted=True), "tokens")
    tokens = stored.where("n IS NOT NULL").drop("counts")
    count, total = tokens.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per id of the vocabulary at most.
    seen = document_frequencies(stored).toPandas()
    df = np.zeros(int(seen["id"].max()) + 1 if len(seen) else 1)
    df[seen["id"]] = seen["n"]
    idf = spark.sparkContext.broadcast(np.log1p((count - df + 0.5) / (df + 0.5)).astype(np.float32))
    mean = total / max(count, 1)
    dealt = _dealt(tokens, dtype, idf, mean, count, total)

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("n", "ascending")])
        ids = [np.frombuffer(x, dtype) for x in group["ids"].to_pylist()]
        shard = group["shard"][0].as_py()
        pieces = np.array(pack_shard(ids, idf.value, mean, window), np.int64).reshape(-1, 5)
        doc, start, length, sequence, offset = pieces.T
        raw = [ids[d][s : s + n].astype("<u4").tobytes() for d, s, n in zip(doc, start, length)]
        return pa.table(
            {
                "doc_id": group["doc_id"].take(pa.array(doc)),
                "start": start,
                "length": length,
                "ids": pa.array(raw, pa.binary()),
                "doc_tokens": group["n"].take(pa.array(doc)),
                "sequence_id": (shard << 32) + sequence,
                "offset": offset,
            }
        )

    schema = (
        "doc_id long, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long"
    )
    return dealt.groupBy("shard").applyInArrow(packed, schema)
