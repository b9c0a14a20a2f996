"""Substring deduplication: passages of at least LENGTH words that an earlier document has.

Seeds are winnowed anchors: of the SEED-word grams in a window of LENGTH words, the one with the
smallest hash. Equal windows have equal anchors, so only windows whose anchor occurs in two
documents can repeat. Those are the seed's extensions to both sides, up to LENGTH words around
it; each is looked up under its anchor and its own hash together (128 bits), and the earliest
document that has it decides. Windows in a row make up the maximal repeats, which are removed.

No pair of documents is formed, however many share a passage: anchors and windows are reduced to
their first and last document before they are shuffled. Documents equal in all words are reduced
to the earliest one first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelist.llm import words
from tidelist.llm.common import byte_texts, discard, fresh, lean, mix64, written

LENGTH = 50
SEED = 25
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def gram_hashes(word: np.ndarray, size: int, base: int) -> np.ndarray:
    """A polynomial hash of each ``size`` words in a row, by joining ever longer halves."""
    count = len(word) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    factor = words.powers(size + 1, base)
    own, width = word, 1  # hashes of ``width`` words
    out, done = np.zeros(count, np.uint64), 0
    while True:
        if size & width:
            out = out * factor[width] + own[done : done + count]
            done += width
        if done == size:
            return mix64(out)
        own = own[:-width] * factor[width] + own[width:]
        width *= 2


def anchors(word: np.ndarray, length: int) -> np.ndarray:
    """The anchor's hash of each window of ``length`` words."""
    seed = (length + 1) // 2
    grams = gram_hashes(word, seed, 0x9E3779B97F4A7C15)
    if len(grams) < length - seed + 1:
        return np.zeros(0, np.uint64)
    return sliding_window_view(grams, length - seed + 1).min(axis=1)


def windows(word: np.ndarray, length: int) -> np.ndarray:
    return gram_hashes(word, length, 0xC2B2AE3D27D4EB4F)


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change)[:n] > 0


def _profiles(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, n_words, words_sha256, anchors): distinct anchors of each document."""

    @lean
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded, bounds = words.split(batch.column(1))
            word = words.hashes(coded)
            cut = list(zip(bounds.tolist(), bounds[1:].tolist()))
            found = [np.unique(anchors(word[a:b], length)).view(np.int64) for a, b in cut]
            digests = [sha256(b" ".join((t or b"").split())).hexdigest() for t in byte_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(digests),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_words", "words_sha256", "anchors"],
            )

    schema = "doc_id long, n_words long, words_sha256 string, anchors array<long>"
    return docs.select("doc_id", "text").mapInArrow(profile, schema)


def _windows(suspects: DataFrame, length: int) -> DataFrame:
    """(anchor, window, doc_id, start) of the windows whose anchor is in the row's ``anchors``."""

    @lean
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded, bounds = words.split(batch.column(1))
            word = words.hashes(coded)
            cut = zip(bounds.tolist(), bounds[1:].tolist())
            for doc, seeds, (a, b) in zip(batch.column(0), batch.column(2), cut):
                seeds = seeds.values.to_numpy().view(np.uint64)
                anchor = anchors(word[a:b], length)
                start = np.flatnonzero(np.isin(anchor, seeds))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[start].view(np.int64)),
                        pa.array(windows(word[a:b], length)[start].view(np.int64)),
                        pa.array(np.full(len(start), doc.as_py())),
                        pa.array(start.astype(np.int32)),
                    ],
                    ["anchor", "window", "doc_id", "start"],
                )

    schema = "anchor long, window long, doc_id long, start int"
    return suspects.select("doc_id", "text", "anchors").mapInArrow(extend, schema)


class Repeats:
    """What repeats in a table of documents.

    ``whole``: (doc_id, n_words, words_sha256, first) of every row, ``first`` being the smallest
    doc_id with the same words. ``starts``: (doc_id, starts) of documents that are no such copy
    and hold windows which a smaller doc_id has. ``suspects``: (doc_id, text) of those and others.
    """

    def __init__(self, docs: DataFrame, length: int = LENGTH):
        self.length = length
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        profiles = written(_profiles(docs, length), "profiles")
        firsts = profiles.groupBy("words_sha256").agg(F.min("doc_id").alias("first"))
        placed = profiles.select("doc_id", "n_words", "words_sha256").join(firsts, "words_sha256")
        self.whole = written(placed.select("doc_id", "n_words", "words_sha256", "first"), "whole")
        # Lists of anchors travel by document, not by digest, so copies do not meet in one task.
        own = self.whole.where(F.col("doc_id") == F.col("first")).select("doc_id")
        listed = profiles.select("doc_id", "anchors").join(own, "doc_id", "left_semi")
        seeds = written(listed.select("doc_id", F.explode("anchors").alias("anchor")), "anchors")
        discard(profiles)
        shared = (
            seeds.groupBy("anchor")
            .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
            .where(F.col("low") < F.col("high"))
            .select("anchor")
        )
        # A list is bounded by its document's length.
        listed = (
            seeds.join(shared, "anchor")
            .groupBy("doc_id")
            .agg(F.collect_set("anchor").alias("anchors"))
        )
        suspects = written(docs.join(listed, "doc_id"), "suspects")
        discard(seeds)
        found = written(_windows(suspects, length), "windows")
        earliest = (
            found.groupBy("anchor", "window")
            .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
            .where(F.col("low") < F.col("high"))
            .drop("high")
        )
        # Written by itself, so that both sides of the join are plain exchanges, which adaptive
        # execution splits where one window is very common.
        earliest = written(earliest, "earliest")
        later = found.join(earliest, ["anchor", "window"]).where(F.col("low") < F.col("doc_id"))
        starts = later.groupBy("doc_id").agg(F.collect_set("start").alias("starts"))
        self.starts = written(starts, "starts")
        discard(found, earliest)
        self.suspects = suspects.select("doc_id", "text")

    def _is_copy(self):
        return (F.col("first") < F.col("doc_id")) & (F.col("n_words") >= self.length)

    def counts(self) -> DataFrame:
        """(doc_id, n_words, n_removed, kept_sha256) of every row.

        The digest is of the kept words, joined by one space.
        """
        length = self.length

        @lean
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                removed, digests = [], []
                for text, starts in zip(byte_texts(batch.column(1)), batch.column(2)):
                    word = text.split()
                    gone = covered(len(word), starts.values.to_numpy(), length)
                    removed.append(int(gone.sum()))
                    kept = [w for w, g in zip(word, gone.tolist()) if not g]
                    digests.append(sha256(b" ".join(kept)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                    ["doc_id", "part_removed", "part_sha256"],
                )

        cut = self.suspects.dropDuplicates(["doc_id"]).join(self.starts, "doc_id")
        part = cut.mapInArrow(keep, "doc_id long, part_removed long, part_sha256 string")
        copy = self._is_copy()
        nothing = F.lit(sha256(b"").hexdigest())
        return self.whole.join(part, "doc_id", "left").select(
            "doc_id",
            "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("part_removed", F.lit(0))).alias("n_removed"),
            F.when(copy, nothing).otherwise(F.coalesce("part_sha256", "words_sha256")).alias("kept_sha256"),
        )

    def removed_from(self, docs: DataFrame, counted: str = "n_removed") -> DataFrame:
        """``docs`` with the repeats cut out of ``text``, and a column of the words removed.

        What is kept stays byte for byte; the white space behind a removed passage goes with it.
        A text without repeats is unchanged, and of a copy nothing is left.
        """
        length = self.length
        copies = self.whole.where(self._is_copy()).select("doc_id").distinct()
        marked = copies.withColumn("starts", F.lit(None).cast("array<int>")).unionByName(self.starts)
        names, at = docs.columns, docs.columns.index("text")
        doc, starts = fresh("doc", names), fresh("starts", names)
        marked = marked.withColumnsRenamed({"doc_id": doc, "starts": starts})
        joined = docs.join(marked, docs["doc_id"] == marked[doc], "left")
        schema = docs.withColumn(counted, F.lit(0).cast("long")).schema

        @lean
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = byte_texts(batch.column(at))
                removed = [0] * len(texts)
                hit, listed = batch.column(len(names)), batch.column(len(names) + 1)
                for i in np.flatnonzero(hit.is_valid().to_numpy(zero_copy_only=False)).tolist():
                    spans = [m.span() for m in _WORD.finditer(texts[i] or b"")]
                    if listed[i].is_valid:
                        gone = covered(len(spans), listed[i].values.to_numpy(), length)
                    else:
                        gone = np.ones(len(spans), bool)
                    texts[i], removed[i] = _without(texts[i], spans, gone), int(gone.sum())
                columns = batch.columns[: len(names)]
                columns[at] = pa.array([None if t is None else t.decode("utf-8", "replace") for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int64())], [*names, counted])

        return joined.select(*(docs[c] for c in names), doc, starts).mapInArrow(cut, schema)


def _without(text: bytes | None, spans: list[tuple[int, int]], gone: np.ndarray) -> bytes | None:
    """The text without the words that are gone, each cut up to the next word."""
    kept, at = [], 0
    for i in np.flatnonzero(gone).tolist():
        begin = spans[i][0]
        if at < begin:
            kept.append(text[at:begin])
        at = spans[i + 1][0] if i + 1 < len(spans) else len(text)
    kept.append(text[at:] if text else b"")
    return b"".join(kept)


def deduplicated(docs: DataFrame, length: int = LENGTH, counted: str = "n_removed") -> DataFrame:
    """``docs`` without the words of windows of ``length`` words that a smaller doc_id has too.

    Windows are judged on the input, not on what is left. Every row stays; the number
    of words removed is added as ``counted``. Texts that are null or shorter than ``length`` words are unchanged, and so are rows
    with a null doc_id, which take no part. Repeated rows get equal results (an id that several
    rows share must have one text). Other columns pass through.
    """
    return Repeats(docs, length).removed_from(docs, counted)
