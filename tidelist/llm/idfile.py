"""Files of token ids: frequency ranks in byte-aligned variable-length codes.

An id is replaced by its rank, the most frequent id of all documents being rank 0, and a rank
takes 1 to 4 bytes. Two control bits per id (its bytes less one; four ids to a control byte, the
first in the low bits) lie apart from the data bytes. A decoder looks control bytes up in a table
of 256 x 4 lengths and gathers the data bytes with numpy.

A file is ``MAGIC``, blocks, an index of the documents, and a footer. A block holds the control
bytes of its documents (each document starts a new control byte) and then their data bytes. Files
are numbered in ascending order of the documents' ids. The ranks lie beside the files.

Tasks write files under names of their own and report them; only files in the manifest count, so
a task that is run again, or twice, leaves nothing behind that is read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelist.llm.common import file_system, lean, spread, written
from tidelist.llm.tokens import id_type, token_table

MAGIC = b"TLIDS1\0\0"
FILE_IDS = 8 << 20  # mean ids of a file
BLOCK_IDS = 1 << 20  # a block ends at the first document that reaches as many ids
LENGTHS = np.array([[(c >> shift & 3) + 1 for shift in (0, 2, 4, 6)] for c in range(256)], np.int64)
_FOOTER = struct.Struct("<QQQ8s")  # documents, blocks, where the index begins
_INDEX = np.dtype([("doc_id", "<i8"), ("named", "u1"), ("n", "<i8"), ("block", "<i8")])
_BLOCKS = np.dtype([("at", "<i8"), ("control", "<i8"), ("data", "<i8")])


def code(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of a row of ranks."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(size) // 4) * 4, np.uint8)
    padded[: len(size)] = size - 1
    control = padded.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    taken = np.arange(4, dtype=np.uint8) < size[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[taken].tobytes()


def decode(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The ranks of several documents in a row, by table lookup; ``counts``: ids of each."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)]
    groups = -(-counts // 4)
    ends = np.cumsum(groups)
    real = np.ones(lengths.size, bool)
    for spare in (1, 2, 3):  # the unused places in the last control byte of a document
        real[ends[(groups * 4 - counts >= spare) & (groups > 0)] * 4 - spare] = False
    size = lengths.ravel()[real]
    at = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        ranks[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


@dataclass(frozen=True)
class IdFiles:
    """Written files: where they lie, and (path, shard, docs, ids) of each."""

    folder: str
    dtype: str
    manifest: DataFrame


def frequencies(tokens: DataFrame, dtype: str) -> DataFrame:
    """(id, n) over all documents."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype)
            here = np.bincount(ids, minlength=len(total))
            here[: len(total)] += total
            total = here
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    return tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _ranges(tokens: DataFrame, total: int) -> tuple[int, np.ndarray]:
    """How many files, and the last doc_id of each but the last: ranges of about as many documents.

    Reads the ids of the documents alone, where a range exchange would code all of them twice.
    """
    files = max(1, -(-total // FILE_IDS))
    shares = [k / files for k in range(1, files)]
    bounds = tokens.stat.approxQuantile("doc_id", shares, 0.25 / files) if shares else []
    return files, np.unique(np.array(bounds, np.int64))


def write(docs: DataFrame, vocabulary: str, end_id: int, folder: str) -> IdFiles:
    """Encode all texts and write their ids in ascending order of doc_id.

    A null text is empty (one id, the end). Null doc_ids come first; equal ones stay beside each
    other in any order. Other columns are ignored. An empty table gives no file.
    """
    spark = docs.sparkSession
    dtype = id_type(vocabulary)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tokens = written(token_table(docs, vocabulary, end_id), "ids")
    # One row per id of the vocabulary at most.
    counted = frequencies(tokens, dtype).orderBy(F.desc("n"), "id").collect()
    by_rank = np.array([r["id"] for r in counted], np.int64)
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    files, bounds = _ranges(tokens, sum(r["n"] for r in counted))
    store, root = file_system(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/ranks", compression=None) as f:
        f.write(by_rank.astype("<u4").tobytes())
    ranks = spark.sparkContext.broadcast(rank_of)

    @lean
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [code(ranks.value[np.frombuffer(x, dtype)]) for x in batch.column(1).to_pylist()]
            file = np.searchsorted(bounds, batch.column(0).fill_null(-1 << 63).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([c for c, _ in pairs], pa.binary()),
                    pa.array([d for _, d in pairs], pa.binary()),
                    pa.array(file.astype(np.int32)),
                ],
                ["doc_id", "n", "control", "data", "file"],
            )

    @lean
    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        path = f"{folder}/{shard:08d}-{uuid4().hex}.ids"
        docs_in, ids_in = _write_file(path, batches)
        if docs_in:
            yield pa.RecordBatch.from_pylist(
                [{"path": path, "shard": shard, "docs": docs_in, "ids": ids_in}]
            )

    saved = (
        tokens.mapInArrow(coded, "doc_id long, n long, control binary, data binary, file int")
        .repartitionById(files, F.col("file"))
        .drop("file")
        .sortWithinPartitions("doc_id")
        .mapInArrow(save, "path string, shard long, docs long, ids long")
    )
    return IdFiles(folder, dtype, written(saved, "manifest"))


def _write_file(path: str, batches: Iterator[pa.RecordBatch]) -> tuple[int, int]:
    """Write one file as its documents arrive; (documents, ids). No document: no file."""
    index: list[np.ndarray] = []
    blocks: list[tuple[int, int, int]] = []
    control: list[bytes] = []
    data: list[bytes] = []
    held = at = 0
    out = None
    for batch in batches:
        if out is None:
            store, root = file_system(path)
            out = store.open_output_stream(root, compression=None)
            out.write(MAGIC)
            at = len(MAGIC)
        rows = np.zeros(batch.num_rows, _INDEX)
        rows["doc_id"] = batch.column(0).fill_null(0).to_numpy()
        rows["named"] = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        rows["n"] = batch.column(1).to_numpy()
        for k, (n, c, d) in enumerate(
            zip(rows["n"].tolist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())
        ):
            rows["block"][k] = len(blocks)
            control.append(c)
            data.append(d)
            held += n
            if held >= BLOCK_IDS:
                at, held = _write_block(out, at, control, data, blocks), 0
        index.append(rows)
    if out is None:
        return 0, 0
    if control:
        at = _write_block(out, at, control, data, blocks)
    rows = np.concatenate(index)
    out.write(rows.tobytes())
    out.write(np.array(blocks, _BLOCKS).tobytes())
    out.write(_FOOTER.pack(len(rows), len(blocks), at, MAGIC))
    out.close()
    return len(rows), int(rows["n"].sum())


def _write_block(out, at: int, control: list, data: list, blocks: list) -> int:
    c, d = b"".join(control), b"".join(data)
    control.clear()
    data.clear()
    blocks.append((at, len(c), len(d)))
    out.write(c)
    out.write(d)
    return at + len(c) + len(d)


def read_file(path: str, by_rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Block by block: (doc_ids, which of them are not null, ids of each, all ids in a row)."""
    store, root = file_system(path)
    with store.open_input_file(root) as f:
        size = f.size()
        docs, n_blocks, at, magic = _FOOTER.unpack(f.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no file of ids")
        rows = np.frombuffer(f.read_at(docs * _INDEX.itemsize, at), _INDEX)
        where = f.read_at(n_blocks * _BLOCKS.itemsize, at + docs * _INDEX.itemsize)
        bounds = np.searchsorted(rows["block"], np.arange(n_blocks + 1))
        for k, block in enumerate(np.frombuffer(where, _BLOCKS)):
            begin, c, d = block.tolist()
            raw = f.read_at(c + d, begin)
            own = rows[bounds[k] : bounds[k + 1]]
            ids = by_rank[decode(raw[:c], raw[c:], own["n"])]
            yield own["doc_id"], own["named"].astype(bool), own["n"], ids


def read(spark: SparkSession, files: IdFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    ``start`` counts the ids of all documents before it; the checksum is of its ids as
    little-endian unsigned 32-bit integers.
    """
    folder = files.folder
    # One row per file: running totals of a file list, not of the documents.
    before = F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")
    listed = files.manifest.withColumn("base", before).select("path", "base")

    @lean
    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        with store.open_input_file(f"{root}/ranks") as f:
            by_rank = np.frombuffer(f.read(), "<u4")
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for doc_ids, named, n, ids in read_file(path, by_rank):
                    ends = np.cumsum(n)
                    cut = [0, *ends.tolist()]
                    sums = [zlib.crc32(ids[a:b]) for a, b in zip(cut, cut[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, mask=~named),
                            pa.array(base + ends - n),
                            pa.array(n),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    base += int(n.sum())

    return spread(listed, "path").mapInArrow(
        load, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
