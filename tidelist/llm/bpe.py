"""Byte-level BPE: encoding with offsets and decoding, from a file of byte ranks.

The ranks become merges of the tokenizers library: a token's merge is the pair that the merges of
smaller rank leave of its bytes. Whatever surrounds it, a token can only arise by that pair, so
the library gives the ids of the rank-based algorithm; a piece that is itself a token is that
token (``ignore_merges``). Bytes stand as printable characters in the library's vocabulary; the
table of those characters is reversed for decoding.

Texts are cut where no match of the pattern can go on: before a space behind a character that is
none, and behind a letter before an ASCII mark or line end. The library is asked once per distinct
part; numpy lays the ids in a row and finds their offsets from the lengths of the tokens.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelist.llm.common import lean

KEPT_PARTS = 500_000  # per generation; two generations are kept
LONGEST_KEPT = 48  # bytes; longer parts are encoded each time
AT_ONCE = 400  # parts joined into one string for the library
_BYTE = np.arange(256)
_PRINTED = (_BYTE > 32) & (_BYTE < 127)
_LETTER = np.isin(_BYTE, np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8))
_AFTER_LETTER = np.isin(_BYTE, np.frombuffer(b"\t\n\r!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8))
_TWO = (_BYTE >= 0xC3) & (_BYTE <= 0xDF)  # first bytes of two; none of these is white space


def byte_characters() -> list[str]:
    """The printable character that stands for each byte.

    Printable bytes of Latin-1 stand for themselves, the others for characters from U+0100 on.
    """
    own = [33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 for b in range(256)]
    shift = iter(range(256, 512))
    return [chr(b) if own[b] else chr(next(shift)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that a token's last merge joins, or None if merges don't lead to it."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        joined = [ranks.get(a + b, len(ranks) + 512) for a, b in zip(parts, parts[1:])]
        best = min(joined)
        if best >= ranks[token]:
            return None
        at = joined.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def definition(ranks: dict[bytes, int], pattern: str) -> str:
    """The tokenizers library's definition of the ranks; each match of ``pattern`` is a piece."""
    letters = byte_characters()
    say = lambda token: "".join(letters[b] for b in token)
    merges = [
        [say(pair[0]), say(pair[1])]
        for token in sorted(ranks, key=ranks.get)
        if len(token) > 1 and (pair := last_pair(token, ranks))
    ]
    return json.dumps(
        {
            "version": "1.0",
            "truncation": None,
            "padding": None,
            "added_tokens": [],
            "normalizer": None,
            "pre_tokenizer": {
                "type": "Sequence",
                "pretokenizers": [
                    {
                        "type": "Split",
                        "pattern": {"Regex": pattern},
                        "behavior": "Isolated",
                        "invert": False,
                    },
                    {
                        "type": "ByteLevel",
                        "add_prefix_space": False,
                        "trim_offsets": False,
                        "use_regex": False,
                    },
                ],
            },
            "post_processor": None,
            "decoder": {
                "type": "ByteLevel",
                "add_prefix_space": False,
                "trim_offsets": False,
                "use_regex": False,
            },
            "model": {
                "type": "BPE",
                "dropout": None,
                "unk_token": None,
                "continuing_subword_prefix": None,
                "end_of_word_suffix": None,
                "fuse_unk": False,
                "byte_fallback": False,
                "ignore_merges": True,
                "vocab": {say(token): rank for token, rank in ranks.items()},
                "merges": merges,
            },
        }
    )


class ByteTable:
    """The bytes of each id, for decoding whole columns at once."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.binary())

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each text whose ids lie between two bounds.

        An id may end within a character; only a text's bytes together are UTF-8.
        """
        laid = self.tokens.take(pa.array(ids))
        offsets = np.frombuffer(laid.buffers()[1], "<i4", len(laid) + 1, laid.offset * 4)
        raw = memoryview(laid.buffers()[2] or b"")
        cut = offsets[bounds].tolist()
        return [bytes(raw[a:b]) for a, b in zip(cut, cut[1:])]


def parts(data: np.ndarray) -> np.ndarray:
    """Where UTF-8 may be cut (places in order, neither its start nor its end)."""
    last, this = data[:-1], data[1:]
    two = np.zeros(len(last), bool)
    two[1:] = _TWO[last[:-1]] & (last[1:] >= 0x80)
    latin = np.zeros(len(last), bool)  # letters from U+00C0 to U+00FF, without the two signs
    latin[1:] = (last[:-1] == 0xC3) & (last[1:] != 0x97) & (last[1:] != 0xB7)
    before_space = (this == 32) & (_PRINTED[last] | two)
    return np.flatnonzero(before_space | (_AFTER_LETTER[this] & (_LETTER[last] | latin))) + 1


class TextEncoder:
    """Ids of texts, the library being asked once per distinct part."""

    def __init__(self, definition: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(definition)
        vocabulary = self.tokenizer.get_vocab()  # a character per byte
        self.length = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.length[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _ids(self, some: list[bytes]) -> list[np.ndarray]:
        texts = [x.decode() for x in some]
        return [np.asarray(e.ids, "<i4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of parts that are not in the young generation; short ones are kept."""
        if len(self.young) > KEPT_PARTS:
            self.old, self.young = self.young, {}
        found = {x: ids for x in new if (ids := self.old.get(x)) is not None} if self.old else {}
        rowed, alone = [], []
        for x in new:
            if x not in found:
                ends = _PRINTED[x[-1]] or len(x) > 2 and x[-1] >= 0x80 and _TWO[x[-2]]
                (rowed if x[0] == 32 and ends and len(x) <= LONGEST_KEPT else alone).append(x)
        for i in range(0, len(rowed), AT_ONCE):  # a row of such parts is cut between them as well
            some = rowed[i : i + AT_ONCE]
            ids = self._ids([b"".join(some)])[0]
            cut = np.searchsorted(np.cumsum(self.length[ids]), np.cumsum([len(x) for x in some])) + 1
            raw, cut = ids.tobytes(), (cut * 4).tolist()
            found.update(zip(some, [raw[a:b] for a, b in zip([0, *cut], cut)]))
        for i in range(0, len(alone), AT_ONCE):
            some = alone[i : i + AT_ONCE]
            found.update(zip(some, [ids.tobytes() for ids in self._ids(some)]))
        self.young.update((x, ids) for x, ids in found.items() if len(x) <= LONGEST_KEPT)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts in a row, bounds of each text's, UTF-8 of all texts, bounds of each)."""
        texts = texts.fill_null("").cast(pa.string())
        edges = np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, texts.offset * 4)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
        edges = (edges - edges[0]).astype(np.int64)
        cut = np.union1d(parts(data), edges) if len(data) else np.zeros(1, np.int64)
        buffers = [None, pa.py_buffer(cut.astype("<i4").tobytes()), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.binary(), len(cut) - 1, buffers).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.young.get, distinct))
        if None in ids:
            learnt = self._learn([x for x, i in zip(distinct, ids) if i is None])
            ids = [learnt[x] if i is None else i for x, i in zip(distinct, ids)]
        laid = pa.array(ids, pa.binary()).take(coded.indices)  # their bytes are all ids in a row
        ends = np.frombuffer(laid.buffers()[1], "<i4", len(laid) + 1, laid.offset * 4) // 4
        every = np.frombuffer(laid.buffers()[2] or b"", "<i4")[ends[0] : ends[-1]]
        return every, (ends - ends[0])[np.searchsorted(cut, edges)], data, edges

    def offsets(self, ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, edges: np.ndarray):
        """(starts, ends) of each id in characters of its text, of what :meth:`encode` gave."""
        begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters begun before
        after = np.cumsum(self.length[ids])
        base = np.repeat(begun[edges[:-1]], np.diff(bounds))
        starts = begun[after - self.length[ids] + 1] - 1 - base if len(ids) else after
        return starts.astype(np.int32), (begun[after] - base).astype(np.int32)


_MADE: dict[int, object] = {}


def _once(key: int, make):
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def _encoder(text: bytes) -> TextEncoder:
    return _once(hash(text), lambda: TextEncoder(text))


def encoded(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", offsets: bool = True
) -> DataFrame:
    """(key, ids array<int>[, starts array<int>, ends array<int>]) of each whole text.

    ``starts`` and ``ends`` are offsets in characters; of a character that is split over several
    ids, each of them has the whole character. A null text has no ids, an empty one neither.
    ``path`` holds base64 tokens and their ranks; their number bounds what travels to the tasks.
    No match of ``pattern`` may hold a space behind another character than white space, or an ASCII
    mark (the apostrophe aside), tab or line end behind a letter; those in use don't.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(definition(read_ranks(path), pattern).encode())
    kind = docs.schema[key].dataType.simpleString()

    @lean
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = _encoder(shared.value)
        for batch in batches:
            ids, bounds, data, edges = by.encode(batch.column(1))
            values = [ids, *(by.offsets(ids, bounds, data, edges) if offsets else [])]
            lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v)) for v in values]
            names = [key, "ids", "starts", "ends"][: len(lists) + 1]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names)

    more = ", starts array<int>, ends array<int>" if offsets else ""
    return docs.select(key, "text").mapInArrow(encode, f"{key} {kind}, ids array<int>{more}")


def decoded(rows: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, bytes binary): the bytes that the ids stand for; null ids give no bytes."""
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(path))
    kind = rows.schema[key].dataType.simpleString()

    @lean
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _once(hash(("bytes", path)), lambda: ByteTable(shared.value))
        for batch in batches:
            ids, bounds = flat(batch.column(1))
            texts = pa.array(table.decode(ids, bounds), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), texts], [key, "ids", "bytes"]
            )

    return rows.select(key, "ids").mapInArrow(decode, f"{key} {kind}, ids array<int>, bytes binary")


def flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column in a row, and the bounds of each list; null lists are empty."""
    values = lists.flatten().to_numpy(zero_copy_only=False)
    length = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return values, np.concatenate([[0], np.cumsum(length)]).astype(np.int64)


def text_of(data: bytes) -> str:
    """Decoded bytes as text; bytes that are no UTF-8 (a cut within a character) are replaced."""
    return data.decode("utf-8", "replace")


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, offsets_crc32) of encoding and decoding.

    ``offsets_crc32`` is of a text's starts and then its ends, as little-endian unsigned 32-bit
    integers. One row per row of ``docs``, repeated or null ids included; a null text is empty, and
    other columns are ignored. Ids are decoded where they were made, so no list of ids travels.
    """
    ranks = read_ranks(path)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((definition(ranks, pattern).encode(), ranks))
    kind = docs.schema["doc_id"].dataType.simpleString()

    @lean
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256
        from zlib import crc32

        text, of_bytes = shared.value
        by = _encoder(text)
        table = _once(hash(("bytes", path)), lambda: ByteTable(of_bytes))
        for batch in batches:
            ids, bounds, data, edges = by.encode(batch.column(1))
            starts, ends = by.offsets(ids, bounds, data, edges)
            raw = ids.astype("<u4")
            cut = bounds.tolist()
            own = list(zip(cut, cut[1:]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([sha256(raw[a:b]).hexdigest() for a, b in own], pa.string()),
                    pa.array([sha256(x).hexdigest() for x in table.decode(ids, bounds)], pa.string()),
                    pa.array([crc32(ends[a:b], crc32(starts[a:b])) for a, b in own], pa.int64()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "offsets_crc32"],
            )

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string, offsets_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(digest, f"doc_id {kind}, {columns}")
