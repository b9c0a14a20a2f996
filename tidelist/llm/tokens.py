"""Token ids of whole texts by the tokenizers library, one encoding per distinct word.

The normaliser and the pre-tokeniser of the vocabulary drop white space and no piece crosses it,
nor the place between a letter and an ASCII mark or digit behind it. So the ids of a text are the
ids of its words (split at ASCII white space and at such places) in a row. A batch is split and
its distinct words numbered by Arrow; a worker keeps the ids of words it has met and asks the
library for all new ones at once; numpy then lays the ids of all words in a row.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidelist.llm.common import lean

SEPARATOR = "|"  # words that hold it are encoded one by one
KEPT_WORDS = 500_000  # per generation; two generations are kept
LONGEST_KEPT = 48  # bytes; longer words are encoded each time
AT_ONCE = 400  # words joined into one string for the library
# Letters of Latin-1: normalising leaves them as they are and each has one lower-case letter. (A
# letter whose lower case ends in a combining mark would make one piece with a mark behind it.)
LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _plain(definition: bytes) -> bytes:
    """The definition for words of lower-case letters: not normalised, parted at spaces.

    A pattern that takes letters in a row leaves such words whole, but takes longer.
    """
    plain = json.loads(definition) | {"normalizer": None}
    steps = (plain["pre_tokenizer"] or {}).get("pretokenizers") or []
    if [s["type"] for s in steps] == ["Split", "ByteLevel"]:
        steps[0] = {"type": "WhitespaceSplit"}
    return json.dumps(plain).encode()


class WordEncoder:
    """Ids of texts as little-endian integers of ``dtype``."""

    def __init__(self, definition: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(definition)
        self.plain = Tokenizer.from_buffer(_plain(definition))  # for lower-case letters of Latin-1
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        alone = self._ids(SEPARATOR)
        # What follows a letter within an added token, as in <|end|>, does not end a word.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        inner = {b for t in added for a, b in zip(t, t[1:]) if a.isalpha()}
        marks = [c for c in map(chr, range(33, 127)) if not c.isalpha() and c not in inner]
        self.ending = f"({LETTER})([{''.join(map(re.escape, marks))}])"
        self.separator = alone[0] if len(alone) == 1 else None
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        self.closing[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.young: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _alone(self, word: bytes) -> bytes:
        return np.asarray(self._ids(word.decode("utf-8", "replace")), self.dtype).tobytes()

    def _joined(self, words: list[bytes], letters: bool) -> Iterator[bytes]:
        """Ids of words in a row, many from one call, cut behind pieces' ends or at the separator."""
        by = self.plain if letters else self.tokenizer
        glue = b" " if letters else f" {SEPARATOR} ".encode()
        width = self.dtype.itemsize
        for i in range(0, len(words), AT_ONCE):
            some = words[i : i + AT_ONCE]
            text = glue.join(some).decode("utf-8", "replace")
            found = by.encode_batch_fast([text.lower() if letters else text], add_special_tokens=False)
            ids = np.asarray(found[0].ids, self.dtype)
            cuts = np.flatnonzero(self.closing[ids] if letters else ids == self.separator)
            if letters:
                starts, ends = np.concatenate([[0], cuts[:-1] + 1]), cuts + 1
            else:
                starts, ends = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(ids)]])
            if len(starts) != len(some) or (len(ends) and ends[-1] != len(ids)):
                yield from map(self._alone, some)
                continue
            raw = ids.tobytes()
            yield from [raw[a:b] for a, b in zip((starts * width).tolist(), (ends * width).tolist())]

    def _learn(self, new: list[bytes]) -> list[bytes]:
        """Ids of words that are not in the young generation; short ones are kept."""
        if len(self.young) > KEPT_WORDS:
            self.old, self.young = self.young, {b"": b""}
        ids: list = list(map(self.old.get, new)) if self.old else [None] * len(new)
        letters, mixed, alone = [], [], []  # places in ``new``
        for k, word in enumerate(new):
            if ids[k] is not None:
                continue
            if len(word) > LONGEST_KEPT or self.separator is None:
                alone.append(k)
            elif word.isalpha() or LETTERS.fullmatch(word):  # the first knows ASCII only, but is quick
                letters.append(k)
            elif b"|" in word:
                alone.append(k)
            else:
                mixed.append(k)
        for places, by_letters in ((letters, True), (mixed, False)):
            for k, found in zip(places, self._joined([new[k] for k in places], by_letters)):
                ids[k] = found
        for k in alone:
            ids[k] = self._alone(new[k])
        self.young.update(zip(new, ids))
        for k in alone:
            if len(new[k]) > LONGEST_KEPT:
                del self.young[new[k]]
        return ids

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids begin and end) of an Arrow column.

        A null text has no ids.
        """
        apart = pc.replace_substring_regex(pc.fill_null(texts, ""), self.ending, r"\1 \2")
        split = pc.ascii_split_whitespace(apart)
        bounds = split.offsets.to_numpy()
        coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.young.get, words))
        if None in ids:
            new = [k for k, i in enumerate(ids) if i is None]
            for k, found in zip(new, self._learn([words[k] for k in new])):
                ids[k] = found
        laid = pa.array(ids, pa.binary()).take(coded.indices)  # their bytes are all ids in a row
        offsets = np.frombuffer(laid.buffers()[1], "<i4", len(laid) + 1, laid.offset * 4)
        every = np.frombuffer(laid.buffers()[2] or b"", self.dtype)
        first = offsets[0] // self.dtype.itemsize
        ends = offsets.astype(np.int64) // self.dtype.itemsize - first
        return every[first : first + ends[-1]], ends[bounds]


_ENCODERS: dict[int, WordEncoder] = {}


def encoder(definition: bytes) -> WordEncoder:
    """The encoder of this worker process, made once."""
    key = hash(definition)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(definition)
    return _ENCODERS[key]


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with one more id behind each text."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


def binaries(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Each text's ids as one binary value."""
    width = ids.dtype.itemsize
    offsets = pa.py_buffer((bounds * width).astype("<i4").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(ids.tobytes())])


class Frequencies:
    """In how many of the documents that were added each id occurs; ends are not counted."""

    def __init__(self):
        self.total = np.zeros(np.iinfo(np.uint16).max + 1, np.int64)

    def add(self, ids: np.ndarray, bounds: np.ndarray) -> None:
        """Documents with their ends, as :func:`with_end` gives them."""
        ids = ids.astype(np.intp)
        if len(ids) and (highest := int(ids.max())) >= len(self.total):
            self.total = np.append(self.total, np.zeros(highest + 1 - len(self.total), np.int64))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            self.total[ids[a : b - 1]] += 1  # once for each distinct id

    def raw(self) -> bytes:
        """The ids that occur, then their counts, as integers of 64 bits."""
        seen = np.flatnonzero(self.total)
        return np.concatenate([seen, self.total[seen]]).astype("<i8").tobytes()


def token_table(
    docs: DataFrame, path: str, end_id: int, key: str = "doc_id", counted: bool = False
) -> DataFrame:
    """(key, ids, n): each document's ids as little-endian integers and how many there are.

    A null text is empty; ``end_id`` is appended to every document. ``path`` is the vocabulary
    file; its content (bounded by the vocabulary) travels to the tasks. ``ids`` holds 16-bit
    numbers for vocabularies of up to 65,536 ids, else 32-bit numbers. With ``counted`` a column
    ``counts`` follows; it is null but in one more row of each task, which has the document
    frequencies in that task and null for ``n``.
    """
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "ids", "n"] + ["counts"] * counted

    @lean
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = encoder(shared.value)
        frequencies, columns = Frequencies(), []
        for batch in batches:
            ids, bounds = with_end(*by.encode(batch.column(1)), end_id)
            columns = [batch.column(0), binaries(ids, bounds), pa.array(np.diff(bounds), pa.int64())]
            if counted:
                frequencies.add(ids, bounds)
                columns.append(pa.nulls(len(bounds) - 1, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)
        if counted and columns:
            empty = [pa.nulls(1, column.type) for column in columns[:-1]]
            yield pa.RecordBatch.from_arrays([*empty, pa.array([frequencies.raw()], pa.binary())], names)

    schema = f"{key} {kind}, ids binary, n long" + (", counts binary" if counted else "")
    return docs.select(key, "text").mapInArrow(encode, schema)


def id_type(path: str) -> str:
    """The numpy type of ``ids`` for this vocabulary."""
    from tokenizers import Tokenizer

    highest = max(Tokenizer.from_file(path).get_vocab().values())
    return "<u2" if highest < 1 << 16 else "<u4"
