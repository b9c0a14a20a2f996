"""Byte context trees of several classes: variable-order models with escape probabilities.

Prediction by partial matching, method C, without exclusions: in a context seen ``t`` times with
``q`` different next bytes, a byte seen ``n`` times costs -log2(n / (t + q)) bits, and an escape
to the next shorter context -log2(q / (t + q)). A context that a class has never seen costs it
nothing; below the empty context, each byte costs 8 bits.

The statistics are frozen after fitting, so the cost of a byte depends on itself and at most
``order`` bytes before it. The costs of all grams met in fitting are computed once, for all
classes, and put into hash tables that numpy probes for a whole batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelist.llm.common import batches as arrow_batches
from tidelist.llm.common import byte_texts, lean

START = 10  # texts are read as if line ends stood before them
BYTES_AT_ONCE = 1 << 20
GRAMS_HELD = 1 << 21  # by a task that counts, before it passes them on
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class HashTable:
    """Rows of unsigned numbers; open addressing, all queries probed at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.mask = (1 << self.bits) - 1
        self.row = np.full(1 << self.bits, -1, np.int32)
        self.key = np.zeros(1 << self.bits, keys.dtype)
        rest, slot = np.arange(len(keys)), self._slots(keys)
        while len(rest):
            free = self.row[slot] < 0
            at, first = np.unique(slot[free], return_index=True)
            placed = rest[free][first]
            self.row[at], self.key[at] = placed, keys[placed]
            left = self.row[slot] != rest
            rest, slot = rest[left], (slot[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        scrambled = keys.astype(np.uint64) * _MULTIPLIER
        return (scrambled >> np.uint64(64 - self.bits)).astype(np.int64)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where it has none."""
        slot = self._slots(keys)
        found = self.row[slot]
        wrong = np.flatnonzero((found >= 0) & (self.key[slot] != keys))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & self.mask
            row = self.row[slot[wrong]]
            found[wrong] = row
            wrong = wrong[(row >= 0) & (self.key[slot[wrong]] != keys[wrong])]
        return found


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes that end at each place, as one number, the first byte highest."""
    kind = np.uint32 if size <= 4 else np.uint64
    out = np.zeros(len(data), kind)
    for back in range(size):
        part = data.astype(kind) << kind(8 * back)
        out[back:] |= part[: len(data) - back]
    return out


def laid_out(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in a row, each after ``order`` starting bytes; where each begins and ends."""
    lead = bytes([START]) * order
    data = np.frombuffer(lead + lead.join(texts), np.uint8) if texts else np.zeros(0, np.uint8)
    length = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(length + order)
    return data, ends - length, ends


@dataclass
class Model:
    """Costs in bits by gram, and by context of an escape; one column per class."""

    classes: list
    order: int
    grams: list[HashTable]  # by size, from 1
    cost: list[np.ndarray]
    contexts: list[HashTable]  # by size, from 0
    escape: list[np.ndarray]

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """The code length of each text under each class."""
        total = np.zeros((len(texts), len(self.classes)))
        group: list[int] = []
        held = 0
        for i, text in enumerate(texts):
            for part in range(0, max(len(text), 1), BYTES_AT_ONCE):  # long texts piece by piece
                if part or len(text) > BYTES_AT_ONCE:
                    begin = max(part - self.order, 0)
                    piece = text[begin : part + BYTES_AT_ONCE]
                    total[i] += self._costs([piece], part - begin)[0]
            if len(text) <= BYTES_AT_ONCE:
                group.append(i)
                held += len(text)
            if held >= BYTES_AT_ONCE:
                total[group] = self._costs([texts[j] for j in group])
                group, held = [], 0
        if group:
            total[group] = self._costs([texts[j] for j in group])
        return total

    def _costs(self, texts: list[bytes], known: int = 0) -> np.ndarray:
        """``known``: bytes at the start of the one text that are context only."""
        data, begin, end = laid_out(texts, self.order)
        counted = np.zeros(len(data), bool)
        for a, b in zip((begin + known).tolist(), end.tolist()):
            counted[a:b] = True
        cost = np.zeros((len(data), len(self.classes)), np.float32)
        open_ = np.flatnonzero(counted)
        key = grams(data, self.order + 1)
        for size in range(self.order + 1, 0, -1):
            own = key[open_] & key.dtype.type((1 << 8 * size) - 1)
            row = self.grams[size - 1].rows(own)
            hit = row >= 0
            cost[open_[hit]] += self.cost[size - 1][row[hit]]
            open_, own = open_[~hit], own[~hit]
            if not len(open_):
                break
            row = self.contexts[size - 1].rows(own >> own.dtype.type(8))
            hit = row >= 0
            cost[open_[hit]] += self.escape[size - 1][row[hit]]
        cost[open_] += 8
        sums = np.concatenate([np.zeros((1, cost.shape[1])), np.cumsum(cost, axis=0, dtype=np.float64)])
        return sums[end] - sums[begin]


def _pieces(texts: list[bytes], order: int) -> Iterator[list[bytes]]:
    """Texts, long ones in pieces, each after the ``order`` bytes before it; some at a time."""
    lead = bytes([START]) * order
    group: list[bytes] = []
    held = 0
    for text in texts:
        for part in range(0, len(text), BYTES_AT_ONCE):
            before = (lead + text[max(part - order, 0) : part])[-order:] if order else b""
            group.append(before + text[part : part + BYTES_AT_ONCE])
            held += len(group[-1])
            if held >= BYTES_AT_ONCE:
                yield group
                group, held = [], 0
    if group:
        yield group


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One count per key, keys ascending."""
    keys, of = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, of, np.concatenate([n for _, n in found]))
    return keys, counts


def tally(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of ``order + 1`` bytes that end at the bytes of the texts, and how many of each."""
    found = [(grams(np.zeros(0, np.uint8), order + 1), np.zeros(0, np.int64))]
    for pieces in _pieces(texts, order):
        data = np.frombuffer(b"".join(pieces), np.uint8)
        counted = np.ones(len(data), bool)
        starts = np.cumsum([0] + [len(p) for p in pieces[:-1]])
        for back in range(order):
            counted[starts + back] = False
        found.append(np.unique(grams(data, order + 1)[counted], return_counts=True))
    return _merged(found)


def learnt(texts: DataFrame, order: int, classes: list[str] | None = None) -> Model | None:
    """A model from all rows of (kind, text), neither null; None if there is no byte to learn from.

    Grams are counted where texts are read and summed by Spark. The driver gets each different
    gram of a class once: their number follows the alphabets, not the number of texts.
    """

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
        held: dict[str, list] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for kind, (keys, counts) in held.items():
                for i in range(0, len(keys), 1 << 16):
                    part = keys[i : i + (1 << 16)].astype(np.uint64).view(np.int64)
                    rows = {"kind": [kind] * len(part), "gram": part, "n": counts[i : i + (1 << 16)]}
                    yield from arrow_batches(rows, schema)
            held.clear()

        for batch in batches:
            of: dict[str, list[bytes]] = {}
            for kind, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
                of.setdefault(kind, []).append(text)
            for kind, own in of.items():
                found = tally(own, order)
                held[kind] = _merged([held[kind], found]) if kind in held else found
            if sum(len(keys) for keys, _ in held.values()) > GRAMS_HELD:
                yield from passed_on()
        yield from passed_on()

    counted = texts.select("kind", "text").mapInArrow(count, "kind string, gram long, n long")
    table = counted.groupBy("kind", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not table.num_rows:
        return None
    names = np.array(table["kind"].to_pylist())
    keys = table["gram"].to_numpy().view(np.uint64).astype(grams(np.zeros(0, np.uint8), order + 1).dtype)
    counts = table["n"].to_numpy()
    kinds = sorted(set(classes) if classes else set(names.tolist()))
    return fit_counts({k: (keys[names == k], counts[names == k]) for k in kinds}, order)


def fit(samples: dict, order: int) -> Model:
    """A model of each class from its sample texts (bytes), in the order of the classes."""
    return fit_counts({name: tally(texts, order) for name, texts in samples.items()}, order)


def fit_counts(counts: dict, order: int) -> Model:
    """A model of each class from its grams of ``order + 1`` bytes and their counts."""
    classes = sorted(counts)
    model = Model(classes, order, [], [], [], [])
    shorter_keys, shorter_cost = None, np.full((1, len(classes)), 8.0)
    for size in range(1, order + 2):
        seen = []
        for name in classes:
            key, times = counts[name]
            seen.append(_merged([(key & key.dtype.type((1 << 8 * size) - 1), times)]))
        keys = np.unique(np.concatenate([k for k, _ in seen]))
        count = np.zeros((len(keys), len(classes)))
        for c, (k, n) in enumerate(seen):
            count[np.searchsorted(keys, k), c] = n
        context, of = np.unique(keys >> keys.dtype.type(8), return_inverse=True)
        times = np.zeros((len(context), len(classes)))
        kinds = np.zeros_like(times)
        np.add.at(times, of, count)
        np.add.at(kinds, of, count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(times > 0, np.log2((times + kinds) / kinds), 0.0)
            direct = np.log2((times + kinds)[of] / count)
        if shorter_keys is None:
            below = shorter_cost[np.zeros(len(keys), np.int64)]
        else:
            suffix = keys & keys.dtype.type((1 << 8 * (size - 1)) - 1)
            below = shorter_cost[np.searchsorted(shorter_keys, suffix)]
        cost = np.where(count > 0, direct, escape[of] + below)
        model.grams.append(HashTable(keys))
        model.cost.append(cost.astype(np.float32))
        model.contexts.append(HashTable(context))
        model.escape.append(escape.astype(np.float32))
        shorter_keys, shorter_cost = keys, cost
    return model
