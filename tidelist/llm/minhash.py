"""Near-duplicate documents by b-bit MinHash.

Each document's set of word shingles gets PERMUTATIONS minima. Bands of ROWS full minima propose
candidates; of each minimum the low BITS bits are kept, packed into longs, and the similarity of a
candidate pair is estimated by counting differing places, corrected for places that agree by
chance. What may reach the threshold is confirmed on the full sets.

Documents with equal sets are one class from the start. In a bucket, every class is first compared
with the bucket's smallest one, which joins large groups of near copies with as many pairs as
members. Only where a bucket still holds several components, its members are compared with each
other, in blocks of bounded size, by longer signatures of single bits, which tell what may be
linked much more sharply. No link between different sets is lost beyond the chance of the bands,
(1 - s^ROWS)^BANDS = 5e-8 at s = 0.8, and of the margins of the estimates.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelist.llm import words
from tidelist.llm.common import discard, lean, mix64, written
from tidelist.llm.components import components

SHINGLE = 5
THRESHOLD = 80  # per cent
BANDS, ROWS = 32, 4
PERMUTATIONS = BANDS * ROWS
BITS = 4
LONGS = PERMUTATIONS * BITS // 64
MARGIN = 0.16  # over four standard errors of the estimate at 0.8
FINE = 1024  # minima of which one bit is kept, where members of a bucket are compared
FINE_MARGIN = 0.085  # likewise
BLOCK = 1000  # members of a bucket that are compared at once
_NIBBLES = 0x1111111111111111


@lru_cache
def _constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, np.uint64)


def shingle_sets(texts, size: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted; fewer words than ``size`` are one shingle."""
    coded, bounds = words.split(texts, lower=True)
    word = words.hashes(coded)
    factor = words.powers(size)
    whole = np.zeros(max(len(word) - size + 1, 0), np.uint64)
    for k in range(size):
        whole += word[k : k + len(whole)] * factor[k]
    whole = mix64(whole)
    sets = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            short = (word[a:b] * factor[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(mix64(np.array([short])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minima(shingles: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """That many minima of a set that is not empty."""
    a = _constants(permutations, 7).astype(np.uint32)[:, None] | np.uint32(1)
    b = (_constants(permutations, 8) >> np.uint64(20)).astype(np.uint32)[:, None]
    low = shingles.astype(np.uint32)
    found = np.full(permutations, 0xFFFFFFFF, np.uint32)
    step = 262_144 // permutations
    for i in range(0, len(low), step):
        np.minimum(found, (a * low[None, i : i + step] + b).min(axis=1), out=found)
    return found


def packed(signature: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The low bits of each minimum, in longs; not the lowest, which is that of few products."""
    low = (signature >> np.uint32(8) & np.uint32((1 << bits) - 1)).astype(np.uint64)
    low = low.reshape(len(low) * bits // 64, -1)
    shift = np.arange(low.shape[1], dtype=np.uint64) * np.uint64(bits)
    return np.bitwise_or.reduce(low << shift, axis=1).view(np.int64)


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(BANDS, ROWS).astype(np.uint64)
    return mix64((rows * words.powers(ROWS, 0xC2B2AE3D27D4EB4F)).sum(axis=1, dtype=np.uint64)).view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, set_key, bits, bands): empty sets have no key, bits or bands."""
    from xxhash import xxh3_128_digest

    @lean
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            sets = shingle_sets(batch.column(1), size)
            rows = [minima(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([None if r is None else packed(r) for r in rows], longs),
                    pa.array([None if r is None else band_keys(r) for r in rows], longs),
                ],
                ["doc_id", "n", "set_key", "bits", "bands"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        sign, "doc_id long, n long, set_key binary, bits array<long>, bands array<long>"
    )


def _differing(left: str, right: str) -> Column:
    """Places in which two packed signatures differ."""
    counts = []
    for i in range(LONGS):
        x = F.col(left)[i].bitwiseXOR(F.col(right)[i])
        for shift in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        counts.append(F.bit_count(x.bitwiseAND(F.lit(_NIBBLES))))
    return reduce(lambda a, b: a + b, counts)


def estimate(differing, permutations: int = PERMUTATIONS, bits: int = BITS):
    """The similarity, given the places that differ: chance agreement is taken off."""
    chance = 2.0**-bits
    return ((1 - differing / permutations) - chance) / (1 - chance)


def _may_link(threshold: int) -> Column:
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold
    return sizes & (estimate(_differing("bits_a", "bits_b")) >= threshold / 100 - MARGIN)


def _side(classes: DataFrame, side: str) -> DataFrame:
    return classes.select(*(F.col(c).alias(f"{c}_{side}" if c != "rep" else side) for c in ("rep", "n", "bits")))


def _sets(docs: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """(id, n, hashes, fine): the full sets and the fine signatures of the documents ``needed``.

    The join is a merge join at every size: the number of documents needed has no bound.
    """
    texts = docs.select("doc_id", "text").join(
        needed.hint("merge"), F.col("doc_id") == F.col("id"), "left_semi"
    )

    @lean
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([packed(minima(s, FINE), 1) for s in sets], pa.list_(pa.int64())),
                ],
                ["id", "n", "hashes", "fine"],
            )

    schema = "id long, n long, hashes binary, fine array<long>"
    # An id that several rows share has one text.
    return written(texts.mapInArrow(listed, schema).dropDuplicates(["id"]), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as asked."""

    @lean
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    whole = (
        pairs.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("of_b")), "b")
        .join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("of_a")), "a")
        .select("a", "b", "of_a", "of_b")
    )
    return whole.mapInArrow(confirm, "a long, b long")


def _open(members: DataFrame) -> DataFrame:
    """Members (band, key, rep, component) of buckets with several components, and ``blocks``."""
    counted = members.groupBy("band", "key").agg(
        F.count("*").alias("m"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    several = counted.where(F.col("low") < F.col("high")).select(
        "band", "key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")
    )
    return members.join(several, ["band", "key"])


def _within_buckets(members: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of different components in a bucket that may be linked.

    From (band, key, blocks, rep, component, n, fine, bands). Members of a bucket are dealt by
    hash to blocks of about BLOCK rows, and every two blocks are compared, so the work of a task
    is bounded and large buckets spread. A pair comes from the first of the buckets it shares.
    """
    dealt = (
        members.withColumn("own", F.pmod(F.hash("rep"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            (F.col("own") <= F.col("other")).alias("left"), "rep", "component", "n", "fine", "bands",
        )
    )
    keys = ["band", "key", "i", "j"]
    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys)

    @lean
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part])
            cut = _last_group(rest, keys)
            if cut:
                yield _compared(rest.slice(0, cut).combine_chunks(), keys, threshold)
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield _compared(rest.combine_chunks(), keys, threshold)

    return ordered.mapInArrow(compare, "a long, b long")


def _codes(table: pa.Table, keys: list[str]) -> np.ndarray:
    return np.stack([table[k].to_numpy() for k in keys], axis=1)


def _last_group(table: pa.Table, keys: list[str]) -> int:
    """Where the last group of sorted rows begins."""
    codes = _codes(table, keys)
    return int(np.flatnonzero((codes != codes[-1]).any(axis=1)).max(initial=-1)) + 1


def _compared(table: pa.Table, keys: list[str], threshold: int) -> pa.RecordBatch:
    codes = _codes(table, keys)
    edge = np.flatnonzero((codes[1:] != codes[:-1]).any(axis=1)) + 1
    bounds = [0, *edge.tolist(), len(codes)]
    rep, component, n = (table[c].to_numpy() for c in ("rep", "component", "n"))
    left = table["left"].to_numpy().astype(bool)
    bits = table["fine"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(rep), -1)
    bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
    least = threshold / 100 - FINE_MARGIN
    one, two = [], []
    for a, b in zip(bounds, bounds[1:]):
        same = codes[a, 2] == codes[a, 3]
        rows = np.arange(a, b)
        these, those = (rows, rows) if same else (rows[left[a:b]], rows[~left[a:b]])
        for x in these.tolist():
            some = those[those > x] if same else those
            size = np.minimum(n[some], n[x]) * 100 >= np.maximum(n[some], n[x]) * threshold
            some = some[size & (component[some] != component[x])]
            if not len(some):
                continue
            differ = np.bitwise_count(bits[some] ^ bits[x]).sum(axis=1, dtype=np.int64)
            near = some[estimate(differ, FINE, 1) >= least]
            near = near[(bands[near] == bands[x]).argmax(axis=1) == codes[a, 0]]
            one += np.minimum(rep[near], rep[x]).tolist()
            two += np.maximum(rep[near], rep[x]).tolist()
    return pa.RecordBatch.from_pydict({"a": pa.array(one, pa.int64()), "b": pa.array(two, pa.int64())})


def near_duplicates(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Linked are documents with 100 * intersection >= threshold * union of their sets of
    ``size``-word shingles (A-Z lower-cased). ``component_id`` is the smallest doc_id reachable,
    ``kept`` tells whether it is the document's own. A null or blank text has no shingle and is
    linked with nothing. A null doc_id takes no part: its component is null and it is kept.
    Repeated rows get equal results. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(signatures(docs, size), "signatures")
    named = signed.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    classes = named.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"),
        F.first("n").alias("n"),
        F.first("bits").alias("bits"),
        F.first("bands").alias("bands"),
    )
    classes = written(classes, "classes")
    placed = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    pivots = (
        placed.groupBy("band", "key")
        .agg(F.min("rep").alias("a"), F.max("rep").alias("last"))
        .where(F.col("a") < F.col("last"))
        .drop("last")
    )
    shared = written(placed.join(pivots, ["band", "key"]), "buckets")
    proposed = shared.where(F.col("rep") != F.col("a")).select("a", F.col("rep").alias("b")).distinct()

    def likely(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(_side(classes, "a"), "a")
            .join(_side(classes, "b"), "b")
            .where(_may_link(threshold))
            .select("a", "b")
        )

    sets = _sets(docs, shared.select(F.col("rep").alias("id")).distinct(), size)
    pairs = written(likely(proposed), "pairs")
    stars = written(_confirmed(pairs, sets, threshold), "links")
    discard(pairs)
    reached = components(stars)

    members = (
        shared.select("band", "key", "rep")
        .join(reached.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    open_ = written(_open(members), "open")
    discard(shared)
    if not open_.isEmpty():
        signed_sets = sets.select(F.col("id").alias("rep"), "n", "fine")
        compared = open_.join(signed_sets, "rep").join(classes.select("rep", "bands"), "rep")
        left = written(_within_buckets(compared, threshold), "pairs")
        more = written(_confirmed(left, sets, threshold), "links")
        discard(left)
        reached = components(stars.unionByName(more))
    discard(sets, open_)

    of_set = (
        classes.select("set_key", "rep")
        .join(reached.withColumnRenamed("node", "rep"), "rep", "left")
        .select("set_key", F.coalesce("component", "rep").alias("component_id"))
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        signed.select("doc_id", "n", "set_key")
        .join(of_set, "set_key", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
