"""Spelling variants: words one edit apart, by a trie of letter counts.

A word is represented by how many of its letters fall into each of GROUPS groups, and words are
arranged in a trie by these counts, one group per level. One inserted code point adds one to a
count (a surplus), one deleted takes one away (a deficit), one replaced does both at most. A
search walks the levels with a budget of one surplus and one deficit; the words at the leaves it
reaches are verified. It goes depth first over pieces of many queries at once, so that what waits
is bounded. A pair need only be found from one side, so a word looks for words that are not
shorter, and spends its deficit after its surplus only.

The trie is spread over the cluster: nodes of more than SHARD_WORDS words are its top, everything
below a smaller node is a shard. The same search on the top tells which shards a word must visit.
The top has about one node for each SHARD_WORDS words, and is all that reaches the driver. Words
that share all counts and are still too many for one shard are dealt into blocks, each of which
their queries visit; queries of a shard are dealt into blocks in any case.

At a leaf, a word is only compared with words that share its first or its last half: one edit
leaves one of them as it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelist.llm.common import byte_texts, lean, mix64, spread, written

GROUPS = 16
SHARD_WORDS = 1 << 16
QUERY_BLOCK = 1 << 16
PIECE = 1 << 16  # queries at nodes that are moved down together
WIDE = 48  # code points; pairs with a longer word are compared one by one
KEPT_WORDS = 300_000  # distinct words a task counts before it hands them on

# --- Words ------------------------------------------------------------------------------------

_LETTER = np.zeros(256, bool)
_LETTER[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)] = True
_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF in UTF-8, and of nothing else
_LETTER[_LEAD] = True


def runs(texts) -> tuple[pa.Array, np.ndarray]:
    """(runs of letters of all texts in a row, A-Z lower-cased; where each text's runs begin and end).

    Letters are A-Z, a-z and U+00C0 to U+00FF. A null text has none.
    """
    texts = pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    offsets = np.frombuffer(texts.buffers()[1], "<i8", len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    letter = _LETTER[data]
    letter[1:] |= data[:-1] == _LEAD
    blanked = pa.py_buffer(np.where(letter, data, 0x20).astype(np.uint8).tobytes())
    spaced = pa.Array.from_buffers(
        pa.large_string(), len(texts), [None, pa.py_buffer((offsets - offsets[0]).tobytes()), blanked]
    )
    lists = pc.ascii_split_whitespace(spaced)
    return lists.flatten(), lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()


def words(docs: DataFrame, least: int = 7, every: int = 31) -> DataFrame:
    """(word, n): letter runs of whole texts with planted misspellings, and how often they occur.

    A run whose crc32 of ``<doc_id>:<run>`` is a multiple of ``every`` loses the code point at that
    number modulo its length. Only results of ``least`` code points count. A null doc_id is an
    empty string there; repeated rows count again. Tasks hand on counts, so a frequent word is
    shuffled once per task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def hand_on() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            found, bounds = runs(batch.column(1))
            of = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            long = pc.greater_equal(pc.utf8_length(found), least).to_numpy(zero_copy_only=False)
            coded = found.filter(pa.array(long)).cast(pa.string()).dictionary_encode()
            texts = coded.dictionary.to_pylist()
            if not texts:
                continue
            both, times = np.unique(of[long] * len(texts) + coded.indices.to_numpy(), return_counts=True)
            document, word = np.divmod(both, len(texts))
            ids = batch.column(0).to_pylist()
            begun = [crc32(f"{'' if i is None else i}:".encode()) for i in ids]
            raw = byte_texts(coded.dictionary)
            check = np.fromiter((crc32(raw[w], begun[d]) for d, w in zip(document.tolist(), word.tolist())), np.int64, len(both))
            changed = check % every == 0
            whole = np.bincount(word[~changed], times[~changed], len(texts)).astype(np.int64)
            for w, n in zip(texts, whole.tolist()):
                if n:
                    held[w] = held.get(w, 0) + n
            for w, h, n in zip(word[changed].tolist(), check[changed].tolist(), times[changed].tolist()):
                text = texts[w]
                if len(text) > least:
                    at = h % len(text)
                    text = text[:at] + text[at + 1 :]
                    held[text] = held.get(text, 0) + n
            if len(held) > KEPT_WORDS:
                yield hand_on()
        if held:
            yield hand_on()

    counted = docs.select("doc_id", "text").mapInArrow(lean(count), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# --- The trie ---------------------------------------------------------------------------------


def counts_of(texts: list[str]) -> np.ndarray:
    """Word by group: how many code points are in it, 255 at most."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.repeat(np.arange(len(texts)), lengths) * GROUPS + points % GROUPS
    return np.minimum(np.bincount(at, minlength=len(texts) * GROUPS), 255).astype(np.uint8).reshape(-1, GROUPS)


class Trie:
    """Levels of (parent node * 256 + count) in ascending order; each leads to a node or a leaf."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.levels = levels  # keys, and what they lead to: a node of the next level or ~leaf

    @classmethod
    def of_vectors(cls, vectors: np.ndarray) -> tuple[Trie, np.ndarray]:
        """The trie of whole vectors, and the leaf of each."""
        distinct, leaf = np.unique(vectors, axis=0, return_inverse=True)
        node, levels = np.zeros(len(distinct), np.int64), []
        for level in range(GROUPS):
            keys, child = np.unique(node << 8 | distinct[:, level], return_inverse=True)
            last = level == GROUPS - 1
            levels.append((keys, ~np.arange(len(keys)) if last else np.arange(len(keys))))
            node = child.reshape(-1)
        return cls(levels), leaf.reshape(-1)

    @classmethod
    def of_prefixes(cls, leaves: dict[bytes, int]) -> Trie:
        """A trie whose leaves may end at any level; no leaf's prefix begins another's."""
        levels, nodes = [], {b"": 0}
        for level in range(GROUPS):
            own = sorted({p[: level + 1] for p in leaves if len(p) > level})
            inner = [p for p in own if p not in leaves]
            numbers = {p: i for i, p in enumerate(inner)}
            keys = np.array([nodes[p[:-1]] << 8 | p[-1] for p in own], np.int64)
            levels.append((keys, np.array([numbers.get(p, ~leaves.get(p, 0)) for p in own], np.int64)))
            nodes = numbers
            if not inner:
                break
        return cls(levels)

    def search(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(query, leaf, surplus, deficit) of what each vector reaches, piece by piece."""
        n = len(vectors)
        waiting = [
            (0, np.arange(i, min(i + PIECE, n)), *(np.zeros(min(PIECE, n - i), t) for t in (np.int64, np.int8, np.int8)))
            for i in range(0, n, PIECE)
        ]
        while waiting:
            level, query, node, surplus, deficit = waiting.pop()
            keys, leads = self.levels[level]
            own = vectors[query, level].astype(np.int64)
            found = []
            for delta in (0, 1, -1):
                if delta == 0:
                    may = np.arange(len(query))
                else:
                    may = surplus == 0 if delta > 0 else (surplus > deficit) & (own > 0)
                    may = np.flatnonzero(may & (own + delta < 256))
                wanted = node[may] << 8 | own[may] + delta
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit = keys[at] == wanted
                may, at = may[hit], at[hit]
                found.append((query[may], leads[at], surplus[may] + (delta > 0), deficit[may] + (delta < 0)))
            query, lead, surplus, deficit = (np.concatenate(x) for x in zip(*found))
            leaf = lead < 0
            if leaf.any():
                yield query[leaf], ~lead[leaf], surplus[leaf], deficit[leaf]
            rest = np.flatnonzero(~leaf)
            for i in range(0, len(rest), PIECE):
                some = rest[i : i + PIECE]
                waiting.append((level + 1, query[some], lead[some], surplus[some], deficit[some]))


# --- Search within a shard --------------------------------------------------------------------


def _key(leaf: np.ndarray, kind: int, part: np.ndarray) -> np.ndarray:
    return mix64(part.astype(np.uint64) ^ mix64(leaf.astype(np.uint64) * np.uint64(4) + np.uint64(kind)))


def _halves(texts: list[str], less: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first and of the last (length - less) // 2 code points."""
    cut = [(len(t) - less) // 2 for t in texts]
    first = np.fromiter((hash(t[:h]) for t, h in zip(texts, cut)), np.int64, len(texts))
    last = np.fromiter((hash(t[len(t) - h :]) for t, h in zip(texts, cut)), np.int64, len(texts))
    return first, last


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes one word of the other."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) > len(a) + 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _matrix(texts: list[str]) -> np.ndarray:
    return np.array([t[:WIDE] for t in texts], f"<U{WIDE}").view(np.uint32).reshape(len(texts), WIDE)


class Words:
    """Words of a shard (or block of it): their trie, and who is at a leaf with which half."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.trie, leaf = Trie.of_vectors(counts_of(texts))
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.matrix = _matrix(texts)
        # A word of the queries' length is posted by the halves of that length, a word that is one
        # longer by the halves that the shorter word has.
        same, longer = _halves(texts, 1), _halves(texts, 2)
        keys = np.concatenate([_key(leaf, i, part) for i, part in enumerate([*same, *longer])])
        order = np.argsort(keys, kind="stable")
        self.keys, self.posted = keys[order], order % len(texts)

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of pairs one edit apart, of which the word is not shorter.

        Of two words as long as each other, the one finds the other whose counts are larger in the
        first group in which they differ, or, if all counts are equal, which comes later.
        """
        vectors, halves = counts_of(queries), _halves(queries, 1)
        lengths = np.fromiter(map(len, queries), np.int64, len(queries))
        matrix = _matrix(queries)
        full = vectors.max(axis=1) >= 254  # counts may have been cut
        found = []
        for query, leaf, surplus, deficit in self.trie.search(vectors):
            pairs = []
            for kind in range(4):
                more = 1 if kind > 1 else 0
                may = (surplus.astype(int) - deficit == more) | full[query]
                q = query[may]
                wanted = _key(leaf[may], kind, halves[kind % 2][q])
                low = np.searchsorted(self.keys, wanted)
                some = np.flatnonzero(self.keys[np.minimum(low, len(self.keys) - 1)] == wanted)
                low, q = low[some], q[some]
                count = np.searchsorted(self.keys, wanted[some], "right") - low
                at = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
                q, w = np.repeat(q, count), self.posted[at]
                right = self.lengths[w] == lengths[q] + more
                if not more:
                    equal = np.flatnonzero(right & np.repeat(surplus[may][some] == 0, count))
                    right[equal] = [queries[i] < self.texts[j] for i, j in zip(q[equal].tolist(), w[equal].tolist())]
                pairs.append(q[right] * len(self.texts) + w[right])
            for both in np.array_split(np.unique(np.concatenate(pairs)), 1 + sum(map(len, pairs)) // PIECE):
                q, w = np.divmod(both, len(self.texts))
                is_near = self._verified(matrix[q], self.matrix[w], lengths[q], self.lengths[w])
                for i in np.flatnonzero(self.lengths[w] > WIDE).tolist():
                    is_near[i] = one_edit(queries[q[i]], self.texts[w[i]])
                found.append(both[is_near])
        return np.divmod(np.concatenate(found), len(self.texts)) if found else (np.zeros(0, int),) * 2

    @staticmethod
    def _verified(a: np.ndarray, b: np.ndarray, short: np.ndarray, long: np.ndarray) -> np.ndarray:
        unlike = a != b
        replaced = (short == long) & (unlike.sum(axis=1) == 1)
        behind = np.arange(WIDE)[None, :-1] >= unlike.argmax(axis=1)[:, None]
        within = np.arange(WIDE)[None, :-1] < short[:, None]
        inserted = (short < long) & ~((a[:, :-1] != b[:, 1:]) & behind & within).any(axis=1)
        return replaced | inserted


# --- Over the cluster -------------------------------------------------------------------------


def top_of(vectors: DataFrame) -> tuple[Trie, dict[bytes, int], dict[int, int]]:
    """(the trie's top, its shards by prefix, blocks of each shard) for rows of (word, vector).

    Counts of a level are taken below the nodes that are too large only.
    """
    spark = vectors.sparkSession
    large, shards, blocks = [b""], {}, {}
    if vectors.limit(1).count() == 0:
        return Trie([]), shards, blocks
    for depth in range(1, GROUPS + 1):
        # At most one row for each SHARD_WORDS words.
        above = spark.createDataFrame([(p,) for p in large], "above binary")
        prefix = vectors.select(F.substring("vector", 1, depth).alias("prefix"), F.substring("vector", 1, depth - 1).alias("above"))
        counted = prefix.join(F.broadcast(above), "above", "left_semi").groupBy("prefix").count().collect()
        large = []
        for p, n in counted:
            if n > SHARD_WORDS and depth < GROUPS:
                large.append(bytes(p))
            else:
                shards[bytes(p)] = len(shards)
                blocks[len(blocks)] = -(-n // SHARD_WORDS)
        if not large:
            break
    return Trie.of_prefixes(shards), shards, blocks


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): for each word of (word, n) all words one edit away, both ways.

    Words are distinct and not null. Pairs are found once by the trie and turned around; none is
    left out.
    """
    spark = vocabulary.sparkSession

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [v.tobytes() for v in counts_of(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.binary())], ["word", "n", "vector"])

    known = written(vocabulary.select("word", "n").mapInArrow(lean(vector), "word string, n long, vector binary"), "spelling-words")
    top, shards, blocks = top_of(known)
    empty = "word string, n long, near string, near_n long"
    if not shards:
        return spark.createDataFrame([], empty)
    shared = spark.sparkContext.broadcast(top)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for batch in batches:
            vectors = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, GROUPS)
            for query, leaf, surplus, deficit in trie.search(vectors):
                own = pa.array((surplus == 0) & (deficit == 0))
                rows = pa.array(query)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf), own, batch.column(0).take(rows), batch.column(1).take(rows)],
                    ["shard", "own", "word", "n"],
                )

    kind = "shard long, own boolean, word string, n long"
    # A shard is reached in several ways (what differs may lie below it); one visit is enough.
    visits = known.mapInArrow(lean(route), kind).groupBy("shard", "word", "n").agg(F.max("own").alias("own"))
    visits = written(visits, "spelling-visits")
    parts = spark.createDataFrame([(s, b) for s, b in blocks.items()], "shard long, blocks long")
    dealt = lambda size: F.pmod(F.xxhash64("word"), size)
    packed = lambda name: F.sort_array(F.collect_list(F.struct("word", "n"))).alias(name)
    # Blocks bound both sides of every row.
    posted = (
        visits.where("own").join(parts, "shard").groupBy("shard", dealt(F.col("blocks")).alias("block")).agg(packed("posted"))
    )
    asked = visits.groupBy("shard").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("query_blocks"))
    queries = (
        visits.join(asked, "shard")
        .groupBy("shard", dealt(F.col("query_blocks")).alias("query_block"))
        .agg(packed("queries"))
    )
    met = spread(written(posted.join(queries, "shard"), "spelling-blocks"), "shard", "block", "query_block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, asked in zip(batch.column(0), batch.column(1)):
                own, asked = own.values, asked.values
                texts, ask = own.field("word"), asked.field("word")
                q, w = Words(texts.to_pylist()).near(ask.to_pylist())
                a, b = pa.array(q), pa.array(w)
                out = [ask.take(a), asked.field("n").take(a), texts.take(b), own.field("n").take(b)]
                yield pa.RecordBatch.from_arrays(out, ["word", "n", "near", "near_n"])
                turned = [out[2], out[3], out[0], out[1]]
                yield pa.RecordBatch.from_arrays(turned, ["word", "n", "near", "near_n"])

    return met.select("posted", "queries").mapInArrow(lean(search), empty)


def forms(vocabulary: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of (word, n).

    The form is the near word of largest n (ties: the smallest in code-point order), if that n is
    at least ``ratio`` times the word's own. The root is where forms lead. Forms grow by the ratio
    at each step, so the way to the root has few steps, and pointers double at each.
    """
    vocabulary = written(vocabulary.select("word", "n"), "spelling-vocabulary")
    # Strings are ordered by their UTF-8 bytes, which is the order of code points.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = near_pairs(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best)
    is_form = -F.col("best.less") >= ratio * F.col("n")
    own = written(
        vocabulary.select("word", "n")
        .join(found, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    # Only distinct forms are followed, so a form of very many words is one row here.
    target = own.where("form IS NOT NULL").select(F.col("form").alias("at")).distinct()
    roots = written(target.join(own.select(F.col("word").alias("at"), "form"), "at").select("at", F.coalesce("form", "at").alias("root")), "spelling-roots")
    while True:
        ahead = roots.select(F.col("at").alias("root"), F.col("root").alias("next"))
        further = written(roots.join(ahead, "root", "left").select("at", F.coalesce("next", "root").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "spelling-roots")
        roots = further.select("at", "root")
        if further.where("moved").isEmpty():
            break
    return own.join(roots.withColumnRenamed("at", "form"), "form", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
