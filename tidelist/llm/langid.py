"""Language identification by prediction by partial matching.

One byte context tree per language, fitted on all labelled texts and frozen; a text gets the
language whose tree codes it in the fewest bits. Every text is coded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelist.llm.common import byte_texts, lean, written
from tidelist.llm.markov import Model, fit, learnt

UNKNOWN = "und"
SAMPLE_BYTES = 20_000  # where a sample is asked for: longer texts only of languages with too few others
ORDER = 3  # longest context, in bytes
COST_QUANTILE, COST_MARGIN = 0.995, 1.5
UNEXPLAINED = 8.0  # bits of a byte without a model
COST_GRID = 1024  # costs are counted by this part of a bit


def held_out() -> Column:
    """Whether a document is kept from fitting; not, if its id is null."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def _sample(labelled: DataFrame, texts: int, longest: int) -> dict[str, list[bytes]]:
    """At most ``texts`` different texts of each language, in order of their hashes.

    Texts of up to ``longest`` bytes are chosen by hash. Where a language has too few of them, its
    next longer texts join, as long as all of its sample has at most ``texts * longest`` bytes. Of
    a language whose shortest text is beyond that, only as much of this text as fits is sampled.
    """
    budget = texts * longest
    size = F.octet_length("text")
    usable = labelled.where(F.col("lang").isNotNull() & (size > 0)).select(
        "lang", "text", size.alias("size"), F.xxhash64("text").alias("h")
    )
    hashes = written(usable.select("lang", "h", "size").distinct(), "hashes")
    short = F.col("size") <= longest
    counted = hashes.groupBy("lang").agg(
        F.count_if(short).alias("n"), F.count_if(~short).alias("long"), F.sum(F.when(short, F.col("size"))).alias("bytes")
    )
    chosen = F.lit(False)
    for row in counted.collect():  # one row per language
        own = hashes.where(F.col("lang") == row["lang"])
        taken = short
        if row["n"] > texts:
            taken = short & (F.col("h") <= own.where(short).orderBy("h").limit(texts).agg(F.max("h")).first()[0])
        elif row["n"] < texts and row["long"]:
            room, more = budget - (row["bytes"] or 0), []
            for r in own.where(~short).orderBy("size", "h").limit(texts - row["n"]).collect():
                room -= r["size"]
                if room >= 0 or not (row["n"] or more):
                    more.append(r["h"])
            taken = short | F.col("h").isin(more)
        chosen = chosen | ((F.col("lang") == row["lang"]) & taken)
    fitting = F.when(F.col("size") <= budget, F.col("text")).otherwise(F.left("text", F.lit(max(budget // 4, 1))))
    rows = usable.where(chosen).dropDuplicates(["lang", "h"]).select("lang", "h", fitting.alias("text")).collect()
    samples: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["h"])):
        samples.setdefault(row["lang"], []).append(row["text"].encode())
    return samples


def _different(labelled: DataFrame) -> DataFrame:
    """(lang, text, h): every different text of a language once."""
    usable = labelled.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    return usable.select("lang", "text", F.xxhash64("text").alias("h"))


def train(
    labelled: DataFrame,
    texts: int | None = None,
    longest: int = SAMPLE_BYTES,
    order: int = ORDER,
) -> Model | None:
    """A model from (text, lang): of all different texts of every language.

    Rows with a null or empty text or without lang are left out. None if no text is left. Spark
    counts; the driver gets counts of grams.

    A caller who wants a smaller job gives a number of ``texts``: of each language at most so many
    are fitted then, chosen by sizes and hashes; those of over ``longest`` bytes where a language
    has too few others. The driver gets ``texts * longest`` bytes of each language at most.
    """
    if texts is None:
        different = _different(labelled).dropDuplicates(["lang", "h"])
        return learnt(different.select(F.col("lang").alias("kind"), "text"), order)
    samples = _sample(labelled, texts, longest)
    return fit(samples, order) if samples else None


def cost_limit(unfitted: DataFrame, model: Model) -> float:
    """Bits per byte above which no language of the model explains a text.

    From all different texts of (text, lang) that the model was not fitted on: half more than all
    but the dearest cost, so that a few foreign texts among the labelled do not set the limit.
    Costs are counted on a grid of 1 / COST_GRID bits, of which the driver gets the counts.
    Without such texts, what a byte costs of which nothing is known.
    """
    judged = predicted(_different(unfitted), model, cost="cost").where(F.col("lang_pred") != UNKNOWN)
    step = F.ceil(F.col("cost") * COST_GRID)
    once = judged.groupBy("lang", "h").agg(F.min(step).alias("step"))
    rows = sorted(once.groupBy("step").count().collect())
    if not rows:
        return UNEXPLAINED
    steps, counts = zip(*rows)
    upto = np.cumsum(counts)
    at = int(np.searchsorted(upto, COST_QUANTILE * upto[-1]))
    return COST_MARGIN * steps[at] / COST_GRID


def predicted(
    docs: DataFrame,
    model: Model | None,
    lang: str = "lang_pred",
    score: str = "score",
    cost: str | None = None,
) -> DataFrame:
    """``docs`` with two more columns, the language and the score of every row.

    With ``cost``, a third: the bits per byte under the language, 0 where it is ``und``.

    The language is ``und`` with score 0 where the text is null or holds no letter, and
    everywhere if there is no model. The score is the posterior of the language, each language as
    likely beforehand. Only the text decides: equal texts get equal results. Among languages of
    equal code length the first in order of name is taken.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.withColumns({lang: F.lit(""), score: F.lit(0.0)} | ({cost: F.lit(0.0)} if cost else {})).schema
    at = docs.columns.index("text")

    @lean
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = shared.value
        for batch in batches:
            column = batch.column(at)
            letters = pc.match_substring_regex(column, r"\pL").fill_null(False)
            spoken = np.flatnonzero(letters.to_numpy(zero_copy_only=False)) if by else []
            names = [UNKNOWN] * batch.num_rows
            likely = np.zeros(batch.num_rows)
            dear = np.zeros(batch.num_rows)
            if len(spoken):
                texts = byte_texts(column.take(pa.array(spoken)))
                bits = by.bits(texts)
                dear[spoken] = bits.min(axis=1) / [len(t) for t in texts]
                best = bits.argmin(axis=1)
                more = bits - bits.min(axis=1, keepdims=True)
                likely[spoken] = 1 / np.exp2(-more).sum(axis=1)
                for i, b in zip(spoken.tolist(), best.tolist()):
                    names[i] = by.classes[b]
            columns = [*batch.columns, pa.array(names), pa.array(likely)] + ([pa.array(dear)] if cost else [])
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(predict, schema)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, text, held_out, lang_pred, score): fit on what is not held out, predict all."""
    flagged = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = train(flagged.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return predicted(flagged.drop("lang"), model)
