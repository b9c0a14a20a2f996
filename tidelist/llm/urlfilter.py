"""URL filter: rules on host and path, and for the rest a ratio of character language models.

URLs that rules accept or reject are the labels: a variable-order Markov model is fitted on each,
and a URL without a rule is judged by the difference of its code lengths under both models, per
byte, against a limit calibrated on the labelled URLs that were not fitted, a share by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelist.llm.common import byte_texts, discard, lean, written
from tidelist.llm.markov import Model, learnt

ALLOW, BLOCK = "allow", "block"
ORDER = 4  # longest context, in bytes
CALIBRATION_SHARE = 4  # one in so many URLs calibrates the limit, by hash; the others are fitted
RATIO_GRID = 1024  # ratios are counted by this part of a bit

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_parts(urls: DataFrame) -> DataFrame:
    """Adds host and path; both are empty if the URL is null or has no ``://``."""
    url = F.coalesce("url", F.lit(""))
    host = F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _UPPER.lower())
    return urls.withColumns({"host": host, "path": F.regexp_extract(url, _PARTS, 2)})


def with_rule(urls: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Adds rule and ruled: the longest rule that fits host and path, and its verdict, else null.

    ``rules`` maps a host with a path, like ``example.net/en/``, to a verdict.
    """
    rule = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for text in sorted(rules, key=lambda r: (len(r), r)):  # longer ones are asked first
        host, slash, rest = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col(
            "path"
        ).startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(rules[text])).otherwise(verdict)
    return urls.withColumns({"rule": rule, "ruled": verdict})


def train(ruled: DataFrame, order: int = ORDER) -> tuple[Model, float] | None:
    """Models of accepted and rejected URLs and the limit, from (url, ruled).

    Of all different URLs of a verdict, in the order of their hashes, one in CALIBRATION_SHARE is
    calibrated on and the others are fitted; a single one serves both. None if either verdict has
    no URL. Spark counts grams and ratios; the driver gets the counts.
    """
    known = F.col("ruled").isin(ALLOW, BLOCK) & F.col("url").isNotNull()
    different = ruled.where(known).select(F.col("ruled").alias("kind"), F.col("url").alias("text")).distinct()
    by_hash = different.orderBy("kind", F.xxhash64("text"), "text")
    kept = written(
        by_hash.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "urls"
    )
    counts = {r["kind"]: r["count"] for r in kept.groupBy("kind").count().collect()}
    if len(counts) < 2:
        return None
    placed = _placed(kept)
    calibrates = F.col("place") % CALIBRATION_SHARE == 0
    single = F.col("kind").isin([kind for kind, n in counts.items() if n == 1])
    model = learnt(placed.where(~calibrates | single), order, [ALLOW, BLOCK])
    if model is None:
        return None
    limit = _limit(_ratios(placed.where(calibrates), model))
    discard(kept)
    return model, limit


def _placed(urls: DataFrame) -> DataFrame:
    """(kind, text, place): the number of each text among those of its kind, from 0.

    ``urls`` has (kind, text, part, at): sorted parts, and ascending numbers within them. Only the
    parts' sizes are added up, so no task sees all texts.
    """
    runs = urls.groupBy("part", "kind").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("part", "kind", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.col("at") - F.col("first") + F.col("before")
    return urls.join(starts, ["part", "kind"]).select("kind", "text", place.alias("place"))


def _ratios(urls: DataFrame, model: Model) -> dict[str, dict[int, int]]:
    """For each verdict, how many of (kind, text) have a ratio from n to n + 1 steps of the grid."""
    shared = urls.sparkSession.sparkContext.broadcast(model)

    @lean
    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.floor(ratio(shared.value, byte_texts(batch.column(1))) * RATIO_GRID)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(step.astype(np.int64))], ["kind", "step"])

    counted = urls.mapInArrow(steps, "kind string, step long").groupBy("kind", "step").count()
    found: dict[str, dict[int, int]] = {ALLOW: {}, BLOCK: {}}
    for r in counted.collect():
        found[r["kind"]][r["step"]] = r["count"]
    shared.unpersist()
    return found


def ratio(model: Model, urls: list[bytes]) -> np.ndarray:
    """Bits per byte by which the model of rejected URLs is longer; empty URLs: 0."""
    bits = model.bits(urls)
    length = np.maximum([len(u) for u in urls], 1)
    return (bits[:, model.classes.index(BLOCK)] - bits[:, model.classes.index(ALLOW)]) / length


def _limit(ratios: dict[str, dict[int, int]]) -> float:
    """Where the mean of both shares judged rightly is largest, midway between two occupied steps."""
    steps = np.array(sorted(set(ratios[ALLOW]) | set(ratios[BLOCK])))
    cuts = np.concatenate([[steps[0]], (steps[1:] + steps[:-1] + 1) / 2, [steps[-1] + 1]]) / RATIO_GRID
    below = {
        verdict: np.concatenate([[0], np.cumsum([counts.get(s, 0) for s in steps.tolist()])])
        for verdict, counts in ratios.items()
    }
    good = 1 - below[ALLOW] / below[ALLOW][-1] + below[BLOCK] / below[BLOCK][-1]
    best = np.flatnonzero(good >= good.max() - 1e-12)
    return float(cuts[best[len(best) // 2]])


def judge(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, ratio) of every row of ``pages``.

    The rule's verdict, else the models'; a null or empty URL has the ratio 0. Without URLs of
    both verdicts to learn from, every URL without a rule is allowed. Equal URLs get equal
    verdicts.
    """
    ruled = with_rule(with_parts(pages.select("page_id", "url")), rules)
    shared = pages.sparkSession.sparkContext.broadcast(train(ruled))
    schema = ruled.withColumn("ratio", F.lit(0.0)).withColumn("judged", F.lit("")).schema
    at = ruled.columns.index("url")

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = shared.value
        for batch in batches:
            values, limit = np.zeros(batch.num_rows), -1.0
            if learnt:
                model, limit = learnt
                values = ratio(model, byte_texts(batch.column(at).fill_null("")))
            judged = np.where(values >= limit, ALLOW, BLOCK)
            columns = [*batch.columns, pa.array(values), pa.array(judged, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "ratio", "judged"])

    return ruled.mapInArrow(score, schema).select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("ruled", "judged").alias("verdict"), "ratio",
    )
