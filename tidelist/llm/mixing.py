"""Mixing sources to target weights, by hash-random order and distributed prefix sums.

Each document gets a random key from its id and is put in the order of these keys within its
source. The keys are cut into ranges of equal width, so a (source, range) is a group of bounded
size, whatever share of the rows one source has; it is sorted on its own, its sizes are summed up
in order, and the totals of the ranges before it in its source are added. A source's order is then
taken as often as its budget asks for (epochs), and cut in its last epoch exactly where the budget
is used up.

Budgets are targets in whole words. Targets are weight times a rate, at most CAP times the
source's size; the rate rises until the whole is shared out, as sources that reach their cap leave
the rest to the others. Only the rate's sums reach the driver, however many sources there are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelist.llm.common import fresh, written

RANGE_ROWS = 1 << 16
KEY_BITS = 60
CAP = 3


def words_in(text: Column) -> Column:
    """The number of runs of bytes other than ASCII white space; 0 of a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def key_of(row_id: Column, seed: int) -> Column:
    """KEY_BITS random bits from the md5 of ``<seed>:<id>``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def numbered(sources: DataFrame, parts: int = 64) -> DataFrame:
    """The rows with ``number``, from 0 in code-point order of ``source``, null last.

    Rows are range-partitioned and numbered within their part; no task sees them all.
    """
    order = F.col("source").asc_nulls_last()
    placed = sources.repartitionByRange(parts, order).withColumn("part", F.spark_partition_id())
    placed = written(placed, "mix-sources")  # the parts stay as they are
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").count().withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("part").orderBy(order))
    return placed.join(offsets.select("part", "offset"), "part").withColumn("number", within - 1 + F.col("offset")).drop("part", "offset")


def targets(sources: DataFrame, weights: list[int], cap: int = CAP) -> DataFrame:
    """(source, source_size, weight, target, budget) for rows of (source, source_size).

    Weights repeat over the sources in code-point order, null last. What all targets add up to is
    the whole size. ``target`` is exact up to double precision, ``budget`` its floor. Sources are
    capped in rounds until no target exceeds ``cap`` times its source's size.
    """
    repeated = F.array(*[F.lit(w).cast("long") for w in weights])
    own = written(
        numbered(sources).select("source", "source_size", F.get(repeated, (F.col("number") % len(weights)).cast("int")).alias("weight")),
        "mix-weights",
    )
    most = F.col("source_size") * cap
    whole = own.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    rest, weight, capped = whole, 0, F.lit(False)
    while True:
        # A capped source stays so, as the rate rest / weight only rises.
        sums = own.agg(
            F.coalesce(F.sum(F.when(capped, most)), F.lit(0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0))
        ).first()
        now = whole - sums[0], sums[1]
        if now == (rest, weight):
            break
        rest, weight = now
        # In whole numbers: rest / weight * weight of the source > cap * size.
        capped = F.lit(rest).cast("decimal(25,0)") * F.col("weight") > most.cast("decimal(25,0)") * F.lit(weight)
    share = F.lit(rest).cast("decimal(25,0)") * F.col("weight")
    exact = F.try_divide(share.cast("double"), F.lit(weight).cast("double"))
    floor = F.expr(f"CAST({rest} AS decimal(25,0)) * weight DIV {max(weight, 1)}").cast("long")
    return own.select(
        "*",
        F.when(capped, most.cast("double")).otherwise(F.coalesce(exact, F.lit(0.0))).alias("target"),
        F.when(capped, most).otherwise(floor).alias("budget"),
    )


@dataclass(frozen=True)
class Mix:
    """``sources``: what ``targets`` tells; ``documents``: what the mix takes of each document."""

    sources: DataFrame
    documents: DataFrame


def mix(docs: DataFrame, weights: list[int], size: Column | None = None, seed: int = 13, cap: int = CAP) -> Mix:
    """Take from ``docs`` (doc_id, text, source) as many words of each source as its target asks for.

    ``documents`` has a row per row of ``docs``: (doc_id, source, size, source_size, target, start,
    epochs, taken), where ``start`` counts the words before it in its source's random order,
    ``epochs`` how often it is taken whole, and ``taken`` all its words, the piece at the cut
    included. ``size`` (a long, default: the words of the text) may be any measure. Documents of
    null source are a source, a null text is empty; repeated rows count again. The key of a null
    doc_id is that of its text. Equal keys follow each other by doc_id and size, so that reruns
    agree. An empty table gives no row.
    """
    row_id = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # Never null, so that the sort and the join share one partitioning.
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("of"),
        (words_in(F.col("text")) if size is None else size).alias("size"),
        key_of(row_id, seed).alias("key"),
    )
    narrow = written(narrow, "mix-documents")
    ranges = max(1, -(-narrow.count() // RANGE_ROWS))
    # Keys are uniform, so each range gets its share of every source.
    width = -(-(1 << KEY_BITS) // ranges)
    ranged = narrow.withColumn("range", F.expr(f"key DIV {width}L"))
    # One row per source and range: the hot source is a few rows from here on.
    totals = written(ranged.groupBy("of", "range").agg(F.sum("size").alias("size")), "mix-ranges")
    source = F.when(F.col("of") != "", F.expr("substring(of, 2)")).alias("source")
    sizes = totals.groupBy("of").agg(F.sum("size").alias("source_size")).select(source, "source_size")
    sources = written(targets(sizes, weights, cap), "mix-targets")
    before = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("of", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    budgets = sources.withColumn("of", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    known = offsets.join(budgets, "of").select("of", "range", "offset", "source", "source_size", "target", "budget")
    in_order = Window.partitionBy("of", "range").orderBy("key", "doc_id", "size")
    start = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.expr("budget DIV source_size")).otherwise(0)
    left = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("start")
    documents = (
        ranged.withColumn("start", start)
        .join(known, ["of", "range"])
        .withColumn("start", F.col("start") + F.col("offset"))
        .withColumn("epochs", epochs)
        .withColumn("taken", F.col("epochs") * F.col("size") + F.greatest(F.least(left, F.col("size")), F.lit(0)))
        .withColumn("epochs", F.when(left >= F.col("size"), F.col("epochs") + 1).otherwise(F.col("epochs")))
    )
    return Mix(sources, documents.select("doc_id", "source", "size", "source_size", "target", "start", "epochs", "taken"))


def mixed_texts(docs: DataFrame, found: Mix, copy: str = "copy") -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken, with the number of the copy.

    The piece at a source's cut is the beginning of its text, that many words joined by one space.
    For tables of unique, non-null doc_id.
    """
    copy = fresh(copy, docs.columns)
    often = found.documents.where("taken > 0").select(
        F.col("doc_id").alias("_id"),
        F.col("epochs").alias("_epochs"),
        (F.col("taken") - F.col("epochs") * F.col("size")).alias("_piece"),
    )
    last = F.col("_epochs") + F.when(F.col("_piece") > 0, 1).otherwise(0)
    rows = docs.join(often, docs["doc_id"] == often["_id"]).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), last)))
    own_words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    piece = F.array_join(F.slice(own_words, F.lit(1), F.col("_piece").cast("int")), " ")
    text = F.when(F.col(copy) > F.col("_epochs"), piece).otherwise(F.col("text"))
    return rows.withColumn("text", text).select(*docs.columns, copy)
