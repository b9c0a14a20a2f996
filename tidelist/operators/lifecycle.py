"""The snapshot fact and the lifecycle spells derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelist.functions.dates import days_between
from tidelist.operators.manifests import ok_landings
from tidelist.schemas import DAILY, SPELL_ATTRIBUTES, columns_of


def daily_fact(classified: DataFrame, ok_manifests: DataFrame) -> DataFrame:
    """Postings of the current successful landings, one row per posting and snapshot.

    Only postings taken by the landing that counts are let in: the join includes the extraction
    time. Size decides how Spark joins; with adaptive execution an over-large board and day is
    split.
    """
    keys = ["company_key", "snapshot_date", "extracted_at"]
    landings = ok_manifests.select(*keys, "landing_id")
    joined = classified.drop("landing_id").join(landings, keys)
    return joined.select([name for name, _ in columns_of(DAILY)])


def snapshot_calendar(
    manifests: DataFrame, group: str = "company_key", day: str = "snapshot_date"
) -> DataFrame:
    """Successful days per group: their number, the next one, and the first one.

    Failed days are not in it, which is what keeps them from closing or splitting a spell.
    """
    per_group = Window.partitionBy(group)
    in_order = per_group.orderBy(day)
    return manifests.select(
        group,
        day,
        F.row_number().over(in_order).alias("snapshot_seq"),
        F.lead(day).over(in_order).alias("next_snapshot"),
        F.min(day).over(per_group).alias("first_snapshot"),
    )


_SPELL_COLUMNS = [
    "posting_spell_key",
    "spell_number",
    "first_seen",
    "last_seen",
    "closed_at",
    "is_open",
    "is_left_censored",
    "snapshots_observed",
    "unparsed_snapshots",
    "days_to_close",
]


def spells(
    parsed: DataFrame,
    unparsed: DataFrame,
    calendar: DataFrame,
    attributes: list[str] = SPELL_ATTRIBUTES,
    entity: str = "posting_key",
    group: str = "company_key",
    day: str = "snapshot_date",
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Maximal runs of consecutive successful snapshots in which an entity was listed.

    ``parsed`` has one row per entity and day, with the attributes; ``unparsed`` has the days on
    which the entity was listed but unreadable (they hold a spell together, describe nothing, and
    never make one alone). Days outside ``calendar`` are ignored.

    An entity's observations are numbered with ``dense_rank``, so a day seen both ways counts
    once and needs no anti-join; runs share ``snapshot_seq - rank``. Everything after the
    calendar join is keyed by the entity: one shuffle serves both windows and the aggregate, and
    no group is larger than the calendar.

    ``earlier`` holds spells already known up to some day, in the format of the result; then
    ``parsed`` need only have the later days, and ``unparsed`` may have any. Open spells are
    resumed from their last day. The result then holds only spells that are open or were closed
    since: of closed ones it reads nothing but whose they are, for the numbers of later ones.
    """
    attrs = F.struct(*attributes).alias("attrs")
    attrs_type = parsed.select(attrs).schema["attrs"].dataType
    keys = [entity, group, day]
    carried_type = "struct<first_seen: date, snapshots: bigint, unparsed: bigint>"
    nothing = F.lit(None).cast(carried_type).alias("carried")
    seen = parsed.select(*keys, F.lit(True).alias("is_parsed"), attrs, nothing)
    listed = unparsed.select(
        *keys, F.lit(False).alias("is_parsed"), F.lit(None).cast(attrs_type).alias("attrs"), nothing
    ).distinct()
    if earlier is not None:
        still_open = earlier.where("is_open")
        resumed = still_open.select(
            entity,
            group,
            F.col("last_seen").alias(day),
            F.lit(True).alias("is_parsed"),
            attrs,
            F.struct(
                "first_seen",
                F.col("snapshots_observed").alias("snapshots"),
                F.col("unparsed_snapshots").alias("unparsed"),
            )
            .cast(carried_type)
            .alias("carried"),
        )
        # What an open spell already counts must not be counted again.
        known = still_open.select(entity, F.col("last_seen").alias("_known_until"))
        listed = (
            listed.join(known, entity, "left")
            .where(F.col("_known_until").isNull() | (F.col(day) > F.col("_known_until")))
            .drop("_known_until")
        )
        seen = seen.unionByName(resumed)
    observations = seen.unionByName(listed).join(calendar, [group, day])

    rank = F.dense_rank().over(Window.partitionBy(entity).orderBy("snapshot_seq"))
    runs = observations.withColumn("run", F.col("snapshot_seq") - rank)
    span = F.max("snapshot_seq") - F.min("snapshot_seq") + 1
    carried = lambda c: F.coalesce(c - 1, F.lit(0))  # noqa: E731  (its last day is in the span)
    snapshots = span + carried(F.max("carried.snapshots"))
    parsed_days = F.count_if("is_parsed") + carried(
        F.max(F.col("carried.snapshots") - F.col("carried.unparsed"))
    )
    found = (
        runs.groupBy(entity, group, "run")
        .agg(
            F.min(F.coalesce("carried.first_seen", day)).alias("first_seen"),
            F.max(day).alias("last_seen"),
            F.max_by("next_snapshot", "snapshot_seq").alias("closed_at"),
            F.min("first_snapshot").alias("first_snapshot"),
            snapshots.cast("bigint").alias("snapshots_observed"),
            (snapshots - parsed_days).cast("bigint").alias("unparsed_snapshots"),
            F.max_by("attrs", F.when(F.col("is_parsed"), F.col("snapshot_seq"))).alias("attrs"),
        )
        .where(F.col("unparsed_snapshots") < F.col("snapshots_observed"))
        .withColumns(
            {
                "posting_spell_key": F.concat(
                    F.col(entity), F.lit("@"), F.col("first_seen").cast("string")
                ),
                "is_open": F.col("closed_at").isNull(),
                "is_left_censored": F.col("first_seen") == F.col("first_snapshot"),
                "days_to_close": days_between(F.col("first_seen"), F.col("closed_at")),
                **{name: F.col(f"attrs.{name}") for name in attributes},
            }
        )
        .drop("run", "attrs", "first_snapshot")
    )
    number = F.row_number().over(Window.partitionBy(entity).orderBy("first_seen"))
    if earlier is not None:
        ended = earlier.where(~F.col("is_open")).groupBy(entity).agg(F.count("*").alias("_ended"))
        found = found.join(ended, entity, "left")
        number = number + F.coalesce("_ended", F.lit(0))
    key, *rest = _SPELL_COLUMNS
    return found.withColumn("spell_number", number.cast("bigint")).select(
        key, entity, group, *rest, *attributes
    )


def spell_fact(
    daily: DataFrame, unparsed: DataFrame, manifests: DataFrame, earlier: DataFrame | None = None
) -> DataFrame:
    """Spells of the current state, with the watermark of the board they were computed from.

    With ``earlier`` spells, those that are open or were closed since (see ``spells``).
    """
    ok = ok_landings(manifests)
    current = spells(daily, unparsed, snapshot_calendar(ok), earlier=earlier)
    return current.join(board_watermarks(ok), "company_key")


def board_watermarks(ok_manifests: DataFrame) -> DataFrame:
    """One digest per board over its successful days and their landings.

    Any added, withdrawn or re-landed day changes it. The list is one short text per day of the
    calendar.
    """
    entry = F.concat(F.col("snapshot_date").cast("string"), F.lit("@"), F.col("landing_id"))
    ordered = F.array_sort(F.collect_list(F.struct("snapshot_date", entry.alias("entry"))))
    joined = F.array_join(F.transform(ordered, lambda e: e["entry"]), ",")
    return ok_manifests.groupBy("company_key").agg(F.md5(joined).alias("board_watermark"))
