"""Building facts and marts, incrementally or from scratch."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelist.operators import marts, quality
from tidelist.operators.geo import dim_location
from tidelist.operators.incremental import (
    board_changes,
    current_daily,
    live_spells,
    live_states,
    logged,
    of_boards,
    of_weeks,
    pending_landings,
    touched_weeks,
)
from tidelist.operators.lifecycle import daily_fact, spell_fact
from tidelist.operators.manifests import ok_landings, unparsed_observations
from tidelist.operators.normalize import (
    classify,
    normalize,
    one_per_snapshot,
    union_sources,
)
from tidelist.operators.skills import bridge_of_tagged, skill_bridge, tagged_observations
from tidelist.schemas import ATTEMPTS, DAILY, columns_of, conform
from tidelist.session import bound_broadcasts
from tidelist.sources.lake import (
    DAILY_LOG,
    OBSERVATIONS,
    SPELL_COUNTS,
    SPELL_ROWS,
    SPELLS,
    SPELLS_LOG,
    UNPARSED,
    WEEK_LOG,
    WEEK_STATES,
    Lake,
)
from tidelist.sources.rules import Rules

MARTS = [
    "fct_posting_daily",
    "fct_postings",
    "dim_company",
    "dim_location",
    "dim_role_family",
    "bridge_posting_skill",
    "mart_weekly_postings_flow",
    "mart_time_to_close",
    "mart_skill_demand",
    "mart_remote_share",
    "mart_entry_level_share",
]
CONCURRENT_JOBS = 6
_DAILY_COLUMNS = [name for name, _ in columns_of(DAILY)]


def vocabulary_version(rules: Rules) -> str:
    return hashlib.sha256(json.dumps(rules.skill_vocabulary).encode()).hexdigest()[:16]


def classified_postings(lines: DataFrame, rules: Rules) -> DataFrame:
    """Lines to deduplicated, classified postings."""
    return classify(one_per_snapshot(normalize(lines)), rules.role_family_rules)


def observations_of(lines: DataFrame, rules: Rules) -> DataFrame:
    """Rows to store for landed lines: daily columns, location text and skill tags.

    Descriptions are searched where they are read and go no further; what is shuffled to find
    the copies of a posting is narrow.
    """
    kept = [
        "posting_key",
        "company_key",
        "source",
        "board",
        "posting_id",
        "snapshot_date",
        "extracted_at",
        "title",
        "department",
        "location_raw",
        "employment_type",
        "workplace_type",
        "published_at",
        "posting_url",
        "landing_id",
    ]
    tagged = tagged_observations(normalize(lines), rules.skill_vocabulary, kept)
    return classify(one_per_snapshot(tagged), rules.role_family_rules)


INPUTS = "landings string, rules string"


def build(lake: Lake, rules: Rules | None = None, full_refresh: bool = False) -> int:
    """Bring facts and marts up to date with what has landed; returns the build number.

    If nothing has landed and no rule has changed since the last build, that build is returned.
    Only landings that are not loaded yet are read. Boards with new days at the end continue the
    spells they have; boards whose earlier days changed are recomputed from their full history,
    so the result does not depend on the order in which days arrived. A full refresh starts an
    empty generation of the stored facts.
    """
    bound_broadcasts(lake.spark)
    rules = rules or Rules()
    lake.reopen()
    number, generation = lake.last_commit("build")
    inputs = [(lake.landed_state(), rules_state(rules))]
    if generation and not full_refresh and inputs == _inputs_of(lake, number, generation):
        return number
    number += 1
    nothing = lake.spark.createDataFrame
    if full_refresh or generation == 0:
        generation += 1
        loaded, loaded_spells = nothing([], DAILY_LOG), nothing([], SPELLS_LOG)
        earlier, counted = nothing([], SPELLS), nothing([], ATTEMPTS)
    else:
        loaded, loaded_spells = lake.daily_log(), lake.spells_log()
        earlier, counted = lake.stored_spells(), lake.built_manifests()
    base = f"warehouse/generation={generation}"

    def write(df: DataFrame, ddl: str, table: str, by: tuple[str, ...] = ()) -> None:
        lake._write(conform(df, ddl), f"{base}/{table}/build={number}", by)

    own = lambda table, ddl: lake._read(f"{base}/{table}/build={number}", ddl)

    # Resolved once and written: everything below, and every reader, sees the same state.
    write(lake.manifests(), ATTEMPTS, "manifests")
    manifests = own("manifests", ATTEMPTS)
    ok = ok_landings(manifests)
    version = F.lit(vocabulary_version(rules))
    new = pending_landings(ok, loaded).withColumn("vocabulary_version", version)
    boards = logged(board_changes(ok, loaded_spells), loaded_spells, number)
    _together(
        lambda: write(new, DAILY_LOG, "daily_log"),
        lambda: write(boards, SPELLS_LOG, "spells_log"),
        lambda: write(touched_weeks(ok_landings(counted), ok), WEEK_LOG, "week_log"),
    )
    pending = current_daily(ok, own("daily_log", DAILY_LOG))
    stored_lines = lambda: observations_of(lake.lines(pending), rules)
    _together(
        lambda: write(stored_lines(), OBSERVATIONS, "observations", ("snapshot_date",)),
        lambda: write(lake.unparsed_of(pending), UNPARSED, "unparsed"),
    )
    stored = _stored(lake, base, "observations", OBSERVATIONS, number)
    daily = current_daily(stored, ok)
    unparsed = current_daily(_stored(lake, base, "unparsed", UNPARSED, number), ok)
    boards = own("spells_log", SPELLS_LOG)
    touched = of_weeks(stored, ok, own("week_log", WEEK_LOG))

    def write_spells() -> None:
        changed = _spells(boards, daily, unparsed, ok, earlier)
        write(changed, SPELL_ROWS, "spells", ("is_open",))
        ended = own("spells", SPELL_ROWS).where("NOT is_open")
        write(marts.spell_counts(ended), SPELL_COUNTS, "spell_counts")

    _together(
        write_spells, lambda: write(marts.week_states(touched), WEEK_STATES, "week_states")
    )
    # The marts are independent and mostly small: their jobs share the cluster.
    made = _marts(lake, base, number, rules, manifests, daily, boards)
    save = lambda name, mart: lake._write(mart, f"{base}/marts/{name}/build={number}")
    _together(
        lambda: write(nothing(inputs, INPUTS).coalesce(1), INPUTS, "inputs"),
        *[lambda name=name, mart=mart: save(name, mart) for name, mart in made.items()],
    )
    lake.commit("build", number, generation)
    return number


def _together(*jobs: Callable[[], None]) -> None:
    """Run jobs that don't depend on each other at the same time."""
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        for job in [pool.submit(job) for job in jobs]:
            job.result()


def rules_state(rules: Rules) -> str:
    """Changes with any rule table."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()


def _inputs_of(lake: Lake, number: int, generation: int) -> list[tuple]:
    """What a build was made from: committed landings and rules."""
    rows = lake._read(f"warehouse/generation={generation}/inputs/build={number}", INPUTS)
    return [tuple(r) for r in rows.collect()]


def _spells(
    boards: DataFrame, daily: DataFrame, unparsed: DataFrame, ok: DataFrame, earlier: DataFrame
) -> DataFrame:
    """Spells to store: none of unchanged boards, open and newly closed ones of extended boards,
    all of rebuilt boards."""
    changes = {
        r.change: r.known_until
        for r in boards.groupBy("change").agg(F.min("known_until").alias("known_until")).collect()
    }
    of = lambda change: boards.where(F.col("change") == change)
    parts = []
    if "extended" in changes:
        board = of("extended").select("company_key", "known_until")
        # The literal bound prunes the folders of earlier days.
        recent = daily.where(F.col("snapshot_date") > F.lit(changes["extended"]))
        later = recent.join(board, "company_key").where("snapshot_date > known_until")
        parts.append(
            spell_fact(
                later,
                of_boards(unparsed, board),
                of_boards(ok, board),
                of_boards(earlier, board).drop("board_watermark"),
            )
        )
    if "rebuilt" in changes or not parts:
        board = of("rebuilt")
        parts.append(
            spell_fact(of_boards(daily, board), of_boards(unparsed, board), of_boards(ok, board))
        )
    return union_sources(*parts)


def _stored(lake: Lake, base: str, table: str, ddl: str, number: int) -> DataFrame:
    """A stored fact including the folders of the build in progress."""
    return _numbered(lake, base, table, ddl, number).drop("build")


def _numbered(lake: Lake, base: str, table: str, ddl: str, number: int) -> DataFrame:
    rows = lake._read(f"{base}/{table}", f"{ddl}, build bigint")
    return rows.where(F.col("build") <= number)


def _marts(
    lake: Lake,
    base: str,
    number: int,
    rules: Rules,
    manifests: DataFrame,
    daily: DataFrame,
    boards: DataFrame,
) -> dict[str, DataFrame]:
    spark = lake.spark
    stored = lambda table, ddl: _numbered(lake, base, table, ddl, number)
    bridge = _bridge(lake, rules, daily, stored("daily_log", DAILY_LOG))
    spells = live_spells(stored("spells", SPELL_ROWS), boards)
    counts = live_spells(stored("spell_counts", SPELL_COUNTS), boards).drop("board_watermark")
    counts = counts.unionByName(marts.spell_counts(spells.where("is_open")))
    states = live_states(stored("week_states", WEEK_STATES), stored("week_log", WEEK_LOG))
    return {
        "dim_company": marts.dim_company_of(manifests, marts.postings_seen_of(counts)),
        "dim_location": dim_location(daily, rules.frame(spark, "geo_aliases")),
        "dim_role_family": marts.dim_role_family(rules.frame(spark, "role_families")),
        "bridge_posting_skill": bridge,
        "mart_weekly_postings_flow": marts.weekly_flow_of(manifests, states, counts),
        "mart_time_to_close": marts.time_to_close_of(counts),
        "mart_skill_demand": marts.skill_demand(spells, bridge),
        "mart_remote_share": marts.remote_share_of(states),
        "mart_entry_level_share": marts.entry_level_share_of(states),
    }


def _bridge(lake: Lake, rules: Rules, daily: DataFrame, log: DataFrame) -> DataFrame:
    """The skill bridge from stored tags; if the vocabulary has changed, from the texts again."""
    version = vocabulary_version(rules)
    if log.where(F.col("vocabulary_version") != version).isEmpty():
        return bridge_of_tagged(daily, [F.col("snapshot_date").desc()])
    return skill_bridge(normalize(lake.lines()), rules.skill_vocabulary)


# ---- Reading a built lake --------------------------------------------------------------------


def daily(lake: Lake) -> DataFrame:
    """The snapshot fact as of the last build: stored rows of the landings that count."""
    return current_daily(lake.observations(), ok_landings(lake.built_manifests())).select(
        _DAILY_COLUMNS
    )


def spells(lake: Lake) -> DataFrame:
    """The spell fact as of the last build."""
    return lake.stored_spells()


def relation(lake: Lake, name: str) -> DataFrame:
    """One of ``MARTS`` by name."""
    facts = {"fct_posting_daily": daily, "fct_postings": spells}
    return facts[name](lake) if name in facts else lake.table(name)


class NotBuilt(ValueError):
    """The lake has no committed build."""


def require_built(lake: Lake) -> None:
    if lake.last_commit("build")[0] == 0:
        raise NotBuilt(f"{lake.root} has no committed build yet")


def register_views(lake: Lake) -> list[str]:
    """Make the facts, dimensions and marts available to ``spark.sql`` under their names."""
    require_built(lake)
    for name in MARTS:
        relation(lake, name).createOrReplaceTempView(name)
    lake.manifests().createOrReplaceTempView("extract_manifests")
    return [*MARTS, "extract_manifests"]


def check(
    lake: Lake,
    rules: Rules | None = None,
    bounds: dict[str, tuple[int, int]] | None = None,
    examples: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """(check_name, failing_rows, passed) for the standard quality checks on a built lake.

    ``bounds`` replaces entries of ``fixed_values.CHECK_BOUNDS``. The rule tables are checked too,
    and ``examples`` of what they should answer (see ``quality.example_checks``).
    """
    require_built(lake)
    rules = rules or Rules()
    lines = lake.lines()
    manifests = lake.manifests()
    postings = one_per_snapshot(normalize(lines))
    classified = classify(postings, rules.role_family_rules)
    t = {name: relation(lake, name) for name in MARTS}
    frame = lambda name: rules.frame(lake.spark, name)
    vocabulary, aliases = frame("skill_vocabulary"), frame("geo_aliases")
    return quality.standard_suite(
        quality.Tables(
            lines=lines,
            manifests=manifests,
            unparsed=unparsed_observations(lake.rejected_ids()),
            postings=postings,
            classified=classified,
            rebuilt_daily=daily_fact(classified, ok_landings(manifests)),
            daily=t["fct_posting_daily"],
            spells=t["fct_postings"],
            dim_company=t["dim_company"],
            dim_location=t["dim_location"],
            dim_role_family=t["dim_role_family"],
            bridge=t["bridge_posting_skill"],
            weekly_flow=t["mart_weekly_postings_flow"],
            time_to_close=t["mart_time_to_close"],
            skill_demand=t["mart_skill_demand"],
            remote_share=t["mart_remote_share"],
            entry_level_share=t["mart_entry_level_share"],
            vocabulary=vocabulary,
        ),
        bounds,
        [
            *quality.rule_checks(
                vocabulary, frame("role_family_rules"), frame("role_families"), aliases
            ),
            *quality.example_checks(
                examples or {}, rules.skill_vocabulary, rules.role_family_rules, aliases
            ),
        ],
    )
