"""Queries on the derived listings: landing, normalising, lifecycle, marts and report."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import registry as R
from queries import sql as S
from queries.registry import POLICY, RULES, query
from tidelist.operators import geo, incremental, lifecycle, manifests, marts, normalize
from tidelist.operators import quality, report, skills
from tidelist.operators.contracts import parse_responses
from tidelist.operators.gates import drop_guard, reject_gate, summarize_board_days
from tidelist.operators.gates import board_policies
from tidelist.plans import build as built
from tidelist.plans import landing

NTZ = "timestamp_ntz"


def _no_manifests(spark):
    return spark.createDataFrame(
        [],
        "company_key string, snapshot_date date, status string, posting_count bigint, "
        "reject_count bigint",
    )


# ---- Landing ---------------------------------------------------------------------------------


@query(
    "response_items",
    S.chain(S.ITEMS)
    + """SELECT company_key, d AS snapshot_date, CAST(item_index AS INTEGER) AS item_index,
      posting_id, CAST(NULL AS VARCHAR) AS response_problem FROM items
    UNION ALL
    SELECT DISTINCT company_key, d, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR),
      CASE rk WHEN 1 THEN 'HTTP 500' WHEN 2 THEN source || ': response is not JSON'
        ELSE source || ': unexpected envelope' END
    FROM described WHERE rk IN (1, 2, 3)""",
)
def response_items(spark, sf):
    return parse_responses(R.derived_responses(spark, sf)).select(
        "company_key",
        "snapshot_date",
        "item_index",
        "posting_id",
        F.col("response_error").alias("response_problem"),
    )


@query(
    "contract_split",
    S.chain(S.ITEMS)
    + """SELECT company_key, d AS snapshot_date, CAST(item_index AS INTEGER) AS item_index,
      bad_fields IS NULL AS is_valid, bad_fields FROM items""",
)
def contract_split(spark, sf):
    items = R.items(spark, sf).where("item_index IS NOT NULL")
    fields = F.transform(F.split("error", "; "), lambda e: F.split_part(e, F.lit(":"), F.lit(1)))
    return items.select(
        "company_key",
        "snapshot_date",
        "item_index",
        F.col("error").isNull().alias("is_valid"),
        F.array_join(fields, ",").alias("bad_fields"),
    )


@query(
    "reject_gate",
    S.chain(*S.LISTINGS)
    + """SELECT company_key, d AS snapshot_date, valid_count, reject_count, gate_status
    FROM gated""",
)
def reject_gate_query(spark, sf):
    return reject_gate(summarize_board_days(R.items(spark, sf)), POLICY).select(
        "company_key", "snapshot_date", "valid_count", "reject_count", "gate_status"
    )


@query(
    "drop_guard",
    S.chain(*S.LISTINGS)
    + "SELECT company_key, snapshot_date, baseline, is_drop, status FROM manifests",
)
def drop_guard_query(spark, sf):
    gated = reject_gate(summarize_board_days(R.items(spark, sf)), POLICY)
    policies = board_policies(R.derived_boards(spark, sf), POLICY)
    judged = drop_guard(
        gated.join(policies, ["source", "board"]), _no_manifests(spark), POLICY
    )
    return judged.select("company_key", "snapshot_date", "baseline", "is_drop", "status")


@query(
    "manifests",
    S.chain(*S.LISTINGS, S.UNPARSED)
    + """SELECT company_key, source, board, snapshot_date, status, posting_count, reject_count,
      'Company ' || board AS company,
      coalesce((SELECT string_agg(posting_id, ',' ORDER BY posting_id) FROM unparsed AS u
        WHERE u.company_key = m.company_key AND u.snapshot_date = m.snapshot_date), '')
        AS rejected_ids
    FROM manifests AS m""",
)
def manifests_query(spark, sf):
    lake = R.lake(spark, sf)
    rows = manifests.with_rejected_id_arrays(lake.manifests(), lake.rejected_ids())
    return rows.select(
        "company_key",
        "source",
        "board",
        "snapshot_date",
        "status",
        "posting_count",
        "reject_count",
        "company",
        F.array_join("rejected_posting_ids", ",").alias("rejected_ids"),
    )


@query(
    "previous_ok",
    S.chain(*S.LISTINGS)
    + """SELECT company_key, snapshot_date,
      (SELECT max(p.snapshot_date) FROM manifests AS p WHERE p.company_key = m.company_key
        AND p.status = 'ok' AND p.snapshot_date < m.snapshot_date) AS previous_day,
      (SELECT arg_max(p.posting_count, p.snapshot_date) FROM manifests AS p
        WHERE p.company_key = m.company_key AND p.status = 'ok'
          AND p.snapshot_date < m.snapshot_date) AS previous_count
    FROM manifests AS m""",
)
def previous_ok(spark, sf):
    return R.manifests(spark, sf).select(
        "company_key",
        "snapshot_date",
        manifests.previous_ok("snapshot_date").alias("previous_day"),
        manifests.previous_ok("posting_count").alias("previous_count"),
    )


@query(
    "set_aside",
    S.chain(S.ITEMS)
    + """SELECT DISTINCT company_key, d AS snapshot_date, CASE rk WHEN 1 THEN 500 ELSE 200 END
      AS http_status, board LIKE 'error%' AS is_stranger FROM described""",
)
def set_aside(spark, sf):
    """Where each response goes if the boards of errors are not configured."""
    configured = R.derived_boards(spark, sf).where("NOT startswith(board, 'error')")
    known, strangers = landing.by_configuration(R.derived_responses(spark, sf), configured)
    sided = lambda df, side: df.select(
        F.concat("source", F.lit(":"), "board").alias("company_key"),
        "snapshot_date",
        "http_status",
        F.lit(side).alias("is_stranger"),
    )
    return sided(known, False).union(sided(strangers, True))


@query(
    "landing_summary",
    S.chain(*S.LISTINGS)
    + """SELECT count(*) FILTER (WHERE status = 'ok') AS ok_snapshots, count(*) AS snapshots,
      CAST(sum(posting_count) AS BIGINT) AS postings,
      CAST(sum(reject_count) AS BIGINT) AS rejected, CAST(0 AS BIGINT) AS kept_previous
    FROM manifests""",
)
def landing_summary(spark, sf):
    lake = R.lake(spark, sf)
    return manifests.landing_summary(
        manifests.landing_outcomes(lake.attempts(), lake.manifests())
    )


@query(
    "rejects",
    S.chain(S.ITEMS)
    + """SELECT company_key, d AS snapshot_date, CAST(item_index AS INTEGER) AS item_index,
      posting_id FROM items WHERE bad_fields IS NOT NULL""",
)
def rejects(spark, sf):
    return R.lake(spark, sf).rejects().select(
        "company_key", "snapshot_date", "item_index", "posting_id"
    )


@query(
    "evidence",
    S.chain(*S.LISTINGS)
    + """SELECT m.company_key, m.snapshot_date, count(*) AS kept FROM manifests AS m
    JOIN (SELECT company_key, d FROM items UNION ALL
      SELECT DISTINCT company_key, d FROM described WHERE rk IN (2, 3)) AS r
      ON r.company_key = m.company_key AND r.d = m.snapshot_date
    WHERE m.status <> 'ok' GROUP BY m.company_key, m.snapshot_date""",
)
def evidence(spark, sf):
    return (
        R.lake(spark, sf)
        .evidence()
        .groupBy("company_key", "snapshot_date")
        .agg(F.count("*").alias("kept"))
    )


@query(
    "fetch_modes",
    "SELECT 'live' AS requested, 'fixture' AS conflicting WHERE EXISTS (SELECT 1 FROM events)",
)
def fetch_modes(spark, sf):
    return manifests.conflicting_modes(R.lake(spark, sf).attempts(), "live").select(
        F.lit("live").alias("requested"), F.col("fetch_mode").alias("conflicting")
    )


# ---- Normalising -----------------------------------------------------------------------------

_COMMON = [
    "posting_key",
    "company_key",
    "source",
    "board",
    "posting_id",
    "snapshot_date",
    "title",
    "department",
    "location_raw",
    "workplace_type",
    "employment_type",
    "published_at",
    "updated_at",
    "posting_url",
    "description_text",
]


def _common(df):
    return df.select(
        *[F.col(c).cast(NTZ).alias(c) if c.endswith("_at") else F.col(c) for c in _COMMON]
    )


for _source in ("greenhouse", "lever", "ashby"):

    @query(
        f"normalize_{_source}",
        S.chain(*S.LISTINGS, S.NORMALIZED)
        + f"SELECT {', '.join(_COMMON)} FROM normalized WHERE source = '{_source}'",
    )
    def normalize_source(spark, sf, source=_source):
        return _common(getattr(normalize, f"{source}_postings")(R.lines(spark, sf)))


@query(
    "one_per_snapshot",
    S.chain(*S.TO_DAILY) + f"SELECT {', '.join(_COMMON)} FROM postings",
)
def one_per_snapshot(spark, sf):
    return _common(R.postings(spark, sf))


@query(
    "classified_postings",
    S.chain(*S.TO_DAILY)
    + """SELECT posting_key, snapshot_date, title, role_family, seniority, location_key,
      is_entry_level FROM daily""",
)
def classified_postings(spark, sf):
    return R.classified(spark, sf).select(
        "posting_key",
        "snapshot_date",
        "title",
        "role_family",
        "seniority",
        "location_key",
        "is_entry_level",
    )


@query(
    "unparsed_observations",
    S.chain(*S.LISTINGS, S.UNPARSED) + "SELECT * FROM unparsed",
)
def unparsed_observations(spark, sf):
    return R.unparsed(spark, sf)


# ---- Facts and dimensions --------------------------------------------------------------------

_DAILY = [
    "posting_key",
    "company_key",
    "source",
    "board",
    "posting_id",
    "snapshot_date",
    "title",
    "department",
    "role_family",
    "seniority",
    "is_entry_level",
    "employment_type",
    "workplace_type",
    "location_key",
    "published_at",
]


def _ntz(df, columns):
    return df.select(
        *[F.col(c).cast(NTZ).alias(c) if c == "published_at" else F.col(c) for c in columns]
    )


@query("daily_fact", S.chain(*S.TO_DAILY) + f"SELECT {', '.join(_DAILY)} FROM daily")
def daily_fact(spark, sf):
    ok = manifests.ok_landings(R.manifests(spark, sf))
    return _ntz(lifecycle.daily_fact(R.classified(spark, sf), ok), _DAILY)


@query(
    "daily_fact_incremental", S.chain(*S.TO_DAILY) + f"SELECT {', '.join(_DAILY)} FROM daily"
)
def daily_fact_incremental(spark, sf):
    return _ntz(R.daily(spark, sf), _DAILY)


_SPELL = [
    "posting_spell_key",
    "posting_key",
    "company_key",
    "spell_number",
    "first_seen",
    "last_seen",
    "closed_at",
    "is_open",
    "is_left_censored",
    "snapshots_observed",
    "unparsed_snapshots",
    "days_to_close",
    "title",
    "role_family",
    "seniority",
    "is_entry_level",
    "employment_type",
    "workplace_type",
    "location_key",
    "published_at",
]


@query("spells", S.chain(*S.TO_SPELLS) + f"SELECT {', '.join(_SPELL)} FROM spells")
def spells(spark, sf):
    fact = lifecycle.spell_fact(
        R.daily(spark, sf), R.unparsed(spark, sf), R.manifests(spark, sf)
    )
    return _ntz(fact, _SPELL)


@query(
    "spells_incremental", S.chain(*S.TO_SPELLS) + f"SELECT {', '.join(_SPELL)} FROM spells"
)
def spells_incremental(spark, sf):
    return _ntz(R.spells(spark, sf), _SPELL)


@query(
    "skill_bridge",
    S.chain(*S.TO_DAILY, S.VOCABULARY, S.BRIDGE) + "SELECT * FROM bridge",
)
def skill_bridge(spark, sf):
    return skills.skill_bridge(normalize.normalize(R.lines(spark, sf)), RULES.skill_vocabulary)


@query(
    "skill_bridge_incremental",
    S.chain(*S.TO_DAILY, S.VOCABULARY, S.BRIDGE) + "SELECT * FROM bridge",
)
def skill_bridge_incremental(spark, sf):
    return built.relation(R.lake(spark, sf), "bridge_posting_skill")


_COMPANY_SQL = """SELECT company_key, min(source) AS source, min(board) AS board,
  'Company ' || min(board) AS company_name, min(snapshot_date) AS first_snapshot_date,
  max(snapshot_date) FILTER (WHERE status = 'ok') AS last_ok_snapshot_date,
  count(*) FILTER (WHERE status = 'ok') AS ok_snapshots,
  count(*) FILTER (WHERE status <> 'ok') AS failed_snapshots,
  CAST(sum(reject_count) AS BIGINT) AS rejected_records,
  (SELECT count(DISTINCT posting_key) FROM daily AS d WHERE d.company_key = m.company_key)
    AS postings_seen
FROM manifests AS m GROUP BY company_key"""


@query("dim_company", S.chain(*S.TO_DAILY) + _COMPANY_SQL)
def dim_company(spark, sf):
    return marts.dim_company(R.manifests(spark, sf), R.daily(spark, sf))


@query(
    "dim_location",
    S.chain(
        *S.TO_DAILY,
        S.ALIASES,
        "locations AS (SELECT location_key, arg_max(location_raw, snapshot_date) "
        "AS location_raw FROM daily GROUP BY location_key)",
        S.geo("locations"),
    )
    + """SELECT location_key, location_raw,
      CASE WHEN location_raw IS NULL OR starts_with(lower(location_raw), 'remote') THEN NULL
        ELSE trim(split_part(location_raw, ',', 1)) END AS city,
      region, coalesce(country, 'Unknown') AS country,
      coalesce(contains(lower(location_raw), 'remote'), false) AS mentions_remote
    FROM resolved""",
)
def dim_location(spark, sf):
    return geo.dim_location(R.classified(spark, sf), RULES.frame(spark, "geo_aliases"))


@query(
    "dim_role_family",
    S.chain(*S.TO_DAILY, S.ROLE_FAMILIES)
    + """SELECT f.role_family, display_name, archetype, count(d.posting_key) AS observations
    FROM role_families AS f LEFT JOIN daily AS d ON d.role_family = f.role_family
    GROUP BY f.role_family, display_name, archetype""",
)
def dim_role_family(spark, sf):
    families = marts.dim_role_family(RULES.frame(spark, "role_families"))
    seen = R.daily(spark, sf).groupBy("role_family").agg(F.count("*").alias("observations"))
    return families.join(seen, "role_family", "left").fillna({"observations": 0})


# ---- Marts -----------------------------------------------------------------------------------


def _flow(spark, sf):
    return marts.weekly_flow(R.manifests(spark, sf), R.daily(spark, sf), R.spells(spark, sf))


def _demand(spark, sf):
    lake = R.lake(spark, sf)
    return marts.skill_demand(R.spells(spark, sf), built.relation(lake, "bridge_posting_skill"))


query("weekly_flow", S.chain(*S.TO_SPELLS, S.FLOW) + "SELECT * FROM weekly_flow")(_flow)


@query("time_to_close", S.chain(*S.TO_SPELLS, S.close_times()) + "SELECT * FROM times")
def time_to_close(spark, sf):
    return marts.time_to_close(R.spells(spark, sf))


query("skill_demand", S.chain(*S.TO_DEMAND) + "SELECT * FROM demand")(_demand)


@query("remote_share", S.chain(*S.TO_DAILY, S.WEEKLY) + "SELECT * FROM remote")
def remote_share(spark, sf):
    return marts.remote_share(R.daily(spark, sf))


@query("entry_level_share", S.chain(*S.TO_DAILY, S.WEEKLY) + "SELECT * FROM entry_share")
def entry_level_share(spark, sf):
    return marts.entry_level_share(R.daily(spark, sf))


# ---- Report ----------------------------------------------------------------------------------


@query(
    "report_headline",
    S.chain(*S.TO_SPELLS)
    + """SELECT 'fixture' AS fetch_modes, min(snapshot_date) AS first_snapshot,
      max(snapshot_date) AS last_snapshot, count(DISTINCT company_key) AS boards,
      count(*) FILTER (WHERE status = 'ok') AS ok_snapshots,
      count(*) FILTER (WHERE status <> 'ok') AS failed_snapshots,
      CAST(sum(reject_count) AS BIGINT) AS rejected_records,
      (SELECT count(DISTINCT posting_key) FROM spells) AS distinct_postings,
      (SELECT count(*) FROM spells) AS spells,
      (SELECT count(*) FROM spells WHERE is_open) AS open_postings
    FROM manifests""",
)
def report_headline(spark, sf):
    return report.headline(R.manifests(spark, sf), R.spells(spark, sf))


@query(
    "report_mode_banner",
    S.chain(*S.LISTINGS) + "SELECT CASE WHEN count(*) > 0 THEN 'fixture' END AS mode FROM manifests",
)
def report_mode_banner(spark, sf):
    headline = report.headline(R.manifests(spark, sf), R.spells(spark, sf))
    return report.mode_banner(headline).select("mode")


@query(
    "report_extraction_health",
    S.chain(*S.TO_DAILY, f"dim AS ({_COMPANY_SQL})")
    + """SELECT company_name, source, board, ok_snapshots, failed_snapshots,
      rejected_records, postings_seen FROM dim ORDER BY company_name""",
)
def report_extraction_health(spark, sf):
    return report.extraction_health(built.relation(R.lake(spark, sf), "dim_company"))


@query(
    "report_weekly_flow",
    S.chain(*S.TO_SPELLS, S.FLOW)
    + """SELECT week_start, boards_observed, listed_postings, opened, reopened, closed,
      net_change FROM weekly_flow ORDER BY week_start""",
)
def report_weekly_flow(spark, sf):
    lake = R.lake(spark, sf)
    return report.weekly_flow_table(built.relation(lake, "mart_weekly_postings_flow"))


@query(
    "report_time_to_close",
    S.chain(*S.TO_SPELLS, S.close_times())
    + """SELECT role_family, closed_spells, still_open_spells, median_days_to_close,
      mean_days_to_close, p75_days_to_close FROM times
    ORDER BY role_family = 'all_roles' DESC, closed_spells DESC, role_family""",
)
def report_time_to_close(spark, sf):
    return report.time_to_close_table(built.relation(R.lake(spark, sf), "mart_time_to_close"))


@query(
    "report_top_skills",
    S.chain(*S.TO_DEMAND)
    + """SELECT skill, category, postings_with_skill, share_of_postings, open_with_skill,
      share_of_open FROM demand WHERE role_family = 'all_roles'
    ORDER BY postings_with_skill DESC, skill LIMIT 15""",
)
def report_top_skills(spark, sf):
    return report.top_skills(_demand(spark, sf))


@query(
    "report_top_skills_per_family",
    S.chain(*S.TO_DEMAND)
    + """SELECT role_family, rank_in_family, skill, postings_with_skill, share_of_postings
    FROM demand WHERE role_family <> 'all_roles' AND rank_in_family <= 3""",
)
def report_top_skills_per_family(spark, sf):
    return report.top_skills_per_family(_demand(spark, sf))


@query(
    "report_remote_share",
    S.chain(*S.TO_DAILY, S.WEEKLY)
    + """SELECT week_start, listed_postings, remote_postings, hybrid_postings,
      onsite_postings, remote_share, hybrid_share FROM remote ORDER BY week_start""",
)
def report_remote_share(spark, sf):
    return report.remote_share_table(built.relation(R.lake(spark, sf), "mart_remote_share"))


@query(
    "report_entry_level_share",
    S.chain(*S.TO_DAILY, S.WEEKLY)
    + """SELECT week_start, listed_postings, intern_postings, entry_level_postings,
      entry_level_share FROM entry_share WHERE role_family = 'all_roles'""",
)
def report_entry_level_share(spark, sf):
    return report.entry_level_table(
        built.relation(R.lake(spark, sf), "mart_entry_level_share")
    )


# ---- Upkeep and quality ----------------------------------------------------------------------


@query(
    "pending_landings",
    S.chain(*S.LISTINGS)
    + """SELECT company_key, snapshot_date, posting_count FROM manifests
    WHERE status = 'ok' AND snapshot_date > DATE '2024-01-15'""",
)
def pending_landings(spark, sf):
    """What the second build had to read: landings not in the log of the first."""
    lake = R.lake(spark, sf)
    ok = manifests.ok_landings(lake.manifests())
    loaded = lake.daily_log().where(F.col("snapshot_date") <= F.lit(R.FIRST_LOAD_UNTIL))
    return incremental.pending_landings(ok, loaded).select(
        "company_key", "snapshot_date", "posting_count"
    )


@query(
    "changed_boards",
    S.chain(*S.LISTINGS)
    + """SELECT company_key, CASE WHEN bool_or(day(snapshot_date) % 9 = 4
        AND snapshot_date <= DATE '2024-01-15') THEN 'rebuilt'
      WHEN max(snapshot_date) > DATE '2024-01-15' THEN 'extended' ELSE 'unchanged' END AS change
    FROM manifests WHERE status = 'ok' GROUP BY company_key""",
)
def changed_boards(spark, sf):
    """Boards against an earlier state that ended mid-month and lacked some days."""
    ok = manifests.ok_landings(R.lake(spark, sf).manifests())
    early = ok.where(F.col("snapshot_date") <= F.lit(R.FIRST_LOAD_UNTIL))
    last = early.groupBy("company_key").agg(F.max("snapshot_date").alias("last_day"))
    lacking = early.where(F.dayofmonth("snapshot_date") % 9 != 4)
    known = lifecycle.board_watermarks(lacking).join(last, "company_key")
    return incremental.board_changes(ok, known).select("company_key", "change")


@query(
    "stale_daily_rows",
    S.chain(*S.TO_DAILY)
    + """SELECT posting_key, snapshot_date FROM daily WHERE day(snapshot_date) % 5 = 0""",
)
def stale_daily_rows(spark, sf):
    """Daily rows that stop counting when every fifth day is withdrawn."""
    lake = R.lake(spark, sf)
    kept = manifests.ok_landings(lake.manifests()).where(F.dayofmonth("snapshot_date") % 5 != 0)
    return incremental.stale_rows(lake.observations(), kept, incremental.LANDING).select(
        "posting_key", "snapshot_date"
    )


def _kept_mart(name, mart, ctes, relation):
    """A mart as two builds left it, from states that the second one added to or replaced."""
    query(f"{name}_incremental", S.chain(*ctes) + f"SELECT * FROM {relation}")(
        lambda spark, sf: built.relation(R.lake(spark, sf), mart)
    )


_kept_mart("weekly_flow", "mart_weekly_postings_flow", [*S.TO_SPELLS, S.FLOW], "weekly_flow")
_kept_mart("time_to_close", "mart_time_to_close", [*S.TO_SPELLS, S.close_times()], "times")
_kept_mart("remote_share", "mart_remote_share", [*S.TO_DAILY, S.WEEKLY], "remote")
_kept_mart("entry_level_share", "mart_entry_level_share", [*S.TO_DAILY, S.WEEKLY], "entry_share")


@query("dim_company_incremental", S.chain(*S.TO_DAILY) + _COMPANY_SQL)
def dim_company_incremental(spark, sf):
    return built.relation(R.lake(spark, sf), "dim_company")


@query(
    "entry_level_share_after_withdrawal",
    S.chain(
        S.ITEMS,
        S.MANIFESTS.replace("manifests AS (", "landed AS ("),
        "manifests AS (SELECT * REPLACE (CASE WHEN day(snapshot_date) % 5 = 0 "
        "THEN 'contract_failed' ELSE status END AS status) FROM landed)",
        S.NORMALIZED,
        S.ROLE_RULES,
        S.CLASSIFIED,
        S.WEEKLY,
    )
    + "SELECT * FROM entry_share",
)
def entry_level_share_after_withdrawal(spark, sf):
    """Every fifth day is withdrawn: only states of the weeks it touches are replaced."""
    lake = R.lake(spark, sf)
    before = manifests.ok_landings(lake.manifests())
    now = before.where(F.dayofmonth("snapshot_date") % 5 != 0)
    touched = incremental.touched_weeks(before, now)
    numbered = lambda df, n: df.withColumn("build", F.lit(n).cast("bigint"))
    first = marts.week_states(incremental.current_daily(lake.observations(), before))
    second = marts.week_states(incremental.of_weeks(lake.observations(), now, touched))
    every = first.select("week_start", "company_key").distinct()
    states = incremental.live_states(
        numbered(first, 1).unionByName(numbered(second, 2)),
        numbered(every, 1).unionByName(numbered(touched, 2)),
    )
    return marts.entry_level_share_of(states)


@query(
    "spells_after_withdrawal",
    S.chain(
        S.ITEMS,
        S.MANIFESTS.replace("manifests AS (", "landed AS ("),
        "manifests AS (SELECT * REPLACE (CASE WHEN day(snapshot_date) % 5 = 0 "
        "THEN 'contract_failed' ELSE status END AS status) FROM landed)",
        S.NORMALIZED,
        S.ROLE_RULES,
        S.CLASSIFIED,
        S.UNPARSED,
        S.SPELLS,
    )
    + f"SELECT {', '.join(_SPELL)} FROM spells",
)
def spells_after_withdrawal(spark, sf):
    """Spells of stored rows when every fifth day is withdrawn: nothing closes on such a day."""
    lake = R.lake(spark, sf)
    kept = lake.manifests().where(F.dayofmonth("snapshot_date") % 5 != 0)
    daily = incremental.current_daily(lake.observations(), manifests.ok_landings(kept))
    unparsed = manifests.unparsed_observations(manifests.rejected_ids(lake.items(), kept))
    return _ntz(lifecycle.spell_fact(daily, unparsed, kept), _SPELL)


@query(
    "lines_match_manifests",
    S.chain(*S.LISTINGS)
    + """SELECT company_key, snapshot_date FROM manifests
    WHERE status = 'ok' AND day(snapshot_date) % 7 = 0""",
)
def lines_match_manifests(spark, sf):
    """The reconciliation finds exactly the days whose manifest was given a wrong count."""
    wrong = F.when(F.dayofmonth("snapshot_date") % 7 == 0, 1).otherwise(0)
    tampered = R.manifests(spark, sf).withColumn("posting_count", F.col("posting_count") + wrong)
    return quality.landed_versus_manifests(R.lines(spark, sf), tampered).select(
        "company_key", "snapshot_date"
    )


@query(
    "daily_matches_rebuild",
    S.chain(*S.TO_DAILY)
    + """SELECT problem, company_key, snapshot_date, count(*) AS rows_affected
    FROM (SELECT company_key, snapshot_date,
        unnest(['missing_or_changed_in_fact', 'stale_in_fact']) AS problem
      FROM daily WHERE role_family = 'data_engineering')
    GROUP BY problem, company_key, snapshot_date""",
)
def daily_matches_rebuild(spark, sf):
    """A changed role rule shows up as drift of the stored fact."""
    fewer = [r for r in RULES.role_family_rules if r[1] != "data_engineering"]
    postings = normalize.classify(R.postings(spark, sf), fewer)
    rebuilt = lifecycle.daily_fact(postings, manifests.ok_landings(R.manifests(spark, sf)))
    return quality.fact_versus_rebuild(rebuilt, R.daily(spark, sf))


@query(
    "closures_on_ok",
    S.chain(*S.TO_SPELLS)
    + """SELECT posting_spell_key, closed_at FROM spells WHERE day(closed_at) % 6 = 0""",
)
def closures_on_ok(spark, sf):
    """Closures that would be unfounded if every sixth day had failed."""
    fewer = R.manifests(spark, sf).where(F.dayofmonth("snapshot_date") % 6 != 0)
    return quality.closures_off_calendar(R.spells(spark, sf), fewer)


@query(
    "open_on_latest",
    S.chain(*S.TO_SPELLS)
    + """SELECT posting_spell_key, last_seen, latest_ok FROM spells JOIN (
      SELECT company_key, max(snapshot_date) AS latest_ok FROM manifests
      WHERE status = 'ok' AND snapshot_date < DATE '2024-01-30' GROUP BY company_key
    ) AS m USING (company_key) WHERE is_open AND last_seen <> latest_ok""",
)
def open_on_latest(spark, sf):
    """Open spells that were seen after the calendar was cut short."""
    shorter = R.manifests(spark, sf).where("snapshot_date < DATE '2024-01-30'")
    return quality.open_before_latest(R.spells(spark, sf), shorter)


@query(
    "flow_matches_spells",
    S.chain(*S.TO_SPELLS, S.FLOW)
    + """SELECT * FROM (
      SELECT 'opened' AS measure, CAST(sum(opened) AS BIGINT) AS weekly_total,
        (SELECT count(*) FROM spells WHERE NOT is_left_censored) AS lifecycle_total
        FROM weekly_flow WHERE week_start > DATE '2024-01-08'
      UNION ALL SELECT 'closed', CAST(sum(closed) AS BIGINT),
        (SELECT count(*) FROM spells WHERE closed_at IS NOT NULL)
        FROM weekly_flow WHERE week_start > DATE '2024-01-08'
      UNION ALL SELECT 'reopened', CAST(sum(reopened) AS BIGINT),
        (SELECT count(*) FROM spells WHERE spell_number > 1)
        FROM weekly_flow WHERE week_start > DATE '2024-01-08'
    ) WHERE weekly_total <> lifecycle_total""",
)
def flow_matches_spells(spark, sf):
    """Totals disagree once the first weeks are left out."""
    later = _flow(spark, sf).where("week_start > DATE '2024-01-08'")
    return quality.flow_versus_spells(later, R.spells(spark, sf))


@query("quality_suite")
def quality_suite(spark, sf):
    """All standard checks on the built lake."""
    return built.check(R.lake(spark, sf), RULES)


@query(
    "quality_summary",
    "SELECT CAST(81 AS BIGINT) AS passed, CAST(0 AS BIGINT) AS failed, '' AS failing_checks",
)
def quality_summary(spark, sf):
    return quality.outcome_summary(quality_suite(spark, sf))
