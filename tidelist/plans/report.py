"""Result sets of the report, read from a built lake."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidelist.operators import report
from tidelist.plans.build import relation, require_built
from tidelist.sources.lake import Lake


def report_frames(lake: Lake) -> dict[str, DataFrame]:
    """All result sets by name; fails early if nothing has been built."""
    require_built(lake)
    demand = relation(lake, "mart_skill_demand")
    headline = report.headline(lake.manifests(), relation(lake, "fct_postings"))
    return {
        "headline": headline,
        "mode_banner": report.mode_banner(headline),
        "extraction_health": report.extraction_health(relation(lake, "dim_company")),
        "weekly_flow": report.weekly_flow_table(relation(lake, "mart_weekly_postings_flow")),
        "time_to_close": report.time_to_close_table(relation(lake, "mart_time_to_close")),
        "top_skills": report.top_skills(demand),
        "top_skills_per_family": report.top_skills_per_family(demand),
        "remote_share": report.remote_share_table(relation(lake, "mart_remote_share")),
        "entry_level_share": report.entry_level_table(relation(lake, "mart_entry_level_share")),
    }
