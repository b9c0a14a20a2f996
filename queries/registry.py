"""Query registration and the frames derived from the given tables.

The given tables hold no listings, so responses of three providers are derived from ``events``
(who was seen on which board and day), ``part`` and ``nation`` (texts): one item per event. A board
serves 50 users, whose events of one type and day make up a response. Bad records, failed requests, unusable bodies and truncated responses are
derived from the day and the event's properties.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelist.operators.gates import Policy
from tidelist.operators.manifests import unparsed_observations
from tidelist.operators.normalize import classify, normalize, one_per_snapshot
from tidelist.plans import build as built
from tidelist.plans.build import build
from tidelist.plans.landing import land
from tidelist.session import bound_broadcasts, shared_folder
from tidelist.sources.lake import Lake
from tidelist.sources.rules import Rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RULES = Rules()
POLICY = Policy()


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it on whole tables, its oracle."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(bound_broadcasts(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- Derived responses -----------------------------------------------------------------------


def derived_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per item a board lists on a day, before it is made into JSON."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "user_id",
        "value",
        F.to_date("ts").alias("d"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    seen = events.groupBy("event_type", "user_id", "d").agg(
        F.count("*").alias("n"), F.max("value").alias("v"), F.max_by("k", "event_id").alias("k")
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("user_id"), "p_name", "p_brand"
    )
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("nation"), "n_name"
    )
    g = F.floor(F.col("user_id") / 50)
    dom = F.dayofmonth("d")
    located = (
        seen.join(part, "user_id", "left")
        .withColumn("nation", F.col("user_id") % 25)
        .join(nation, "nation", "left")
    )
    source = (
        F.when(F.col("event_type").isin("view", "click"), "greenhouse")
        .when(F.col("event_type").isin("purchase", "error"), "lever")
        .otherwise("ashby")
    )
    job = F.element_at(
        F.array(
            *[
                F.lit(t)
                for t in (
                    "Senior Data Engineer",
                    "Software Engineering Intern",
                    "Account Executive",
                    "Machine Learning Engineer",
                    "QA Analyst Co-op",
                    "Associate Product Manager",
                    "Director, Platform Engineering",
                    "Warehouse Helper",
                )
            ]
        ),
        (F.col("k") % 8 + 1).cast("int"),
    )
    p_name = F.coalesce("p_name", F.lit("item"))
    place = F.col("user_id") % 7
    location = (
        F.when(place == 0, F.lit("Toronto, CA"))
        .when(place == 1, F.concat(F.lit("Remote - "), "n_name"))
        .when(place == 2, F.lit("Bengaluru, IN"))
        .when(place == 3, F.lit("London, ON"))
        .when(place == 4, F.lit("Nagpur, IN (hybrid)"))
        .when(place == 6, F.lit("Paris / Remote"))
    )
    words = F.element_at(
        F.array(*[F.lit(w) for w in ("python", "sql", "go, rust", "excel", "c++ & git", "none")]),
        (F.col("k") % 6 + 1).cast("int"),
    )
    response_kind = (dom * 7 + g * 3) % 29
    titled = located.select(
        "user_id",
        "d",
        "k",
        "v",
        "p_brand",
        source.alias("source"),
        F.concat("event_type", F.lit("-"), g.cast("string")).alias("board"),
        response_kind.alias("response_kind"),
        F.concat(job, F.lit(" - "), p_name).alias("job"),
        location.alias("location"),
        words.alias("words"),
        F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"),
    )
    blank = (F.col("v") < 3) | (F.col("response_kind") == 4) & (F.col("k") % 2 == 0)
    return titled.withColumns(
        {
            "title": F.when(blank, F.lit(" \t")).otherwise(
                F.concat("job", F.when(F.col("copy") == 2, " (copy)").otherwise(""))
            ),
            "id": F.when(
                F.col("k") != 41,
                F.when(F.col("source") == "greenhouse", F.col("user_id").cast("string")).otherwise(
                    F.concat(F.lit("u"), F.col("user_id").cast("string"))
                ),
            ),
        }
    )


def _item_json(items: DataFrame) -> DataFrame:
    day = F.col("d").cast("string")
    stamp = F.when(F.col("k") == 37, F.lit("yesterday")).otherwise(
        F.concat(day, F.lit("T08:00:00-04:00"))
    )
    url = F.concat(F.lit("https://example.invalid/"), F.col("user_id").cast("string"))
    html = F.concat(
        F.lit("&lt;p&gt;We use "), F.replace("words", F.lit("&"), F.lit("&amp;amp;")),
        F.lit(" daily.&lt;/p&gt;"),
    )
    greenhouse = F.struct(
        F.col("id").cast("bigint").alias("id"),
        "title",
        stamp.alias("updated_at"),
        url.alias("absolute_url"),
        F.struct(F.col("location").alias("name")).alias("location"),
        html.alias("content"),
        F.concat(day, F.lit("T00:00:00Z")).alias("first_published"),
        F.array(F.struct(F.col("p_brand").alias("name"))).alias("departments"),
    )
    millis = (F.unix_date("d") * F.lit(86_400_000).cast("bigint")).cast("string")
    lever = F.struct(
        "id",
        F.col("title").alias("text"),
        F.when(F.col("k") == 37, F.lit("soon")).otherwise(millis).alias("createdAt"),
        url.alias("hostedUrl"),
        F.struct(
            "location",
            F.when(F.col("k") % 3 == 0, F.lit("Full-time"))
            .when(F.col("k") % 3 == 1, F.lit("Contract"))
            .alias("commitment"),
            F.col("p_brand").alias("team"),
        ).alias("categories"),
        F.when(F.col("k") % 4 == 0, F.lit("on-site"))
        .when(F.col("k") % 4 == 1, F.lit("hybrid"))
        .alias("workplaceType"),
        F.concat(F.lit("We use "), "words").alias("descriptionPlain"),
        F.array(
            F.struct(F.lit("<li>daily</li>").alias("content")),
            F.struct(F.lit("<li>weekly</li>").alias("content")),
        ).alias("lists"),
        F.lit("Apply.").alias("additionalPlain"),
    )
    ashby = F.struct(
        "id",
        "title",
        stamp.alias("publishedAt"),
        url.alias("jobUrl"),
        (F.col("k") % 9 != 0).alias("isListed"),
        F.when(F.col("k") % 5 == 0, F.lit(True)).alias("isRemote"),
        F.when(F.col("k") % 2 == 0, F.lit("OnSite")).alias("workplaceType"),
        F.when(F.col("k") % 3 == 0, F.lit("PartTime")).alias("employmentType"),
        "location",
        F.col("p_brand").alias("department"),
        html.alias("descriptionHtml"),
    )
    payload = (
        F.when(F.col("k") == 43, F.lit('"not an object"'))
        .when(F.col("source") == "greenhouse", F.to_json(greenhouse))
        .when(F.col("source") == "lever", F.to_json(lever))
        .otherwise(F.to_json(ashby))
    )
    return items.withColumn("json", payload)


def derived_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, board, snapshot_date, http_status, body) as three providers would answer."""
    items = _item_json(derived_items(spark, sf_dir))
    # The events of one type and day of 50 users make up one body.
    grouped = items.groupBy("source", "board", "d", "response_kind").agg(
        F.array_sort(F.collect_list(F.struct("user_id", "copy", "json"))).alias("items")
    )
    listing = F.concat(
        F.lit("["), F.array_join(F.transform("items", lambda i: i["json"]), ","), F.lit("]")
    )
    body = (
        F.when(F.col("response_kind") == 2, F.lit("<html>maintenance</html>"))
        .when(F.col("response_kind") == 3, F.lit('{"positions": []}'))
        .when(F.col("source") == "lever", listing)
        .otherwise(F.concat(F.lit('{"jobs":'), listing, F.lit("}")))
    )
    return grouped.select(
        "source",
        "board",
        F.col("d").alias("snapshot_date"),
        F.when(F.col("response_kind") == 1, 500).otherwise(200).alias("http_status"),
        F.when(F.col("response_kind") != 1, body).alias("body"),
    )


def derived_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board settings: no drop check for purchases, a strict one for errors."""
    boards = derived_items(spark, sf_dir).select("source", "board").distinct()
    purchase = F.startswith("board", F.lit("purchase"))
    strict = F.startswith("board", F.lit("error"))
    return boards.select(
        "source",
        "board",
        F.concat(F.lit("Company "), "board").alias("company"),
        (purchase | strict).alias("overrides_drop_ratio"),
        F.when(strict, F.lit(0.3)).alias("max_drop_ratio"),
    )


# ---- Frames further down the chain -----------------------------------------------------------

_LAKES: dict[tuple[str, str], Lake] = {}
FIRST_LOAD_UNTIL = date(2024, 1, 15)


def _kept(df: DataFrame, folder: str) -> DataFrame:
    """The rows, written and read again."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The derived responses, landed and built in two steps, once per session and data set.

    The second step adds later days, so what queries read has gone through incremental upkeep.
    The lake is written to the shared folder of the cluster.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        made = Lake(spark, f"{shared_folder(spark)}/tidelist-{uuid4().hex}")
        # Every step of both landings reads them: they are derived once.
        responses = _kept(derived_responses(spark, sf_dir), f"{made.root}-responses")
        boards = _kept(derived_boards(spark, sf_dir), f"{made.root}-boards")
        early = F.col("snapshot_date") <= F.lit(FIRST_LOAD_UNTIL)
        for part in (responses.where(early), responses.where(~early)):
            days = sorted(r[0] for r in part.select("snapshot_date").distinct().collect())
            land(made, part, boards, POLICY, dates=days)
            build(made, RULES)
        _LAKES[key] = made
    return _LAKES[key]


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items parsed and judged on landing."""
    return lake(spark, sf_dir).items()


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).manifests()


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid lines of the successful landings."""
    return lake(spark, sf_dir).lines()


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_per_snapshot(normalize(lines(spark, sf_dir)))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(postings(spark, sf_dir), RULES.role_family_rules)


def unparsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unparsed_observations(lake(spark, sf_dir).rejected_ids())


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored snapshot fact."""
    return built.daily(lake(spark, sf_dir))


def spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored spell fact."""
    return built.spells(lake(spark, sf_dir))
