"""Queries that run the operators directly on the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from queries import sql as S
from queries.registry import RULES, query, table
from tidelist import fixed_values as fixed
from tidelist.functions import dates, payload, text
from tidelist.operators import gates, geo, incremental, lifecycle, manifests, marts, quality
from tidelist.operators import skills
from tidelist.operators.normalize import first_per_key, union_sources

# ---- Lifecycle of users per event type -------------------------------------------------------
# A user who caused an event of a type on a day was "listed" there; a day without a value of at
# least 5 counts as listed but unreadable. Every seventh day fails for two of the types.


def _documents(spark, sf):
    return table(spark, sf, "documents")


def _event_days(spark, sf):
    return (
        table(spark, sf, "events")
        .select(
            "event_type",
            F.concat("event_type", F.lit(":"), F.col("user_id").cast("string")).alias("user"),
            F.to_date("ts").alias("day"),
            "value",
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            "event_id",
        )
        .groupBy("event_type", "user", "day")
        .agg(
            F.max("value").alias("value"),
            F.max_by("k", "event_id").alias("k"),
            F.count("*").alias("n"),
        )
        .withColumn("role_family", F.concat(F.lit("r"), (F.col("k") % 5).cast("string")))
    )


def _event_calendar(spark, sf):
    days = table(spark, sf, "events").select("event_type", F.to_date("ts").alias("day")).distinct()
    failed = F.col("event_type").isin("click", "error") & (F.dayofmonth("day") % 7 == 3)
    return lifecycle.snapshot_calendar(days.where(~failed), "event_type", "day")


def _event_spells(spark, sf):
    seen = _event_days(spark, sf)
    return lifecycle.spells(
        seen.where("value >= 5"),
        seen.where("value < 5"),
        _event_calendar(spark, sf),
        ["k", "role_family"],
        "user",
        "event_type",
        "day",
    )


_EVENT_DAYS = """
seen AS (
  SELECT event_type, event_type || ':' || CAST(user_id AS VARCHAR) AS "user",
    CAST(ts AS DATE) AS day, max(value) AS value,
    arg_max(CAST(json_extract_string(props, '$.k') AS BIGINT), event_id) AS k, count(*) AS n
  FROM events GROUP BY event_type, user_id, CAST(ts AS DATE)
),
days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day FROM events),
calendar AS (
  SELECT event_type, day,
    row_number() OVER (PARTITION BY event_type ORDER BY day) AS seq,
    min(day) OVER (PARTITION BY event_type) AS first_day
  FROM days WHERE NOT (event_type IN ('click', 'error') AND day(day) % 7 = 3)
)
"""

# A run starts where the day before in the calendar is not the user's day before.
_EVENT_SPELLS = """
placed AS (
  SELECT s.*, c.seq, c.first_day,
    coalesce(c.seq - lag(c.seq) OVER (PARTITION BY s."user" ORDER BY c.seq), 0) <> 1 AS starts
  FROM seen AS s, calendar AS c WHERE c.event_type = s.event_type AND c.day = s.day
),
runs AS (
  SELECT *, count_if(starts) OVER (PARTITION BY "user" ORDER BY seq) AS run FROM placed
),
listed AS (
  SELECT "user", event_type, run, first_day,
    list({'seq': seq, 'day': day, 'k': k, 'fine': value >= 5} ORDER BY seq) AS days
  FROM runs GROUP BY ALL
),
spells AS (
  SELECT l."user" || '@' || CAST(days[1].day AS VARCHAR) AS posting_spell_key, l."user",
    l.event_type, row_number() OVER (PARTITION BY l."user" ORDER BY run) AS spell_number,
    days[1].day AS first_seen, days[-1].day AS last_seen, gone.day AS closed_at,
    gone.day IS NULL AS is_open, days[1].day = l.first_day AS is_left_censored,
    len(days) AS snapshots_observed,
    len(list_filter(days, lambda d: NOT d.fine)) AS unparsed_snapshots,
    date_diff('day', days[1].day, gone.day) AS days_to_close,
    list_filter(days, lambda d: d.fine)[-1].k AS k,
    'r' || CAST(list_filter(days, lambda d: d.fine)[-1].k % 5 AS VARCHAR) AS role_family
  FROM listed AS l LEFT JOIN calendar AS gone
    ON gone.event_type = l.event_type AND gone.seq - 1 = days[-1].seq
  WHERE len(list_filter(days, lambda d: d.fine)) > 0
)
"""

query("event_spells", S.chain(_EVENT_DAYS, _EVENT_SPELLS) + "SELECT * FROM spells")(
    _event_spells
)


@query(
    "event_weekly_flow",
    S.chain(
        _EVENT_DAYS,
        _EVENT_SPELLS,
        """manifests AS (SELECT event_type AS company_key, day AS snapshot_date, 'ok' AS status
          FROM calendar),
        daily AS (SELECT event_type AS company_key, "user" AS posting_key, seen.day
          AS snapshot_date FROM seen JOIN calendar USING (event_type, day) WHERE value >= 5)""",
        S.FLOW,
    )
    + "SELECT * FROM weekly_flow",
)
def event_weekly_flow(spark, sf):
    names = {"event_type": "company_key", "user": "posting_key", "day": "snapshot_date"}
    calendar = _event_calendar(spark, sf)
    seen = _event_days(spark, sf).where("value >= 5")
    daily = seen.join(calendar.select("event_type", "day"), ["event_type", "day"])
    return marts.weekly_flow(
        calendar.withColumn("status", F.lit("ok")).withColumnsRenamed(names),
        daily.withColumnsRenamed(names),
        _event_spells(spark, sf).withColumnsRenamed(names),
    )


@query(
    "event_time_to_close",
    S.chain(_EVENT_DAYS, _EVENT_SPELLS, S.close_times("spells", "event_type"))
    + "SELECT * FROM times",
)
def event_time_to_close(spark, sf):
    return marts.time_to_close(_event_spells(spark, sf), role="event_type")


@query(
    "event_weekly_latest",
    S.chain(_EVENT_DAYS)
    + """SELECT CAST(date_trunc('week', day) AS DATE) AS week_start, "user" AS posting_key, k
    FROM seen QUALIFY row_number() OVER (
      PARTITION BY date_trunc('week', day), "user" ORDER BY day DESC) = 1""",
)
def event_weekly_latest(spark, sf):
    names = {"user": "posting_key", "day": "snapshot_date"}
    return marts.weekly_latest(_event_days(spark, sf).withColumnsRenamed(names), ["k"])


@query(
    "event_current_manifests",
    """WITH attempts AS (
      SELECT event_type || ':' || CAST(user_id AS VARCHAR) AS company_key,
        CAST(ts AS DATE) AS snapshot_date, event_id AS load,
        CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 = 0 AS withdraws,
        value < 20 AS fails
      FROM events),
    judged AS (SELECT *, NOT withdraws AND NOT fails AS is_ok FROM attempts),
    state AS (
      SELECT company_key, snapshot_date,
        max(load) FILTER (WHERE is_ok) AS last_ok,
        max(load) FILTER (WHERE withdraws) AS last_withdrawal,
        max(load) FILTER (WHERE NOT is_ok) AS last_other
      FROM judged GROUP BY company_key, snapshot_date)
    SELECT company_key, snapshot_date,
      CASE WHEN last_ok > coalesce(last_withdrawal, -1) THEN last_ok ELSE last_other END AS load,
      CASE WHEN last_ok > coalesce(last_withdrawal, -1) THEN 'ok'
        WHEN last_other = last_withdrawal THEN 'contract_failed' ELSE 'failed' END AS status
    FROM state""",
)
def event_current_manifests(spark, sf):
    """Events as landing attempts: some fail, some withdraw what was landed before."""
    withdraws = F.get_json_object("props", "$.k").cast("bigint") % 4 == 0
    attempts = table(spark, sf, "events").select(
        F.concat("event_type", F.lit(":"), F.col("user_id").cast("string")).alias("company_key"),
        F.to_date("ts").alias("snapshot_date"),
        F.col("event_id").alias("load"),
        F.when(withdraws, "invalidate").otherwise("land").alias("event"),
        F.when(withdraws, "contract_failed")
        .when(F.col("value") < 20, "failed")
        .otherwise("ok")
        .alias("status"),
    )
    return manifests.current_manifests(attempts).select(
        "company_key", "snapshot_date", "load", "status"
    )


@query(
    "event_watermarks",
    """SELECT event_type AS company_key, md5(string_agg(CAST(day AS VARCHAR) || '@' || n, ','
      ORDER BY day)) AS board_watermark
    FROM (SELECT event_type, CAST(ts AS DATE) AS day, CAST(count(*) AS VARCHAR) AS n
      FROM events GROUP BY event_type, CAST(ts AS DATE)) GROUP BY event_type""",
)
def event_watermarks(spark, sf):
    landings = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("company_key"), F.to_date("ts").alias("snapshot_date"))
        .agg(F.count("*").cast("string").alias("landing_id"))
    )
    return lifecycle.board_watermarks(landings)


# ---- Texts -----------------------------------------------------------------------------------

WORDS = [
    ("the", "en", r"\bthe\b"),
    ("and", "en", r"\band\b|\bor\b"),
    ("sch", "de", r"\bsch\b"),
    ("nicht", "de", r"\b(nicht|und)\b"),
    ("le", "fr", r"\ble\b"),
    ("accented", "fr", r"(^|\s)é[a-z]*"),
    ("question", "mark", r"[?!]\s|[?!]$"),
    ("number", "mark", r"\b\d{4,}\b"),
    ("mail", "mark", r"\b[a-z0-9._]+@[a-z0-9.]+\b"),
    ("last stop", "mark", r"\.$"),
]
_WORDS = S.values(WORDS, "words", "skill, category, pattern")


@query(
    "document_tags",
    S.chain(_WORDS)
    + """SELECT doc_id, skill, category FROM documents JOIN words
    ON regexp_matches(lower(text), pattern)""",
)
def document_tags(spark, sf):
    docs = _documents(spark, sf).select("doc_id", F.lower("text").alias("txt"))
    return skills.tag_texts(docs, "txt", WORDS, ["doc_id"])


@query(
    "document_skills",
    S.chain(S.VOCABULARY)
    + """SELECT doc_id, skill, category FROM documents JOIN vocabulary
    ON regexp_matches(lower(text), pattern)""",
)
def document_skills(spark, sf):
    """The full skill vocabulary on whole documents."""
    docs = _documents(spark, sf).select("doc_id", F.lower("text").alias("txt"))
    return skills.tag_texts(docs, "txt", RULES.skill_vocabulary, ["doc_id"])


@query(
    "document_tag_demand",
    S.chain(
        _WORDS,
        """spells AS (SELECT CAST(doc_id AS VARCHAR) AS posting_key, lang AS role_family,
          doc_id AS last_seen, n_chars > 500 AS is_open FROM documents),
        bridge AS (SELECT CAST(doc_id AS VARCHAR) AS posting_key, skill, category
          FROM documents JOIN words ON regexp_matches(lower(text), pattern))""",
        S.DEMAND,
    )
    + "SELECT * FROM demand",
)
def document_tag_demand(spark, sf):
    docs = _documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("posting_key"),
        F.col("lang").alias("role_family"),
        F.col("doc_id").alias("last_seen"),
        (F.col("n_chars") > 500).alias("is_open"),
        F.lower("text").alias("txt"),
    )
    tags = skills.tag_texts(docs, "txt", WORDS, ["posting_key"])
    return marts.skill_demand(docs.drop("txt"), tags)


@query(
    "document_top_tags",
    S.chain(_WORDS)
    + """SELECT skill, count(*) AS n FROM documents JOIN words
    ON regexp_matches(lower(text), pattern) GROUP BY skill ORDER BY n DESC, skill LIMIT 5""",
)
def document_top_tags(spark, sf):
    tags = document_tags(spark, sf).groupBy("skill").agg(F.count("*").alias("n"))
    return tags.orderBy(F.col("n").desc(), "skill").limit(5)


_FIRST_RULES = [(10, "german", r"\bsch\b"), (20, "english", r"\bthe\b"), (30, "french", r"\ble\b")]


@query(
    "document_first_rule",
    S.chain(S.values(_FIRST_RULES, "rules", "priority, role_family, pattern"))
    + """SELECT d.doc_id, coalesce(arg_min(role_family, priority), 'other') AS role_family
    FROM documents AS d LEFT JOIN rules ON regexp_matches(lower(d.text), pattern)
    GROUP BY d.doc_id""",
)
def document_first_rule(spark, sf):
    rules = [(priority, family, pattern) for priority, family, pattern in _FIRST_RULES]
    return _documents(spark, sf).select(
        "doc_id", text.role_family(F.col("text"), rules).alias("role_family")
    )


@query(
    "document_copies",
    """SELECT md5(text) AS text_key, min(doc_id) AS doc_id, min(lang) AS lang
    FROM documents GROUP BY md5(text)""",
)
def document_copies(spark, sf):
    """One document per distinct text, however many copies there are."""
    docs = table(spark, sf, "documents").select(F.md5("text").alias("text_key"), "doc_id", "lang")
    return first_per_key(docs, ["text_key"], [F.col("doc_id")])


_DECODE = "{}"
for _entity, _char in [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "''"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
]:
    _DECODE = f"replace({_DECODE}, '{_entity}', '{_char}')"


@query("page_entities", f"SELECT page_id, {_DECODE.format('html')} AS decoded FROM pages")
def page_entities(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.decode_entities(F.col("html")).alias("decoded")
    )


@query(
    "page_text",
    f"""WITH stripped AS (
      SELECT page_id, regexp_replace({_DECODE.format('html')}, '<[^>]+>', ' ', 'g') AS s
      FROM pages)
    SELECT page_id, nullif(trim(regexp_replace({_DECODE.format('s')}, '\\s+', ' ', 'g')), '')
      AS content FROM stripped""",
)
def page_text(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.html_to_text(F.col("html")).alias("content")
    )


_TITLES = """
titles AS (
  SELECT p_partkey, CASE p_size % 10 WHEN 0 THEN 'Senior ' WHEN 1 THEN 'Associate '
    WHEN 2 THEN 'Head of ' WHEN 3 THEN 'Jr. ' WHEN 4 THEN 'Associate Counsel, '
    WHEN 5 THEN 'Internal ' WHEN 6 THEN 'Principal ' WHEN 7 THEN 'Entry-level ' ELSE '' END
    || CASE p_partkey % 9 WHEN 0 THEN 'Data Engineer' WHEN 1 THEN 'ML Engineer'
      WHEN 2 THEN 'Security Analyst' WHEN 3 THEN 'QA Tester' WHEN 4 THEN 'Product Owner'
      WHEN 5 THEN 'UX Designer' WHEN 6 THEN 'iOS Developer' WHEN 7 THEN 'Sales Co-op'
      ELSE p_name END AS title,
    CASE p_partkey % 8 WHEN 0 THEN 'Full-time' WHEN 1 THEN 'PartTime' WHEN 2 THEN 'Intern'
      WHEN 3 THEN 'Co-op' WHEN 4 THEN 'Contract' WHEN 5 THEN 'Fixed term'
      WHEN 6 THEN 'Other' END AS label
  FROM part
)
"""


def _titles(spark, sf):
    """Job titles and employment labels made of part names and sizes."""
    pick = lambda key, options: F.element_at(
        F.array(*[F.lit(o) if isinstance(o, str) else o for o in options]),
        (key % len(options) + 1).cast("int"),
    )
    rank = (
        "Senior |Associate |Head of |Jr. |Associate Counsel, |Internal |Principal |"
        "Entry-level ||"
    ).split("|")
    jobs = "Data Engineer|ML Engineer|Security Analyst|QA Tester|Product Owner|UX Designer|"
    jobs = [*(jobs + "iOS Developer|Sales Co-op").split("|"), F.col("p_name")]
    labels = "Full-time|PartTime|Intern|Co-op|Contract|Fixed term|Other".split("|")
    labels = [*labels, F.lit(None).cast("string")]
    return table(spark, sf, "part").select(
        "p_partkey",
        F.concat(pick(F.col("p_size"), rank), pick(F.col("p_partkey"), jobs)).alias("title"),
        pick(F.col("p_partkey"), labels).alias("label"),
    )


_EMPLOYMENT = "coalesce({}, 'unknown')".format(
    ", ".join(
        f"CASE WHEN regexp_matches(lower({column}), {S.text(pattern)}) THEN {S.text(kind)} END"
        for column, pattern, kind in [
            *(("label", *rule) for rule in fixed.EMPLOYMENT_LABEL_RULES),
            ("title", fixed.INTERN_TITLE, "internship"),
        ]
    )
)


@query(
    "title_classification",
    S.chain(
        _TITLES,
        f"employed AS (SELECT *, {_EMPLOYMENT} AS employment_type FROM titles)",
        S.ROLE_RULES,
    )
    + f"""SELECT p_partkey, title, employment_type,
      {S.seniority_sql('title', 'employment_type')} AS seniority,
      coalesce((SELECT arg_min(role_family, priority) FROM role_rules
        WHERE regexp_matches(lower(title), pattern)), 'other') AS role_family
    FROM employed""",
)
def title_classification(spark, sf):
    title = F.col("title")
    employed = _titles(spark, sf).withColumn(
        "employment_type", text.employment_type(F.col("label"), title)
    )
    return employed.select(
        "p_partkey",
        "title",
        "employment_type",
        text.seniority(title, F.col("employment_type")).alias("seniority"),
        text.role_family(title, RULES.role_family_rules).alias("role_family"),
    )


# ---- Locations -------------------------------------------------------------------------------

_PLACES = (
    "Toronto, ON|Toronto, CA|Sacramento, CA|London, UK|London|Bengaluru, IN|Nagpur, IN|"
    "Remote - Canada|Remote (US)|New York, NY|Seattle, WA / Remote|Dublin, Ireland|Berlin|"
    "Paris; Hybrid|Kyoto|CA|IN|Ontario, Canada|Sydney, Australia|Tokyo|Washington D.C.|"
    "Pune / Mumbai|Austin, TX, USA|Mexico City|"
).split("|")


def _locations(spark, sf):
    """Locations of customers: a place by nation, sometimes with the market segment added."""
    place = F.element_at(
        F.array(*[F.lit(p) for p in _PLACES]), (F.col("c_nationkey") % len(_PLACES) + 1)
    )
    tail = F.when(
        F.col("c_custkey") % 3 == 0, F.concat(F.lit(" | "), F.initcap("c_mktsegment"))
    ).otherwise("")
    raw = F.when(F.col("c_custkey") % 11 != 0, F.concat(place, tail))
    return table(spark, sf, "customer").select(
        "c_custkey", raw.alias("location_raw"), text.location_key(raw).alias("location_key")
    )


_LOCATIONS = (
    S.values(list(enumerate(_PLACES)), "places", "place_id, place")
    + """,
located AS (
  SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN place || CASE WHEN c_custkey % 3 = 0
    THEN ' | ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) ELSE '' END END
    AS location_raw
  FROM customer JOIN places ON place_id = c_nationkey %"""
    + f""" {len(_PLACES)}
),
keyed AS (SELECT *, md5(coalesce(lower(trim(location_raw)), '')) AS location_key FROM located),
locations AS (SELECT location_key, max(location_raw) AS location_raw FROM keyed
  GROUP BY location_key)
"""
)


@query(
    "customer_geo",
    S.chain(S.ALIASES, _LOCATIONS, S.geo("locations"))
    + """SELECT location_key, location_raw, region, country FROM resolved""",
)
def customer_geo(spark, sf):
    distinct = _locations(spark, sf).groupBy("location_key").agg(
        F.max("location_raw").alias("location_raw")
    )
    return geo.resolve_geo(distinct, RULES.frame(spark, "geo_aliases"))


@query(
    "customer_places",
    S.chain(_LOCATIONS)
    + f"""SELECT c_custkey, location_key, {S.location_workplace('location_raw')}
      AS workplace_type,
      CASE WHEN location_raw IS NULL OR starts_with(lower(location_raw), 'remote') THEN NULL
        ELSE trim(split_part(location_raw, ',', 1)) END AS city
    FROM keyed""",
)
def customer_places(spark, sf):
    raw = F.col("location_raw")
    return _locations(spark, sf).select(
        "c_custkey",
        "location_key",
        text.workplace_from_location(raw).alias("workplace_type"),
        geo.city_of(raw).alias("city"),
    )


# ---- Rows, keys and reconciliation -----------------------------------------------------------


@query(
    "latest_turn",
    """SELECT conv_id, turn, role, text FROM conversations
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role) = 1""",
)
def latest_turn(spark, sf):
    turns = table(spark, sf, "conversations")
    return first_per_key(turns, ["conv_id"], [F.col("turn").desc(), F.col("role")])


@query(
    "union_by_name",
    """SELECT key, name, nation FROM (
      SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation FROM customer
      UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier)""",
)
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("key"),
    )
    return union_sources(customers, suppliers)


@query(
    "reconcile_orders",
    """WITH e AS (SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
        WHERE o_orderkey % 97 <> 0),
      a AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 89 = 0
        THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders)
    SELECT problem, o_orderpriority, count(*) AS rows_affected FROM (
      SELECT 'missing_or_changed_in_fact' AS problem, * FROM (
        SELECT * FROM e EXCEPT ALL SELECT * FROM a)
      UNION ALL SELECT 'stale_in_fact', * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM e))
    GROUP BY problem, o_orderpriority""",
)
def reconcile_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    changed = F.when(F.col("o_orderkey") % 89 == 0, F.col("o_totalprice") + 1).otherwise(
        F.col("o_totalprice")
    )
    return incremental.reconcile(
        orders.where("o_orderkey % 97 <> 0"),
        orders.withColumn("o_totalprice", changed),
        ["o_orderpriority"],
    )


@query(
    "lines_versus_orders",
    """WITH l AS (SELECT l_orderkey, count(*) AS landed FROM lineitem GROUP BY l_orderkey),
      m AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'ok' END AS status,
        o_orderkey % 7 AS posting_count FROM orders)
    SELECT CAST(coalesce(l_orderkey, o_orderkey) AS VARCHAR) AS company_key, landed,
      posting_count, status
    FROM l FULL JOIN m ON o_orderkey = l_orderkey
    WHERE (landed IS NOT NULL AND coalesce(status, 'missing') <> 'ok')
      OR (status = 'ok' AND coalesce(landed, 0) <> posting_count)""",
)
def lines_versus_orders(spark, sf):
    day = F.lit("2000-01-01").cast("date").alias("snapshot_date")
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("company_key"), day
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("company_key"),
        day,
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("ok").alias("status"),
        (F.col("o_orderkey") % 7).alias("posting_count"),
    )
    return quality.landed_versus_manifests(lines, orders).drop("snapshot_date")


def _lane_sql(expression: str) -> str:
    lanes = [
        f"bit_xor(CAST('0x' || substr(sha256({expression}), {1 + 15 * i}, 15) AS BIGINT)) "
        f"AS lane{i}"
        for i in range(4)
    ]
    return ", ".join(lanes)


@query(
    "conversation_fingerprint",
    "SELECT conv_id, count(*) AS n, "
    + _lane_sql("concat_ws(':', CAST(turn AS VARCHAR), role, text)")
    + " FROM conversations GROUP BY conv_id",
)
def conversation_fingerprint(spark, sf):
    """Order-sensitive fingerprint of each conversation without gathering its turns."""
    line = gates.line_text(F.col("turn"), F.col("role"), F.col("text"))
    lanes = gates.fingerprint_lanes(line)
    return table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.count("*").alias("n"),
        *[F.bit_xor(lane).alias(f"lane{i}") for i, lane in enumerate(lanes)],
    )


@query(
    "event_properties",
    """SELECT event_id, json_extract_string(props, '$.k') AS k_text,
      TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      json_extract_string(props, '$.missing') AS missing FROM events""",
)
def event_properties(spark, sf):
    props = F.col("props")
    return table(spark, sf, "events").select(
        "event_id",
        payload.json_text(props, "$.k").alias("k_text"),
        payload.json_text(props, "$.k").try_cast("bigint").alias("k"),
        payload.json_text(props, "$.missing").alias("missing"),
    )


@query(
    "page_links",
    """SELECT page_id, url || ' ' || coalesce(substr(html, 1, 0), '') || 'end' AS joined
    FROM pages""",
)
def page_links(spark, sf):
    """Join a field of a JSON array whose members may lack it."""
    lists = F.to_json(
        F.array(
            F.struct(F.col("url").alias("content")),
            F.struct(F.lit("").alias("content")),
            F.struct(F.lit(None).cast("string").alias("content")),
            F.struct(F.lit("end").alias("content")),
        )
    )
    parsed = payload.parse(lists, "array<struct<content: string>>")
    return table(spark, sf, "pages").select(
        "page_id", F.replace(payload.joined_field(parsed, "content"), F.lit("  "), F.lit(" "))
        .alias("joined")
    )


@query(
    "order_dates",
    """SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
      date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS days,
      o_orderdate + INTERVAL 12 HOUR AS from_text,
      make_timestamp(epoch_ms(o_orderdate) * 1000) AS from_millis,
      CAST(NULL AS TIMESTAMP) AS from_word
    FROM orders""",
)
def order_dates(spark, sf):
    day = F.to_date("o_orderdate")
    stamp = F.concat(day.cast("string"), F.lit("T08:00:00-04:00"))
    millis = F.unix_date(day) * F.lit(86_400_000).cast("bigint")
    ntz = lambda c, name: c.cast("timestamp_ntz").alias(name)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.week_start(F.col("o_orderdate")).alias("week_start"),
        dates.days_between(day, F.lit("2001-08-01").cast("date")).alias("days"),
        ntz(dates.utc_timestamp(stamp), "from_text"),
        ntz(dates.millis_timestamp(millis), "from_millis"),
        ntz(dates.utc_timestamp(F.lit("yesterday")), "from_word"),
    )


@query(
    "order_display",
    """SELECT o_orderkey, printf('%.1f', o_totalprice) AS price,
      printf('%.1f%%', (o_totalprice / 1000000) * 100) AS share FROM orders""",
)
def order_display(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.display_value(price, "float").alias("price"),
        text.display_value(price / 1_000_000, "share").alias("share"),
    )


@query(
    "weekly_priority_share",
    """WITH o AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
      o_orderpriority AS priority, o_orderstatus = 'O' AS is_open FROM orders)
    SELECT week_start, CASE WHEN grouping(priority) = 1 THEN 'all_roles' ELSE priority END
      AS role_family, count(*) AS n, count(*) FILTER (WHERE is_open) AS n_open
    FROM o GROUP BY GROUPING SETS ((week_start, priority), (week_start))""",
)
def weekly_priority_share(spark, sf):
    """Grouping sets by rolling up pre-aggregated counts."""
    counted = (
        table(spark, sf, "orders")
        .groupBy(
            dates.week_start(F.col("o_orderdate")).alias("week_start"),
            F.col("o_orderpriority").alias("role_family"),
        )
        .agg(
            F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open")
        )
    )
    return marts.by_role_and_overall(counted, ["week_start"], ["n", "n_open"])


# ---- Data quality ----------------------------------------------------------------------------


@query(
    "dq_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def dq_unique(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_between",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE l_quantity < 5 OR l_quantity > 45""",
)
def dq_between(spark, sf):
    rows = quality.failing_rows(
        table(spark, sf, "lineitem"), quality.outside("l_quantity", 5, 45)
    )
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query(
    "dq_not_before",
    """SELECT l_orderkey, l_linenumber, o_orderdate, l_shipdate FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate <= o_orderdate""",
)
def dq_not_before(spark, sf):
    joined = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    late = quality.failing_rows(
        joined, quality.before("l_shipdate", "o_orderdate", strict=True)
    )
    return late.select("l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate")


@query(
    "dq_relationships",
    """SELECT doc_id, quality FROM labels WHERE doc_id IS NOT NULL AND doc_id NOT IN (
      SELECT doc_id FROM documents WHERE lang = 'en')""",
)
def dq_relationships(spark, sf):
    """Labels whose document is not an English one."""
    english = table(spark, sf, "documents").where("lang = 'en'")
    return quality.orphans(table(spark, sf, "labels"), "doc_id", english, "doc_id").select(
        "doc_id", "quality"
    )


@query(
    "dq_accepted",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('O', 'F')",
)
def dq_accepted(spark, sf):
    rows = quality.failing_rows(
        table(spark, sf, "orders"), quality.not_accepted("o_orderstatus", ["O", "F"])
    )
    return rows.select("o_orderkey", "o_orderstatus")


@query(
    "dq_counts",
    """SELECT check_name, failing_rows, failing_rows = 0 AS passed FROM (
      SELECT 'quantity' AS check_name, count(*) FILTER (WHERE l_quantity > 45) AS failing_rows
        FROM lineitem
      UNION ALL SELECT 'flag', count(*) FILTER (WHERE l_returnflag <> 'A') FROM lineitem
      UNION ALL SELECT 'key', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem)""",
)
def dq_counts(spark, sf):
    """Several row checks in one pass."""
    counts = quality.count_failing(
        table(spark, sf, "lineitem"),
        {
            "quantity": quality.outside("l_quantity", 0, 45),
            "flag": quality.not_accepted("l_returnflag", ["A"]),
            "key": quality.is_null("l_orderkey"),
        },
    )
    return quality.with_outcome(counts)


@query(
    "overlapping_intervals",
    """WITH s AS (SELECT CAST(l_orderkey AS VARCHAR) AS posting_key,
      CAST(l_orderkey AS VARCHAR) || '@' || lpad(CAST(row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) AS VARCHAR), 3, '0')
        AS posting_spell_key,
      CAST(l_shipdate AS DATE) AS first_seen,
      CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS last_seen FROM lineitem)
    SELECT b.posting_spell_key, b.first_seen, max(a.last_seen) AS earlier_last_seen
    FROM s AS b JOIN s AS a ON a.posting_key = b.posting_key
      AND a.posting_spell_key < b.posting_spell_key
    GROUP BY b.posting_spell_key, b.first_seen HAVING b.first_seen <= max(a.last_seen)""",
)
def overlapping_intervals(spark, sf):
    """Line items as intervals from shipping, as long as their quantity."""
    in_order = Window.partitionBy("l_orderkey").orderBy("l_shipdate", "l_linenumber", "l_partkey")
    key = F.col("l_orderkey").cast("string")
    intervals = table(spark, sf, "lineitem").select(
        key.alias("posting_key"),
        F.concat(
            key, F.lit("@"), F.lpad(F.row_number().over(in_order).cast("string"), 3, "0")
        ).alias("posting_spell_key"),
        F.to_date("l_shipdate").alias("first_seen"),
        F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")).alias("last_seen"),
    )
    return quality.overlapping_spells(intervals)


@query(
    "skill_examples",
    S.chain(_WORDS)
    + """SELECT doc_id, skill FROM documents, words
    WHERE skill = CASE doc_id % 3 WHEN 0 THEN 'the' WHEN 1 THEN 'sch' ELSE 'mail' END
      AND regexp_matches(lower(text), pattern) <> (lang = 'en')""",
)
def skill_examples(spark, sf):
    """Documents as examples: English ones are claimed to match their pattern, others not."""
    cases = _documents(spark, sf).select(
        "doc_id",
        "text",
        F.element_at(
            F.array(F.lit("the"), F.lit("sch"), F.lit("mail")),
            (F.col("doc_id") % 3 + 1).cast("int"),
        ).alias("skill"),
        (F.col("lang") == "en").alias("should_match"),
    )
    return quality.skill_example_failures(cases, WORDS).select("doc_id", "skill")


@query(
    "title_examples",
    S.chain(
        _TITLES,
        S.ROLE_RULES,
        f"""actual AS (SELECT title, coalesce((SELECT arg_min(role_family, priority)
          FROM role_rules WHERE regexp_matches(lower(title), pattern)), 'other') AS role_family,
          {S.seniority_sql('title', "'unknown'")} AS seniority FROM titles)""",
    )
    + """SELECT title, count(*) AS failures FROM actual
    WHERE role_family <> 'data_engineering' OR seniority <> 'senior' GROUP BY title""",
)
def title_examples(spark, sf):
    """Titles as examples, all claimed to be senior data engineers."""
    cases = _titles(spark, sf).select(
        "title",
        F.lit("data_engineering").alias("role_family"),
        F.lit("senior").alias("seniority"),
    )
    failures = quality.title_example_failures(cases, RULES.role_family_rules)
    return failures.groupBy("title").agg(F.count("*").alias("failures"))


@query(
    "location_examples",
    S.chain(S.ALIASES, _LOCATIONS, S.geo("locations"))
    + """SELECT location_raw, coalesce(country, 'Unknown') AS actual_country FROM resolved
    WHERE location_raw IS NOT NULL
      AND (region IS NOT NULL OR coalesce(country, 'Unknown') <> 'Canada')""",
)
def location_examples(spark, sf):
    """Locations as examples, all claimed to be somewhere in Canada."""
    cases = (
        _locations(spark, sf)
        .where("location_raw IS NOT NULL")
        .groupBy("location_key")
        .agg(F.max("location_raw").alias("location_raw"))
        .select(
            "location_raw",
            F.lit(None).cast("string").alias("region"),
            F.lit("Canada").alias("country"),
        )
    )
    aliases = RULES.frame(spark, "geo_aliases")
    return quality.location_example_failures(cases, aliases).select(
        "location_raw", "actual_country"
    )


@query(
    "top_ranks",
    """SELECT * FROM (SELECT p_brand, p_type, count(*) AS n, rank() OVER (
      PARTITION BY p_brand ORDER BY count(*) DESC) AS r FROM part GROUP BY p_brand, p_type)
    WHERE r <= 3""",
)
def top_ranks(spark, sf):
    """The three top ranks per brand, ties included."""
    counted = table(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    rank = F.rank().over(Window.partitionBy("p_brand").orderBy(F.col("n").desc()))
    return counted.withColumn("r", rank.cast("bigint")).where("r <= 3")
