"""The lake: append-only Parquet folders, numbered per load or build, with commit records.

A load or build writes into folders carrying its own number and adds a commit record last.
Readers look only at committed numbers, so a lost job leaves nothing visible and its retry, which
gets the same number, overwrites exactly its own folders. Nothing that is being read is ever
overwritten, and nothing is partitioned by board: one folder per source and day, at most.

One landing or build runs at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelist import fixed_values as fixed
from tidelist.operators.incremental import live_spells
from tidelist.operators.manifests import BOARD_DAY, current_manifests, ok_landings, rejected_ids
from tidelist.schemas import ATTEMPTS, DAILY, ITEMS, columns_of, conform

OBSERVATIONS = (
    f"{DAILY}, location_raw string, tags array<struct<skill: string, category: string>>"
)
SPELLS = (
    "posting_spell_key string, posting_key string, company_key string, spell_number bigint, "
    "first_seen date, last_seen date, closed_at date, is_open boolean, "
    "is_left_censored boolean, snapshots_observed bigint, unparsed_snapshots bigint, "
    "days_to_close bigint, title string, role_family string, seniority string, "
    "is_entry_level boolean, employment_type string, workplace_type string, "
    "location_key string, published_at timestamp, board_watermark string"
)
DAILY_LOG = (
    "company_key string, snapshot_date date, landing_id string, vocabulary_version string"
)
SPELL_ROWS = SPELLS.removesuffix(", board_watermark string")
SPELLS_LOG = (
    "company_key string, board_watermark string, last_day date, known_until date, change string, "
    "since bigint, changed bigint"
)
SPELL_COUNTS = (
    "company_key string, role_family string, is_left_censored boolean, is_open boolean, "
    "is_first boolean, first_week date, closed_week date, days_to_close bigint, n bigint"
)
WEEK_LOG = "week_start date, company_key string"
WEEK_STATES = (
    f"{WEEK_LOG}, role_family string, listed_postings bigint, intern_postings bigint, "
    "entry_level_postings bigint, "
    + ", ".join(f"{t}_postings bigint" for t in fixed.WORKPLACE_TYPES)
)
UNPARSED = (
    "company_key string, source string, board string, snapshot_date date, posting_id string, "
    "posting_key string, landing_id string"
)
STRANGERS = (
    "source string, board string, snapshot_date date, http_status int, body string"
)
COMMITS = "kind string, number bigint, generation bigint"


@dataclass
class Lake:
    """A view of the lake as of its opening, kept up to date with its own commits.

    Loads are numbered by claims, so that two writers never use the same number, and count once
    their commit is written: what a failed load left behind is never read.
    """

    spark: SparkSession
    root: str
    _commits: dict[str, tuple[int, int]] | None = field(default=None, init=False, repr=False)
    _loads: set[int] = field(default_factory=set, init=False, repr=False)

    # -- reading and writing numbered folders --------------------------------------------------

    def _read(self, folder: str, ddl: str) -> DataFrame:
        path = f"{self.root}/{folder}"
        try:
            return self.spark.read.schema(ddl).option("basePath", path).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ddl)

    def _write(self, df: DataFrame, folder: str, partition_by: tuple[str, ...] = ()) -> None:
        """Write one numbered folder; adaptive rebalancing evens out the file sizes."""
        rebalanced = df.hint("rebalance", *partition_by) if partition_by else df
        rebalanced.write.mode("overwrite").partitionBy(*partition_by).parquet(
            f"{self.root}/{folder}"
        )

    # -- commits -------------------------------------------------------------------------------

    def last_commit(self, kind: str) -> tuple[int, int]:
        """(number, generation) of the newest commit of a kind; (0, 0) before the first."""
        if self._commits is None:
            newest = F.max(F.struct("number", "generation")).alias("c")
            rows = self._read("commits", COMMITS).groupBy("kind").agg(newest).collect()
            self._commits = {r.kind: (r.c.number, r.c.generation) for r in rows}
            landed = self._read("commits", COMMITS).where(F.col("kind") == "landing")
            self._loads = {r.number for r in landed.select("number").distinct().collect()}
        return self._commits.get(kind, (0, 0))

    def commit(self, kind: str, number: int, generation: int = 0) -> None:
        self.last_commit(kind)
        record = self.spark.range(1).select(F.lit(generation).cast("bigint").alias("generation"))
        self._write(record.coalesce(1), f"commits/kind={kind}/number={number}")
        self._commits[kind] = (number, generation)
        if kind == "landing":
            self._loads.add(number)

    def reopen(self) -> None:
        """See what other writers have committed since."""
        self._commits = None

    # -- bronze --------------------------------------------------------------------------------

    def next_load(self) -> int:
        return self.last_commit("landing")[0] + 1

    def claim_load(self) -> int:
        """The next load number that no other writer has claimed."""
        self.reopen()
        number = self.next_load()
        while True:
            record = self.spark.range(1).coalesce(1)
            try:
                record.write.mode("errorifexists").parquet(f"{self.root}/claims/load={number}")
                return number
            except AnalysisException as taken:
                if taken.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
                number += 1

    def landed_state(self) -> str:
        """Changes with every committed landing."""
        self.last_commit("landing")
        return f"{len(self._loads)} up to {max(self._loads, default=0)}"

    def _landed(self, rows: DataFrame) -> DataFrame:
        """Rows of committed loads."""
        self.last_commit("landing")
        return rows.where(F.col("load").isin(sorted(self._loads)))

    def write_items(self, load: int, items: DataFrame) -> None:
        self._write(conform(items, ITEMS), f"items/load={load}", ("source", "snapshot_date"))

    def items_of_load(self, load: int) -> DataFrame:
        path = f"{self.root}/items"
        return self.spark.read.schema(f"{ITEMS}, load bigint").option("basePath", path).parquet(
            f"{path}/load={load}"
        )

    def items(self) -> DataFrame:
        """Items of all committed loads."""
        return self._landed(self._read("items", f"{ITEMS}, load bigint"))

    def write_strangers(self, load: int, responses: DataFrame) -> None:
        self._write(conform(responses, STRANGERS), f"strangers/load={load}")

    def strangers(self) -> DataFrame:
        """Responses of boards that were not configured, as they came, with their load."""
        return self._landed(self._read("strangers", f"{STRANGERS}, load bigint"))

    def write_attempts(self, load: int, attempts: DataFrame) -> None:
        rows = conform(attempts, ATTEMPTS).drop("load")
        self._write(rows, f"attempts/load={load}")

    def attempts(self) -> DataFrame:
        return self._landed(self._read("attempts", ATTEMPTS))

    def manifests(self) -> DataFrame:
        """The current manifest of every board and day."""
        return current_manifests(self.attempts())

    def _items_of(self, landings: DataFrame, *columns: str) -> DataFrame:
        """Items of some landings, with columns of the landing."""
        keys = landings.select(*BOARD_DAY, F.col("items_load").alias("load"), *columns)
        return _prune(self.items(), landings).join(keys, [*BOARD_DAY, "load"])

    def lines(self, landings: DataFrame | None = None) -> DataFrame:
        """Valid posting lines of the given (default: all current) successful landings."""
        ok = ok_landings(self.manifests()) if landings is None else landings
        return (
            self._items_of(ok, "company", "extracted_at", "landing_id")
            .where("item_index IS NOT NULL AND error IS NULL")
            .withColumn("posting_key", F.concat("company_key", F.lit(":"), "posting_id"))
        )

    def unparsed_of(self, landings: DataFrame) -> DataFrame:
        """Postings the given landings list but could not read."""
        return (
            self._items_of(landings, "landing_id")
            .where("error IS NOT NULL AND posting_id IS NOT NULL")
            .withColumn("posting_key", F.concat("company_key", F.lit(":"), "posting_id"))
            .select([name for name, _ in columns_of(UNPARSED)])
            .distinct()
        )

    def rejected_ids(self) -> DataFrame:
        return rejected_ids(self.items(), self.manifests())

    def rejects(self) -> DataFrame:
        """Quarantined records that explain the current manifests."""
        now = self.manifests().select(
            *BOARD_DAY, F.col("items_load").alias("load"), "extracted_at"
        )
        return (
            self.items()
            .where("error IS NOT NULL")
            .join(now, [*BOARD_DAY, "load"])
            .select(
                "source",
                "board",
                *BOARD_DAY,
                "extracted_at",
                "item_index",
                "posting_id",
                "error",
                "payload",
            )
        )

    def evidence(self) -> DataFrame:
        """What was received on days that do not count: unusable bodies and refused items."""
        refused = (
            self.manifests()
            .where(F.col("status") != "ok")
            .select(*BOARD_DAY, F.col("items_load").alias("load"), "status")
        )
        return (
            self.items()
            .join(refused, [*BOARD_DAY, "load"])
            .where("body IS NOT NULL OR payload IS NOT NULL")
        )

    # -- warehouse -----------------------------------------------------------------------------

    def _generation(self) -> str:
        return f"warehouse/generation={self.last_commit('build')[1]}"

    def _built(self, table: str, ddl: str) -> DataFrame:
        number, _ = self.last_commit("build")
        stored = self._read(f"{self._generation()}/{table}", f"{ddl}, build bigint")
        return stored.where(F.col("build") <= number).drop("build")

    def observations(self) -> DataFrame:
        """Every stored observation, current or not."""
        return self._built("observations", OBSERVATIONS)

    def daily_log(self) -> DataFrame:
        return self._built("daily_log", DAILY_LOG)

    def _of_last_build(self, table: str, ddl: str) -> DataFrame:
        number, _ = self.last_commit("build")
        return self._read(f"{self._generation()}/{table}/build={number}", ddl)

    def built_manifests(self) -> DataFrame:
        """The manifests the last build worked with."""
        return self._of_last_build("manifests", ATTEMPTS)

    def stored_spells(self) -> DataFrame:
        """The spells as of the last build: of all builds' rows those that count."""
        number, _ = self.last_commit("build")
        rows = self._read(f"{self._generation()}/spells", f"{SPELL_ROWS}, build bigint")
        live = live_spells(rows.where(F.col("build") <= number), self.spells_log())
        return live.select([name for name, _ in columns_of(SPELLS)])

    def spells_log(self) -> DataFrame:
        """The boards as of the last build, and how they had changed."""
        return self._of_last_build("spells_log", SPELLS_LOG)

    def table(self, name: str) -> DataFrame:
        """A mart of the last committed build."""
        number, generation = self.last_commit("build")
        return self.spark.read.parquet(
            f"{self.root}/warehouse/generation={generation}/marts/{name}/build={number}"
        )


def _prune(items: DataFrame, landings: DataFrame) -> DataFrame:
    """Skip the folders that hold none of the landings: days outside their span, other loads."""
    # One number per landing run, as the commit records that every read goes through.
    first, last, loads = landings.agg(
        F.min("snapshot_date"), F.max("snapshot_date"), F.collect_set("items_load")
    ).first()
    if first is None:
        return items.where(F.lit(False))
    of_span = F.col("snapshot_date").between(F.lit(first), F.lit(last))
    return items.where(of_span & F.col("load").isin(loads))
