"""Landing newly arrived response files as they come.

The lifecycle itself is not kept as streaming state: late and withdrawn days rewrite history, so
each micro-batch is landed and built with the batch plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelist.operators.gates import Policy
from tidelist.plans.build import build
from tidelist.plans.landing import land
from tidelist.sources.lake import Lake
from tidelist.sources.responses import one_per_board_day, responses_from_files
from tidelist.sources.rules import Rules


def land_new_files(
    lake: Lake,
    responses_root: str,
    boards: DataFrame,
    policy: Policy = Policy(),
    rules: Rules | None = None,
) -> StreamingQuery:
    """Land and build whatever response files have not been seen yet, then stop.

    The query's checkpoint, kept in the lake, remembers the files. A batch that is run again
    after a failure lands the same content again, which changes nothing. Files of boards that are
    not configured are set aside; boards without a file on a day of the batch are recorded as not
    found, which a good snapshot of that day outlives.
    """
    files = (
        lake.spark.readStream.format("text")
        .options(wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.{json,status}")
        .load(responses_root)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )

    def run(batch: DataFrame, _epoch: int) -> None:
        responses = one_per_board_day(responses_from_files(batch))
        # A board whose file is still to come counts as not found until it lands.
        days = [r[0] for r in responses.select("snapshot_date").distinct().collect()]
        land(lake, responses, boards, policy, dates=sorted(days))
        build(lake, rules)

    return (
        files.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{lake.root}/stream-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
