"""Features of a row from the previous row of the same entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.times import hours_between
from tarmac.operators.ordered import ROWS_PER_TASK, previous_values

# Fixed value: a previous trip shorter than this many minutes does not start a waiting time.
SHORTEST_TRIP = 120


def previous_trip_features(
    df: DataFrame, entity: str, start: str, end: str, elapsed: str, delay: str,
    order: list[str], shortest: float | None = SHORTEST_TRIP, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Previous end, elapsed time and delay, and the hours waited since the previous end.

    The hours are 0 where there is no previous trip or it was shorter than ``shortest`` minutes
    (None: no such rule); the delay is 0 where there is none. ``has_previous`` tells them apart.
    """
    looked_back = previous_values(
        df.withColumn("_row", F.lit(True)), [entity], order,
        {"prev_end": end, "prev_elapsed": elapsed, "_delay": delay, "has_previous": "_row"},
        rows_per_task,
    )
    waited = hours_between(F.col("prev_end"), F.col(start))
    if shortest is not None:
        waited = F.when(F.col("prev_elapsed") >= shortest, waited)
    return looked_back.select(
        *df.columns, "prev_end", "prev_elapsed",
        F.coalesce(waited, F.lit(0.0)).alias("hours_since_prev"),
        F.coalesce("_delay", F.lit(0.0)).alias("prev_delay"),
        F.coalesce("has_previous", F.lit(False)).alias("has_previous"),
    )
