"""Daily extraction as an incremental job: each run takes the days that are new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfare.operators import sessions
from wayfare.schemas import NESTED_SESSION

JOURNEY_MULTISETS = {"DeviceCategories": "deviceCategory"}


def extract_day(nested: DataFrame) -> DataFrame:
    """Journeys per day of nested sessions."""
    rows = sessions.sessions_of(sessions.nested_visits(nested))
    return sessions.count_journeys(
        rows, keys=("date", *sessions.JOURNEY_KEYS), multisets=JOURNEY_MULTISETS
    )


def start_daily_extraction(
    spark: SparkSession, source: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Write the journeys of the days of ``source`` that got new files below ``target``.

    A batch tells which days were touched; those are counted anew from all their files
    and take the place of what ``target`` has for them, so files that come late, or in
    several runs, count as if they had come at once. A batch that runs again after a
    failure does the same again.
    """
    days = spark.readStream.schema(NESTED_SESSION).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        # At most one row per day of the batch.
        touched = [row["date"] for row in batch.select("date").distinct().collect()]
        if touched:
            whole = spark.read.schema(NESTED_SESSION).parquet(source).where(F.col("date").isin(touched))
            extract_day(whole).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "date"
            ).parquet(target)

    return (
        days.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
