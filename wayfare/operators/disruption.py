"""Journeys that a page of interest disrupts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare import constants as C
from wayfare.functions.parsing import last_item


def contains_page(pages: Column, page: str) -> Column:
    return F.array_contains(pages, page)


def positions_of(pages: Column, page: str) -> Column:
    """Positions of the page, from 0."""
    marked = F.transform(pages, lambda p, i: F.when(p == page, i))
    return F.filter(marked, lambda i: i.isNotNull())


def exits_on(pages: Column, page: str) -> Column:
    return F.coalesce(last_item(pages) == page, F.lit(False))


def disruptions(pages: Column, positions: Column, wrap: bool = True) -> Column:
    """Per position: is the page before another one than the page after?

    With ``wrap`` the page before the first is the last page of the list, otherwise
    there is none.
    """

    def disrupted(i: Column) -> Column:
        first = last_item(pages) if wrap else F.lit(None).cast("string")
        before = F.when(i == 0, first).otherwise(F.get(pages, i - 1))
        return ~before.eqNullSafe(F.get(pages, i + 1))

    return F.transform(positions, disrupted)


def mark(journeys: DataFrame, page: str, pages: str = "Page_List") -> DataFrame:
    """Journeys with flag, positions and exit flag of the page."""
    return journeys.withColumns(
        {
            "contains_page": contains_page(F.col(pages), page),
            "positions": positions_of(F.col(pages), page),
            "exits_on_page": exits_on(F.col(pages), page),
        }
    )


def drop_length_one(journeys: DataFrame, pages: str = "Page_List") -> DataFrame:
    return journeys.where(F.size(pages) != 1)


def touching_shares(marked: DataFrame) -> DataFrame:
    """Journey types and sessions that touch the page, with their shares."""
    occurrences = F.col("Occurrences")
    return marked.agg(
        F.count_if("contains_page").alias("types_with"),
        F.count("*").alias("types"),
        F.coalesce(F.sum(F.when(F.col("contains_page"), occurrences)), F.lit(0)).alias("sessions_with"),
        F.sum(occurrences).alias("sessions"),
    ).select(
        "*",
        F.try_divide(F.col("types_with").cast("double"), F.col("types")).alias("share_types"),
        F.try_divide(F.col("sessions_with").cast("double"), F.col("sessions")).alias("share_sessions"),
    )


def exit_shares(marked: DataFrame) -> DataFrame:
    """Of the journeys with the page, how many end on it."""
    occurrences = F.col("Occurrences")
    return (
        marked.where("contains_page")
        .agg(
            F.count_if("exits_on_page").alias("types_exit"),
            F.count("*").alias("types"),
            F.coalesce(F.sum(F.when(F.col("exits_on_page"), occurrences)), F.lit(0)).alias("sessions_exit"),
            F.sum(occurrences).alias("sessions"),
        )
        .select(
            "*",
            F.try_divide(F.col("types_exit").cast("double"), F.col("types")).alias("share_types"),
            F.try_divide(F.col("sessions_exit").cast("double"), F.col("sessions")).alias("share_sessions"),
        )
    )


def with_disruptions(
    journeys: DataFrame, page: str, count_exits: bool = False, wrap: bool = True
) -> DataFrame:
    """Journeys with the page and their flags.

    Journeys that end on the page are left out, or with ``count_exits`` an exit page is
    put behind every journey instead.
    """
    touched = mark(journeys, page).where("contains_page")
    if count_exits:
        touched = touched.withColumn("Page_List", F.concat("Page_List", F.array(F.lit(C.EXIT_PAGE))))
    else:
        touched = touched.where(~F.col("exits_on_page"))
    flagged = touched.withColumn("disrupted", disruptions(F.col("Page_List"), F.col("positions"), wrap))
    return flagged.withColumn("disrupted_at_least_once", F.exists("disrupted", lambda d: d))


def pattern_frequencies(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("disrupted").agg(F.count("*").alias("n"))


def disruption_totals(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.coalesce(F.sum(F.size(F.filter("disrupted", lambda d: d))), F.lit(0)).alias("disruptions"),
        F.coalesce(F.sum(F.size(F.filter("disrupted", lambda d: ~d))), F.lit(0)).alias("non_disruptions"),
        F.count("*").alias("types"),
    )


def disrupted_share(flagged: DataFrame) -> DataFrame:
    """Sessions disrupted at least once among those with the page."""
    once = F.col("disrupted_at_least_once")
    return flagged.agg(
        F.coalesce(F.sum(F.when(once, F.col("Occurrences"))), F.lit(0)).alias("sessions_disrupted"),
        F.coalesce(F.sum(F.when(~once, F.col("Occurrences"))), F.lit(0)).alias("sessions_undisrupted"),
        F.sum("Occurrences").alias("sessions"),
    ).withColumn(
        "share", F.try_divide(F.col("sessions_disrupted").cast("double"), F.col("sessions"))
    )
