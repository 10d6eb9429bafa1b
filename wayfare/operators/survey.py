"""Survey responses and the journeys of the clients who gave them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLIENT = "clientID"


def count_clients(responses: DataFrame) -> DataFrame:
    return responses.agg(F.countDistinct(CLIENT).alias("n_clients"))


def repeated_rows(responses: DataFrame, keys: Sequence[str] = (CLIENT,)) -> DataFrame:
    """Rows whose key occurs more than once."""
    repeated = responses.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return responses.join(repeated, list(keys), "left_semi")


def _first_row(responses: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    others = [c for c in responses.columns if c not in keys]
    ordered = [c for c in order if c in others] + [c for c in others if c not in order]
    return responses.groupBy(*keys).agg(
        F.min(F.struct(*ordered)).alias("row"), F.count("*").alias("n")
    )


def first_response(
    responses: DataFrame, keys: Sequence[str] = (CLIENT,), order: Sequence[str] = ()
) -> DataFrame:
    """One row per key, the first by ``order`` and then by the other columns."""
    rows = _first_row(responses, keys, order)
    return rows.select(*keys, "row.*")


def never_repeated(responses: DataFrame, keys: Sequence[str] = (CLIENT,)) -> DataFrame:
    """Rows whose key occurs exactly once."""
    return _first_row(responses, keys, ()).where("n = 1").select(*keys, "row.*")


def word_count(answer: Column) -> Column:
    """Words of an answer; a missing or blank one has none."""
    text = F.trim(F.regexp_replace(answer, r"\s+", " "))
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(text, " ")))


def answered(responses: DataFrame, answer: str, more_than: int = 1) -> DataFrame:
    """Responses with more than so many words."""
    return responses.withColumn("answer_words", word_count(F.col(answer))).where(
        F.col("answer_words") > more_than
    )


def date_part(started: Column) -> Column:
    """The day in front of a ``dd/MM/yyyy ...`` text."""
    return F.to_date(F.get(F.split(started, " "), F.lit(0)), "dd/MM/yyyy")


def with_dates(responses: DataFrame) -> DataFrame:
    return responses.withColumns(
        {"sdate": date_part(F.col("Started")), "edate": date_part(F.col("Ended"))}
    )


def since(responses: DataFrame, day: str) -> DataFrame:
    return with_dates(responses).where(F.col("sdate") >= F.lit(day).cast("date"))


def client_of_session(session_id: Column) -> Column:
    """The client is the fourth field of the session id."""
    return F.get(F.split(session_id, "-"), F.lit(3))


def journeys_of_clients(journeys: DataFrame, responses: DataFrame) -> DataFrame:
    """Journeys whose client answered; takes the place of one long id pattern."""
    keyed = journeys.withColumn("client_id", client_of_session(F.col("sessionId")))
    return keyed.join(responses.select(F.col(CLIENT).alias("client_id")), "client_id", "left_semi")


def clients_without_journeys(responses: DataFrame, journeys: DataFrame) -> DataFrame:
    seen = journeys.select(client_of_session(F.col("sessionId")).alias(CLIENT))
    return responses.select(CLIENT).distinct().join(seen, CLIENT, "left_anti")


def responses_of(responses: DataFrame, client: str) -> DataFrame:
    return responses.where(F.col(CLIENT) == client)


def users_behind(responses: DataFrame, client: str) -> DataFrame:
    return responses_of(responses, client).agg(F.countDistinct("UserID").alias("n_users"))
