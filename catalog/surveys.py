"""Survey responses and the journeys of their clients."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.registry import register
from wayfare.operators import survey as U

V = I.SURVEY_SQL
PAGE_KEY = ("clientID", "Page_Path")
register("u1_count_clients", lambda s, d: U.count_clients(I.survey(s, d)), V, "SELECT count(DISTINCT clientID) AS n_clients FROM survey")
register(
    "u1_repeated_rows",
    lambda s, d: U.repeated_rows(I.survey(s, d)).select("clientID", "response"),
    V,
    "SELECT clientID, response FROM survey WHERE clientID IN (SELECT clientID FROM survey GROUP BY ALL HAVING count(*) > 1)",
)
for name, keys in (("u2_first_per_client", ("clientID",)), ("u2_first_per_client_and_page", PAGE_KEY)):
    register(
        name,
        lambda s, d, keys=keys: U.first_response(I.survey(s, d), keys, ("response",)).select("clientID", "Page_Path", "response"),
        V,
        f"""SELECT clientID, Page_Path, response FROM (
              SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY response) AS r FROM survey) WHERE r = 1""",
    )
for name, keys in (("u3_never_repeated", ("clientID",)), ("u3_never_repeated_on_page", PAGE_KEY)):
    register(
        name,
        lambda s, d, keys=keys: U.never_repeated(I.survey(s, d), keys).select("clientID", "Page_Path", "response"),
        V,
        f"""SELECT clientID, Page_Path, response FROM (
              SELECT *, count(*) OVER (PARTITION BY {', '.join(keys)}) AS c FROM survey) WHERE c = 1""",
    )
WORDS = "CASE WHEN trim(coalesce(answer, '')) = '' THEN 0 ELSE len(string_split_regex(trim(answer), '\\s+')) END"
register(
    "u4_answer_words",
    lambda s, d: I.survey(s, d).select("response", U.word_count(F.col("answer")).cast("bigint").alias("n")),
    V,
    f"SELECT response, {WORDS} AS n FROM survey",
)
register(
    "u4_answered",
    lambda s, d: U.first_response(U.answered(I.survey(s, d), "answer", 2), PAGE_KEY, ("response",)).select(*PAGE_KEY, "response"),
    V,
    f"""SELECT clientID, Page_Path, response FROM (
          SELECT *, row_number() OVER (PARTITION BY clientID, Page_Path ORDER BY response) AS r FROM survey WHERE {WORDS} > 2) WHERE r = 1""",
)
register(
    "u5_since_date",
    lambda s, d: U.since(I.survey(s, d), "1998-11-25").select(
        "response", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("sdate", "edate")]
    ),
    V,
    """SELECT response, strftime(sdate, '%Y-%m-%d') AS sdate, strftime(edate, '%Y-%m-%d') AS edate FROM (
         SELECT response, strptime(string_split(Started, ' ')[1], '%d/%m/%Y') AS sdate, strptime(string_split(Ended, ' ')[1], '%d/%m/%Y') AS edate FROM survey)
       WHERE sdate >= TIMESTAMP '1998-11-25'""",
)
S = I.CLIENT_SESSIONS_SQL + V
register(
    "u6_client_of_session",
    lambda s, d: I.client_sessions(s, d).select("sessionId", U.client_of_session(F.col("sessionId")).alias("client_id")),
    S,
    "SELECT sessionId, client_id FROM client_sessions",
)
MATCH = "SELECT sessionId, client_id FROM client_sessions WHERE client_id IN (SELECT clientID FROM survey {0})"
register(
    "u7_journeys_of_clients",
    lambda s, d: U.journeys_of_clients(I.client_sessions(s, d), I.survey(s, d)).select("sessionId", "client_id"),
    S,
    MATCH.format(""),
)
register(
    "u8_clients_without_journeys",
    lambda s, d: U.clients_without_journeys(I.survey(s, d), I.client_sessions(s, d)),
    S,
    "SELECT DISTINCT clientID FROM survey WHERE clientID NOT IN (SELECT client_id FROM client_sessions)",
)
register(
    "u9_clients_since_date",
    lambda s, d: U.journeys_of_clients(I.client_sessions(s, d), U.since(I.survey(s, d), "2001-06-01")).select("sessionId", "client_id"),
    S,
    MATCH.format("WHERE strptime(string_split(Started, ' ')[1], '%d/%m/%Y') >= TIMESTAMP '2001-06-01'"),
)
register(
    "u10_responses_of_client",
    lambda s, d: U.responses_of(I.survey(s, d), "7").select("clientID", "Page_Path", "UserID", "response"),
    V,
    "SELECT clientID, Page_Path, UserID, response FROM survey WHERE clientID = '7'",
)
register(
    "u10_users_behind",
    lambda s, d: U.users_behind(I.survey(s, d), "7"),
    V,
    "SELECT count(DISTINCT UserID) AS n_users FROM survey WHERE clientID = '7'",
)

