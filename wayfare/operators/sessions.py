"""From hits to sessions, and from sessions to counted journeys.

``hits`` are flat rows with ``fullVisitorId, visitId``, the columns of
``sources.sessions.explode_hits``, an orderable ``hitOrder`` and a ``hitChunk`` that
never falls as ``hitOrder`` grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare import constants as C

SESSION_HEAD = ("visitNumber", "deviceCategory", "date")
JOURNEY_KEYS = ("Sequence", "PageSequence", "PageSeq_Length", "Actions_Length")


def session_id(with_start_time: bool = False) -> Column:
    """``visitor-visit-number``; any missing part makes it NULL."""
    parts = [F.col("fullVisitorId"), F.col("visitId"), F.col("visitNumber")]
    if with_start_time:
        parts.append(
            F.date_format(F.timestamp_seconds("visitStartTime"), "yyyy-MM-dd HH:mm:ss")
        )
    pieces: list[Column] = []
    for part in parts:
        pieces += [part.cast("string"), F.lit("-")]
    return F.concat(*pieces[:-1])


def hit_token(style: str = "taxon") -> Column:
    """Text of one hit.

    ``taxon``: page, typed event and taxons; NULL when the taxons are missing.
    ``event``: page and typed event. ``no_type``: page, category and action.
    ``legacy``: page, category and action with the older delimiters.
    """
    category = F.coalesce("eventCategory", F.lit(C.NULL_TEXT))
    action = F.coalesce("eventAction", F.lit(C.NULL_TEXT))
    return tokens_of(F.col("pagePath"), F.col("type"), category, action, F.col("taxons"))[style]


def tokens_of(page: Column, kind: Column, category: Column, action: Column, taxons: Column) -> dict[str, Column]:
    """The text of a hit in every style."""
    field, part = F.lit(C.FIELD_DELIMITER), F.lit(C.EVENT_DELIMITER)
    event = F.concat(page, field, kind, part, category, part, action)
    return {
        "taxon": F.concat(event, field, taxons),
        "event": event,
        "no_type": F.concat(page, field, category, part, action),
        "legacy": F.concat(
            page,
            F.lit(C.LEGACY_FIELD_DELIMITER),
            category,
            F.lit(C.LEGACY_EVENT_DELIMITER),
            action,
        ),
    }


def _joined(column: str, order: str, alias: str) -> Column:
    return F.expr(
        f"listagg({column}, '{C.HIT_DELIMITER}') WITHIN GROUP (ORDER BY {order})"
    ).alias(alias)


def _pieces(hits: DataFrame, keys: Sequence[str], head: Sequence[str]) -> DataFrame:
    """Texts, counts and heads of each group of hits, shuffled once."""
    is_page = F.col("type") == "PAGE"
    return (
        hits.repartition(*keys)
        .groupBy(*keys)
        .agg(
            _joined("token", "hitOrder", "Sequence"),
            _joined("pageToken", "hitOrder", "PageSequence"),
            F.count("*").alias("Actions_Length"),
            F.count_if(is_page).alias("PageSeq_Length"),
            F.count_if(F.col("eventAction") == C.FEEDBACK_YES).alias("EventYes"),
            F.collect_set(F.struct(*head)).alias("heads"),
        )
    )


def visits(
    hits: DataFrame, style: str = "taxon", head: Sequence[str] = SESSION_HEAD, giants: DataFrame | None = None
) -> DataFrame:
    """One row per visit with its texts, counts and the distinct session heads.

    Hits are shuffled once, by visit, and joined in order there: texts do not shrink by combining
    earlier. ``giants`` (fullVisitorId, visitId), if given, are visits with too many hits for one task;
    theirs are joined within chunks first and the chunks per visit second, so that they are spread
    over tasks until only the texts are left.
    """
    tokens = hits.withColumn("token", hit_token(style)).withColumn(
        "pageToken", F.when(F.col("type") == "PAGE", F.col("pagePath"))
    )
    visit = ["fullVisitorId", "visitId"]
    if giants is None:
        return _pieces(tokens, visit, head)
    named = giants.select(*visit).distinct()
    chunks = _pieces(tokens.join(named, visit, "left_semi"), [*visit, "hitChunk"], head)
    large = chunks.groupBy(*visit).agg(
        _joined("Sequence", "hitChunk", "Sequence"),
        _joined("PageSequence", "hitChunk", "PageSequence"),
        *(F.sum(name).alias(name) for name in ("Actions_Length", "PageSeq_Length", "EventYes")),
        F.array_distinct(F.flatten(F.collect_list("heads"))).alias("heads"),
    )
    return _pieces(tokens.join(named, visit, "left_anti"), visit, head).unionByName(large)


def nested_visits(
    sessions: DataFrame, style: str = "taxon", head: Sequence[str] = SESSION_HEAD
) -> DataFrame:
    """``visits`` straight from nested sessions: hits are never shuffled as rows."""
    from wayfare.sources.sessions import ab_variant_dimension, dimension

    flat = {
        "deviceCategory": F.col("device.deviceCategory"),
        "trafficSource": F.col("trafficSource.source"),
        "trafficMedium": F.col("trafficSource.medium"),
        "abVariant": ab_variant_dimension(F.col("customDimensions")),
    }

    def render(hit: Column) -> Column:
        page = hit["page"]["pagePath"]
        category = F.coalesce(hit["eventInfo"]["eventCategory"], F.lit(C.NULL_TEXT))
        action = F.coalesce(hit["eventInfo"]["eventAction"], F.lit(C.NULL_TEXT))
        token = tokens_of(
            page, hit["type"], category, action, dimension(hit["customDimensions"], C.DIMENSION_TAXONS)
        )[style]
        return F.struct(
            hit["hitNumber"].alias("order"),
            token.alias("token"),
            F.when(hit["type"] == "PAGE", page).alias("page"),
            (hit["type"] == "PAGE").alias("isPage"),
            (hit["eventInfo"]["eventAction"] == C.FEEDBACK_YES).alias("yes"),
        )

    rows = sessions.where(F.size("hits") > 0).select(
        "fullVisitorId",
        "visitId",
        F.struct(*[flat.get(name, F.col(name)).alias(name) for name in head]).alias("head"),
        F.transform("hits", render).alias("rendered"),
    )
    grouped = rows.groupBy("fullVisitorId", "visitId").agg(
        F.array_sort(F.flatten(F.collect_list("rendered"))).alias("rendered"),
        F.collect_set("head").alias("heads"),
    )

    def text(field: str) -> Column:
        present = F.filter(F.transform("rendered", lambda h: h[field]), lambda v: v.isNotNull())
        return F.when(F.size(present) > 0, F.array_join(present, C.HIT_DELIMITER))

    def number(field: str) -> Column:
        return F.size(F.filter("rendered", lambda h: h[field])).cast("bigint")

    return grouped.select(
        "fullVisitorId",
        "visitId",
        text("token").alias("Sequence"),
        text("page").alias("PageSequence"),
        F.size("rendered").cast("bigint").alias("Actions_Length"),
        number("isPage").alias("PageSeq_Length"),
        number("yes").alias("EventYes"),
        "heads",
    )


def sessions_of(visit_rows: DataFrame) -> DataFrame:
    """One row per session: visit numbers under one visit share its whole texts."""
    return (
        visit_rows.withColumn("head", F.explode("heads"))
        .drop("heads")
        .select("*", "head.*")
        .drop("head")
        .withColumn("sessionId", session_id())
    )


def build_sessions(
    hits: DataFrame, style: str = "taxon", head: Sequence[str] = SESSION_HEAD
) -> DataFrame:
    return sessions_of(visits(hits, style, head))


def longer_than_one_page(df: DataFrame) -> DataFrame:
    return df.where(F.col("PageSeq_Length") > 1)


def ab_sessions(sessions: DataFrame, prefix: str) -> DataFrame:
    """Sessions of one experiment without tablets, the prefix taken off the variant."""
    return sessions.where(
        F.col("abVariant").startswith(f"{prefix}:") & (F.col("deviceCategory") != "tablet")
    ).withColumn("ABVariant", F.replace("abVariant", F.lit(f"{prefix}:"), F.lit("")))


def count_journeys(
    sessions: DataFrame,
    keys: Sequence[str] = JOURNEY_KEYS,
    multisets: dict[str, str] | None = None,
    kept: Sequence[str] = (),
) -> DataFrame:
    """Sessions per journey, with ``map<string,bigint>`` counts of further columns.

    ``kept`` columns are not keys: the journey takes them from its first row in their
    own order. Totals and the values of every multiset travel as rows of one long frame,
    counted before they are shuffled; a map gathers only its own distinct values, and
    values of several multisets are never combined.
    """
    multisets = multisets or {}
    if not multisets and not kept:
        return sessions.groupBy(*keys).agg(F.count("*").alias("Occurrences"))
    parts = [F.struct(F.lit(-1).alias("part"), F.lit(None).cast("string").alias("item"))] + [
        F.struct(F.lit(i).alias("part"), F.col(column).cast("string").alias("item"))
        for i, column in enumerate(multisets.values())
    ]
    kept_row = F.struct(*kept) if kept else F.lit(None).cast("string")
    long = sessions.select(
        *keys, kept_row.alias("_kept"), F.explode(F.array(*parts)).alias("_e")
    ).where("_e.part < 0 OR _e.item IS NOT NULL")
    total = F.col("_e.part") < 0
    counted = long.groupBy(*keys, F.col("_e.part").alias("_part"), F.col("_e.item").alias("_item")).agg(
        F.count("*").alias("_n"), F.min(F.when(total, F.col("_kept"))).alias("_kept")
    )

    def collected(part: int) -> Column:
        entry = F.struct(F.col("_item").alias("key"), F.col("_n").alias("value"))
        return F.map_from_entries(F.collect_list(F.when(F.col("_part") == part, entry)))

    return (
        counted.groupBy(*keys)
        .agg(
            F.sum(F.when(F.col("_part") < 0, F.col("_n"))).alias("Occurrences"),
            F.min("_kept").alias("_kept"),
            *[collected(part).alias(name) for part, name in enumerate(multisets)],
        )
        .select(*keys, "Occurrences", *multisets, *[F.col("_kept")[c].alias(c) for c in kept])
    )


def device_counts(sessions: DataFrame, keys: Sequence[str] = JOURNEY_KEYS) -> DataFrame:
    """Journeys with mobile and desktop counts as columns."""
    return sessions.groupBy(*keys).agg(
        F.count("*").alias("Occurrences"),
        F.count_if(F.col("deviceCategory") == "mobile").alias("MobileCount"),
        F.count_if(F.col("deviceCategory") == "desktop").alias("DesktopCount"),
    )
