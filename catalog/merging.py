"""Union, merge and reduction of daily journeys."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as I
from catalog.extract import multiset_rows
from catalog.registry import register
from wayfare.functions import features
from wayfare.operators import merge as M
from wayfare.operators import sessions as S
from wayfare.plans import stages
from wayfare.session import cut_lineage, scratch_path
from wayfare.sources import journeys as J


def counted(spark, sf):
    """Journeys by their four keys; a sequence may have several rows."""
    return S.count_journeys(I.event_sessions(spark, sf).where("Sequence IS NOT NULL"))


def daily(spark, sf):
    """Journeys by day and their four keys, with multisets."""
    rows = I.event_sessions(spark, sf).where("Sequence IS NOT NULL")
    return S.count_journeys(rows, keys=("date", *S.JOURNEY_KEYS), multisets=I.MULTISETS)


def m1(spark, sf):
    rows = daily(spark, sf)
    early = rows.where("day(date) <= 10").drop("Dates")
    middle = rows.where("day(date) BETWEEN 11 AND 20")
    late = rows.where("day(date) > 20").drop("DeviceCategories")
    return M.union_daily([early, middle, late]).select(
        F.date_format("date", "yyyy-MM-dd").alias("day"),
        "Sequence",
        "PageSequence",
        "Occurrences",
        F.col("Dates").isNotNull().alias("has_dates"),
        F.col("DeviceCategories").isNotNull().alias("has_devices"),
    )


register(
    "m1_union_daily",
    m1,
    I.SESSIONS_SQL,
    """SELECT strftime(date, '%Y-%m-%d') AS day, Sequence, PageSequence, count(*) AS Occurrences,
       day(date) > 10 AS has_dates, day(date) <= 20 AS has_devices
       FROM sessions WHERE Sequence IS NOT NULL GROUP BY date, Sequence, PageSequence, PageSeq_Length, Actions_Length""",
)


def m2(spark, sf):
    journeys = I.event_journeys(spark, sf, I.MULTISETS)
    text = J.render_multiset(F.col("DeviceCategories"))
    counts = journeys.select("Sequence", features.text_to_multiset(text).alias("devices"))
    return multiset_rows(counts, "devices", "Sequence")


SEQ_DEVICES = "SELECT Sequence, device AS item, n FROM seq_devices"
register("m2_text_to_multiset", m2, I.JOURNEYS_SQL, SEQ_DEVICES)


def m3(spark, sf):
    merged = M.merge_journeys(daily(spark, sf).drop("date"))
    devices = multiset_rows(merged, "DeviceCategories", "Sequence")
    return devices.unionByName(multiset_rows(merged, "Dates", "Sequence"))


register(
    "m3_merge_journeys",
    m3,
    I.JOURNEYS_SQL,
    SEQ_DEVICES + " UNION ALL SELECT Sequence, day, n FROM seq_dates",
)
register(
    "m3_merge_one_multiset",
    lambda s, d: multiset_rows(
        M.merge_multiset(daily(s, d), "DeviceCategories"), "DeviceCategories", "Sequence"
    ),
    I.JOURNEYS_SQL,
    SEQ_DEVICES,
)
register(
    "m3_merged_rows",
    lambda s, d: M.merge_journeys(daily(s, d).drop("date")).drop(*I.MULTISETS),
    I.JOURNEYS_SQL,
    "SELECT * FROM journeys",
)


def stage_inputs(spark, sf):
    """Daily gzip extracts with five countable columns, and files whose names must not match."""
    sets = {**I.MULTISETS, "TrafficSources": "trafficSource", "TrafficMediums": "trafficMedium"}
    head = ("visitNumber", "deviceCategory", "trafficSource", "trafficMedium", "date")
    rows = S.count_journeys(
        I.event_sessions(spark, sf, head=head), keys=("date", *S.JOURNEY_KEYS), multisets=sets
    )
    texts = rows.drop("date").withColumns({name: J.render_multiset(F.col(name)) for name in sets})
    folder = scratch_path(spark, "merge")
    J.write_extract(texts, f"{folder}/extract")
    J.write_extract(texts.withColumn("Occurrences", F.lit(10**9)), f"{folder}/other")
    # Both writers name their files alike, so the stub is a part of the real ones' names.
    return folder, I.file_stub(spark, f"{folder}/extract")


def merged_stage(spark, sf, **options):
    folder, stub = stage_inputs(spark, sf)
    return stages.merge_extracts(spark, folder, stub, **options)


STAGE_SQL = "SELECT Sequence, Occurrences, coalesce(seq_occ, -1) AS Page_Seq_Occurrences FROM parsed JOIN (SELECT Sequence AS s, PageSeq_Length AS n FROM journeys) ON s = Sequence"
for option, options, condition in (
    ("all", {}, ""),
    ("no_one_offs", {"one_offs": False}, " WHERE seq_occ > 1"),
    ("no_length_one", {"length_one": "drop"}, " WHERE n > 1"),
    ("only_length_one", {"length_one": "only"}, " WHERE n = 1"),
):
    register(
        f"m3_merge_stage_{option}",
        lambda s, d, o=options: merged_stage(s, d, **o).select(
            "Sequence", "Occurrences", F.coalesce("Page_Seq_Occurrences", F.lit(-1)).alias("Page_Seq_Occurrences")
        ),
        I.PARSED_SQL,
        STAGE_SQL + condition,
    )
register(
    "m3_merge_stage_sources",
    lambda s, d: multiset_rows(merged_stage(s, d), "TrafficSources", "Sequence"),
    I.SESSIONS_SQL,
    "SELECT Sequence, trafficSource AS item, count(*) AS n FROM sessions WHERE Sequence IS NOT NULL AND trafficSource IS NOT NULL GROUP BY ALL",
)


def m4(spark, sf):
    rows = I.event_sessions(
        spark, sf, head=("visitNumber", "deviceCategory", "trafficSource", "trafficMedium")
    )
    sets = {"a": "deviceCategory", "b": "trafficSource", "c": "trafficMedium"}
    counts = S.count_journeys(rows, keys=("PageSequence",), multisets=sets)
    total = counts.select(
        "PageSequence", features.sum_multiset_list(F.array("a", "b", "c", "a")).alias("all")
    )
    return multiset_rows(total, "all", "PageSequence")


register(
    "m4_sum_multiset_list",
    m4,
    I.SESSIONS_SQL,
    """SELECT PageSequence, item, CAST(sum(n) AS BIGINT) AS n FROM (
         SELECT PageSequence, deviceCategory AS item, 2 * count(*) AS n FROM sessions GROUP BY ALL
         UNION ALL SELECT PageSequence, trafficSource, count(*) FROM sessions GROUP BY ALL
         UNION ALL SELECT PageSequence, trafficMedium, count(*) FROM sessions GROUP BY ALL) GROUP BY ALL""",
)


def m5(spark, sf):
    lists = (
        I.event_hits(spark, sf)
        .groupBy("fullVisitorId", "visitId")
        .agg(
            F.expr("listagg(type, ',') WITHIN GROUP (ORDER BY hitOrder)").alias("kinds"),
            F.expr("listagg(pagePath, ',') WITHIN GROUP (ORDER BY hitOrder)").alias("pages"),
        )
    )
    joint = features.zip_multiset({"kind": F.col("kinds"), "page": F.col("pages")})
    return lists.select("fullVisitorId", "visitId", F.inline(joint))


register(
    "m5_joint_multiset",
    m5,
    I.HITS_SQL,
    "SELECT fullVisitorId, visitId, type AS kind, pagePath AS page, count(*) AS n FROM hits GROUP BY ALL",
)
register(
    "m6_sum_occurrences",
    lambda s, d: M.sum_occurrences(cut_lineage(counted(s, d))),
    I.JOURNEYS_SQL,
    """SELECT Sequence, PageSequence, PageSeq_Length, Actions_Length,
       CAST(sum(Occurrences) OVER (PARTITION BY Sequence) AS BIGINT) AS Occurrences FROM counted""",
)
register(
    "m7_first_per_sequence",
    lambda s, d: M.first_per_sequence(counted(s, d).drop("Occurrences")),
    I.JOURNEYS_SQL,
    "SELECT Sequence, PageSequence, PageSeq_Length, Actions_Length FROM journeys",
)
register(
    "m8_page_sequence_occurrences",
    lambda s, d: M.page_sequence_occurrences(cut_lineage(I.event_journeys(s, d))).select(
        "Sequence", F.coalesce("Page_Seq_Occurrences", F.lit(-1)).alias("Page_Seq_Occurrences")
    ),
    I.PARSED_SQL,
    "SELECT Sequence, coalesce(seq_occ, -1) AS Page_Seq_Occurrences FROM parsed",
)
register(
    "m9_delooped_occurrences",
    lambda s, d: M.delooped_occurrences(cut_lineage(I.parsed(s, d))).select(
        "Sequence", "Page_Seq_NL", "Occurrences_NL"
    ),
    I.PARSED_SQL,
    "SELECT Sequence, seq_nl AS Page_Seq_NL, nl_occ AS Occurrences_NL FROM parsed",
)
register(
    "m10_drop_one_offs",
    lambda s, d: M.drop_one_offs(cut_lineage(I.event_journeys(s, d))).select(
        "Sequence", "Occurrences", "Page_Seq_Occurrences"
    ),
    I.PARSED_SQL,
    "SELECT Sequence, Occurrences, seq_occ AS Page_Seq_Occurrences FROM parsed WHERE seq_occ > 1",
)
register(
    "m11_drop_length_one",
    lambda s, d: M.drop_length_one(I.event_journeys(s, d)),
    I.JOURNEYS_SQL,
    "SELECT * FROM journeys WHERE PageSeq_Length > 1",
)
register(
    "m12_keep_length_one",
    lambda s, d: M.keep_length_one(I.event_journeys(s, d)),
    I.JOURNEYS_SQL,
    "SELECT * FROM journeys WHERE PageSeq_Length = 1",
)
register(
    "m13_repeated_sequences",
    lambda s, d: M.repeated_sequences(daily(s, d)),
    I.SESSIONS_SQL,
    """SELECT count(*) > 0 AS has_repeats FROM (
         SELECT Sequence FROM (SELECT DISTINCT date, Sequence, PageSequence, PageSeq_Length, Actions_Length
                               FROM sessions WHERE Sequence IS NOT NULL) GROUP BY Sequence HAVING count(*) > 1)""",
)


def m14(spark, sf):
    journeys = cut_lineage(I.event_journeys(spark, sf))
    days = daily(spark, sf).select("date", "Sequence", "Occurrences")
    return M.surviving_metadata(days, M.drop_one_offs(journeys)).groupBy("Sequence").agg(
        F.count("*").alias("n_rows"), F.sum("Occurrences").alias("Occurrences")
    )


register(
    "m14_surviving_metadata",
    m14,
    I.PARSED_SQL,
    """SELECT Sequence, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS Occurrences FROM (
         SELECT date, Sequence, PageSequence, PageSeq_Length, Actions_Length, count(*) AS n FROM sessions
         WHERE Sequence IN (SELECT Sequence FROM parsed WHERE seq_occ > 1) GROUP BY ALL) GROUP BY Sequence""",
)


def m15(spark, sf):
    base = M.drop_length_one(I.event_journeys(spark, sf)).select("Sequence", "Occurrences")
    devices = multiset_rows(
        M.merge_multiset(daily(spark, sf), "DeviceCategories"), "DeviceCategories", "Sequence"
    )
    wide = devices.where("item = 'mobile'").select("Sequence", F.col("n").alias("n_mobile"))
    return M.attach_columns(base, wide).withColumn("n_mobile", F.coalesce("n_mobile", F.lit(0)))


register(
    "m15_attach_columns",
    m15,
    I.JOURNEYS_SQL,
    """SELECT Sequence, Occurrences, coalesce(n, 0) AS n_mobile FROM journeys
       LEFT JOIN (SELECT * FROM seq_devices WHERE device = 'mobile') USING (Sequence) WHERE PageSeq_Length > 1""",
)


def m16(spark, sf):
    merged = M.merge_journeys(daily(spark, sf).drop("date"))
    return M.check_merge(daily(spark, sf), M.drop_length_one(merged), "DeviceCategories").select(
        "Sequence", "item", "n_input", F.col("n_merged").isNull().alias("lost")
    )


register(
    "m16_check_merge",
    m16,
    I.JOURNEYS_SQL,
    """SELECT Sequence, item, n_input, true AS lost FROM (
         SELECT Sequence, 'total' AS item, CAST(sum(Occurrences) AS BIGINT) AS n_input FROM counted GROUP BY ALL
         UNION ALL SELECT Sequence, 'key ' || device, n FROM seq_devices)
       WHERE Sequence IN (SELECT Sequence FROM journeys WHERE PageSeq_Length <= 1)""",
)


def m16_whole(spark, sf):
    merged = M.merge_journeys(daily(spark, sf).drop("date"))
    wrong = M.check_merge(daily(spark, sf), merged, "Dates")
    return wrong.agg(F.count("*").alias("n_differences"))


register(
    "m16_check_whole_merge",
    m16_whole,
    I.JOURNEYS_SQL,
    """SELECT count(*) AS n_differences FROM (
         SELECT Sequence, 'total' AS item, sum(Occurrences) AS n FROM counted GROUP BY ALL
         UNION ALL SELECT Sequence, day, sum(n) FROM seq_dates GROUP BY ALL) x
       FULL JOIN (SELECT Sequence, 'total' AS item, Occurrences AS n FROM journeys
         UNION ALL SELECT Sequence, day, n FROM seq_dates) y ON x.Sequence = y.Sequence AND x.item = y.item
       WHERE x.n IS DISTINCT FROM y.n""",
)
