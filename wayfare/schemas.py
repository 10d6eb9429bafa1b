"""Explicit schemas of the stages."""

from pyspark.sql import types as T

DIMENSIONS = T.ArrayType(
    T.StructType(
        [T.StructField("index", T.IntegerType()), T.StructField("value", T.StringType())]
    )
)

HIT = T.StructType(
    [
        T.StructField("hitNumber", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("page", T.StructType([T.StructField("pagePath", T.StringType())])),
        T.StructField(
            "eventInfo",
            T.StructType(
                [
                    T.StructField("eventCategory", T.StringType()),
                    T.StructField("eventAction", T.StringType()),
                ]
            ),
        ),
        T.StructField("customDimensions", DIMENSIONS),
    ]
)

NESTED_SESSION = T.StructType(
    [
        T.StructField("fullVisitorId", T.StringType()),
        T.StructField("visitId", T.LongType()),
        T.StructField("visitNumber", T.LongType()),
        T.StructField("visitStartTime", T.LongType()),
        T.StructField("device", T.StructType([T.StructField("deviceCategory", T.StringType())])),
        T.StructField(
            "trafficSource",
            T.StructType(
                [T.StructField("source", T.StringType()), T.StructField("medium", T.StringType())]
            ),
        ),
        T.StructField("customDimensions", DIMENSIONS),
        T.StructField("hits", T.ArrayType(HIT)),
        T.StructField("date", T.DateType()),
    ]
)

RAW_JOURNEY = T.StructType(
    [
        T.StructField("Occurrences", T.LongType()),
        T.StructField("DeviceCategories", T.StringType()),
        T.StructField("PageSeq_Length", T.LongType()),
        T.StructField("Actions_Length", T.LongType()),
        T.StructField("Dates", T.StringType()),
        T.StructField("Sequence", T.StringType()),
        T.StructField("PageSequence", T.StringType()),
    ]
)

TAXON = T.StructType(
    [
        T.StructField("content_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("base_path", T.StringType()),
        T.StructField("parent_content_id", T.StringType()),
    ]
)

ADJACENCY = T.StructType(
    [
        T.StructField("source_base_path", T.StringType()),
        T.StructField("sink_base_path", T.StringType()),
        T.StructField("link_type", T.StringType()),
    ]
)
