"""Whole stages as one lazy plan each."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import features, parsing
from wayfare.operators import merge
from wayfare.sources import journeys as source


def merge_extracts(
    spark: SparkSession,
    path: str,
    stub: str = "",
    one_offs: bool = True,
    length_one: str = "keep",
    sep: str = "\t",
) -> DataFrame:
    """Merged journeys of all extracts below ``path`` whose file name holds ``stub``.

    The countable columns of the extracts are parsed to multisets and summed per
    sequence. ``one_offs=False`` drops journeys whose page sequence occurs once;
    ``length_one`` is ``keep``, ``drop`` or ``only``.
    """
    if length_one not in ("keep", "drop", "only"):
        raise ValueError("length_one is keep, drop or only")
    read = source.read_extracts(spark, path, stub, sep, schema=None)
    merged = merge.page_sequence_occurrences(merge.merge_journeys(source.parse_multisets(read)))
    if not one_offs:
        merged = merge.drop_one_offs(merged)
    if length_one == "drop":
        merged = merge.drop_length_one(merged)
    elif length_one == "only":
        merged = merge.keep_length_one(merged)
    return merged


def add_sequence_columns(df: DataFrame) -> DataFrame:
    """``Page_Event_List``, ``Page_List`` and, where it is missing, ``PageSequence``."""
    df = df.withColumn("Page_Event_List", parsing.page_event_list(F.col("Sequence")))
    df = df.withColumn("Page_List", parsing.page_list(F.col("Page_Event_List")))
    if "PageSequence" not in df.columns:
        df = df.withColumn("PageSequence", parsing.join_pages(F.col("Page_List")))
    return df


def add_event_columns(df: DataFrame) -> DataFrame:
    df = df.withColumn("Event_List", parsing.event_list(F.col("Page_Event_List")))
    events = F.col("Event_List")
    return df.withColumns(
        {
            "num_event_cats": features.count_event_categories(events),
            "Event_cats_agg": features.category_frequencies(events),
            "Event_cat_act_agg": features.event_frequencies(events),
        }
    )


def add_taxon_columns(df: DataFrame) -> DataFrame:
    hits = F.col("Page_Event_List")
    return df.withColumns(
        {
            "Taxon_List": parsing.taxon_list(hits),
            "Taxon_Page_List": parsing.taxon_page_list(hits),
        }
    )


def add_delooped_columns(df: DataFrame) -> DataFrame:
    df = df.withColumn("Page_List_NL", parsing.collapse_loops(F.col("Page_List")))
    return df.withColumn("Page_Seq_NL", parsing.join_pages(F.col("Page_List_NL")))


def add_loop_columns(df: DataFrame) -> DataFrame:
    """De-looped lists and the totals per page sequence, looped and de-looped."""
    df = add_delooped_columns(df)
    if "Page_Seq_Occurrences" not in df.columns:
        df = merge.page_sequence_occurrences(df)
    return merge.delooped_occurrences(df)


def process_journeys(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """All derived columns, or only those named; unused ones are never computed."""
    full = add_loop_columns(add_taxon_columns(add_event_columns(add_sequence_columns(df))))
    return full if columns is None else full.select(*columns)


THIN_COLUMNS = ("Page_Event_List", "Page_List", "Page_List_NL", "Page_Seq_NL")


def add_thin_columns(df: DataFrame) -> DataFrame:
    """Only the four columns that path analyses read."""
    return add_delooped_columns(add_sequence_columns(df))
