"""Union, merge and reduction of counted journeys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.constants import COUNTABLE
from wayfare.functions.features import multiset_entries


def union_daily(frames: Sequence[DataFrame]) -> DataFrame:
    """All daily frames below each other; a column missing in one reads NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_journeys(
    journeys: DataFrame, key: str = "Sequence", multisets: Sequence[str] | None = None
) -> DataFrame:
    """One row per ``key``: occurrences and multisets summed, other columns kept.

    ``multisets`` default to the countable columns that the journeys have; they must be
    maps, as ``parse_multisets`` makes of comma texts. A map that is none of them is an
    error, for it has no first row. The other columns come from the first row in their
    own order. Totals and every
    multiset entry travel as rows of one long frame, so one aggregate with map-side
    combining sums them all and no task holds the copies of a frequent journey.
    """
    if multisets is None:
        multisets = [name for name in COUNTABLE if name in journeys.columns]
    types = dict(journeys.dtypes)
    if unread := [name for name in multisets if not types[name].startswith("map")]:
        raise ValueError(f"parse {unread} to multisets before merging")
    if unknown := [n for n, t in types.items() if t.startswith("map") and n != key and n not in multisets]:
        raise ValueError(f"name {unknown} among the multisets or drop them")
    kept = [c for c in journeys.columns if c not in (key, "Occurrences", *multisets)]
    kept_row = F.struct(*kept) if kept else F.lit(None).cast("string")

    # An entry is (which multiset, key, count); the row's own total has no multiset.
    entry_type = "array<struct<part:int,item:string,n:bigint>>"

    def entries(index: int, name: str) -> Column:
        return F.transform(
            F.coalesce(multiset_entries(F.col(name)), F.array()),
            lambda e: F.struct(F.lit(index).alias("part"), e["key"].alias("item"), e["n"].alias("n")),
        ).cast(entry_type)

    total = F.array(
        F.struct(
            F.lit(-1).alias("part"), F.lit(None).alias("item"), F.col("Occurrences").alias("n")
        )
    ).cast(entry_type)
    long = journeys.select(
        key,
        kept_row.alias("kept"),
        F.explode(F.concat(total, *[entries(i, m) for i, m in enumerate(multisets)])).alias("e"),
    ).select(key, F.when(F.col("e.part") < 0, F.col("kept")).alias("kept"), "e.*")
    summed = long.groupBy(key, "part", "item").agg(
        F.sum("n").alias("n"), F.min("kept").alias("kept")
    )

    def collected(index: int) -> Column:
        return F.map_from_entries(
            F.collect_list(F.when(F.col("part") == index, F.struct("item", "n")))
        )

    merged = summed.groupBy(key).agg(
        F.sum(F.when(F.col("part") < 0, F.col("n"))).alias("Occurrences"),
        F.min("kept").alias("kept"),
        *[collected(i).alias(m) for i, m in enumerate(multisets)],
    )
    return merged.select(
        key, "Occurrences", *multisets, *[F.col("kept")[c].alias(c) for c in kept]
    )


def merge_multiset(journeys: DataFrame, column: str, key: str = "Sequence") -> DataFrame:
    """One multiset summed per ``key``."""
    summed = (
        journeys.select(key, F.explode(column).alias("item", "n"))
        .groupBy(key, "item")
        .agg(F.sum("n").alias("n"))
    )
    return summed.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("item", "n"))).alias(column)
    )


def group_total(
    df: DataFrame, key: str, name: str, value: str = "Occurrences"
) -> DataFrame:
    """Add the total of ``value`` over all rows with the same ``key``; NULL for no key.

    The total is a map-side aggregate joined back, so a key that holds a large part of
    the rows is not gathered in one task: the join splits it, a window would not.
    """
    totals = df.groupBy(key).agg(F.sum(value).alias(name))
    return df.join(totals.where(F.col(key).isNotNull()), key, "left")


def page_sequence_occurrences(df: DataFrame) -> DataFrame:
    return group_total(df, "PageSequence", "Page_Seq_Occurrences")


def delooped_occurrences(df: DataFrame) -> DataFrame:
    return group_total(df, "Page_Seq_NL", "Occurrences_NL")


def sum_occurrences(df: DataFrame, key: str = "Sequence") -> DataFrame:
    """Every row with the total of its sequence."""
    return df.drop("Occurrences").join(
        df.groupBy(key).agg(F.sum("Occurrences").alias("Occurrences")), key
    )


def first_per_sequence(df: DataFrame, key: str = "Sequence") -> DataFrame:
    """The first row per ``key`` in the order of its other columns."""
    others = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*others)).alias("row"))
        .select(key, *[F.col("row")[c].alias(c) for c in others])
    )


def drop_one_offs(df: DataFrame) -> DataFrame:
    """Keep journeys whose page sequence occurs more than once."""
    if "Page_Seq_Occurrences" not in df.columns:
        df = page_sequence_occurrences(df)
    return df.where(F.col("Page_Seq_Occurrences") > 1)


def drop_length_one(df: DataFrame) -> DataFrame:
    return df.where(F.col("PageSeq_Length") > 1)


def keep_length_one(df: DataFrame) -> DataFrame:
    return df.where(F.col("PageSeq_Length") == 1)


def repeated_sequences(df: DataFrame, key: str = "Sequence") -> DataFrame:
    """One row: does any sequence occur in more than one row?"""
    repeats = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").limit(1)
    return repeats.agg((F.count("*") > 0).alias("has_repeats"))


def surviving_metadata(metadata: DataFrame, survivors: DataFrame) -> DataFrame:
    """Metadata rows whose sequence is still present."""
    return metadata.join(survivors.select("Sequence"), "Sequence", "left_semi")


def attach_columns(df: DataFrame, aggregated: DataFrame, key: str = "Sequence") -> DataFrame:
    return df.join(aggregated, key, "left")


def check_merge(inputs: DataFrame, merged: DataFrame, multiset: str) -> DataFrame:
    """Sequences whose total or multiset differs between inputs and merged rows."""

    def flat(df: DataFrame, name: str) -> DataFrame:
        entries = df.select(
            "Sequence",
            F.explode(
                F.concat(
                    F.array(F.struct(F.lit("total").alias("item"), F.col("Occurrences").alias("n"))),
                    F.transform(
                        multiset_entries(F.col(multiset)),
                        lambda e: F.struct(
                            F.concat(F.lit("key "), e["key"]).alias("item"), e["n"].alias("n")
                        ),
                    ),
                )
            ).alias("e"),
        )
        return entries.groupBy("Sequence", "e.item").agg(F.sum("e.n").alias(name))

    both = flat(inputs, "n_input").join(flat(merged, "n_merged"), ["Sequence", "item"], "full")
    return both.where(~F.col("n_input").eqNullSafe(F.col("n_merged")))
