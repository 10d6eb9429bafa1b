"""Comparison of two page variants."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare import constants as C
from wayfare.functions import features, parsing, statistics


def keep_variants(journeys: DataFrame, variants: tuple[str, ...] = ("A", "B")) -> DataFrame:
    return journeys.where(F.col("ABVariant").isin(*variants))


def add_related_clicks(journeys: DataFrame) -> DataFrame:
    """Related clicks per sequence, whether there are any, and clicks of all sessions."""
    clicks = features.related_clicks(F.col("Event_cat_act_agg"))
    return journeys.withColumn("Related_Clicks", clicks).withColumns(
        {
            "Has_Related": F.col("Related_Clicks") > 0,
            "Related_Clicks_Total": F.col("Related_Clicks") * F.col("Occurrences"),
        }
    )


def content_page_counts(
    journeys: DataFrame, page_types: DataFrame, keys: tuple[str, ...] = ("Sequence",)
) -> DataFrame:
    """Per journey: navigation clicks on, and searches started from, content pages.

    Both kinds of candidate rows are exploded together and meet the page types in one
    join. ``keys`` must identify a journey; journeys are read twice, so pass them
    written.
    """
    navigation = F.transform(
        F.filter("Page_Event_List", lambda h: features.is_navigation_event(h["event"])),
        lambda h: F.struct(F.lit("nav").alias("kind"), h["page"].alias("pagePath")),
    )
    searches = F.transform(
        F.filter(
            parsing.adjacent_pairs(F.col("Page_List")),
            lambda p: p["dst"].contains(C.SEARCH_QUERY),
        ),
        lambda p: F.struct(F.lit("search").alias("kind"), p["src"].alias("pagePath")),
    )
    things = page_types.where("is_finding = 0").select("pagePath")
    counts = (
        journeys.select(*keys, F.inline(F.concat(navigation, searches)))
        .join(things, "pagePath")
        .groupBy(*keys)
        .agg(
            F.count_if(F.col("kind") == "nav").alias("Content_Page_Nav_Event_Count"),
            F.count_if(F.col("kind") == "search").alias("Content_Search_Event_Count"),
        )
    )
    names = ["Content_Page_Nav_Event_Count", "Content_Search_Event_Count"]
    return journeys.join(counts, list(keys), "left").withColumns(
        {name: F.coalesce(name, F.lit(0).cast("bigint")) for name in names}
    )


def add_ratio(journeys: DataFrame) -> DataFrame:
    """Navigation and searches per sequence to related clicks of all its sessions."""
    used = F.col("Content_Page_Nav_Event_Count") + F.col("Content_Search_Event_Count") + 1
    return journeys.withColumn(
        "Ratio_Nav_Search_to_Rel", (used / (F.col("Related_Clicks_Total") + 1)).cast("double")
    )


def any_finding_page(
    journeys: DataFrame, page_types: DataFrame, keys: tuple[str, ...] = ("Sequence",)
) -> DataFrame:
    """Journeys flagged for a finding page among their pages; pass them written."""
    finding = page_types.where("is_finding = 1").select("pagePath")
    hit = (
        journeys.select(*keys, F.explode(F.array_distinct("Page_List")).alias("pagePath"))
        .join(finding, "pagePath", "left_semi")
        .select(*keys)
        .distinct()
        .withColumn("Any_Finding", F.lit(True))
    )
    return journeys.join(hit, list(keys), "left").withColumn(
        "Any_Finding", F.coalesce("Any_Finding", F.lit(False))
    )


def rates(journeys: DataFrame, flag: Column) -> DataFrame:
    """``ABVariant, x, n, p``: sessions with the flag among all, per variant."""
    return (
        journeys.groupBy("ABVariant")
        .agg(
            F.coalesce(F.sum(F.when(flag, F.col("Occurrences"))), F.lit(0)).alias("x"),
            F.sum("Occurrences").alias("n"),
        )
        .withColumn("p", (F.col("x") / F.col("n")).cast("double"))
    )


def overall_rate(journeys: DataFrame, flag: Column) -> DataFrame:
    return journeys.agg(
        F.coalesce(F.sum(F.when(flag, F.col("Occurrences"))), F.lit(0)).alias("x"),
        F.sum("Occurrences").alias("n"),
    ).withColumn("p", F.try_divide(F.col("x").cast("double"), F.col("n")))


def _paired(rate_rows: DataFrame) -> DataFrame:
    """One row ``x_a, n_a, x_b, n_b, p`` from the rates of both variants."""
    return rate_rows.agg(
        *[
            F.sum(F.when(F.col("ABVariant") == variant, F.col(value)))
            .cast("double")
            .alias(f"{value}_{variant.lower()}")
            for variant in ("A", "B")
            for value in ("x", "n")
        ]
    ).withColumn("p", (F.col("x_a") + F.col("x_b")) / (F.col("n_a") + F.col("n_b")))


def sample_size_checks(rate_rows: DataFrame, at_least: float = 5.0) -> DataFrame:
    """Whether each variant expects enough sessions with and without the flag."""
    p = F.col("p")
    return _paired(rate_rows).select(
        *[
            (F.col(f"n_{v}") * share >= at_least).alias(f"{v}_{name}_ok")
            for v in ("a", "b")
            for name, share in (("with", p), ("without", 1 - p))
        ]
    )


def z_test(rate_rows: DataFrame) -> DataFrame:
    """Two-proportion z statistic with the pooled rate."""
    p = F.col("p")
    spread = F.sqrt(p * (1 - p) * (1 / F.col("n_a") + 1 / F.col("n_b")))
    difference = F.col("x_a") / F.col("n_a") - F.col("x_b") / F.col("n_b")
    return _paired(rate_rows).select(
        "x_a", "n_a", "x_b", "n_b", F.try_divide(difference, spread).alias("z")
    )


def with_p_value(z_row: DataFrame) -> DataFrame:
    return z_row.withColumn("p_value", statistics.normal_two_sided(F.col("z")))


def difference_interval(rate_rows: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Confidence interval of the rate of B less that of A, spreads not pooled."""
    p_a, p_b = F.col("x_a") / F.col("n_a"), F.col("x_b") / F.col("n_b")
    error = F.sqrt(p_a * (1 - p_a) / F.col("n_a") + p_b * (1 - p_b) / F.col("n_b"))
    reach = error * statistics.normal_quantile(1 - alpha / 2)
    return _paired(rate_rows).select(
        F.lit(1 - alpha).alias("level"),
        error.alias("standard_error"),
        (p_b - p_a - reach).alias("low"),
        (p_b - p_a + reach).alias("high"),
    )


def bootstrap_means(
    journeys: DataFrame, value: str, replicates: int = 10_000, seed: int = 1337
) -> DataFrame:
    """``ABVariant, replicate, mean``: Bayesian bootstrap of a session-weighted mean.

    The weights of the sessions that share a value add up to one gamma draw, so the
    draws are made per distinct value. Each task adds up its values for all replicates;
    what is shuffled are those sums, not the draws.
    """
    histogram = (
        journeys.groupBy("ABVariant", F.col(value).cast("double").alias("value"))
        .agg(F.sum("Occurrences").cast("double").alias("n"))
        .where("n > 0 AND value IS NOT NULL")
        .withColumn("key", F.xxhash64("ABVariant", "value"))
    )

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                rng = np.random.default_rng([seed, row.key & 0xFFFFFFFFFFFFFFFF])
                weights = rng.standard_gamma(row.n, replicates)
                total = sums.setdefault(row.ABVariant, np.zeros((2, replicates)))
                total[0] += weights
                total[1] += weights * row.value
        for variant, total in sums.items():
            yield pd.DataFrame(
                {
                    "ABVariant": variant,
                    "replicate": np.arange(replicates),
                    "weight": total[0],
                    "weighted": total[1],
                }
            )

    partial = histogram.mapInPandas(
        draw, "ABVariant string, replicate long, weight double, weighted double"
    )
    return (
        partial.groupBy("ABVariant", "replicate")
        .agg((F.sum("weighted") / F.sum("weight")).alias("mean"))
    )


def highest_density_interval(
    replicates: DataFrame, value: str = "mean", by: str = "ABVariant", alpha: float = 0.05
) -> DataFrame:
    """Narrowest interval that holds ``1 - alpha`` of the replicates of each group.

    A group has as many rows as there are replicates, a number the caller sets.
    """
    ordered = W.partitionBy(by).orderBy(value)
    sized = replicates.select(
        by,
        F.col(value).alias("low"),
        F.row_number().over(ordered).alias("i"),
        F.count("*").over(W.partitionBy(by)).alias("n"),
    )
    width = (F.col("n") - F.round(F.col("n") * alpha)).cast("int")
    starts = sized.withColumn("width", width)
    ends = starts.select(by, F.col("i").alias("end"), F.col("low").alias("high"))
    windows = starts.where(F.col("i") <= F.col("n") - F.col("width")).withColumn(
        "end", F.col("i") + F.col("width") - 1
    )
    return (
        windows.join(ends, [by, "end"])
        .groupBy(by)
        .agg(F.min(F.struct((F.col("high") - F.col("low")).alias("span"), "i", "low", "high")).alias("best"))
        .select(by, F.col("best.low").alias("hdi_low"), F.col("best.high").alias("hdi_high"))
    )


def posterior_difference(replicates: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Mean and interval of B less A over the replicates, and how often B is larger."""
    a = replicates.where("ABVariant = 'A'").select("replicate", F.col("mean").alias("mean_a"))
    b = replicates.where("ABVariant = 'B'").select("replicate", F.col("mean").alias("mean_b"))
    pairs = a.join(b, "replicate").select(
        F.lit("B-A").alias("pair"), (F.col("mean_b") - F.col("mean_a")).alias("difference")
    )
    centre = pairs.groupBy("pair").agg(
        F.avg("difference").alias("mean"),
        F.avg((F.col("difference") > 0).cast("double")).alias("p_b_greater"),
    )
    return centre.join(highest_density_interval(pairs, "difference", "pair", alpha), "pair")


def clicks_distribution(journeys: DataFrame) -> DataFrame:
    """Sessions per number of related clicks."""
    return journeys.groupBy("Related_Clicks").agg(F.sum("Occurrences").alias("Occurrences"))


def page_views(journeys: DataFrame) -> DataFrame:
    return journeys.withColumn(
        "Page_Views", F.size("Page_List").cast("bigint") * F.col("Occurrences")
    )


def containing_event(journeys: DataFrame, text: str, limit: int) -> DataFrame:
    """``limit`` examples of journeys with a text in their sequence, first by sequence."""
    return journeys.where(F.col("Sequence").contains(text)).orderBy("Sequence").limit(limit)


def contains_search(sequence: Column) -> Column:
    return sequence.contains(C.SEARCH_QUERY)


def distinct_events(journeys: DataFrame) -> DataFrame:
    return journeys.select(F.inline("Event_cat_act_agg")).select("category", "action").distinct()
