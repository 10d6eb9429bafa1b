"""Devices and related links: volumes, shares, tests and descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import features, parsing, statistics
from wayfare.operators.describe import describe_segments

DEVICE_COLUMNS = {"DesktopCount": "desktop", "MobileCount": "mobile", "TabletCount": "tablet"}


def add_device_columns(journeys: DataFrame) -> DataFrame:
    return journeys.withColumns(
        {
            name: features.multiset_count(F.col("DeviceCategories"), device)
            for name, device in DEVICE_COLUMNS.items()
        }
    )


def remove_tablets(journeys: DataFrame, drop_empty: bool = False) -> DataFrame:
    """Take tablet sessions off the occurrences; on request drop rows left with none."""
    left = journeys.withColumn("Occurrences", F.col("Occurrences") - F.col("TabletCount"))
    return left.where("Occurrences <> 0") if drop_empty else left


def add_related_flag(journeys: DataFrame) -> DataFrame:
    return journeys.withColumn("Has_Related", features.mentions_related(F.col("Sequence")))


def add_page_length(journeys: DataFrame) -> DataFrame:
    if "PageSeq_Length" in journeys.columns:
        return journeys
    return journeys.withColumn("PageSeq_Length", F.size("Page_List").cast("bigint"))


def prepare(journeys: DataFrame) -> DataFrame:
    """All columns the report reads, tablets taken off."""
    return add_related_flag(remove_tablets(add_device_columns(add_page_length(journeys))))


def without_length_one(journeys: DataFrame) -> DataFrame:
    return journeys.where(F.col("PageSeq_Length") > 1)


def volumes(prepared: DataFrame) -> DataFrame:
    """One row with all volumes and row counts of the report, from one pass."""
    related = F.col("Has_Related")
    sums: list[Column] = []
    for name, column in (("all", "Occurrences"), ("desktop", "DesktopCount"), ("mobile", "MobileCount")):
        used = F.lit(True) if name == "all" else F.col(column) > 0
        sums += [
            F.coalesce(F.sum(column), F.lit(0)).alias(name),
            F.coalesce(F.sum(F.when(related, F.col(column))), F.lit(0)).alias(f"{name}_related"),
            F.count_if(used).alias(f"{name}_rows"),
            F.count_if(used & related).alias(f"{name}_related_rows"),
        ]
    return prepared.agg(*sums)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * 100.0, whole).cast("double"), digits)


def device_report(prepared: DataFrame) -> DataFrame:
    """Six rows: ``Segment, Volume, Percentage, Shape``."""
    lines = [
        ("All", "all", None),
        ("All_related", "all_related", "all"),
        ("Desktop", "desktop", "all"),
        ("Desktop_rel", "desktop_related", "desktop"),
        ("Mobile", "mobile", "all"),
        ("Mobile_rel", "mobile_related", "mobile"),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("Segment"),
                F.col(part).alias("Volume"),
                (F.lit(100.0) if whole is None else percent(F.col(part), F.col(whole))).alias(
                    "Percentage"
                ),
                F.col(f"{part}_rows").alias("Shape"),
            )
            for label, part, whole in lines
        ]
    )
    return volumes(prepared).select(F.inline(rows))


def device_shares(prepared: DataFrame) -> DataFrame:
    """Volumes of each device and of its related clicks, with percentages."""
    return volumes(prepared).select(
        percent(F.col("desktop"), F.col("all")).alias("percent_desktop"),
        percent(F.col("mobile"), F.col("all")).alias("percent_mobile"),
        percent(F.col("all_related"), F.col("all")).alias("percent_related"),
        percent(F.col("desktop_related"), F.col("desktop")).alias("percent_desktop_related"),
        percent(F.col("mobile_related"), F.col("mobile")).alias("percent_mobile_related"),
    )


def _contingency(prepared: DataFrame) -> tuple[DataFrame, list[Column]]:
    table = volumes(prepared).select(
        F.col("mobile_related").alias("a"),
        (F.col("mobile") - F.col("mobile_related")).alias("b"),
        F.col("desktop_related").alias("c"),
        (F.col("desktop") - F.col("desktop_related")).alias("d"),
    )
    return table, [F.col(name) for name in "abcd"]


def _test_row(table: DataFrame, statistic: Column) -> DataFrame:
    return table.select(
        F.col("a").alias("mobile_related"),
        F.col("b").alias("mobile_not_related"),
        F.col("c").alias("desktop_related"),
        F.col("d").alias("desktop_not_related"),
        statistic.alias("statistic"),
        F.lit(1).alias("degrees_of_freedom"),
    )


def chi2_test(prepared: DataFrame) -> DataFrame:
    """Mobile against desktop, with and without a related click: statistic."""
    table, cells = _contingency(prepared)
    return _test_row(table, statistics.chi2_statistic(*cells))


def g_test(prepared: DataFrame) -> DataFrame:
    table, cells = _contingency(prepared)
    return _test_row(table, statistics.g_statistic(*cells))


def with_p_value(test_row: DataFrame) -> DataFrame:
    return test_row.withColumn("p_value", statistics.chi2_one_degree(F.col("statistic")))


def length_distribution(prepared: DataFrame, weight: str = "Occurrences") -> DataFrame:
    """Sessions per page length."""
    return prepared.groupBy("PageSeq_Length").agg(F.sum(weight).alias("n"))


def describe_lengths(prepared: DataFrame) -> DataFrame:
    """Description of the page length in six segments."""
    related = F.col("Has_Related")
    everything = F.lit(True)
    return describe_segments(
        prepared,
        "PageSeq_Length",
        {
            "All_Journeys": (everything, "Occurrences"),
            "All_Desktop": (everything, "DesktopCount"),
            "All_Mobile": (everything, "MobileCount"),
            "Journeys_Related": (related, "Occurrences"),
            "Desktop_Related": (related, "DesktopCount"),
            "Mobile_Related": (related, "MobileCount"),
        },
    )


def category_totals(journeys: DataFrame) -> DataFrame:
    """Frequency of each event category over all journey types."""
    return (
        journeys.select(F.inline("Event_cats_agg"))
        .groupBy("category")
        .agg(F.sum("n").alias("n"))
    )


def device_totals(journeys: DataFrame) -> DataFrame:
    return (
        journeys.select(F.explode("DeviceCategories").alias("device", "n"))
        .groupBy("device")
        .agg(F.sum("n").alias("n"))
    )


def device_ratio(devices: Column) -> Column:
    """Desktop to mobile, -1 without mobile."""
    mobile = features.multiset_count(devices, "mobile")
    desktop = features.multiset_count(devices, "desktop")
    return F.when(mobile == 0, F.lit(-1.0)).otherwise(
        F.try_divide(desktop.cast("double"), mobile.cast("double"))
    )


def percent_desktop(devices: Column) -> Column:
    """Desktop share in percent of desktop, mobile and tablet."""
    desktop = features.multiset_count(devices, "desktop")
    mobile = features.multiset_count(devices, "mobile") + features.multiset_count(devices, "tablet")
    return F.try_divide(desktop * 100.0, desktop + mobile).cast("double")


def most_used_device_is(devices: Column, device: str) -> Column:
    return features.top_key(devices) == device


def add_related_clicks(journeys: DataFrame) -> DataFrame:
    return journeys.withColumn(
        "num_rel_cont", features.related_action_clicks(F.col("Event_cat_act_agg"))
    )


def occurrences_by_clicks(journeys: DataFrame) -> DataFrame:
    return (
        add_related_clicks(journeys)
        .groupBy("num_rel_cont")
        .agg(F.sum("Occurrences").alias("Occurrences"))
    )


def clicks_by_desktop_share(journeys: DataFrame) -> DataFrame:
    """Mean related clicks per journey type for each desktop share."""
    return (
        add_related_clicks(journeys)
        .groupBy(percent_desktop(F.col("DeviceCategories")).alias("percent_desktop"))
        .agg(F.round(F.avg("num_rel_cont"), 3).alias("mean_clicks"))
    )


def one_off_share(related: DataFrame) -> DataFrame:
    """Share of related journeys whose page sequence occurs once."""
    return related.agg(
        F.count_if(F.col("Page_Seq_Occurrences") == 1).alias("one_offs"),
        F.count("*").alias("journeys"),
    ).select("one_offs", "journeys", percent(F.col("one_offs"), F.col("journeys"), 4).alias("percent"))


def related_content_share(related: DataFrame) -> DataFrame:
    """Share of related-click journeys that name the related content itself."""
    named = F.col("Sequence").contains("Related content")
    return related.agg(
        F.count_if(named).alias("related_content"), F.count("*").alias("journeys")
    ).select(
        "related_content",
        "journeys",
        percent(F.col("related_content"), F.col("journeys"), 2).alias("percent"),
    )


def with_pages(journeys: DataFrame) -> DataFrame:
    """Journeys with their page list, for inputs that carry only the sequence text."""
    hits = parsing.page_event_list(F.col("Sequence"))
    return journeys.withColumn("Page_List", parsing.page_list(hits))
