"""Finding and thing pages, from the document types seen on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare import constants as C


def _with_content(hits: DataFrame) -> DataFrame:
    return hits.where(
        F.col("contentId").isNotNull() & ~F.col("contentId").isin(C.PLACEHOLDER_CONTENT_IDS)
    )


def _is_finding() -> Column:
    return F.coalesce(F.col("documentType").isin(C.FINDING_DOCUMENT_TYPES), F.lit(False))


def page_types(hits: DataFrame) -> DataFrame:
    """``pagePath, is_finding``: 1 when any hit of the page had a finding type."""
    return (
        _with_content(hits)
        .groupBy("pagePath")
        .agg(F.max(_is_finding().cast("int")).alias("is_finding"))
    )


def content_page_types(hits: DataFrame) -> DataFrame:
    """Distinct ``contentId, pagePath, finding_or_thing``."""
    return (
        _with_content(hits)
        .select(
            "contentId",
            "pagePath",
            F.when(_is_finding(), "finding").otherwise("thing").alias("finding_or_thing"),
        )
        .distinct()
    )
