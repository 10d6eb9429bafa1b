"""Column functions that turn sequence text into lists and back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare import constants as C


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip_quotes(text: Column) -> Column:
    return F.regexp_replace(text, C.QUOTES, "")


def scrub_fragments(sequence: Column) -> Column:
    """Remove the odd fragments that contain the hit delimiter."""
    return F.regexp_replace(sequence, C.ODD_FRAGMENTS, "")


def split_text(text: Column, delimiter: str) -> Column:
    return F.split(text, rf"\Q{delimiter}\E")


def page_event_list(sequence: Column) -> Column:
    """``array<struct<page,event,taxons>>`` of the hits with two or three fields."""
    hits = F.transform(
        split_text(scrub_fragments(sequence), C.HIT_DELIMITER),
        lambda hit: F.transform(split_text(hit, C.FIELD_DELIMITER), strip_quotes),
    )
    well_formed = F.filter(hits, lambda fields: F.size(fields).isin(2, 3))
    return F.transform(
        well_formed,
        lambda fields: F.struct(
            F.get(fields, F.lit(0)).alias("page"),
            F.get(fields, F.lit(1)).alias("event"),
            F.get(fields, F.lit(2)).alias("taxons"),
        ),
    )


def split_event(event: Column) -> Column:
    """``struct<category,action>`` of an event text, NULL unless it has 2 or 3 parts.

    With three parts the hit type is dropped, or put in front of both other parts
    when the category carries the text ``NULL``.
    """
    return bound(split_text(event, C.EVENT_DELIMITER), _pair_of_parts)


def _pair_of_parts(parts: Column) -> Column:
    first, second, third = (F.get(parts, F.lit(i)) for i in range(3))

    def pair(category: Column, action: Column) -> Column:
        return F.struct(category.alias("category"), action.alias("action"))

    typed = F.when(
        second.contains(C.NULL_TEXT),
        pair(F.concat_ws("_", first, second), F.concat_ws("_", first, third)),
    ).otherwise(pair(second, third))
    return F.when(F.size(parts) == 2, pair(first, second)).when(F.size(parts) == 3, typed)


def page_hits(page_events: Column) -> Column:
    return F.filter(page_events, lambda hit: hit["event"] == C.PAGE_HIT)


def page_list(page_events: Column) -> Column:
    return F.transform(page_hits(page_events), lambda hit: hit["page"])


def event_list(page_events: Column) -> Column:
    parts = F.transform(page_events, lambda hit: split_text(hit["event"], C.EVENT_DELIMITER))
    return F.transform(parts, _pair_of_parts)


def join_pages(pages: Column) -> Column:
    return F.array_join(pages, C.HIT_DELIMITER)


def split_pages(sequence: Column) -> Column:
    """The page list of a page sequence; an empty sequence has no pages."""
    return F.when(sequence == "", F.array().cast("array<string>")).otherwise(
        split_text(sequence, C.HIT_DELIMITER)
    )


def taxon_list(page_events: Column) -> Column:
    return F.transform(page_hits(page_events), lambda hit: hit["taxons"])


def split_taxons(taxons: Column) -> Column:
    return split_text(taxons, C.TAXON_DELIMITER)


def taxon_page_list(page_events: Column) -> Column:
    """``array<struct<page,taxons:array>>`` of the page hits."""
    return F.transform(
        page_hits(page_events),
        lambda hit: F.struct(hit["page"].alias("page"), split_taxons(hit["taxons"]).alias("taxons")),
    )


def all_hits_taxons(page_events: Column) -> Column:
    """``array<struct<page,taxons>>`` of every hit, the taxon text left whole."""
    return F.transform(
        page_events, lambda hit: F.struct(hit["page"].alias("page"), hit["taxons"].alias("taxons"))
    )


def nest_taxons(taxon_texts: Column) -> Column:
    return F.transform(taxon_texts, split_taxons)


def collapse_loops(pages: Column) -> Column:
    """Drop a page that repeats the page right before it."""
    return bound(
        pages, lambda l: F.filter(l, lambda page, i: (i == 0) | (page != F.get(l, i - 1)))
    )


def adjacent_pairs(items: Column) -> Column:
    """``array<struct<src,dst>>`` of neighbours in the list."""

    def pairs(l: Column) -> Column:
        following = F.slice(l, F.lit(2), F.greatest(F.size(l) - 1, F.lit(0)))
        return F.transform(
            following, lambda item, i: F.struct(F.get(l, i).alias("src"), item.alias("dst"))
        )

    return bound(items, pairs)


def first_item(items: Column) -> Column:
    return F.get(items, F.lit(0))


def last_item(items: Column) -> Column:
    return F.get(items, F.size(items) - 1)


def ends_of_pairs(pairs: Column) -> Column:
    """First and last page of a pair list."""
    return F.struct(
        first_item(pairs)["src"].alias("start"), last_item(pairs)["dst"].alias("end")
    )


def end_pairs(pairs: Column) -> Column:
    """First and last pair of a pair list."""
    return F.struct(first_item(pairs).alias("first"), last_item(pairs).alias("last"))


def reindex_hits(page_events: Column) -> Column:
    """``array<struct<position,page,event>>``: the position counts page changes.

    A hit on the same page as its predecessor stays only if its event differs from
    that of the last hit kept.
    """
    kept_type = "array<struct<position:int,page:string,event:string>>"

    def starts_of(hits: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(1), F.greatest(F.size(hits), F.lit(1))),
            lambda i: (i == 1) | ~F.element_at(hits, i)["page"].eqNullSafe(F.get(hits, i - 2)["page"]),
        )

    def kept_of(run: Column, position: Column) -> Column:
        # A missing event differs from none: it is left out, and after it as the first nothing is kept.
        known = F.when(
            F.element_at(run, 1)["event"].isNotNull(), F.filter(run, lambda hit: hit["event"].isNotNull())
        ).otherwise(F.slice(run, 1, 1))

        def changes(hits: Column) -> Column:
            return F.filter(hits, lambda hit, i: (i == 0) | (hit["event"] != F.get(hits, i - 1)["event"]))

        return F.transform(
            bound(known, changes),
            lambda hit: F.struct(
                position.cast("int").alias("position"), hit["page"].alias("page"), hit["event"].alias("event")
            ),
        )

    def kept(hits: Column) -> Column:
        def runs(starts: Column) -> Column:
            following = lambda k: F.coalesce(F.get(starts, k + 1), F.size(hits) + 1)
            return F.transform(starts, lambda at, k: kept_of(F.slice(hits, at, following(k) - at), k))

        return F.when(F.size(hits) > 0, F.flatten(bound(starts_of(hits), runs))).otherwise(F.array().cast(kept_type))

    return F.when(page_events.isNotNull(), bound(page_events, kept))


def delimiter_length(sequence: Column) -> Column:
    """Number of pages of a sequence, read off its delimiters."""
    return F.regexp_count(sequence, F.lit(C.HIT_DELIMITER)) + 1
