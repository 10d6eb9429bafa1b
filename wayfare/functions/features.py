"""Row-local features of page lists, event lists and multisets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare import constants as C
from wayfare.functions.parsing import adjacent_pairs, bound, split_text


def any_of(conditions: list[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found


def has_loop(pages: Column) -> Column:
    return F.exists(adjacent_pairs(pages), lambda pair: pair["src"] == pair["dst"])


def has_repetition(pages: Column) -> Column:
    return F.size(F.array_distinct(pages)) != F.size(pages)


def _known(events: Column) -> Column:
    return F.filter(events, lambda event: event.isNotNull())


def event_categories(events: Column) -> Column:
    return F.transform(_known(events), lambda event: event["category"])


def count_event_categories(events: Column) -> Column:
    return F.size(F.array_distinct(event_categories(events))).cast("bigint")


def count_event(events: Column, category: str, action: str) -> Column:
    return F.size(
        F.filter(events, lambda e: (e["category"] == category) & (e["action"] == action))
    ).cast("bigint")


def _runs(sorted_items: Column, item: Callable[[Column], Column], entry: Callable[[Column, Column, Column], Column]) -> Column:
    """``entry(items, first, last)`` of each run of equal items of a sorted list; places count from 1."""

    def ends_of(items: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1))),
            lambda i: (i == F.size(items)) | ~item(F.element_at(items, i)).eqNullSafe(item(F.get(items, i))),
        )

    def runs(items: Column) -> Column:
        return bound(
            ends_of(items),
            lambda ends: F.transform(ends, lambda at, k: entry(items, F.coalesce(F.get(ends, k - 1), F.lit(0)) + 1, at)),
        )

    return bound(sorted_items, lambda items: F.when(F.size(items) > 0, runs(items)))


def _counts(items: Column) -> Column:
    """``array<struct<first,item,n>>`` of equal items in order of first appearance; null for an empty list.

    Items are sorted once with their places; the ends of the runs of equal items give the counts.
    """
    placed = F.array_sort(F.transform(items, lambda item, i: F.struct(item.alias("item"), i.alias("first"))))

    def entry(sorted_items: Column, first: Column, last: Column) -> Column:
        start = F.element_at(sorted_items, first)
        return F.struct(start["first"].alias("first"), start["item"].alias("item"), (last - first + 1).cast("bigint").alias("n"))

    return F.array_sort(_runs(placed, lambda x: x["item"], entry))


def _or_empty(found: Column, items: Column, kind: str) -> Column:
    """An empty list for an empty list, null for null."""
    return F.when(items.isNotNull(), F.coalesce(found, F.array().cast(kind)))


def category_frequencies(events: Column) -> Column:
    """``array<struct<category,n>>`` in order of first appearance."""
    named = F.transform(_counts(event_categories(events)), lambda c: F.struct(c["item"].alias("category"), c["n"].alias("n")))
    return _or_empty(named, events, "array<struct<category:string,n:bigint>>")


def event_frequencies(events: Column) -> Column:
    """``array<struct<category,action,n>>`` in order of first appearance."""
    named = F.transform(
        _counts(_known(events)),
        lambda c: F.struct(c["item"]["category"].alias("category"), c["item"]["action"].alias("action"), c["n"].alias("n")),
    )
    return _or_empty(named, events, "array<struct<category:string,action:string,n:bigint>>")


def list_to_multiset(items: Column) -> Column:
    """``map<string,bigint>`` of how often each item occurs.

    The items are sorted once; the ends of the runs of equal items give the counts.
    """

    def runs(present: Column) -> Column:
        end = F.filter(
            F.sequence(F.lit(1), F.size(present)),
            lambda i: (i == F.size(present)) | (F.element_at(present, i) != F.get(present, i)),
        )
        counted = bound(
            end,
            lambda ends: F.transform(
                ends,
                lambda at, k: F.struct(
                    F.element_at(present, at).alias("key"),
                    (at - F.coalesce(F.get(ends, k - 1), F.lit(0))).cast("bigint").alias("n"),
                ),
            ),
        )
        return F.when(F.size(present) > 0, counted).otherwise(F.array().cast("array<struct<key:string,n:bigint>>"))

    return F.map_from_entries(bound(F.array_sort(F.filter(items, lambda item: item.isNotNull())), runs))


def text_to_multiset(text: Column) -> Column:
    return list_to_multiset(split_text(text, C.LIST_DELIMITER))


def sum_entries(entries: Column) -> Column:
    """``map<string,bigint>`` from ``array<struct<key,n>>`` with repeated keys summed.

    Entries are sorted once; each run of equal keys is added up.
    """
    placed = F.array_sort(
        F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("first"), e["n"].alias("n")))
    )

    def entry(items: Column, first: Column, last: Column) -> Column:
        start = F.element_at(items, first)
        total = F.aggregate(
            F.slice(items, first, last - first + 1), F.lit(0).cast("bigint"), lambda acc, e: acc + e["n"]
        )
        return F.struct(start["first"].alias("first"), start["key"].alias("key"), total.alias("n"))

    summed = F.array_sort(_runs(placed, lambda x: x["key"], entry))
    named = F.transform(summed, lambda e: F.struct(e["key"].alias("key"), e["n"].alias("n")))
    return F.map_from_entries(_or_empty(named, entries, "array<struct<key:string,n:bigint>>"))


def multiset_entries(multiset: Column) -> Column:
    return F.transform(
        F.map_entries(multiset), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("n"))
    )


def sum_multiset_list(multisets: Column) -> Column:
    """Sum a list of multisets within one row."""
    return sum_entries(F.flatten(F.transform(multisets, multiset_entries)))


def zip_multiset(columns: dict[str, Column]) -> Column:
    """Joint counts of comma lists read position by position.

    ``array<struct<names..., n>>`` of the combinations, in order of first appearance.
    """
    names = list(columns)
    zipped = F.arrays_zip(
        *[split_text(text, C.LIST_DELIMITER).alias(name) for name, text in columns.items()]
    )
    return F.transform(
        _counts(zipped), lambda c: F.struct(*[c["item"][name].alias(name) for name in names], c["n"].alias("n"))
    )


def multiset_count(multiset: Column, key: str) -> Column:
    return F.coalesce(F.try_element_at(multiset, F.lit(key)), F.lit(0).cast("bigint"))


def multiset_total(multiset: Column) -> Column:
    return F.aggregate(
        F.map_values(multiset), F.lit(0).cast("bigint"), lambda acc, value: acc + value
    )


def top_key(multiset: Column) -> Column:
    """The key with the highest count; the first by name among equals."""
    best = F.array_max(F.map_values(multiset))
    return F.array_min(F.map_keys(F.map_filter(multiset, lambda _, value: value == best)))


def mentions_related(sequence: Column) -> Column:
    """Both related-link texts occur somewhere in the sequence."""
    return sequence.contains(C.RELATED_CATEGORY) & sequence.contains(C.RELATED_ACTION)


def mentions_navigation(sequence: Column) -> Column:
    return any_of([sequence.contains(name) for name in C.NAVIGATION_CATEGORIES])


def mentions_navigation_pair(sequence: Column) -> Column:
    return any_of(
        [sequence.contains(cat) & sequence.contains(act) for cat, act in C.NAVIGATION_PAIRS]
    )


def is_navigation_event(event: Column) -> Column:
    """A navigation click, tested on the event text."""
    return (
        event.contains(C.BREADCRUMB_CATEGORY)
        | event.contains(C.HOME_LINK_CATEGORY)
        | (event.contains(C.RELATED_CATEGORY) & event.contains(C.EXPLORE_ACTION))
    )


def any_navigation_event(frequencies: Column) -> Column:
    """A navigation click among the (category, action) frequencies."""
    return F.exists(
        frequencies,
        lambda e: e["category"].isin(C.BREADCRUMB_CATEGORY, C.HOME_LINK_CATEGORY)
        | ((e["category"] == C.RELATED_CATEGORY) & e["action"].contains(C.EXPLORE_ACTION)),
    )


def _sum_n(frequencies: Column) -> Column:
    return F.aggregate(frequencies, F.lit(0).cast("bigint"), lambda acc, e: acc + e["n"])


def related_clicks(frequencies: Column) -> Column:
    """Clicks whose own category and action name a related link."""
    return _sum_n(
        F.filter(
            frequencies,
            lambda e: (e["category"] == C.RELATED_CATEGORY) & e["action"].contains(C.RELATED_ACTION),
        )
    )


def related_action_clicks(frequencies: Column) -> Column:
    """Clicks whose action names a related link, whatever the category."""
    return _sum_n(F.filter(frequencies, lambda e: e["action"].contains(C.RELATED_ACTION)))


def drop_search_pages(pages: Column) -> Column:
    """Remove the search page and the pages below it."""
    return F.filter(pages, lambda page: ~(page.rlike(r"^/search[/?|]") | (page == "/search")))
