"""Parsing and features on the worked cases."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from wayfare import constants as C
from wayfare.functions import features, parsing
from wayfare.operators import disruption, eda, network


def value(spark, column, **data):
    """The value of a column expression over one row of typed data."""
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in data.items())
    df = spark.createDataFrame([tuple(v for _, v in data.values())], schema)
    return df.select(column.alias("v")).first()["v"]


def pages_value(spark, function, pages):
    return value(spark, function(F.col("l")), l=("array<string>", pages))


def events_value(spark, function, events):
    kind = "array<struct<category:string,action:string>>"
    return value(spark, function(F.col("l")), l=(kind, events))


def parse(spark, text):
    hits = value(spark, parsing.page_event_list(F.col("s")), s=("string", text))
    return [tuple(x for x in hit) for hit in hits]


def test_page_event_list_drops_trailing_delimiter(spark):
    assert parse(spark, "page1<<cat1<:<act1>>page2<<cat2<:<act2>>") == [
        ("page1", "cat1<:<act1", None),
        ("page2", "cat2<:<act2", None),
    ]


def test_page_event_list_equals_plain_rendering(spark):
    rng = random.Random(7)
    pieces = ["/a", "/b", "<<", ">>", "<:<", "PAGE", "NULL", '"', "'", ".", "iii", " ", "t1,t2"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(400)]

    def plain(text):
        hits = re.sub(C.ODD_FRAGMENTS, "", text).split(">>")
        fields = [[re.sub("[\"']", "", f) for f in hit.split("<<")] for hit in hits]
        return [tuple(f + [None] * (3 - len(f))) for f in fields if len(f) in (2, 3)]

    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for row in df.select("s", parsing.page_event_list(F.col("s")).alias("l")).collect():
        assert [tuple(x for x in hit) for hit in row["l"]] == plain(row["s"]), row["s"]


@pytest.mark.parametrize(
    "event, pair",
    [
        ("cat<:<act", ("cat", "act")),
        ("yesNoFeedbackForm<:<ffYesClick", ("yesNoFeedbackForm", "ffYesClick")),
        ("EVENT<:<cat<:<act", ("cat", "act")),
        ("EVENT<:<NULL<:<NULL", ("EVENT_NULL", "EVENT_NULL")),
        ("EVENT<:<xNULLx<:<act", ("EVENT_xNULLx", "EVENT_act")),
        ("alone", None),
        ("a<:<b<:<c<:<d", None),
    ],
)
def test_split_event(spark, event, pair):
    found = value(spark, parsing.split_event(F.col("e")), e=("string", event))
    assert (tuple(found) if found else None) == pair


def test_page_list_only_takes_page_hits(spark):
    kind = "array<struct<page:string,event:string,taxons:string>>"
    hits = [("page1", "c1<:<a1", None), ("page2", C.PAGE_HIT, "t"), ("page3", "c2<:<a1", None)]
    assert value(spark, parsing.page_list(F.col("l")), l=(kind, hits)) == ["page2"]
    assert value(spark, parsing.page_list(F.col("l")), l=(kind, hits[:1])) == []
    events = value(spark, parsing.event_list(F.col("l")), l=(kind, hits))
    assert [tuple(e) for e in events] == [("c1", "a1"), ("PAGE_NULL", "PAGE_NULL"), ("c2", "a1")]


def test_collapse_loops(spark):
    assert pages_value(spark, parsing.collapse_loops, ["p1", "p1", "p2", "p3", "p1"]) == ["p1", "p2", "p3", "p1"]
    assert pages_value(spark, parsing.collapse_loops, ["p1", "p1", "p2", "p1", "p1"]) == ["p1", "p2", "p1"]
    assert pages_value(spark, parsing.collapse_loops, []) == []


def test_adjacent_pairs(spark):
    pairs = pages_value(spark, parsing.adjacent_pairs, ["p1", "p1", "p2", "p3", "p1"])
    assert [tuple(p) for p in pairs] == [("p1", "p1"), ("p1", "p2"), ("p2", "p3"), ("p3", "p1")]
    assert pages_value(spark, parsing.adjacent_pairs, ["p1"]) == []
    assert pages_value(spark, parsing.adjacent_pairs, []) == []


def test_first_and_last(spark):
    assert pages_value(spark, parsing.first_item, ["p1", "p2", "p3"]) == "p1"
    assert pages_value(spark, parsing.last_item, ["p1", "p2", "p3"]) == "p3"
    assert pages_value(spark, parsing.last_item, ["p1"]) == "p1"
    assert pages_value(spark, parsing.last_item, []) is None
    ends = pages_value(spark, lambda l: parsing.ends_of_pairs(parsing.adjacent_pairs(l)), ["p1", "p1", "p2", "p3", "p1"])
    assert tuple(ends) == ("p1", "p1")
    pairs = pages_value(spark, lambda l: parsing.end_pairs(parsing.adjacent_pairs(l)), ["p1", "p1", "p2", "p3", "p1"])
    assert (tuple(pairs["first"]), tuple(pairs["last"])) == (("p1", "p1"), ("p3", "p1"))


def test_reindex_hits(spark):
    kind = "array<struct<page:string,event:string,taxons:string>>"
    hits = [("a", "x", None), ("a", "x", None), ("a", "y", None), ("b", "y", None), ("a", "y", None), ("a", "y", None)]
    found = value(spark, parsing.reindex_hits(F.col("l")), l=(kind, hits))
    assert [tuple(f) for f in found] == [(0, "a", "x"), (0, "a", "y"), (1, "b", "y"), (2, "a", "y")]


def test_loops_and_repetitions(spark):
    assert pages_value(spark, features.has_loop, ["p1", "p2", "p1"]) is False
    assert pages_value(spark, features.has_loop, ["p1", "p2", "p2"]) is True
    assert pages_value(spark, features.has_repetition, ["p1", "p2", "p3"]) is False
    assert pages_value(spark, features.has_repetition, ["p1", "p1", "p1"]) is True
    assert pages_value(spark, features.has_repetition, ["p2", "p3", "p2", "p1"]) is True


EVENTS = [("c1", "a1"), ("c2", "a2"), ("c2", "a1")]


def test_event_counts(spark):
    assert events_value(spark, features.count_event_categories, EVENTS) == 2
    assert events_value(spark, lambda l: features.count_event(l, "c1", "a1"), EVENTS) == 1
    assert [tuple(x) for x in events_value(spark, features.category_frequencies, EVENTS)] == [("c1", 1), ("c2", 2)]
    found = events_value(spark, features.event_frequencies, EVENTS + [None, ("c1", "a1")])
    assert [tuple(x) for x in found] == [("c1", "a1", 2), ("c2", "a2", 1), ("c2", "a1", 1)]


def test_multisets(spark):
    found = value(spark, features.text_to_multiset(F.col("s")), s=("string", "Mobile,Desktop,Mobile"))
    assert found == {"Mobile": 2, "Desktop": 1}
    summed = value(
        spark,
        features.sum_multiset_list(F.col("l")),
        l=("array<map<string,bigint>>", [{"Mobile": 4, "Desktop": 2}, {"Mobile": 2, "Tablet": 4}]),
    )
    assert summed == {"Mobile": 6, "Desktop": 2, "Tablet": 4}
    joint = value(
        spark,
        features.zip_multiset({"x": F.col("a"), "y": F.col("b")}),
        a=("string", "u,u,v"),
        b=("string", "1,1,2"),
    )
    assert [tuple(j) for j in joint] == [("u", "1", 2), ("v", "2", 1)]
    assert value(spark, features.top_key(F.col("m")), m=("map<string,bigint>", {"b": 2, "a": 2, "c": 1})) == "a"


def test_related_text_need_not_be_one_event(spark):
    text = "/x<<PAGE<:<relatedLinkClicked<:<NULL>>/x<<EVENT<:<NULL<:<1.4 Related content"
    assert value(spark, features.mentions_related(F.col("s")), s=("string", text)) is True
    strict = features.related_clicks(
        features.event_frequencies(parsing.event_list(parsing.page_event_list(F.col("s"))))
    )
    assert value(spark, strict, s=("string", text)) == 0


@pytest.mark.parametrize(
    "event, expected",
    [
        ("EVENT<:<breadcrumbClicked<:<2", True),
        ("PAGE<:<NULL<:<NULL", False),
        ("EVENT<:<relatedLinkClicked<:<2.3 Explore the topic", True),
        ("EVENT<:<relatedLinkClicked<:<2.3 Related content", False),
        ("EVENT<:<homeLinkClicked<:<homeHeader", True),
    ],
)
def test_navigation_event(spark, event, expected):
    assert value(spark, features.is_navigation_event(F.col("e")), e=("string", event)) is expected


def test_search_pages_leave_the_list(spark):
    pages = ["/search", "/search?q=a", "/search/all", "/search|x", "/searching", "/a/search"]
    assert pages_value(spark, features.drop_search_pages, pages) == ["/searching", "/a/search"]


def test_disruptions(spark):
    pages = ["/a", "/x", "/b", "/x", "/b", "/x", "/c"]

    def flags(l, wrap=True):
        return disruption.disruptions(l, disruption.positions_of(l, "/x"), wrap)

    assert pages_value(spark, lambda l: disruption.positions_of(l, "/x"), pages) == [1, 3, 5]
    assert pages_value(spark, flags, pages) == [True, False, True]
    # At the start the list wraps to its last page, or there is no page before.
    assert pages_value(spark, flags, ["/x", "/exit"]) == [False]
    assert pages_value(spark, lambda l: flags(l, False), ["/x", "/exit"]) == [True]


def test_search_pattern_also_matches_without_h(spark):
    text = "/search?q=1>>/searc>>/search/x"
    assert value(spark, eda.count_searches(F.col("s")), s=("string", text)) == 4
    assert value(spark, eda.count_searches(F.col("s"), literal=True), s=("string", text)) == 2


def test_last_page_type_wins(spark):
    assert value(spark, eda.final_page_type(F.col("s")), s=("string", "/apply/pay/change-login")) == "change"
    assert value(spark, eda.final_page_type(F.col("s")), s=("string", "/get-an-information-pack")) == "get_information"
    assert value(spark, eda.final_page_type(F.col("s")), s=("string", "/x")) == "other"
    link = value(
        spark, eda.final_external_link(F.col("s")), s=("string", "EVENT<:<External Link Clicked<:<https://a")
    )
    assert link == "https://a"
    assert value(spark, eda.final_external_link(F.col("s")), s=("string", "EVENT<:<other<:<x")) is None


def test_search_removal_may_create_loops_in_delooped_graph(spark):
    rows = [("/a>>/search>>/a>>/b", ["/a", "/search", "/a", "/b"], 2)]
    df = spark.createDataFrame(rows, "Page_Seq_NL string, Page_List_NL array<string>, Occurrences bigint")
    cleaned = network.without_search_pages(df, "Page_List_NL")
    edges = {(r.src, r.dst): r.weight for r in network.edge_weights(cleaned, delooped=True).collect()}
    assert edges == {("/a", "/a"): 2, ("/a", "/b"): 2}
