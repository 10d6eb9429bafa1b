"""Operators on small frames, invariants and brute-force comparisons."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from catalog import inputs as I
from wayfare.operators import abtest, describe, eda, merge, network, positions, survey, taxonomy
from wayfare.operators import sessions as S
from wayfare.session import cut_lineage, scratch_path
from wayfare.sources import journeys as journeys_source
from wayfare.sources import sessions as N
from wayfare.streaming import daily

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def journeys(spark):
    return cut_lineage(I.parsed(spark, SF, I.MULTISETS))


def test_flat_and_nested_sessions_agree(spark):
    columns = ["sessionId", "Sequence", "PageSequence", "Actions_Length", "PageSeq_Length", "EventYes"]
    flat = I.event_sessions(spark, SF).select(columns)
    nested = S.sessions_of(S.nested_visits(I.nested_sessions(spark, SF))).select(columns)
    assert flat.exceptAll(nested).isEmpty() and nested.exceptAll(flat).isEmpty()


def test_chunks_do_not_change_sequences(spark):
    hits = I.event_hits(spark, SF)
    whole = S.visits(hits.withColumn("hitChunk", F.lit(0))).select("fullVisitorId", "visitId", "Sequence", "PageSequence")
    split = S.visits(hits.withColumn("hitChunk", F.minute("hitOrder.ts") + 60 * F.hour("hitOrder.ts"))).select(whole.columns)
    assert whole.exceptAll(split).isEmpty() and split.exceptAll(whole).isEmpty()


def test_visit_numbers_share_the_visit_sequence(spark):
    hit = "struct<hitNumber:int,type:string,page:struct<pagePath:string>,eventInfo:struct<eventCategory:string,eventAction:string>,customDimensions:array<struct<index:int,value:string>>>"
    schema = f"""fullVisitorId string, visitId bigint, visitNumber bigint, visitStartTime bigint,
        device struct<deviceCategory:string>, trafficSource struct<source:string,medium:string>,
        customDimensions array<struct<index:int,value:string>>, hits array<{hit}>, date date"""
    import datetime

    def one(number, position, page, taxons):
        dims = [(59, taxons)] if taxons else []
        return ("v", 1, number, 0, ("mobile",), ("s", "m"), [], [(position, "PAGE", (page,), (None, None), dims)], datetime.date(2024, 1, 1))

    empty = ("w", 2, 1, 0, ("mobile",), ("s", "m"), [], [], datetime.date(2024, 1, 1))
    nested = spark.createDataFrame([one(1, 1, "/a", "t"), one(2, 2, "/b", None), empty], schema)
    expected = [("v-1-1", "/a<<PAGE<:<NULL<:<NULL<<t", "/a>>/b", 2), ("v-1-2", "/a<<PAGE<:<NULL<:<NULL<<t", "/a>>/b", 2)]
    columns = ["sessionId", "Sequence", "PageSequence", "PageSeq_Length"]
    assert rows(S.sessions_of(S.nested_visits(nested)).select(columns)) == expected
    assert rows(S.build_sessions(N.explode_hits(nested)).select(columns)) == expected


def test_merge_keeps_totals(spark, journeys):
    sessions = I.event_sessions(spark, SF).where("Sequence IS NOT NULL")
    per_day = S.count_journeys(sessions, ("date", *S.JOURNEY_KEYS), I.MULTISETS)
    merged = merge.merge_journeys(per_day.drop("date"))
    assert merged.agg(F.sum("Occurrences")).first()[0] == sessions.count()
    assert merge.check_merge(per_day, merged, "DeviceCategories").isEmpty()
    direct = journeys.select("Sequence", "Occurrences", "PageSequence", "PageSeq_Length", "Actions_Length")
    assert rows(direct.fillna("", ["PageSequence"])) == rows(merged.select(direct.columns).fillna("", ["PageSequence"]))


def test_device_counts_sum_to_occurrences(journeys):
    total = F.aggregate(F.map_values("DeviceCategories"), F.lit(0).cast("bigint"), lambda a, b: a + b)
    assert journeys.where(total != F.col("Occurrences")).isEmpty()


def test_edge_weights_sum_to_steps(journeys):
    per_sequence = network.per_sequence(journeys)
    steps = per_sequence.agg(F.sum(F.col("Occurrences") * F.greatest(F.size("pages") - 1, F.lit(0)))).first()[0]
    edges = network.edge_weights(journeys)
    assert edges.agg(F.sum("weight")).first()[0] == steps
    nodes = network.number_nodes(network.endpoints(edges))
    attached = network.attach_ends(edges, nodes)
    assert attached.where("Source_id IS NULL OR Destination_id IS NULL").isEmpty()


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([("x", 1)], "Sequence string, Occurrences bigint")
    b = spark.createDataFrame([("y", 2, "d")], "Sequence string, Occurrences bigint, Extra string")
    assert rows(merge.union_daily([a, b]).fillna("-")) == [("x", 1, "-"), ("y", 2, "d")]


def test_missing_page_sequence_has_no_total(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", None, 2), ("c", "p", 3), ("d", "p", 4)], "Sequence string, PageSequence string, Occurrences bigint")
    found = dict(merge.page_sequence_occurrences(df).select("Sequence", "Page_Seq_Occurrences").collect())
    assert found == {"a": None, "b": None, "c": 7, "d": 7}
    assert rows(merge.drop_one_offs(df).select("Sequence")) == [("c",), ("d",)]


def test_positions_are_dense_and_sorted(spark):
    values = random.Random(1).sample(range(100_000), 5_000)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    placed = positions.with_position(df, [F.col("v")], "at")
    assert rows(placed.select("at", "v")) == list(enumerate(sorted(values)))


def test_running_total(spark):
    df = spark.createDataFrame([(f"{i:04d}", i % 5 + 1) for i in range(500)], "k string, w bigint")
    found = dict(eda.with_running_total(df, [F.col("k")], "w", "upto").select("k", "upto").collect())
    total = 0
    for i in range(500):
        total += i % 5 + 1
        assert found[f"{i:04d}"] == total


def test_sample_with_replacement_size_and_weight(spark):
    df = spark.createDataFrame([("hot", 30_000)] + [(f"k{i}", 10) for i in range(3000)], "Sequence string, Occurrences bigint")
    found = dict(eda.sample_with_replacement(df, 0.4).select("Sequence", "draws").collect())
    assert sum(found.values()) == 24_000
    assert abs(found["hot"] - 12_000) < 500


def test_weighted_sample_prefers_frequent_rows(spark):
    df = spark.createDataFrame([(f"k{i}", 100 if i < 50 else 1) for i in range(1000)], "Sequence string, Occurrences bigint")
    found = eda.weighted_sample(df, 100)
    assert found.count() == 100
    assert found.where("Occurrences = 100").count() > 40


def test_expand_sessions(spark):
    df = spark.createDataFrame([("a", 5), ("b", 1)], "Sequence string, Occurrences bigint")
    found = rows(eda.expand_sessions(df, per_block=2).select("Sequence", "session"))
    assert found == [("a", i) for i in range(5)] + [("b", 0)]


def test_concentration_against_sorting(spark):
    rng = random.Random(3)
    visits = [rng.choice([1, 1, 1, 2, 3, 10, 50]) for _ in range(333)]
    df = spark.createDataFrame([(f"p{i}", v) for i, v in enumerate(visits)], "page string, visits bigint")
    ordered = sorted(visits, reverse=True)
    for row in eda.concentration_curve(df).collect():
        top = int(len(visits) * row.share_of_pages)
        assert (row.top, row.visits) == (top, sum(ordered[:top]))


def test_describe_equals_expanded_data(spark):
    data = [(1, 5), (2, 3), (7, 1), (9, 2)]
    expanded = sorted(v for v, n in data for _ in range(n))
    row = describe.describe(spark.createDataFrame(data, "v int, n bigint"), "v", "n").first()
    mean = sum(expanded) / len(expanded)
    std = math.sqrt(sum((x - mean) ** 2 for x in expanded) / (len(expanded) - 1))
    assert (row["count"], row["mean"], row["std"]) == (11, round(mean, 3), round(std, 3))
    assert (row["min"], row["25%"], row["50%"], row["75%"], row["max"]) == (1, 1, 2, 4.5, 9)


def test_taxonomy_levels_orphan_and_cycle(spark):
    data = [
        ("r", "Root", "/r", None), ("a", "A", "/r/a", "r"), ("b", "B", "/r/a/b", "a"), ("c", "C", "/r/a/b/c", "b"),
        ("d", "D", "/d", "c"), ("o", "Orphan", "/o", "gone"), ("x", "X", "/x", "y"), ("y", "Y", "/y", "x"),
    ]
    tree = spark.createDataFrame(data, "content_id string, title string, base_path string, parent_content_id string")
    table = {r.content_id: r for r in taxonomy.taxon_table(tree).collect()}
    assert {k: v.level for k, v in table.items()} == {"r": 1, "a": 2, "b": 3, "c": 4, "d": 5, "o": 1, "x": 2, "y": 2}
    assert [p.title for p in table["d"].parents] == ["Root", "A", "B", "C"]
    assert table["d"].level1_parent == "Root" and table["o"].level1_parent == "Orphan"


def test_adjacency_list_parts_hold_every_neighbour(spark):
    edges = spark.createDataFrame([("hub", f"p{i}", 1) for i in range(95)] + [("q", "hub", 1)], "src string, dst string, weight bigint")
    parts = network.adjacency_lists(edges, parts=10).collect()
    assert sorted(p for r in parts if r.src == "hub" for p in r.pages) == sorted(f"p{i}" for i in range(95))
    assert len([r for r in parts if r.src == "hub"]) > 5


def test_node_with_two_ids_is_an_error(spark):
    links = spark.createDataFrame([("a", "b", "l")], "source_base_path string, sink_base_path string, link_type string")
    nodes = spark.createDataFrame([("a", 0), ("b", 1), ("b", 2)], "Node string, Node_id bigint")
    with pytest.raises(Exception, match="several ids"):
        network.attach_node_ids(links, nodes).collect()


def test_z_test_and_interval(spark):
    data = spark.createDataFrame([("A", 120, 1000), ("B", 150, 1000)], "ABVariant string, x bigint, n bigint")
    row = abtest.with_p_value(abtest.z_test(data)).first()
    pooled = 270 / 2000
    z = (0.12 - 0.15) / math.sqrt(pooled * (1 - pooled) * (2 / 1000))
    assert row.z == pytest.approx(z) and row.p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))
    low, high = abtest.difference_interval(data, 0.05).select("low", "high").first()
    se = math.sqrt(0.12 * 0.88 / 1000 + 0.15 * 0.85 / 1000)
    assert (low, high) == (pytest.approx(0.03 - 1.959963985 * se), pytest.approx(0.03 + 1.959963985 * se))


def test_bootstrap_mean_and_interval(spark):
    data = [("A", 1, 400), ("A", 3, 400), ("B", 2, 300), ("B", 6, 100)]
    df = spark.createDataFrame(data, "ABVariant string, length int, Occurrences bigint")
    means = cut_lineage(abtest.bootstrap_means(df, "length", replicates=4000))
    centre = {r.ABVariant: (r.m, r.s) for r in means.groupBy("ABVariant").agg(F.avg("mean").alias("m"), F.stddev("mean").alias("s")).collect()}
    assert centre["A"][0] == pytest.approx(2.0, abs=0.01) and centre["B"][0] == pytest.approx(3.0, abs=0.02)
    assert centre["A"][1] == pytest.approx(1 / math.sqrt(801), rel=0.06)
    again = abtest.bootstrap_means(df.repartition(5), "length", replicates=4000)
    both = means.join(again.withColumnRenamed("mean", "other"), ["ABVariant", "replicate"])
    assert both.where(F.abs(F.col("mean") - F.col("other")) < 1e-9).count() == 8000
    ordered = sorted(r["mean"] for r in means.where("ABVariant = 'A'").collect())
    width = len(ordered) - round(len(ordered) * 0.05)
    spans = [(ordered[i + width - 1] - ordered[i], ordered[i]) for i in range(len(ordered) - width)]
    found = {r.ABVariant: r for r in abtest.highest_density_interval(means).collect()}["A"]
    assert found.hdi_low == min(spans)[1] and found.hdi_high - found.hdi_low == min(spans)[0]
    difference = abtest.posterior_difference(means).first()
    assert difference["mean"] == pytest.approx(1.0, abs=0.03) and difference.p_b_greater > 0.99


def test_survey_words_and_first_rows(spark):
    data = [("c1", "a  b", 2), ("c1", None, 1), ("c2", "  ", 3), ("c3", " one two\tthree ", 4)]
    df = spark.createDataFrame(data, "clientID string, answer string, response int")
    counts = dict(df.select("response", survey.word_count(F.col("answer"))).collect())
    assert counts == {2: 2, 1: 0, 3: 0, 4: 3}
    assert rows(survey.first_response(df, order=("response",)).select("clientID", "response")) == [("c1", 1), ("c2", 3), ("c3", 4)]
    assert rows(survey.never_repeated(df).select("clientID")) == [("c2",), ("c3",)]


def test_daily_stream_equals_one_batch(spark):
    source, target, state = (scratch_path(spark, n) for n in ("source", "target", "state"))
    N.write_daily(I.nested_sessions(spark, SF), source)
    for _ in range(2):  # the second run finds nothing new
        daily.start_daily_extraction(spark, source, target, state).awaitTermination()
    found = spark.read.parquet(target).agg(F.sum("Occurrences")).first()[0]
    assert found == I.event_sessions(spark, SF).count()
    expected = daily.extract_day(I.nested_sessions(spark, SF))
    assert spark.read.parquet(target).count() == expected.count()


def test_late_files_of_a_day_count_as_one_batch(spark):
    source, target, state = (scratch_path(spark, n) for n in ("source", "target", "state"))
    nested = cut_lineage(I.nested_sessions(spark, SF))
    late = F.pmod(F.xxhash64("fullVisitorId", "visitId", "visitNumber"), F.lit(2)) == 0
    for part in (nested.where(~late), nested.where(late)):
        part.write.mode("append").partitionBy("date").parquet(source)
        daily.start_daily_extraction(spark, source, target, state).awaitTermination()
    columns = ["date", "Sequence", "PageSequence", "Occurrences"]
    found = spark.read.parquet(target).withColumn("date", F.col("date").cast("string")).select(columns)
    expected = daily.extract_day(nested).withColumn("date", F.col("date").cast("string")).select(columns)
    assert found.exceptAll(expected).count() == 0 and found.count() == expected.count()


def test_one_journey_with_very_many_sources(spark):
    sessions = spark.range(200_000).select(F.lit("a").alias("Sequence"), F.concat(F.lit("s"), "id").alias("source"), (F.col("id") % 3).cast("string").alias("medium"))
    found = S.count_journeys(sessions, keys=("Sequence",), multisets={"Sources": "source", "Mediums": "medium"}).first()
    assert found.Occurrences == 200_000 and len(found.Sources) == 200_000 and sum(found.Mediums.values()) == 200_000


def test_merging_keeps_every_countable_column(spark):
    df = spark.createDataFrame([("a", 1, "google", "x"), ("a", 2, "bing,bing", "x")], "Sequence string, Occurrences bigint, TrafficSources string, Note string")
    with pytest.raises(ValueError, match="parse"):
        merge.merge_journeys(df)
    parsed = journeys_source.parse_multisets(df)
    row = merge.merge_journeys(parsed).first()
    assert row.Occurrences == 3 and row.TrafficSources == {"google": 1, "bing": 2} and row.Note == "x"
    with pytest.raises(ValueError, match="name"):
        merge.merge_journeys(parsed.withColumnRenamed("TrafficSources", "Odd"))


def test_date_range_prunes_partitions(spark):
    path = I.written_sessions(spark, SF)
    plan = N.read_sessions(spark, path, "2024-01-10", "2024-01-12", ["2024-01-11"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_taxon_joins_send_nothing_through_the_driver(spark):
    rows = [("a", "A", None), ("b", "B", "a"), ("c", "C", "b"), ("d", "D", "missing"), ("e", "E", "f"), ("f", "F", "e"), (None, "N", "a")]
    tree = spark.createDataFrame(rows, "content_id string, title string, parent_content_id string").withColumn("base_path", F.lit("/"))
    wanted = spark.createDataFrame([("c",), ("e",)], "content_id string")
    for given in (None, wanted):
        table = taxonomy.taxon_table(tree, given)
        assert "Broadcast" not in table._jdf.queryExecution().executedPlan().toString()
        found = {r["content_id"]: (r["level"], r["level1_parent"]) for r in table.collect()}
        assert found["c"] == (3, "A") and found["e"] == (2, "F")
