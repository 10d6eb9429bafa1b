"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = """x10_order_sequences x10_sequence_from_nested x19_journey_counts x19_order_journey_counts x21_device_multiset
m3_merge_journeys m8_page_sequence_occurrences p3_page_event_list p23_event_frequencies io8_process_and_write
n7_edge_weights n7_order_edge_weights n9_node_ids n11_attach_ends n14_ancestors n22_titled_edges g1_item_graph
g9_item_degrees g15_connected_components g17_transitivity d9_device_report d13_describe_lengths a5_navigation_from_content
a6_searches_from_content a8_any_navigation a9_any_finding_page a13_difference_interval a14_bootstrap_means
j8_disrupted_share e22_search_by_length e26_concentration_curve e33_top_and_others u2_first_per_client""".split()


def on_written_journeys(spark, sf_dir: str) -> tuple[dict[str, float], int]:
    """Per-journey metrics on processed journeys that lie on disk, as their published timings."""
    from pyspark.sql import functions as F

    from catalog import inputs
    from wayfare.functions import features
    from wayfare.operators import abtest
    from wayfare.session import cut_lineage

    journeys = cut_lineage(inputs.ab_journeys(spark, sf_dir).repartition(8))
    types = cut_lineage(inputs.page_types(spark, sf_dir))
    keys = ("Sequence", "ABVariant")
    frames = {
        "a6_on_written_journeys": abtest.content_page_counts(journeys, types, keys),
        "a8_on_written_journeys": journeys.select(
            *keys, features.any_navigation_event(F.col("Event_cat_act_agg")).alias("any_nav")
        ),
        "a9_on_written_journeys": abtest.any_finding_page(journeys, types, keys),
    }
    return {name: timed(frame) for name, frame in frames.items()}, journeys.count()


def timed(frame) -> float:
    start = time.perf_counter()
    frame.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    from catalog.everything import QUERIES
    from wayfare.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "wayfare-bench",
        **{
            "spark__master": f"local[{cpus}]",
            "spark__sql__shuffle__partitions": cpus,
            "spark__driver__memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark__ui__enabled": "false",
            "spark__ui__showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the workers and compile what all queries share before the clock runs.
    QUERIES["n7_edge_weights"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    written, n_journeys = on_written_journeys(spark, sf_dir)
    seconds.update(written)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "written_journeys": n_journeys,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
