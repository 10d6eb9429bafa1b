"""The taxon tree, and taxons of journeys and nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import parsing
from wayfare.session import cut_lineage


def node_taxon_set(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.explode("Node_Taxon").alias("content_id")).distinct()


def ancestors(taxonomy: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``content_id, level, ancestor_id, ancestor_parent_id, title``, the root at level 1.

    One join per step towards the root. A chain ends at an unknown parent, and where
    it would meet one of its own taxons again. Both sides grow with the taxonomy, so joins shuffle
    them: a broadcast would pass through the driver once a step.
    """
    tree = cut_lineage(taxonomy.select("content_id", "title", "parent_content_id"))
    start = tree if wanted is None else tree.join(wanted.hint("merge"), "content_id", "left_semi")
    parent = tree.select(
        F.col("content_id").alias("next_id"),
        F.col("title").alias("next_title"),
        F.col("parent_content_id").alias("next_parent"),
    )
    frontier = start.select(
        "content_id",
        F.col("parent_content_id").alias("next_id"),
        F.array("content_id").alias("path"),
    ).where(F.col("next_id").isNotNull())
    steps = []
    while True:
        step = cut_lineage(
            frontier.join(parent.hint("merge"), "next_id")
            .where(~F.array_contains("path", F.col("next_id")))
            .select(
                "content_id",
                F.size("path").alias("distance"),
                F.col("next_id").alias("ancestor_id"),
                F.col("next_parent").alias("ancestor_parent_id"),
                F.col("next_title").alias("title"),
                F.concat("path", F.array("next_id")).alias("path"),
            )
        )
        if step.isEmpty():
            break
        steps.append(step)
        frontier = step.where(F.col("ancestor_parent_id").isNotNull()).select(
            "content_id", F.col("ancestor_parent_id").alias("next_id"), "path"
        )
    chains = (steps or [step])[0]
    for other in steps[1:]:
        chains = chains.unionByName(other)
    depth = chains.groupBy("content_id").agg(F.max("distance").alias("depth"))
    return chains.join(depth.hint("merge"), "content_id").select(
        "content_id",
        (F.col("depth") - F.col("distance") + 1).cast("int").alias("level"),
        "ancestor_id",
        "ancestor_parent_id",
        "title",
    )


def taxon_table(taxonomy: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Title, path, level, parents from the root and title of the top parent."""
    entry = F.struct(
        "level",
        F.col("ancestor_id").alias("content_id"),
        F.col("ancestor_parent_id").alias("parent_content_id"),
        "title",
    )
    chains = (
        ancestors(taxonomy, wanted)
        .groupBy("content_id")
        .agg(
            F.array_sort(F.collect_list(entry)).alias("parents"),
            F.min_by("title", "level").alias("top"),
        )
    )
    own = taxonomy if wanted is None else taxonomy.join(wanted.hint("merge"), "content_id", "left_semi")
    none = F.array().cast(chains.schema["parents"].dataType)
    return own.join(chains.hint("merge"), "content_id", "left").select(
        "content_id",
        "title",
        "base_path",
        (F.size(F.coalesce("parents", none)) + 1).alias("level"),
        F.coalesce("parents", none).alias("parents"),
        F.coalesce("top", "title").alias("level1_parent"),
    )


def translate_nodes(nodes: DataFrame, taxons: DataFrame) -> DataFrame:
    """Nodes with the paths of their taxons in order, unknown taxons left out."""
    found = (
        nodes.select("Node", F.posexplode("Node_Taxon").alias("position", "content_id"))
        .join(taxons.select("content_id", "base_path"), "content_id")
        .groupBy("Node")
        .agg(F.array_sort(F.collect_list(F.struct("position", "base_path"))).alias("found"))
    )
    paths = F.coalesce(
        F.transform("found", lambda t: t["base_path"]), F.array().cast("array<string>")
    )
    return nodes.join(found, "Node", "left").withColumn("Node_Taxon_basepath", paths).drop("found")


def journeys_with_taxon(journeys: DataFrame, content_id: str) -> DataFrame:
    """Journeys with at least one page in the taxon."""
    return journeys.where(
        F.exists("Taxon_Page_List", lambda p: F.array_contains(p["taxons"], content_id))
    )


def mentioning_taxon(journeys: DataFrame, content_id: str) -> DataFrame:
    """Journeys whose sequence text holds the taxon id anywhere."""
    return journeys.where(F.col("Sequence").contains(content_id))


def taxon_counts(journeys: DataFrame) -> DataFrame:
    """Per journey: taxon texts and single taxons, all and distinct."""
    texts = F.filter("Taxon_List", lambda t: t.isNotNull())
    single = F.flatten(parsing.nest_taxons(texts))
    return journeys.withColumns(
        {
            "taxon_nested_all": F.size(texts).cast("bigint"),
            "taxon_nested_unique": F.size(F.array_distinct(texts)).cast("bigint"),
            "taxon_flat_all": F.size(single).cast("bigint"),
            "taxon_flat_unique": F.size(F.array_distinct(single)).cast("bigint"),
        }
    )


def taxon_frequency(journeys: DataFrame) -> DataFrame:
    """How often each taxon stands on a page of a journey type."""
    single = F.flatten(parsing.nest_taxons(F.filter("Taxon_List", lambda t: t.isNotNull())))
    return (
        journeys.select(F.explode(single).alias("content_id"))
        .groupBy("content_id")
        .agg(F.count("*").alias("n"))
    )


def taxon_coverage(frequency: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """One row: taxonomy entries seen in journeys, and their share in percent."""
    seen = frequency.select("content_id", F.lit(1).alias("seen"))
    return taxonomy.join(seen, "content_id", "left").agg(
        F.count("seen").alias("found"),
        F.count("*").alias("taxons"),
        F.try_divide(F.count("seen") * 100.0, F.count("*")).cast("double").alias("percent"),
    )


def parent_frequency(frequency: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Frequencies summed under the title of the immediate parent, or the own title."""
    parent = taxonomy.select(
        F.col("content_id").alias("parent_content_id"), F.col("title").alias("parent_title")
    )
    return (
        frequency.join(taxonomy, "content_id")
        .join(parent, "parent_content_id", "left")
        .groupBy(F.coalesce("parent_title", "title").alias("parent"))
        .agg(F.sum("n").alias("n"))
    )


def taxon_titles(taxon_lists: DataFrame, taxonomy: DataFrame, column: str) -> DataFrame:
    """``column, titles`` for each distinct taxon list; an unknown taxon reads NULL."""
    distinct = taxon_lists.select(column).where(F.col(column).isNotNull()).distinct()
    rows = distinct.select(
        column, F.posexplode(column).alias("position", "content_id")
    ).join(taxonomy.select("content_id", "title"), "content_id", "left")
    ordered = F.array_sort(F.collect_list(F.struct("position", "title")))
    return rows.groupBy(column).agg(F.transform(ordered, lambda t: t["title"]).alias("titles"))


def titled_edges(journeys: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Page pairs with the taxon titles of both pages and their sessions.

    Pairs are added up by page and taxon list first; titles are looked up once per
    distinct taxon list.
    """
    pairs = (
        journeys.select(
            F.explode(parsing.adjacent_pairs(F.col("Taxon_Page_List"))).alias("pair"),
            "Occurrences",
        )
        .groupBy(
            F.col("pair.src.page").alias("src"),
            F.col("pair.src.taxons").alias("src_taxons"),
            F.col("pair.dst.page").alias("dst"),
            F.col("pair.dst.taxons").alias("dst_taxons"),
        )
        .agg(F.sum("Occurrences").alias("weight"))
    )
    pairs = cut_lineage(pairs)
    lists = pairs.select(F.explode(F.array("src_taxons", "dst_taxons")).alias("taxons"))
    titles = cut_lineage(taxon_titles(lists, taxonomy, "taxons"))

    def side(end: str) -> DataFrame:
        return titles.select(
            F.col("taxons").alias(f"{end}_taxons"), F.col("titles").alias(f"{end}_titles")
        )

    return pairs.join(side("src"), "src_taxons", "left").join(side("dst"), "dst_taxons", "left")


def page_label(titles: Column) -> Column:
    """Titles in one text, a missing title as ``None``."""
    return F.array_join(titles, "_", "None")
