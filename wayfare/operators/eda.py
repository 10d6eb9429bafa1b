"""Exploration of journeys, weighted by their sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare import constants as C
from wayfare.functions import features, parsing
from wayfare.operators.positions import with_position
from wayfare.session import cut_lineage

SEARCH_PATTERN = "/search?"
SEARCH_FOLDER = "/search/"


def final_interaction(page_events: Column, with_taxons: bool = False) -> Column:
    """Event text of the last hit, or with ``with_taxons`` its last field."""
    last = parsing.last_item(page_events)
    return F.coalesce(last["taxons"], last["event"]) if with_taxons else last["event"]


def other_devices(devices: Column) -> Column:
    """Sessions on anything but desktop and mobile."""
    known = features.multiset_count(devices, "desktop") + features.multiset_count(devices, "mobile")
    return features.multiset_total(devices) - known


def more_desktop(devices: Column) -> Column:
    desktop = features.multiset_count(devices, "desktop")
    return (desktop > features.multiset_total(devices) - desktop).cast("int")


def _search_pattern(literal: bool) -> str:
    return rf"\Q{SEARCH_PATTERN}\E" if literal else SEARCH_PATTERN


def count_searches(page_sequence: Column, literal: bool = False) -> Column:
    """Search hits; unless ``literal`` the question mark makes the ``h`` optional."""
    return F.regexp_count(page_sequence, F.lit(_search_pattern(literal))) + F.regexp_count(
        page_sequence, F.lit(SEARCH_FOLDER)
    )


def contains_search(page_sequence: Column, literal: bool = False) -> Column:
    found = page_sequence.rlike(_search_pattern(literal)) | page_sequence.contains(SEARCH_FOLDER)
    return F.coalesce(found, F.lit(False)).cast("int")


def flag(condition: Column) -> Column:
    """1 or 0, a missing value as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def events_contain_start(events: Column) -> Column:
    return flag(
        F.exists(events, lambda e: e["category"].contains("start") | e["action"].contains("start"))
    )


def final_page_type(page: Column) -> Column:
    """Type of a page by the last matching pattern, ``other`` without any."""
    kind = F.lit("other")
    for pattern, name in C.FINAL_PAGE_TYPES:
        kind = F.when(page.rlike(pattern), name).otherwise(kind)
    return F.when(page.isNotNull(), kind).otherwise("other")


def _extract(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


def final_interaction_type(interaction: Column) -> Column:
    return _extract(interaction, "<:<(.*)<:<")


def final_external_link(interaction: Column) -> Column:
    link = _extract(interaction, "EVENT<:<External Link Clicked<:(.*)")
    return F.regexp_replace(link, "^<", "")


def derive_columns(processed: DataFrame, service_domain: str, literal: bool = False) -> DataFrame:
    """All exploration columns of processed journeys.

    ``service_domain`` marks links to services that passed an assessment.
    """
    sequence, pages = F.col("Sequence"), F.col("PageSequence")
    devices = F.col("DeviceCategories")
    df = processed.withColumns(
        {
            "page_seq_len": F.size("Page_List").cast("bigint"),
            "page_seq_len_NL": F.size("Page_List_NL").cast("bigint"),
            "count_search": count_searches(pages, literal),
            "event_list_contains_start": events_contain_start(F.col("Event_List")),
            "page_seq_contains_start": flag(sequence.contains("start")),
            "page_seq_contains_service": flag(sequence.contains(service_domain)),
            "final_page": parsing.last_item(F.col("Page_List")),
            "final_interaction": final_interaction(F.col("Page_Event_List")),
            "contains_search_regex": contains_search(pages, literal),
            "desktop": features.multiset_count(devices, "desktop"),
            "mobile": features.multiset_count(devices, "mobile"),
            "other_device": other_devices(devices),
            "more_desktop": more_desktop(devices),
        }
    )
    df = df.withColumns(
        {
            "contains_search_n": F.col("contains_search_regex") * F.col("Page_Seq_Occurrences"),
            "final_page_type": final_page_type(F.col("final_page")),
            "final_interaction_type": final_interaction_type(F.col("final_interaction")),
            "final_external_link": final_external_link(F.col("final_interaction")),
        }
    )
    return df.withColumn(
        "exit_to_assessed_service", flag(F.col("final_external_link").contains(service_domain))
    )


def group_percent(df: DataFrame, by: str) -> DataFrame:
    """``by, n, percent`` of the rows; the total comes from the groups."""
    groups = df.groupBy(by).agg(F.count("*").alias("n"))
    return _with_share(groups, "n", "percent", 100.0)


def value_shares(df: DataFrame, by: str, weight: str = "Occurrences") -> DataFrame:
    """``by, n, share`` weighted by sessions."""
    groups = df.groupBy(by).agg(F.sum(weight).alias("n"))
    return _with_share(groups, "n", "share", 1.0)


def _with_share(groups: DataFrame, value: str, name: str, scale: float) -> DataFrame:
    """The groups are read twice, so they are written, not the rows they come from."""
    groups = cut_lineage(groups)
    total = groups.agg(F.sum(value).cast("double").alias("total")).scalar()
    return groups.withColumn(name, F.try_divide(F.col(value) * F.lit(scale), total))


def _hash_number(key: str, seed: int) -> Column:
    """A number of 48 bits that depends on the key and the seed alone."""
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")


def _hash_uniform(key: str, seed: int) -> Column:
    """The same as a number between 0 and 1, neither included."""
    return (_hash_number(key, seed).cast("double") + 1.0) / float(2**48 + 1)


def weighted_sample(df: DataFrame, n: int, key: str = "Sequence", seed: int = 1234) -> DataFrame:
    """``n`` rows without replacement, drawn in proportion to their occurrences.

    Keeps the rows with the smallest ``-ln(u) / weight`` (Efraimidis and Spirakis).
    """
    draw = -F.ln(_hash_uniform(key, seed)) / F.col("Occurrences")
    return df.withColumn("_draw", draw).orderBy("_draw", key).limit(n).drop("_draw")


def uniform_sample(df: DataFrame, fraction: float, key: str = "Sequence", seed: int = 1234) -> DataFrame:
    return df.where(_hash_uniform(key, seed) < fraction)


def sample_with_replacement(
    df: DataFrame, share: float, key: str = "Sequence", seed: int = 1234
) -> DataFrame:
    """``ceil(share * sessions)`` draws in proportion to occurrences, as counts ``draws``.

    Sessions are numbered through all rows and every draw is a session number. Rows and
    draws meet by blocks of numbers; a row with many sessions spans many blocks, so no
    block and no task holds more than its part of the draws.
    """
    placed = cut_lineage(with_running_total(df, [F.col(key)], "Occurrences", "_upto"))
    total = placed.agg(F.sum("Occurrences")).first()[0] or 0
    draws = -int(-share * total // 1)
    # About one draw a block, so a block meets few draws however many rows begin in it.
    block = max(1, int(total // max(draws, 1)))
    spans = placed.select(
        key,
        (F.col("_upto") - F.col("Occurrences")).alias("_from"),
        "_upto",
        F.explode(
            F.sequence(
                F.expr(f"(_upto - Occurrences) DIV {block}"), F.expr(f"(_upto - 1) DIV {block}")
            )
        ).alias("_block"),
    )
    picks = (
        df.sparkSession.range(draws)
        .withColumn("_pick", _hash_number("id", seed) % max(total, 1))
        .withColumn("_block", F.expr(f"_pick DIV {block}"))
    )
    counts = (
        picks.join(spans, "_block")
        .where("_pick >= _from AND _pick < _upto")
        .groupBy(key)
        .agg(F.count("*").alias("draws"))
    )
    return placed.drop("_upto").join(counts, key)


def with_running_total(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` up to and with each row, in an order without ties."""
    return with_running_totals(df, order, {name: value})


def with_running_totals(df: DataFrame, order: list[Column], values: dict[str, str]) -> DataFrame:
    """Add the running sum of each value under its name, in an order without ties.

    Positions cut the order into blocks; totals run within a block and over the block
    sums.
    """
    rows_per_block = 100_000
    placed = with_position(df, order, "_position").withColumn(
        "_block", F.expr(f"_position DIV {rows_per_block}")
    )
    inside = W.partitionBy("_block").orderBy("_position")
    # One row per block of rows.
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_block")
        .agg(*[F.sum(value).alias(f"_sum_{name}") for name, value in values.items()])
        .select(
            "_block",
            *[F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_offset_{name}") for name in values],
        )
    )
    return (
        placed.select("*", *[F.sum(value).over(inside).alias(f"_inside_{name}") for name, value in values.items()])
        .join(offsets, "_block")
        .withColumns({name: F.col(f"_inside_{name}") + F.col(f"_offset_{name}") for name in values})
        .drop("_position", "_block", *[f"_{part}_{name}" for name in values for part in ("inside", "offset")])
    )


def expand_sessions(df: DataFrame, per_block: int = 100_000) -> DataFrame:
    """One row per session, numbered from 0 within its journey.

    A journey with very many sessions is first cut into blocks; rebalancing spreads the
    blocks evenly over tasks.
    """
    blocks = df.withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.expr(f"(Occurrences - 1) DIV {per_block}")))
    ).hint("rebalance")
    first = F.col("_block") * per_block
    last = F.least(first + per_block, F.col("Occurrences")) - 1
    return blocks.withColumn("session", F.explode(F.sequence(first, last))).drop("_block")


def page_rows(df: DataFrame, pages: str = "Page_List_NL") -> DataFrame:
    """One row per page of a journey, with its position."""
    others = [c for c in df.columns if c != pages]
    return df.select(*others, F.posexplode(pages).alias("position", "page"))


def distinct_page_rows(df: DataFrame, pages: str = "Page_List_NL") -> DataFrame:
    """One row per journey and page, however often the page is visited."""
    others = [c for c in df.columns if c != pages]
    return df.select(*others, F.explode(F.array_distinct(pages)).alias("page"))


def consistency_totals(df: DataFrame) -> DataFrame:
    """One row: sessions, journey types, de-looped types, page visits and their means.

    Everything is counted in one aggregate per journey type.
    """
    pages = F.size("Page_List_NL") * F.col("Occurrences")
    distinct = F.size(F.array_distinct("Page_List_NL")) * F.col("Occurrences")
    return df.agg(
        F.sum("Occurrences").alias("journeys"),
        F.count("*").alias("journey_types"),
        F.countDistinct("Page_Seq_NL").alias("journey_types_nl"),
        F.sum(pages).cast("bigint").alias("page_visits"),
        F.sum(distinct).cast("bigint").alias("pages_once_per_session"),
    ).select(
        "*",
        F.try_divide(F.col("journeys").cast("double"), F.col("journey_types_nl")).alias(
            "journeys_per_type"
        ),
        F.try_divide(F.col("page_visits").cast("double"), F.col("pages_once_per_session")).alias(
            "visits_per_page"
        ),
    )


def search_by_length(derived: DataFrame) -> DataFrame:
    """Per page length: sessions that search, all sessions, percent and variance."""
    share = F.col("percent") / 100.0
    return (
        derived.groupBy(F.col("page_seq_len").alias("length"))
        .agg(F.sum("contains_search_n").alias("n"), F.sum("Page_Seq_Occurrences").alias("denom"))
        .where("denom >= 1 AND length >= 1")
        .withColumn("percent", F.round(F.col("n") * 100.0 / F.col("denom"), 1).cast("double"))
        .withColumn("variance", (share * (1 - share)) / F.col("denom"))
    )


def page_visits(df: DataFrame) -> DataFrame:
    """Sessions that visit each page at least once."""
    return distinct_page_rows(df.select("Page_List_NL", "Occurrences")).groupBy("page").agg(
        F.sum("Occurrences").alias("visits")
    )


def concentration(visits: DataFrame, shares: list[float]) -> DataFrame:
    """For each share of all pages, the visits that the most visited of them hold.

    Pages with equally many visits are interchangeable, so the running sums go over the
    distinct visit counts. There are at most ``sqrt(2 * visits)`` of those.
    """
    levels = visits.groupBy("visits").agg(F.count("*").alias("pages"))
    running = cut_lineage(
        with_running_totals(
            levels.withColumn("held", F.col("visits") * F.col("pages")),
            [F.desc("visits")],
            {"pages_upto": "pages", "visits_upto": "held"},
        )
    )
    n_pages, n_visits = running.agg(F.max("pages_upto"), F.max("visits_upto")).first()
    tops = [(share, int(n_pages * share)) for share in shares] if n_pages else []
    # Each share's pages end in one level, so no level is repeated for shares that end elsewhere.
    begins = F.col("pages_upto") - F.col("pages")
    wanted = F.array(*[F.struct(F.lit(s).alias("share"), F.lit(n).cast("bigint").alias("top")) for s, n in tops if n])
    none = visits.sparkSession.createDataFrame([t for t in tops if not t[1]], "share_of_pages double, top bigint")
    none = none.withColumn("visits", F.lit(0).cast("bigint"))
    found = none
    if any(n for _, n in tops):
        ends_here = F.filter(wanted, lambda t: (t["top"] > begins) & (t["top"] <= F.col("pages_upto")))
        rows = running.withColumn("end", F.explode(ends_here)).select(
            F.col("end.share").alias("share_of_pages"),
            F.col("end.top").alias("top"),
            (F.col("visits_upto") - F.col("held") + F.col("visits") * (F.col("end.top") - begins)).alias("visits"),
        )
        found = rows.unionByName(none)
    return found.withColumn(
        "share_of_visits", F.try_divide(F.col("visits").cast("double"), F.lit(n_visits).cast("bigint"))
    )


def concentration_curve(visits: DataFrame, points: int = 100) -> DataFrame:
    return concentration(visits, [i / points for i in range(points)])


def destinations(derived: DataFrame) -> DataFrame:
    """Sessions per final page."""
    return derived.groupBy("final_page").agg(F.sum("Occurrences").alias("n"))


def count_destinations(derived: DataFrame) -> DataFrame:
    return derived.agg(F.countDistinct("final_page").alias("n_destinations"))


def ways_to_page(derived: DataFrame) -> DataFrame:
    """Distinct de-looped sequences that end on each page."""
    return (
        derived.select("final_page", "Page_Seq_NL")
        .distinct()
        .groupBy("final_page")
        .agg(F.count("*").alias("n_ways"))
    )


def missing_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, n_missing, share`` in one pass."""
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in columns]
    )
    return counted.select("_rows", F.inline(rows)).select(
        "column",
        "n_missing",
        F.try_divide(F.col("n_missing").cast("double"), F.col("_rows")).alias("share"),
    )


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def sessions_per_sequence(df: DataFrame, sequence: str = "PageSequence") -> DataFrame:
    """``PageSequence, journey_occurrences``, also for de-looped sequences."""
    return (
        df.where(F.col(sequence).isNotNull())
        .groupBy(F.col(sequence).alias("PageSequence"))
        .agg(F.sum("Occurrences").alias("journey_occurrences"))
    )


def top_and_others(per_sequence: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent sequences with their percentage, the rest as ``Others``."""
    total = per_sequence.agg(F.sum("journey_occurrences").alias("total")).scalar()
    top = per_sequence.orderBy(F.desc("journey_occurrences"), "PageSequence").limit(n)
    others = (
        top.agg(F.coalesce(F.sum("journey_occurrences"), F.lit(0)).alias("in_top"))
        .select(
            F.lit("Others").alias("PageSequence"),
            (total - F.col("in_top")).alias("journey_occurrences"),
        )
    )
    return top.unionByName(others).withColumn(
        "percent", (F.col("journey_occurrences") * 100.0 / total).cast("double")
    )


def fixed_width_histogram(df: DataFrame, value: str, width: int, upper: int) -> DataFrame:
    """``bin, frequency, share``: bins open to the left, the first holds 0 as well.

    Empty bins are listed up to ``upper``, fuller ones wherever the values go.
    """
    index = F.greatest(F.ceil(F.col(value) / F.lit(width)), F.lit(1)).cast("bigint")
    filled = df.groupBy(index.alias("bin")).agg(F.count("*").alias("frequency"))
    empty = df.sparkSession.range(1, upper // width + 1).select(
        F.col("id").alias("bin"), F.lit(0).cast("bigint").alias("frequency")
    )
    bins = filled.unionByName(empty).groupBy("bin").agg(F.sum("frequency").alias("frequency"))
    return _with_share(bins, "frequency", "share", 1.0)


def one_off_shares(per_sequence: DataFrame) -> DataFrame:
    """Rounded percentages of one-off and repeated sequences."""
    counts = per_sequence.agg(
        F.count_if(F.col("journey_occurrences") == 1).alias("one_offs"), F.count("*").alias("n")
    )
    return counts.select(
        "one_offs",
        (F.col("n") - F.col("one_offs")).alias("not_one_offs"),
        F.round(F.col("one_offs") * 100.0 / F.col("n"), 0).cast("double").alias("percent_one_off"),
        F.round((F.col("n") - F.col("one_offs")) * 100.0 / F.col("n"), 0)
        .cast("double")
        .alias("percent_not_one_off"),
    )


def rare_shares(per_sequence: DataFrame, at_most: int = 10) -> DataFrame:
    """Share of each occurrence count among the rare sequences."""
    rare = (
        per_sequence.where(F.col("journey_occurrences") <= at_most)
        .groupBy("journey_occurrences")
        .agg(F.count("*").alias("n"))
    )
    return _with_share(rare, "n", "share", 1.0)


# Leading text of sequences that were hardly meant.
JUNK_PATTERNS = {
    "space": r"^/\s",
    "hyphen": "^/-",
    "colon": "^/:",
    "question": r"^/\?",
}
CLEAN_PATTERN = "^/[a-z A-Z 0-9]"


def drop_junk(per_sequence: DataFrame) -> DataFrame:
    """Keep sequences that start like an address, in the steps listed above."""
    sequence = F.col("PageSequence")
    junk = features.any_of([sequence.rlike(p) for p in JUNK_PATTERNS.values()])
    return per_sequence.where(~junk & sequence.rlike(CLEAN_PATTERN))


def junk_counts(per_sequence: DataFrame) -> DataFrame:
    """One row: how many sequences each junk pattern matches, and how many stay."""
    sequence = F.col("PageSequence")
    junk = features.any_of([sequence.rlike(p) for p in JUNK_PATTERNS.values()])
    return per_sequence.agg(
        *[F.count_if(sequence.rlike(p)).alias(name) for name, p in JUNK_PATTERNS.items()],
        F.count_if(~junk & sequence.rlike(CLEAN_PATTERN)).alias("kept"),
    )


def with_length_and_type(per_sequence: DataFrame) -> DataFrame:
    return per_sequence.withColumns(
        {
            "journey_length": parsing.delimiter_length(F.col("PageSequence")),
            "pageseq_type": F.when(F.col("journey_occurrences") == 1, "one-off").otherwise(
                "not-one-off"
            ),
        }
    )


def length_bucket(length: Column) -> Column:
    """1 to 10 as they are, then up to 100, up to 499 and longer."""
    return (
        F.when(length < 11, length.cast("string"))
        .when(length < 101, "11<=x<100")
        .when(length < 500, "101<=x<500")
        .otherwise("x>=500")
    )


def occurrences_by_bucket(typed: DataFrame, by_type: bool = False) -> DataFrame:
    """Sessions and share per length bucket, on request per one-off type as well."""
    keys = [length_bucket(F.col("journey_length")).alias("journey_length_type")]
    if by_type:
        keys.append(F.col("pageseq_type"))
    sums = typed.groupBy(*keys).agg(F.sum("journey_occurrences").alias("journey_occurrences"))
    return _with_share(sums, "journey_occurrences", "share", 1.0)


def by_occurrences(df: DataFrame) -> DataFrame:
    """Journeys from the most to the least frequent."""
    return df.orderBy(F.desc("Occurrences"), "Sequence")
