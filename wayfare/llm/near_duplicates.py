"""Near-duplicate components from SetSketch registers.

A document is its set of word shingles. Its sketch has exponentially spaced, truncated minima,
which merge by maximum and collide with a chance near the Jaccard similarity. Registers are cut
into bands; documents that agree in a band are candidates. The likelihood of all registers and both
set sizes drops hopeless candidates, and the full sets confirm the rest.

In every bucket one member, the pivot, is compared with the others and components are joined; most
buckets are one component then. In the others, the original of edited copies becomes the pivot. What
is still apart is compared by differences: each member is the set of shingles by which it differs from
the pivot, and two sets are links just when they have enough of those in common (see ``_by_difference``).
A member that is no link of the pivot needs many, so that its rarest ones lead to its few possible
partners, and no bucket is compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from wayfare.llm.bytewords import LOWER, buffer_of, hashes, in_bytes, rolled, spans
from wayfare.llm.tables import columns, maybe_among, text_keys
from wayfare.operators.positions import with_position
from wayfare.session import cut_lineage

SHINGLE_WORDS = 5
SIMILARITY = 80  # in hundredths
#: Bands x rows registers. A pair at 0.8 misses all bands with a chance of (1 - 0.8**6)**45 = 1e-6.
BANDS, ROWS = 45, 6
REGISTERS = BANDS * ROWS
#: Registers hold ``floor(1 - log_BASE(x))`` of the least exponential x of rate RATE, in 0..LIMIT.
BASE, RATE, LIMIT = 1.001, 20.0, 65535
#: A pair is dropped unseen only where its registers are e**20 times likelier below the limit.
DOUBT = 20.0
#: A shingle of at most so many members of a cluster is no common one of theirs.
RARE = 8


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``size`` words.

    Words are runs of bytes other than ASCII white space, after A-Z are lower-cased. A text of fewer
    words is one shingle, a text without words or a null has none.
    """
    data, offsets = buffer_of(texts)
    data = LOWER[data]
    starts, ends, first = spans((data != 32) & ((data < 9) | (data > 13)), offsets)
    own = hashes(data, starts, ends)
    out = []
    for at, to in zip(first[:-1], first[1:]):
        words = own[at:to]
        out.append(np.unique(rolled(words, min(size, len(words)))) if len(words) else np.empty(0, np.uint64))
    return out


_SEEDS = np.random.default_rng(1).integers(1, 1 << 63, (2, REGISTERS), dtype=np.uint64)
_FACTORS, _SHIFTS = _SEEDS[0] * np.uint64(2) + np.uint64(1), _SEEDS[1]


def sketch(found: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of hashes, as unsigned 16-bit numbers."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 512):  # blocks that stay in cache
        mixed = np.multiply.outer(_FACTORS, found[at : at + 512])
        mixed += _SHIFTS[:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LIMIT).astype(np.uint16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One hash for each band of registers."""
    out = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in registers.reshape(BANDS, ROWS).astype(np.uint64).T:
        out = (out ^ column) * np.uint64(0xC2B2AE3D27D4EB4F)
        out ^= out >> np.uint64(29)
    return out.astype(np.int64)


def log_likelihood(greater, less, equal, share, similarity):
    """Of register counts, given the first set's ``share`` of both sizes and a Jaccard similarity.

    A register of the first is greater with probability p(u - v J), less with p(v - u J), where
    u = share, v = 1 - share and p(x) = -log_b(1 - x (b - 1) / b).
    """

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    more, fewer = p(share - (1 - share) * similarity), p(1 - share - share * similarity)
    return greater * np.log(more) + less * np.log(fewer) + equal * np.log(np.clip(1 - more - fewer, 1e-12, 1))


def possible(first: np.ndarray, second: np.ndarray, n_first, n_second, limit: float) -> np.ndarray:
    """Whether the registers of pairs leave room for a similarity of ``limit`` or more."""
    greater, less = (first > second).sum(axis=1), (first < second).sum(axis=1)
    equal = first.shape[1] - greater - less
    share = n_first / (n_first + n_second)
    most = np.minimum(n_first, n_second) / np.maximum(n_first, n_second)
    grid = np.linspace(0, 1, 101)[None, :] * most[:, None]
    values = log_likelihood(greater[:, None], less[:, None], equal[:, None], share[:, None], grid)
    above = np.where(grid >= np.minimum(limit, most)[:, None] - 1e-9, values, -np.inf).max(axis=1)
    return (most >= limit - 1e-9) & (above >= values.max(axis=1) - DOUBT)


def set_keys(found: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set of shingles."""
    data = found.tobytes()
    return xxhash.xxh64_intdigest(data) - (1 << 63), xxhash.xxh64_intdigest(data, 1) - (1 << 63)


def _sketched(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_key, text_key2, n, key, key2, bands) of every row; key and key2 tell sets apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches):
            n, key, key2, bands = [], [], [], []
            for found in shingle_sets(batch.column("text"), size):
                n.append(len(found))
                one, two = set_keys(found)
                key.append(one)
                key2.append(two)
                bands.append(band_keys(sketch(found)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("doc_id", "text_key", "text_key2")),
                    *(pa.array(each, pa.int64()) for each in (n, key, key2)),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "text_key2", "n", "key", "key2", "bands"],
            )

    keys = [key.alias(name) for key, name in zip(text_keys(), ("text_key", "text_key2"))]
    rows = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keys)
    return rows.mapInArrow(run, "doc_id long, text_key long, text_key2 long, n long, key long, key2 long, bands array<long>")


def _full(texts: DataFrame, size: int) -> DataFrame:
    """(rep, n, registers, shingles) of texts (rep, key, key2, text) whose set is that of the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches):
            sets = shingle_sets(batch.column("text"), size)
            keys = zip(batch.column("key").to_pylist(), batch.column("key2").to_pylist())
            own = [at for at, (found, key) in enumerate(zip(sets, keys)) if set_keys(found) == key]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rep").take(pa.array(own, pa.int64())),
                    pa.array([len(sets[at]) for at in own], pa.int64()),
                    pa.array([sketch(sets[at]).tobytes() for at in own], pa.binary()),
                    pa.array([sets[at].astype(np.int64) for at in own], pa.list_(pa.int64())),
                ],
                ["rep", "n", "registers", "shingles"],
            )

    found = texts.select("rep", "key", "key2", "text").mapInArrow(run, "rep long, n long, registers binary, shingles array<long>")
    return found.dropDuplicates(["rep"])


def _beside(pairs: DataFrame, full: DataFrame, *names: str) -> DataFrame:
    """``pairs`` (a, b) with the columns ``names`` of both, as a_name and b_name."""
    for side in ("a", "b"):
        pairs = pairs.join(full.select(F.col("rep").alias(side), *(F.col(name).alias(f"{side}_{name}") for name in names)), side)
    return pairs


def _room(n: str, other: str, common: Column, limit: int) -> Column:
    """Whether sets of two sizes with so many shingles in common reach ``limit`` hundredths."""
    return common * 100 >= (F.col(n) + F.col(other) - common) * limit


def _verified(pairs: DataFrame, full: DataFrame, limit: int) -> DataFrame:
    """The pairs (a, b) whose sets reach ``limit`` hundredths."""

    @pandas_udf("boolean")
    def room(ra, rb, na, nb):
        import pandas as pd

        def stack(column):
            return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), REGISTERS).astype(np.int32)

        if not len(ra):
            return pd.Series([], dtype=bool)
        return pd.Series(possible(stack(ra), stack(rb), na.to_numpy(float), nb.to_numpy(float), limit / 100))

    # The sizes alone rule many pairs out.
    near = _beside(pairs, full, "n", "registers").where(_room("a_n", "b_n", F.least("a_n", "b_n"), limit))
    hopeful = near.where(room("a_registers", "b_registers", "a_n", "b_n")).select("a", "b")
    both = _beside(cut_lineage(hopeful), full, "n", "shingles").withColumn("shared", F.size(F.array_intersect("a_shingles", "b_shingles")))
    return both.where(_room("a_n", "b_n", F.col("shared"), limit)).select("a", "b")


def _held(reps: DataFrame, full: DataFrame) -> DataFrame:
    """(rep, n, shared, common) of ``reps`` (rep, cluster).

    ``shared`` counts the shingles that another member of the cluster has too, ``common`` those that
    more than ``RARE`` members have. Two sets have at most the smaller of their ``shared`` in common.
    """

    of = full.select("rep", "n", "shingles").join(reps, "rep")
    keys = of.select("rep", "cluster", F.explode("shingles").alias("shingle"))
    keys = cut_lineage(keys.select(F.xxhash64("cluster", "shingle").alias("key"), "rep"))
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1")
    found = keys.join(counts, "key")
    per = found.groupBy("rep").agg(F.count(F.lit(1)).alias("shared"), F.count_if(F.col("docs") > RARE).alias("common"))
    none = F.lit(0).cast("long")
    sized = of.select("rep", "n").join(per, "rep", "left")
    return cut_lineage(sized.select("rep", "n", F.coalesce("shared", none).alias("shared"), F.coalesce("common", none).alias("common")))


def _are_stars(links: DataFrame) -> bool:
    """Whether each node of links (u, v), v < u, is a centre or tied to one centre and nothing else."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    counts = ends.groupBy("node").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
    return counts.where("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the smallest node reachable.

    Each round, all larger neighbours of a node are tied to the least node it knows, then all its
    smaller ones; the links turn into stars whose centres are the answer, in rounds that grow with
    the logarithm of the longest path. The least neighbours are aggregated and written before they
    are joined, so that a hub's links are split over tasks and never gathered.
    """
    links = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _are_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = cut_lineage(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        centre = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")))
        to = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        links = cut_lineage(large.join(centre, "u").select(to.alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
    centres = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cut_lineage(links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres))


def _joined(members: DataFrame, load: Callable[[DataFrame], DataFrame], limit: int) -> DataFrame:
    """(node, component) from members (bucket, rep) of buckets, by confirmed links.

    ``load`` gives the full sets of a table of reps.
    """
    pivots = members.groupBy("bucket").agg(F.min("rep").alias("a"), F.max("rep").alias("high")).where("a < high")
    members = cut_lineage(members.join(pivots.select("bucket", "a"), "bucket"))
    stars = cut_lineage(members.where("rep > a").select("a", F.col("rep").alias("b")).distinct())
    ends = stars.select(F.col("a").alias("rep")).unionByName(stars.select(F.col("b").alias("rep"))).distinct()
    full = cut_lineage(load(cut_lineage(ends)))
    links = components(cut_lineage(_verified(stars, full, limit)))
    going = _open(members, links)
    if going.isEmpty():
        return links
    tied = components(going.select(F.col("a").alias("a"), F.col("rep").alias("b")))
    sized = _held(tied.select(F.col("node").alias("rep"), F.col("component").alias("cluster")), full)
    # The member with the largest part in common with others, the original of edited copies, is the better pivot.
    central = going.join(sized, "rep").groupBy("bucket").agg(F.max(F.struct(F.col("common") / F.col("n"), "rep")).alias("most"))
    central = cut_lineage(central.select("bucket", F.col("most.rep").alias("pivot")))
    again = going.join(central, "bucket").where("rep <> pivot")
    again = again.select(F.least("pivot", "rep").alias("a"), F.greatest("pivot", "rep").alias("b")).distinct()
    again = cut_lineage(again.join(stars, ["a", "b"], "left_anti"))
    links = _with(links, cut_lineage(_verified(again, full, limit)))
    going = _open(going.select("bucket", "a", "rep"), links)
    pairs = cut_lineage(_by_difference(going.join(central, "bucket"), sized, full, limit))
    known = stars.unionByName(again)
    return _with(links, cut_lineage(_verified(cut_lineage(pairs.join(known, ["a", "b"], "left_anti")), full, limit)))


def _by_difference(going: DataFrame, sized: DataFrame, full: DataFrame, limit: int) -> DataFrame:
    """(a, b): members of a bucket, of different components, whose differences from its pivot leave room for a link.

    The differences D are the shingles that just one of a set and its pivot has. Two sets with one pivot
    differ by the sizes of both D less twice the number that D have in common, so they are links if and
    only if ``2 (100 + limit) common >= w + w'``, where ``w = (100 + limit) |D| - (100 - limit) n``. A member
    that is no link of the pivot, ``far``, asks any partner for some: no set's w is below the pivot's, and
    its own sum with that is above 0. One of any two components is far. By the least w among its possible
    partners each member has a number of differences it must share, so it meets all partners within a
    prefix of them, the rarest first; ``left`` are those from the shared one on. Differences that no other
    member has are left out.
    """
    unit = 100 + limit
    own = going.where(F.col("rep") == F.col("pivot")).select("bucket", F.col("component").alias("own"))
    groups = going.join(own, "bucket").where("rep <> pivot").select("pivot", "rep", "component", (F.col("component") != F.col("own")).alias("far"))
    groups = cut_lineage(groups.distinct().join(sized.where(_room("n", "shared", F.col("shared"), limit)).select("rep"), "rep"))
    groups = groups.join(groups.where("far").select("pivot").distinct(), "pivot", "left_semi")
    both = groups.join(full.select("rep", "n", "shingles"), "rep").join(full.select(F.col("rep").alias("pivot"), F.col("shingles").alias("others")), "pivot")
    both = both.withColumn("differences", F.concat(F.array_except("shingles", "others"), F.array_except("others", "shingles")))
    weight = F.size("differences") * unit - F.col("n") * (100 - limit)
    rows = cut_lineage(both.select("pivot", "rep", "component", "far", weight.alias("w"), F.explode("differences").alias("shingle")))
    counts = rows.groupBy("pivot", "shingle").agg(F.count(F.lit(1)).alias("docs"), F.count_if("far").alias("apart"))
    rows = rows.join(counts.where("docs > 1 AND apart > 0").drop("apart"), ["pivot", "shingle"])
    lists = cut_lineage(rows.groupBy("pivot", "rep", "component", "far", "w").agg(F.sort_array(F.collect_list(F.struct("docs", "shingle"))).alias("held")))
    least = lists.groupBy("pivot").agg(F.min("w").alias("least"), F.min(F.when(F.col("far"), F.col("w"))).alias("least_far"))
    asked = F.ceil((F.col("w") + F.when(F.col("far"), F.col("least")).otherwise(F.col("least_far"))) / (2 * unit))
    lists = lists.join(least, "pivot").withColumn("asked", F.greatest(asked, F.lit(1)).cast("int")).where(F.size("held") >= F.col("asked"))
    prefix = F.posexplode(F.slice("held", F.lit(1), F.size("held") - F.col("asked") + 1)).alias("place", "of")
    met = lists.select("pivot", "rep", "component", "far", "w", F.size("held").alias("size"), prefix)
    met = cut_lineage(met.select("pivot", F.col("of.shingle").alias("shingle"), "rep", "component", "far", "w", (F.col("size") - F.col("place")).alias("left")))
    other = met.select("pivot", "shingle", *(F.col(name).alias(f"other_{name}") for name in ("rep", "component", "far", "w", "left")))
    room = F.least("left", "other_left") * (2 * unit) >= F.col("w") + F.col("other_w")
    once = ~F.col("other_far") | (F.col("rep") < F.col("other_rep"))
    pairs = met.where("far").join(other, ["pivot", "shingle"]).where(room & once & (F.col("component") != F.col("other_component")))
    return pairs.select(F.least("rep", "other_rep").alias("a"), F.greatest("rep", "other_rep").alias("b")).distinct()


def _with(links: DataFrame, found: DataFrame) -> DataFrame:
    """(node, component) of the components ``links`` joined by the pairs ``found`` (a, b)."""
    return components(found.unionByName(links.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def _open(members: DataFrame, links: DataFrame) -> DataFrame:
    """(bucket, a, rep, component, largest) of the buckets that are several components, with the largest of those."""
    known = members.join(links.withColumnRenamed("node", "rep"), "rep", "left")
    known = cut_lineage(known.select("bucket", "a", "rep", F.coalesce("component", "rep").alias("component")))
    parts = known.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"))
    parts = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.sum("size").alias("size"), F.max(F.struct("size", "component")).alias("most"))
    open_ = parts.where("parts > 1 AND size > 2").select("bucket", F.col("most.component").alias("largest"))
    return cut_lineage(known.join(cut_lineage(open_), "bucket"))


def cluster(docs: DataFrame, words: int = SHINGLE_WORDS, limit: int = SIMILARITY, keyed: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Documents with equal sets are one class, compared once, so copies are never paired with each other. Links are sets of at least ``limit`` hundredths Jaccard similarity.
    ``component_id`` is the smallest doc_id reachable over links; ``kept`` marks the row that has it.
    A text without words, or null, has no shingles and its own doc_id. Repeated rows get the same
    result each; texts that share a doc_id are documents of their own. A row without doc_id takes no
    part: its component_id is null, kept false. An empty table gives no rows. ``keyed`` adds the
    ``text_keys`` as text_key and text_key2, and ``leads``: of the sets of a component that stand under
    its smallest doc_id, the smallest has it.
    """
    rows = cut_lineage(_sketched(docs, words))
    named = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(named.groupBy("key", "key2").agg(F.min("n").alias("n"), F.min("doc_id").alias("first")))
    classes = cut_lineage(with_position(classes, [F.col("first"), F.col("key"), F.col("key2")], "rep"))
    # One row stands for its class; its bands are those of all.
    own = F.col("doc_id") == F.col("first")
    members = named.select("key", "key2", "doc_id", "bands").join(classes, ["key", "key2"]).where(own)
    members = members.select("rep", F.explode("bands").alias("bucket"))

    def load(reps: DataFrame) -> DataFrame:
        wanted = cut_lineage(classes.join(reps, "rep", "left_semi").select("rep", "key", "key2", F.col("first").alias("doc_id")))
        texts = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
        texts = maybe_among(texts, F.xxhash64("doc_id"), wanted.select(F.xxhash64("doc_id").alias("hashed")), "wanted")
        return _full(texts.where("wanted").join(wanted, "doc_id"), words)

    found = _joined(members, load, limit)
    linked = cut_lineage(classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    groups = linked.groupBy("component").agg(F.min(F.struct("first", "rep")).alias("least"))
    linked = linked.join(groups, "component")
    linked = cut_lineage(linked.select("key", "key2", F.col("least.first").alias("component_id"), (F.col("least.rep") == F.col("rep")).alias("leads")))
    joined = rows.drop("bands").join(linked, ["key", "key2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(False))
    first = [F.col("text_key"), F.col("text_key2"), (kept & F.coalesce("leads", F.lit(True))).alias("leads")] if keyed else []
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"), *first)
