"""Conversation prefix trie with totals rolled up in depth bands.

Conversations that begin with the same turns share the nodes of those turns. A node is the sequence
of its first turns, known by two 64-bit hashes: the exclusive or of hashes of (depth, turn). Counts
of members are one aggregate; totals over subtrees are rolled up. In bands of ``height`` levels a
node adds its own value to its ancestors of the band only, found on the path of its smallest member.
The tops of the bands form a trie of their own, ``height`` times lower, that is rolled up the same
way; its completed totals then go to the ancestors in the band above. Neither the rounds (a logarithm
of the depth) nor the rows a node adds (``height`` for each round) grow with a conversation's length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.tables import columns
from wayfare.session import cut_lineage

HEIGHT = 32
#: Depths whose hashes are combined in one run; longer conversations are spread over several.
RUN = 1024
#: Ids joined in one text before a node's texts are hashed in order.
JOINED = 4096
#: Characters of role and text that range partitioning looks at, so that its samples stay small.
LOOKED_AT = 64

NODE = ["one", "two"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, turn_one, turn_two, chars) of every turn, ``at`` from 0 by turn, null first.

    Ties in turn go by role, then text; equal rows all count. Null roles and texts are empty. Rows
    without conv_id belong to no conversation. Rows are sorted in ranges over all conversations, so
    a conversation with very many turns is spread over tasks.
    """
    rows = columns(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("role", "text")),
    )
    by_turn = [F.col("conv_id"), F.col("turn").asc_nulls_first()]
    # Prefixes order rows as whole texts do, as long as a longer role ends the comparison.
    starts = [
        F.substring("role", 1, LOOKED_AT),
        F.when(F.length("role") <= LOOKED_AT, F.substring("text", 1, LOOKED_AT)).otherwise(F.lit("")),
    ]
    ranged = cut_lineage(
        rows.repartitionByRange(*by_turn, *starts)
        .sortWithinPartitions(*by_turn, "role", "text")
        .select(
            "conv_id",
            F.xxhash64("role", "text").alias("turn_one"),
            F.xxhash64(F.lit(1), "role", "text").alias("turn_two"),
            F.length("text").cast("long").alias("chars"),
            F.spark_partition_id().alias("range"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("within"),
        )
    )
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("conv_id", "range")
        .agg(F.min("within").alias("first"), F.count(F.lit(1)).alias("n"))
        .select("conv_id", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    )
    at = (F.col("within") + F.col("shift")).alias("at")
    return ranged.join(starts, ["conv_id", "range"]).select("conv_id", at, "turn_one", "turn_two", "chars")


def borrowed(conv_id: Column) -> Column:
    """How many opening turns a conversation takes from the first of its hundred: 0 to 5."""
    return F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % 6


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with turns of the first of their hundred, then go on with their own.

    ``turns`` is the written result of ``ordered_turns``. Returns (conv_id, n), the rebuilt number of
    turns of every conversation, and (conv_id, depth, turn_one, turn_two, chars, n), depth from 1. A
    conversation takes the first h turns of conversation ``conv_id - conv_id % 100`` (all if it has
    fewer, none if there is none; the remainder has the sign of the id) and leaves out its own first h.
    """
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    hundred = F.col("conv_id") - F.col("conv_id") % 100
    known = cut_lineage(own.withColumn("base", hundred).withColumn("h", borrowed(F.col("conv_id"))))
    heads = known.where("base = conv_id").select("base", F.col("own").alias("offered"))
    taken = F.least("h", F.coalesce("offered", F.lit(0)))
    sized = cut_lineage(
        known.join(heads, "base", "left").select(
            "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")
        )
    )
    opening = turns.where((F.col("conv_id") % 100 == 0) & (F.col("at") < 5)).withColumnRenamed("conv_id", "base")
    first = sized.where("taken > 0").join(opening, "base").where("at < taken").withColumn("depth", F.col("at") + 1)
    rest = turns.where(F.col("at") >= borrowed(F.col("conv_id"))).join(sized, "conv_id")
    rest = rest.withColumn("depth", F.col("taken") + F.col("at") - F.col("h") + 1)
    names = ["conv_id", "depth", "turn_one", "turn_two", "chars", "n"]
    return sized.select("conv_id", "n"), first.select(*names).unionByName(rest.select(*names))


def paths(sizes: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, depth, one, two, parent_one, parent_two, chars, ends) of every prefix of every conversation.

    ``one`` and ``two`` name the node; the root, of depth 0, is 0 and 0. ``ends`` marks the whole
    conversation.
    """
    salted = turns.select(
        "conv_id",
        "depth",
        F.expr(f"(depth - 1) div {RUN}").alias("run"),
        F.xxhash64("depth", "turn_one", "turn_two").alias("own_one"),
        F.xxhash64(F.lit(1), "depth", "turn_one", "turn_two").alias("own_two"),
        "chars",
        (F.col("depth") == F.col("n")).alias("ends"),
    )
    in_run = Window.partitionBy("conv_id", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    carried = salted.groupBy("conv_id", "run").agg(F.bit_xor("own_one").alias("own_one"), F.bit_xor("own_two").alias("own_two"))
    carried = carried.select(
        "conv_id", "run", *(F.coalesce(F.bit_xor(f"own_{name}").over(before), F.lit(0)).alias(f"carried_{name}") for name in NODE)
    )
    inside = salted.select("*", *(F.bit_xor(f"own_{name}").over(in_run).alias(f"in_{name}") for name in NODE))
    inside = inside.join(carried, ["conv_id", "run"])
    keys = [F.col(f"in_{name}").bitwiseXOR(F.col(f"carried_{name}")) for name in NODE]
    steps = inside.select(
        "conv_id",
        "depth",
        *(key.alias(name) for key, name in zip(keys, NODE)),
        *(key.bitwiseXOR(F.col(f"own_{name}")).alias(f"parent_{name}") for key, name in zip(keys, NODE)),
        "chars",
        "ends",
    )
    nothing, no_node = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = sizes.select(
        "conv_id",
        nothing.alias("depth"),
        *(nothing.alias(name) for name in NODE),
        *(no_node.alias(f"parent_{name}") for name in NODE),
        nothing.alias("chars"),
        (F.col("n") == 0).alias("ends"),
    )
    return steps.unionByName(roots)


def ends_digest(ends: DataFrame) -> DataFrame:
    """(one, two, ends_sha256) from (one, two, conv_id): the hash of each node's sorted, comma-joined ids.

    Ids are sorted in ranges and joined to texts of ``JOINED`` ids, so copies of one conversation are
    spread over tasks; a node's texts then stream through one hash, as its definition asks.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, made = None, [], 0

        def flush():
            nonlocal made
            made += 1
            return pa.RecordBatch.from_pydict(
                {"one": [node[0]], "two": [node[1]], "range": [at], "piece": [made], "ids": [",".join(map(str, ids))]},
                schema=pa.schema([("one", pa.int64()), ("two", pa.int64()), ("range", pa.int32()), ("piece", pa.int64()), ("ids", pa.string())]),
            )

        rows, at = [], 0
        for batch in batches:
            for one, two, conv_id, at in zip(*(batch.column(name).to_pylist() for name in ("one", "two", "conv_id", "range"))):
                if node is not None and ((one, two) != node or len(ids) == JOINED):
                    rows.append(flush())
                    ids = []
                    if len(rows) == 1024:
                        yield from pa.Table.from_batches(rows).combine_chunks().to_batches()
                        rows = []
                node = (one, two)
                ids.append(conv_id)
        if ids:
            rows.append(flush())
        if rows:
            yield from pa.Table.from_batches(rows).combine_chunks().to_batches()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0] for row in done], pa.int64()), pa.array([row[1] for row in done], pa.int64()), pa.array([row[2] for row in done], pa.string())],
                ["one", "two", "ends_sha256"],
            )

        for batch in batches:
            for one, two, ids in zip(*(batch.column(name).to_pylist() for name in ("one", "two", "ids"))):
                if (one, two) != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (one, two), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if len(done) >= 4096:
                yield out()
                done = []
        if node is not None:
            done.append((*node, digest.hexdigest()))
        yield out()

    ranged = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    ranged = ranged.select(*NODE, "conv_id", F.spark_partition_id().alias("range"))
    pieces = ranged.mapInArrow(joined, "one long, two long, range int, piece long, ids string")
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "range", "piece").select(*NODE, "ids")
    return pieces.mapInArrow(hashed, "one long, two long, ends_sha256 string")


def _to_ancestors(values: DataFrame, ways: DataFrame, names: list[str], stride: int, height: int, up: int) -> DataFrame:
    """Sums over (one, two): each value (conv_id, depth, ..) goes to its ancestors in the band ``up`` bands above.

    ``ways`` holds the paths of all conversations, of which depths divisible by ``stride`` count.
    """
    tall = stride * height
    of = values.select("conv_id", F.col("depth").alias("own_depth"), F.expr(f"depth div {tall} - {up}").alias("band"), *names)
    steps = ways.where(F.col("depth") % stride == 0).select("conv_id", "depth", F.expr(f"depth div {tall}").alias("band"), *NODE)
    met = of.join(steps, ["conv_id", "band"]).where("depth <= own_depth")
    return met.groupBy(*NODE).agg(*(F.sum(name).alias(name) for name in names))


def roll_up(nodes: DataFrame, ways: DataFrame, names: list[str], height: int = HEIGHT, stride: int = 1) -> DataFrame:
    """(one, two, ..): the sums of ``names`` over the subtree of every node of depth divisible by ``stride``.

    ``nodes`` (one, two, depth, conv_id, ..) holds those nodes with their own values and any member;
    ``ways`` (conv_id, depth, one, two) the path of every member, the root included. Both are read
    several times, so they should be written before.
    """
    deepest = nodes.agg(F.max("depth").alias("depth")).first()["depth"] or 0
    some = " OR ".join(f"{name} <> 0" for name in names)
    inside = cut_lineage(_to_ancestors(nodes.where(some), ways, names, stride, height, 0))
    tall = stride * height
    if deepest < tall:
        return inside
    # A top without values in its own band stays: what lies below it passes through.
    tops = nodes.where(F.col("depth") % tall == 0).select(*NODE, "depth", "conv_id")
    zeros = (F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in names)
    tops = cut_lineage(tops.join(inside, NODE, "left").select(*NODE, "depth", "conv_id", *zeros))
    whole = roll_up(tops, ways, names, height, tall)
    whole = cut_lineage(tops.drop(*names).join(whole, NODE))
    # What lies below a band reaches its nodes through the tops of the next one.
    below = _to_ancestors(whole.where("depth > 0"), ways, names, stride, height, 1)
    return cut_lineage(inside.unionByName(below).groupBy(*NODE).agg(*(F.sum(name).alias(name) for name in names)))


def trie(sizes: DataFrame, turns: DataFrame, height: int = HEIGHT) -> DataFrame:
    """All nodes of the trie of conversations (conv_id, n) and their turns (as ``rebuilt`` gives them).

    Returns conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens (code points that sharing a node saves, over its subtree) and
    ends_sha256. Conversations without turns end in the root. No conversations give no rows.
    """
    ways = cut_lineage(paths(sizes, turns))
    members = ways.groupBy(*NODE).agg(
        F.min("depth").alias("depth"),
        F.min("parent_one").alias("parent_one"),
        F.min("parent_two").alias("parent_two"),
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("chars").alias("chars"),
    )
    members = cut_lineage(members)
    parents = [F.col(f"parent_{name}").alias(name) for name in NODE]
    children = members.where("depth > 0").select(*parents).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut_lineage(
        members.join(children, NODE, "left").select(
            *NODE,
            "parent_one",
            "parent_two",
            "depth",
            "conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            F.col("n_children").isNull().cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        )
    )
    names = ["n_leaves", "saved_tokens"]
    totals = roll_up(nodes.select(*NODE, "depth", "conv_id", *names), ways, names, height)
    digests = ends_digest(ways.where("ends").select(*NODE, "conv_id"))
    above = nodes.select(F.col("one").alias("parent_one"), F.col("two").alias("parent_two"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.drop(*names)
        .join(totals, NODE)
        .join(digests, NODE, "left")
        .join(above, ["parent_one", "parent_two"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            *names,
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def share(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``trie`` of the ``rebuilt`` conversations (conv_id, turn, role, text); other columns play no part."""
    return trie(*rebuilt(cut_lineage(ordered_turns(conversations))), height)
