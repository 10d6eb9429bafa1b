"""Approximate nearest neighbours by a hash-prefix forest.

Every tree gives each vector a string of hash bits and keeps the vectors as an array sorted by it.
A query descends to the place of its longest-prefix match in each tree. All trees then ascend in
step, one prefix bit at a time, until enough vectors share the prefix; these are compared exactly.

How far a query looks is measured, not given: queries of a sample are answered exactly, and the
window is as wide as their neighbours need, up to the whole array.

The sorted arrays are cut into blocks of bounded size, and queries are sent to all blocks they look
at, so that no run of equal prefixes, however long, meets in one task. Runs of equal strings are
sorted by a projection of the tree's own, so that each tree shows other members of a dense cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.tables import columns, in_slices
from wayfare.operators.positions import with_position
from wayfare.session import cut_lineage

#: Trees and bits of their hash strings.
TREES, BITS = 24, 64
#: Places a query looks at on either side in a tree, at least: ``REACH * sqrt(n)`` of n vectors.
REACH = 6.0
#: Queries answered exactly to size the window, the share of their neighbours that has to lie in it,
#: and the share found below which the window is doubled.
SAMPLE, INSIDE, RECALL = 256, 0.98, 0.95
#: Numbers of a block's vectors, at most (32 MB as doubles).
BLOCK_NUMBERS = 1 << 22
#: Vectors that have to share the prefix before the ascent ends, as a share of all places looked at.
ENOUGH = 0.8
SEED = 7


def planes(size: int) -> np.ndarray:
    """Hyperplanes of all trees, in groups of at most ``size`` orthogonal ones."""
    draw = np.random.default_rng(SEED)
    need, out = TREES * BITS, []
    while sum(map(len, out)) < need:
        out.append(np.linalg.qr(draw.standard_normal((size, size)))[0].T)
    return np.concatenate(out)[:need]


def matrix(column) -> np.ndarray:
    """A list column without nulls as rows of doubles."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(array), -1)


def hash_strings(vectors: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """(vectors, trees) hash strings as unsigned 64-bit numbers, first bit highest."""
    bits = (vectors @ normals.T > 0).reshape(len(vectors), TREES, BITS)
    return np.packbits(bits, axis=2).view(">u8").astype(np.uint64).reshape(len(vectors), TREES)


def common_prefix(keys: np.ndarray, key: np.uint64) -> np.ndarray:
    """Leading bits that ``keys`` share with ``key``."""
    apart = keys ^ key
    out = np.zeros(len(keys), np.int64)
    for shift in (32, 16, 8, 4, 2, 1):
        empty = apart < (np.uint64(1) << np.uint64(64 - shift))
        out[empty] += shift
        apart = np.where(empty, apart << np.uint64(shift), apart)
    return np.where(keys == key, BITS, out)


def cosines(vectors: np.ndarray, norms: np.ndarray, one: np.ndarray, norm: float) -> np.ndarray:
    """Row by row, so that equal vectors get equal values wherever they stand."""
    return (vectors * one).sum(axis=1) / (norms * norm)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of rows that can take part, embeddings as they are.

    Left out are rows without id, null, empty and zero vectors, those with a null or non-finite
    component, and those whose length is not the most frequent one.
    """
    rows = columns(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding"
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where("vec_id IS NOT NULL AND size(embedding) > 0").where(finite).where(F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    return rows.where(F.size("embedding") == (sizes[0]["size"] if sizes else 0))


def _trees(reps: DataFrame, size: int) -> DataFrame:
    """(tree, key, within, rep, query): hash strings shifted to keep their order as signed numbers.

    ``within`` orders equal strings: the projection of the unit vector on a direction of the tree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals = planes(size)
        directions = np.random.default_rng(SEED + 1).standard_normal((size, TREES))
        for batch in in_slices(batches, 1024):
            vectors = matrix(batch.column("embedding"))
            keys = (hash_strings(vectors, normals) ^ np.uint64(1 << 63)).astype(np.int64)
            within = vectors @ directions / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(TREES, dtype=np.int32), n)),
                    pa.array(keys.ravel()),
                    pa.array(within.ravel()),
                    pa.array(np.repeat(batch.column("rep").to_numpy(), TREES)),
                    pa.array(np.repeat(batch.column("query").to_numpy(zero_copy_only=False), TREES)),
                ],
                ["tree", "key", "within", "rep", "query"],
            )

    return reps.select("rep", "query", "embedding").mapInArrow(run, "tree int, key long, within double, rep long, query boolean")


def _exact(reps: DataFrame, ids: np.ndarray, asked: np.ndarray, k: int) -> dict[int, list[tuple[float, int]]]:
    """The ``k`` nearest (score, rep) of a sample of queries, by comparing it with all vectors."""
    units = asked / np.sqrt((asked * asked).sum(axis=1))[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, names = np.empty((0, len(ids))), np.empty((0, len(ids)), np.int64)
        for batch in in_slices(batches, 4096):
            vectors, rep = matrix(batch.column("embedding")), batch.column("rep").to_numpy()
            scores = vectors @ units.T / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
            scores[rep[:, None] == ids[None, :]] = -np.inf
            best, names = np.concatenate([best, scores]), np.concatenate([names, np.repeat(rep[:, None], len(ids), axis=1)])
            top = np.argsort(-best, axis=0, kind="stable")[:k]
            best, names = np.take_along_axis(best, top, axis=0), np.take_along_axis(names, top, axis=0)
        query = np.repeat(ids[None, :], len(best), axis=0)
        real = np.isfinite(best)
        yield pa.RecordBatch.from_arrays([pa.array(query[real]), pa.array(names[real]), pa.array(best[real])], ["query", "rep", "score"])

    found = reps.select("rep", "embedding").mapInArrow(run, "query long, rep long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    out: dict[int, list[tuple[float, int]]] = {}
    for row in found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).orderBy("query", "nth").collect():
        out.setdefault(row["query"], []).append((row["score"], row["rep"]))
    return out


def _needed(placed: DataFrame, truth: dict[int, list[tuple[float, int]]]) -> int:
    """Places on either side that hold ``INSIDE`` of the true neighbours, each in the tree where it is nearest."""
    ids = sorted({*truth, *(rep for found in truth.values() for _, rep in found)})
    places = {rep: np.zeros(TREES, np.int64) for rep in ids}
    for row in placed.where(F.col("rep").isin(ids)).select("tree", "rep", "place").collect():
        places[row["rep"]][row["tree"]] = row["place"]
    apart = [np.abs(places[query] - places[rep]).min() for query, found in truth.items() for _, rep in found]
    return int(np.quantile(apart, INSIDE, method="higher")) if apart else 0


def _recall(near: DataFrame, truth: dict[int, list[tuple[float, int]]], k: int) -> float:
    """Share of the sample's true neighbours found; equally near ones stand for each other."""
    rows = near.where(F.col("query").isin(sorted(truth))).select("query", "rep", "score").distinct()
    order = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    rows = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)
    found = sum(row["score"] >= truth[row["query"]][-1][0] - 1e-9 for row in rows.collect())
    return found / max(1, sum(map(len, truth.values())))


def _blocks(placed: DataFrame, reach: int, size: int) -> DataFrame:
    """Rows of ``placed`` (tree, place, query, ..) in their block; those that ask also in all blocks they look at."""
    rows = placed.withColumn("block", F.floor(F.col("place") / size)).withColumn("asks", F.lit(False))
    first, last = F.floor(F.greatest(F.col("place") - reach, F.lit(0)) / size), F.floor((F.col("place") + reach) / size)
    return rows.unionByName(placed.where("query").withColumn("block", F.explode(F.sequence(first, last))).withColumn("asks", F.lit(True)))


def _runs(table: pa.Table, reach: int):
    """Rows of a block in order of place, then for each query: (row, low, high, shared prefix bits).

    Those of ``order[low:high]`` lie within reach; the query itself, if there, shares -1 bits.
    """
    asks = table.column("asks").to_numpy()
    place, keys = table.column("place").to_numpy(), table.column("key").to_numpy().astype(np.uint64)
    order = np.flatnonzero(~asks)
    order = order[np.argsort(place[order])]
    sorted_places, sorted_keys = place[order], keys[order]

    def each():
        for at in np.flatnonzero(asks):
            low, high = np.searchsorted(sorted_places, place[at] - reach), np.searchsorted(sorted_places, place[at] + reach, "right")
            shared = common_prefix(sorted_keys[low:high], keys[at])
            shared[sorted_places[low:high] == place[at]] = -1
            yield at, low, high, shared

    return order, each()


def _levels(placed: DataFrame, reach: int, size: int, enough: int) -> DataFrame:
    """(rep, level) of every query: the longest prefix that ``enough`` vectors share over all trees."""

    def run(table: pa.Table) -> pa.Table:
        reps = table.column("rep").to_numpy()
        rows: list[np.ndarray] = []
        for at, _, _, shared in _runs(table, reach)[1]:
            counts = np.bincount(shared[shared >= 0], minlength=BITS + 1)
            level = np.flatnonzero(counts)
            rows.append(np.stack([np.full(len(level), reps[at]), level, counts[level]]))
        out = np.concatenate(rows, axis=1) if rows else np.empty((3, 0), np.int64)
        return pa.table({"rep": pa.array(out[0], pa.int64()), "level": pa.array(out[1], pa.int64()), "n": pa.array(out[2], pa.int64())})

    found = _blocks(placed, reach, size).groupBy("tree", "block").applyInArrow(run, "rep long, level long, n long")
    levels = found.groupBy("rep", "level").agg(F.sum("n").alias("n"))
    # A query has at most BITS + 1 levels.
    down = Window.partitionBy("rep").orderBy(F.desc("level"))
    reached = levels.withColumn("total", F.sum("n").over(down))
    return reached.groupBy("rep").agg(F.coalesce(F.max(F.when(F.col("total") >= enough, F.col("level"))), F.lit(0)).alias("level"))


def _nearest(placed: DataFrame, reps: DataFrame, levels: DataFrame, reach: int, size: int, k: int) -> DataFrame:
    """(query, rep, score): the ``k`` nearest candidates of each query and tree."""

    def run(table: pa.Table) -> pa.Table:
        ids, level = table.column("rep").to_numpy(), table.column("level").to_numpy()
        vectors = matrix(table.column("embedding"))
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        order, asking = _runs(table, reach)
        ids_, vectors_, norms_ = ids[order], vectors[order], norms[order]
        query, rep, score = [], [], []
        for at, low, high, shared in asking:
            near = low + np.flatnonzero(shared >= max(level[at], 0))
            if len(near) > 4 * k:
                # A quick product leaves out what is clearly farther than the k-th.
                quick = (vectors_[low:high] @ vectors[at])[near - low] / (norms_[near] * norms[at])
                near = near[quick >= np.partition(quick, -k)[-k] - 1e-9]
            values = cosines(vectors_[near], norms_[near], vectors[at], norms[at])
            best = np.lexsort((ids_[near], -values))[:k]
            query.append(np.full(len(best), ids[at]))
            rep.append(ids_[near][best])
            score.append(values[best])
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.empty(0), kind)
        return pa.table({"query": join(query, pa.int64()), "rep": join(rep, pa.int64()), "score": join(score, pa.float64())})

    rows = placed.join(levels, "rep", "left").withColumn("level", F.coalesce("level", F.lit(BITS)))
    rows = _blocks(rows.join(reps.select("rep", "embedding"), "rep"), reach, size)
    return rows.groupBy("tree", "block").applyInArrow(run, "query long, rep long, score double").distinct()


def search(vectors: DataFrame, queries, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found of each row where ``queries`` holds.

    ``queries`` is a condition on vec_id. Nearness is the cosine of the original vectors in double
    precision, ties to the smaller vec_id; a query is no neighbour of itself. Equal vectors are one
    entry of the index with their k + 1 smallest ids, so copies cost nothing and come out exactly.
    A sample of the queries is also answered exactly: the window is sized by it and doubled until
    ``RECALL`` of its neighbours are found, if need be until it holds all rows.
    Rows that ``usable`` leaves out neither ask nor answer; fewer candidates give fewer rows.
    Rows that repeat a vec_id with the same vector count once.
    """
    rows = cut_lineage(usable(vectors).withColumn("key", F.xxhash64("embedding")).withColumn("key2", F.xxhash64(F.lit(1), "embedding")))
    asked = rows.select("vec_id", "key", "key2", queries.alias("query"))
    classes = asked.groupBy("key", "key2").agg(F.min("vec_id").alias("rep"), F.max("query").alias("query"))
    classes = cut_lineage(classes)
    own = Window.partitionBy("key", "key2").orderBy("vec_id")
    members = asked.select("key", "key2", "vec_id").distinct().withColumn("nth", F.row_number().over(own)).where(F.col("nth") <= k + 1)
    members = cut_lineage(members.join(classes, ["key", "key2"]).select("rep", "vec_id"))
    reps = rows.select("vec_id", "key", "key2", "embedding").join(classes.withColumn("vec_id", F.col("rep")), ["key", "key2", "vec_id"])
    reps = cut_lineage(reps.select("rep", "query", "embedding").dropDuplicates(["rep"]))
    n = reps.count()
    size = len(reps.first()["embedding"]) if n else 1
    drawn = reps.where("query").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("rep", "embedding").toArrow()
    truth = _exact(reps, drawn.column("rep").to_numpy(), matrix(drawn.column("embedding")), k) if drawn.num_rows else {}
    positions = with_position(_trees(reps, size), [F.col("tree"), F.col("key"), F.col("within"), F.col("rep")], "at")
    placed = cut_lineage(positions.select("tree", "key", "rep", "query", (F.col("at") - F.col("tree") * F.lit(n)).alias("place")))
    reach = max(k + 1, int(np.ceil(REACH * np.sqrt(n))), _needed(placed, truth))
    while True:
        block = max(256, min(4 * reach, BLOCK_NUMBERS // size))
        levels = cut_lineage(_levels(placed, reach, block, int(ENOUGH * 2 * min(reach, n) * TREES)))
        near = cut_lineage(_nearest(placed, reps, levels, reach, block, k))
        if reach >= n or _recall(near, truth, k) >= RECALL:
            break
        reach *= 2
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    top = near.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k).drop("nth")
    # The cosine of equal vectors by the formula of all others, which can differ from 1 in the last bit.
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    itself = reps.where("query").select(F.col("rep").alias("query"), "rep", (squares / (F.sqrt(squares) * F.sqrt(squares))).alias("score"))
    answers = top.unionByName(itself).join(members, "rep").select("query", "vec_id", "score")
    # Each row that asks has the answers of its class.
    askers = asked.where("query").select("vec_id", "key", "key2").distinct().join(classes.select("key", "key2", "rep"), ["key", "key2"])
    answers = askers.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query")).join(answers, "query").where("query_id <> vec_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
