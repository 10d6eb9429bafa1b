"""Path dependencies of all nodes, source by source, where the links fit into a task."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Searches run side by side on graphs of at most so many levels, on tables of so many numbers.
MOST_LEVELS = 12
TABLE = 1 << 23
# Rows added up at a time, and their bytes; nodes of more links are added up alone.
ROWS = 1024
BLOCK = 1 << 18
HUB = 256
# Links of single cells on the way at once; one of them takes as long as so many cells of a row.
MOST_CELLS = 1 << 23
PULL = 30
# 64 searches for the longest distance share a word, so many words a row; a word on its way takes as long as so many rows.
MOST_WORDS = 16
PUSH = 4
# One of so many nodes is a hub; searches by way of hubs are left off after so many in a row that were not enough.
HUBS = 6
MISSES = 2
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass
class Links:
    """Links sorted by their source: those of node i end at ``to[first[i]:first[i + 1]]``.

    ``mass`` counts the nodes a node stands for; ``cost`` is None where all links count one.
    """

    first: np.ndarray
    to: np.ndarray
    cost: np.ndarray | None
    mass: np.ndarray

    def of(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, node of each) of all links that leave ``nodes``."""
        sizes = self.first[nodes + 1] - self.first[nodes]
        starts = np.repeat(self.first[nodes] - (np.cumsum(sizes) - sizes), sizes)
        return starts + np.arange(len(starts)), np.repeat(nodes, sizes)


def _sorted_links(n: int, src: np.ndarray, dst: np.ndarray, cost: np.ndarray | None, mass: np.ndarray) -> Links:
    order = np.argsort(src, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(src, minlength=n))])
    return Links(first, dst[order], None if cost is None else cost[order], mass)


def peel(n: int, src: np.ndarray, dst: np.ndarray, cost: np.ndarray | None) -> tuple[Links, np.ndarray, np.ndarray]:
    """Links without trees that hang on them, what those trees add to each node, and the nodes that are left.

    A node with one neighbour goes, its mass to the neighbour, until there is none. Through a node that
    took over masses w1, w2, .. with sum W, in a component of mass N, pass the pairs of two of those
    and of one of them with a node outside, W**2 - (w1**2 + w2**2 + ..) + 2 W (N - W - 1), both ways.
    """
    degree = np.bincount(src, minlength=n)
    links = _sorted_links(n, src, dst, cost, np.ones(n, np.int64))
    mass, taken, squares = np.ones(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    gone = np.zeros(n, bool)
    into = np.full(n, -1)
    queue = np.flatnonzero(degree == 1).tolist()
    for node in queue:
        if degree[node] != 1:
            continue
        near = links.to[links.first[node] : links.first[node + 1]]
        other = int(near[~gone[near]][0])
        gone[node], into[node] = True, other
        taken[other] += mass[node]
        squares[other] += mass[node] ** 2
        mass[other] += mass[node]
        degree[node] -= 1
        degree[other] -= 1
        if degree[other] == 1:
            queue.append(other)
    whole = _component_masses(n, src, dst)
    added = taken**2 - squares + 2 * taken * (whole - taken - 1)
    stay = ~gone[src] & ~gone[dst]
    kept = _sorted_links(n, src[stay], dst[stay], None if cost is None else cost[stay], mass)
    return kept, added.astype(float), np.flatnonzero(~gone)


def _labels(n: int, src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """The smallest node of the component of each node; links go both ways."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, src, label[dst])
        np.minimum.at(least, label[src], least[src])
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _component_masses(n: int, src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """How many nodes the component of each node has; links go both ways."""
    label = _labels(n, src, dst)
    return np.bincount(label, minlength=n)[label]


def _levels(links: Links, source: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The steps (from, to) of shortest paths by links, nearest first."""
    far = np.full(len(links.mass), -1)
    far[source], front, at = 0, np.array([source]), 0
    place = np.empty(len(links.mass), np.int64)
    while len(front):
        at += 1
        found, start = links.of(front)
        end = links.to[found]
        far[end[far[end] < 0]] = at
        tight = far[end] == at
        start, end = start[tight], end[tight]
        if len(end):
            yield start, end
        place[end] = np.arange(len(end))
        front = end[place[end] == np.arange(len(end))]


def _by_cost(links: Links, source: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The steps (from, to) of cheapest paths, cheapest ends first; costs are positive."""
    far = np.full(len(links.mass), np.iinfo(np.int64).max // 2)
    far[source], front = 0, np.array([source])
    while len(front):
        found, start = links.of(front)
        end, offer = links.to[found], far[start] + links.cost[found]
        better = offer < far[end]
        np.minimum.at(far, end[better], offer[better])
        front = np.unique(end[better])
    reached = np.flatnonzero(far < np.iinfo(np.int64).max // 2)
    found, start = links.of(reached)
    end = links.to[found]
    tight = far[start] + links.cost[found] == far[end]
    start, end = start[tight], end[tight]
    order = np.argsort(far[end], kind="stable")
    start, end = start[order], end[order]
    cuts = np.flatnonzero(np.diff(far[end])) + 1
    return zip(np.split(start, cuts), np.split(end, cuts)) if len(end) else iter(())


def from_source(links: Links, source: int, by_paths: bool) -> np.ndarray:
    """What passes each node on the way to the source, a unit for each node's mass.

    With ``by_paths`` a node shares by the numbers of shortest paths, else evenly among the nodes before it.
    """
    steps = list(_levels(links, source) if links.cost is None else _by_cost(links, source))
    ways = np.zeros(len(links.mass))
    ways[source] = 1.0
    for start, end in steps:
        np.add.at(ways, end, ways[start] if by_paths else 1.0)
    passed = np.zeros(len(links.mass))
    for start, end in reversed(steps):
        share = (ways[start] if by_paths else 1.0) / ways[end]
        np.add.at(passed, start, share * (links.mass[end] + passed[end]))
    passed[source] = 0.0
    return passed * links.mass[source]


def _sums(links: Links, table: np.ndarray, rows: np.ndarray, merge: np.ufunc = np.add) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(some of ``rows``, the sums of the table's rows over the links that leave each); ``merge`` may stand for the addition.

    Nodes of falling size add up their first neighbours, their second ones, and so on, few at a time so that
    they stay in the cache. Neighbours of a hub are added up in pieces.
    """
    sizes = links.first[rows + 1] - links.first[rows]
    order = np.argsort(-sizes, kind="stable")
    rows, sizes = rows[order], sizes[order]
    starts, hubs = links.first[rows], int(np.searchsorted(-sizes, -HUB, "left"))
    many = max(1, min(ROWS, BLOCK // (table.shape[1] * table.itemsize)))
    taken = np.empty((many, table.shape[1]), table.dtype)
    cuts = [*range(0, hubs, many), *range(hubs, len(rows), many), len(rows)]
    for low, high in zip(cuts, cuts[1:]):
        summed = np.zeros((high - low, table.shape[1]), table.dtype)
        if low < hubs:
            for at in range(low, high):
                for start in range(starts[at], starts[at] + sizes[at], many):
                    some = links.to[start : min(start + many, starts[at] + sizes[at])]
                    found = np.take(table, some, axis=0, out=taken[: len(some)], mode="clip")
                    merge(summed[at - low], merge.reduce(found, axis=0, dtype=table.dtype), out=summed[at - low])
        else:
            own = starts[low:high]
            for at, count in enumerate(np.searchsorted(-sizes[low:high], -np.arange(sizes[low]), "left").tolist()):
                found = np.take(table, links.to[own[:count] + at], axis=0, out=taken[:count], mode="clip")
                merge(summed[:count], found, out=summed[:count])
        yield rows[low:high], summed


def _holding(numbers: np.ndarray, most: float) -> np.ndarray:
    """``numbers``, in a type that holds up to ``most`` exactly, as far as there is one."""
    for kind in (np.uint8, np.uint16, np.uint32):
        if most <= np.iinfo(kind).max:
            return numbers if numbers.dtype.itemsize >= np.dtype(kind).itemsize else numbers.astype(kind)
    return numbers.astype(float, copy=False)


@dataclass
class _Step:
    """A step from one distance to the next: rows of nodes, or single cells (node and source) with their links' ends."""

    rows: np.ndarray | None = None
    cells: np.ndarray | None = None
    own: np.ndarray | None = None
    ends: np.ndarray | None = None


class _SideBySide:
    """``from_source`` of many sources at once, where all links count one and paths are short.

    Tables have a row for a node and a column for a source. A step goes along the links of single cells
    as long as few are on the way, else it adds up whole rows over the neighbours of the nodes in question.
    Numbers of paths are whole; they take the smallest type that holds them.
    """

    def __init__(self, links: Links, both_ways: bool) -> None:
        n = len(links.mass)
        self.leaving, self.entering = links, links
        if not both_ways:
            src = np.repeat(np.arange(n), np.diff(links.first))
            self.entering = _sorted_links(n, links.to, src, None, links.mass)
        self.out, self.into = np.diff(self.leaving.first), np.diff(self.entering.first)
        self.widest = int(self.into.max(initial=0))

    def passed(self, sources: np.ndarray, by_paths: bool) -> np.ndarray:
        """What passes each node, over all ``sources``."""
        n, k = len(self.leaving.mass), len(sources)
        # 0: not met yet; 1: the source itself; 2: at one link from it; ..
        level, ways = np.zeros((n, k), np.uint8), np.zeros((n, k), np.uint8)
        cells = sources * k + np.arange(k)
        level.ravel()[cells], ways.ravel()[cells] = 1, 1
        at, per_row, most, steps = 1, np.bincount(sources, minlength=n), 1, []
        while True:
            level = _holding(level, at + 1)
            reach = int(per_row @ self.out)
            if reach == 0:
                break
            ways = _holding(ways, most * self.widest if by_paths else self.widest)
            rows = None
            if reach > n:
                rows = self._in_question(level, per_row)
            if rows is None or reach <= MOST_CELLS and PULL * reach < k * int(self.into[rows].sum()):
                if cells is None:
                    cells = np.flatnonzero(level.ravel() == at)
                step = self._along_cells(cells, level, ways, at, by_paths)
                found = None if step is None else step.ends
                if found is not None:
                    cells = np.unique(found) if len(found) < n * k // 16 else np.flatnonzero(level.ravel() == at + 1)
                    per_row = np.bincount(cells // k, minlength=n)
                    most = int(ways.ravel()[cells].max()) if by_paths else 1
            else:
                step = _Step(rows=np.flatnonzero(per_row))
                per_row, most = self._along_rows(rows, level, ways, at, most, by_paths)
                cells, found = None, per_row.any()
            if found is None or found is np.False_:
                break
            steps.append(step)
            at += 1
        return self._back(sources, level, ways, steps, cells, by_paths)

    def _in_question(self, level: np.ndarray, per_row: np.ndarray) -> np.ndarray:
        """Nodes that some source has not met, next to one met last."""
        wanted = (level == 0).any(axis=1) & (self.into > 0)
        last = np.flatnonzero(per_row)
        if 2 * int(self.out[last].sum()) < len(self.leaving.to):
            near = np.zeros(len(wanted), bool)
            near[self.leaving.to[self.leaving.of(last)[0]]] = True
            wanted &= near
        return np.flatnonzero(wanted)

    def _along_cells(self, cells: np.ndarray, level: np.ndarray, ways: np.ndarray, at: int, by_paths: bool) -> _Step | None:
        k = level.shape[1]
        node = cells // k
        own = np.repeat(np.arange(len(cells), dtype=np.int32), self.out[node])
        ends = self.leaving.to[self.leaving.of(node)[0]] * k
        ends += (cells - node * k)[own]
        new = level.ravel()[ends] == 0
        own, ends = own[new], ends[new]
        if not len(ends):
            return None
        before = ways.ravel()[cells][own] if by_paths else np.ones(len(own), ways.dtype)
        np.add.at(ways.ravel(), ends, before)
        level.ravel()[ends] = at + 1
        return _Step(cells=cells, own=own, ends=ends.astype(np.int32) if level.size < 1 << 31 else ends)

    def _along_rows(self, rows: np.ndarray, level: np.ndarray, ways: np.ndarray, at: int, most: int, by_paths: bool) -> tuple[np.ndarray, int]:
        front = (level == at).astype(np.uint8)
        if by_paths and most > 1:
            front = front * ways
        front = _holding(front, most * self.widest)
        per_row, most = np.zeros(len(level), np.int64), 0
        for some, summed in _sums(self.entering, front, rows):
            own = level[some]
            summed *= own == 0
            new = summed != 0
            per_row[some] = np.count_nonzero(new, axis=1)
            own += new * own.dtype.type(at + 1)
            level[some] = own
            ways[some] += summed.astype(ways.dtype, copy=False)
            most = max(most, int(summed.max()))
        return per_row, most if by_paths else 1

    def _back(
        self, sources: np.ndarray, level: np.ndarray, ways: np.ndarray, steps: list[_Step], cells: np.ndarray | None, by_paths: bool
    ) -> np.ndarray:
        n, k = level.shape
        mass, weight = self.leaving.mass.astype(float), self.leaving.mass[sources].astype(float)
        total, shares = np.zeros(n), np.zeros((n, k))
        if cells is not None:
            shares.ravel()[cells] = mass[cells // k] / ways.ravel()[cells]
        else:
            many = max(1, BLOCK // (8 * k))
            for low in range(0, n, many):
                some = slice(low, low + many)
                np.divide(level[some] == len(steps) + 1, np.maximum(ways[some], 1), out=shares[some])
                shares[some] *= mass[some, None]
        # What arrives at the sources themselves does not count.
        for at in range(len(steps), 1, -1):
            step = steps.pop()
            if step.cells is not None:
                node = step.cells // k
                arrived = np.bincount(step.own, weights=shares.ravel()[step.ends], minlength=len(step.cells))
                own = ways.ravel()[step.cells].astype(float)
                if by_paths:
                    arrived *= own
                total += np.bincount(node, weights=arrived * weight[step.cells - node * k], minlength=n)
                if steps and steps[-1].cells is None:
                    shares = np.zeros((n, k))
                shares.ravel()[step.cells] = (mass[node] + arrived) / own
                continue
            before = np.zeros((n, k))
            for some, arrived in _sums(self.leaving, shares, step.rows):
                own = ways[some].astype(float)
                is_here = (level[some] == at).astype(float)
                arrived *= is_here
                if by_paths:
                    arrived *= own
                total[some] += arrived @ weight
                arrived += mass[some, None]
                arrived *= is_here
                arrived /= np.maximum(own, 1.0, out=own)
                before[some] = arrived
            shares = before
        return total


def _of_component(links: Links, sources: np.ndarray, both_ways: bool, by_paths: bool) -> np.ndarray:
    """``from_source`` added up over ``sources``."""
    n = len(links.mass)
    total = np.zeros(n)
    if links.cost is None and len(sources) > 1 and sum(1 for _ in _levels(links, sources[0])) <= MOST_LEVELS:
        many, at_once = _SideBySide(links, both_ways), max(4, min(64, TABLE // n))
        for low in range(0, len(sources), at_once):
            total += many.passed(sources[low : low + at_once], by_paths)
    else:
        for source in sources:
            total += from_source(links, source, by_paths)
    return total


@dataclass
class Held:
    """Links with the nodes of a component side by side: component i has the nodes ``cuts[i]:cuts[i + 1]``.

    ``order`` gives the numbers that the nodes had before.
    """

    links: Links
    order: np.ndarray
    cuts: np.ndarray

    def passed(self, sources: np.ndarray, both_ways: bool, by_paths: bool) -> tuple[np.ndarray, np.ndarray]:
        """(node, value) of ``from_source`` added up over ``sources``, both by their former numbers."""
        rank = np.empty(len(self.order), np.int64)
        rank[self.order] = np.arange(len(self.order))
        sources = np.sort(rank[sources])
        part = np.searchsorted(self.cuts, sources, "right") - 1
        nodes, values = [np.zeros(0, np.int64)], [np.zeros(0)]
        for own in np.split(sources, np.flatnonzero(np.diff(part)) + 1) if len(sources) else []:
            at = np.searchsorted(self.cuts, own[0], "right") - 1
            low, high = self.cuts[at], self.cuts[at + 1]
            start, stop = self.links.first[low], self.links.first[high]
            if start == stop:
                continue
            cost = None if self.links.cost is None else self.links.cost[start:stop]
            to = self.links.to[start:stop].astype(np.int64) - low
            local = Links(self.links.first[low : high + 1] - start, to, cost, self.links.mass[low:high])
            total = _of_component(local, own - low, both_ways, by_paths)
            some = np.flatnonzero(total)
            nodes.append(self.order[some + low])
            values.append(total[some])
        return np.concatenate(nodes), np.concatenate(values)


def by_component(links: Links) -> Held:
    """Links with the nodes of each (weak) component side by side."""
    n = len(links.mass)
    src = np.repeat(np.arange(n), np.diff(links.first))
    label = _labels(n, np.concatenate([src, links.to]), np.concatenate([links.to, src]))
    order = np.argsort(label, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    moved = _sorted_links(n, rank[src], rank[links.to].astype(np.int32), links.cost, links.mass[order])
    return Held(moved, order, np.concatenate([[0], np.flatnonzero(np.diff(label[order])) + 1, [n]]).astype(np.int64))


def dependencies(
    links: DataFrame, ids: DataFrame, sources: DataFrame | None, weighted: bool, both_ways: bool, by_paths: bool
) -> DataFrame:
    """``id, value``: what passes each node, over all sources; the caller has checked how many links there are.

    ``links`` are ``src, dst, cost`` by number, ``ids`` the numbers from 0. Every task holds the links
    and adds up its sources, each within its component; one row of each task and node is shuffled.
    """
    spark = links.sparkSession
    n = ids.count()
    ends = [F.col(name).cast("int") for name in ("src", "dst")]
    table = links.select(*ends, *(["cost"] if weighted else [])).toArrow()
    src, dst = (table.column(name).to_numpy().astype(np.int64) for name in ("src", "dst"))
    cost = table.column("cost").to_numpy().astype(np.int64) if weighted else None
    if weighted and len(cost) and cost.min() <= 0:
        raise ValueError("distances must be positive")
    if both_ways and sources is None:
        held, added, starts = peel(n, src, dst, cost)
    else:
        held, added, starts = _sorted_links(n, src, dst, cost, np.ones(n, np.int64)), np.zeros(n), None
    shared = spark.sparkContext.broadcast(by_component(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [batch.column("id").to_numpy() for batch in batches]
        if own:
            found = shared.value.passed(np.concatenate(own), both_ways, by_paths)
            yield pa.RecordBatch.from_arrays([pa.array(each) for each in found], ["id", "value"])

    if starts is not None:
        left = np.flatnonzero(added)
        extra = spark.createDataFrame(pa.table({"id": left, "value": added[left]})) if len(left) else None
        sources = spark.createDataFrame(pa.table({"id": starts}))
    else:
        extra, sources = None, (ids if sources is None else sources).select("id")
    tasks = 4 * spark.sparkContext.defaultParallelism
    found = sources.repartition(tasks, F.xxhash64("id")).mapInArrow(run, "id long, value double")
    found = found if extra is None else found.unionByName(extra)
    return found.groupBy("id").agg(F.sum("value").alias("value"))


def _lacking(bits: np.ndarray) -> np.ndarray:
    """Which rows of (node, word) lack a bit."""
    lacks = bits != FULL
    lacks = lacks.view(np.uint64) if lacks.shape[1] % 8 == 0 else lacks
    found = lacks[:, 0] != 0
    for at in range(1, lacks.shape[1]):
        found |= lacks[:, at] != 0
    return found


def _bit_round(links: Links, seen: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of ``seen`` (node, word) with those of all neighbours, and the nodes that got new ones.

    ``last`` are the nodes that got bits in the round before. While those have few, their words go along
    their links; else whole rows are taken from the neighbours of the nodes in question.
    """
    words = seen.shape[1]
    sizes = np.diff(links.first)
    reach = int(sizes[last].sum())
    node, word = np.nonzero(seen[last]) if reach * PUSH < len(links.to) else (None, None)
    if node is not None and int(sizes[last[node]].sum()) * PUSH < len(links.to):
        places, _ = links.of(last[node])
        own = np.repeat(np.arange(len(node)), sizes[last[node]])
        ends, bits = links.to[places].astype(np.int64) * words + word[own], seen[last[node], word][own]
        order = np.argsort(ends)
        ends, bits = ends[order], bits[order]
        cuts = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]])) if len(ends) else ends
        cells, bits = ends[cuts], np.bitwise_or.reduceat(bits, cuts) if len(ends) else bits
        had = seen.ravel()[cells]
        seen.ravel()[cells] = had | bits
        return seen, np.unique(cells[(bits & ~had) != 0] // words)
    wanted = _lacking(seen)
    if 2 * reach < len(links.to):
        near = np.zeros(len(seen), bool)
        near[links.to[links.of(last)[0]]] = True
        wanted &= near
    after, new = seen.copy(), [last[:0]]
    for rows, bits in _sums(links, seen, np.flatnonzero(wanted), np.bitwise_or):
        had = seen[rows]
        bits |= had
        after[rows] = bits
        new.append(rows[_lacking(FULL ^ bits ^ had)])
    return after, np.concatenate(new)


def _are_met(links: Links, seen: np.ndarray, least: int, via: Links, table: np.ndarray) -> bool:
    """Whether nodes from ``least`` have all bits once they have those of all neighbours, and these those of theirs.

    ``via`` and the rows of ``table`` say what a neighbour gets from its own neighbours. Nodes take the bits of
    one neighbour after the other until they have all; only neighbours that are asked get theirs.
    """
    sizes = np.diff(links.first)
    after, is_done = seen.copy(), np.zeros(len(seen), bool)
    left, bits = np.flatnonzero(_lacking(seen[least:])) + least, None
    many, at = max(1, BLOCK // (8 * seen.shape[1])), 0
    taken, begun = (np.empty((many, seen.shape[1]), np.uint64) for _ in range(2))
    while len(left):
        if (sizes[left] <= at).any():
            return False
        asked = links.to[links.first[left] + at]
        is_new = np.zeros(len(seen), bool)
        is_new[asked] = True
        for rows, found in _sums(via, table, np.flatnonzero(is_new & ~is_done), np.bitwise_or):
            after[rows] |= found
        is_done |= is_new
        kept, rest = [], []
        for low in range(0, len(left), many):
            some = slice(low, low + many)
            own = np.take(after, asked[some], axis=0, out=taken[: len(left[some])], mode="clip")
            own |= bits[some] if bits is not None else np.take(seen, left[some], axis=0, out=begun[: len(own)], mode="clip")
            lacks = _lacking(own)
            kept.append(left[some][lacks])
            rest.append(own[lacks])
        left, bits, at = np.concatenate(kept), np.concatenate(rest), at + 1
    return True


class Searches:
    """Searches for the longest distance from many sources side by side, a bit each, over links that go both ways.

    Nodes come in falling order of their numbers of links, neighbours in rising order of nodes.
    """

    def __init__(self, links: Links) -> None:
        self.links, n = links, len(links.first) - 1
        # The part of each list that leads to hubs, the first nodes.
        self.n_hubs, self.misses = -(-n // HUBS), 0
        sizes = np.zeros(n, np.int64)
        parts, step = [], max(1, TABLE * n // max(1, len(links.to)))
        for low in range(0, n, step):
            first = links.first[low : low + step + 1]
            is_hub = links.to[first[0] : first[-1]] < self.n_hubs
            counts = np.concatenate([[0], np.cumsum(is_hub)])[first - first[0]]
            sizes[low : low + step] = np.diff(counts)
            parts.append(links.to[first[0] : first[-1]][is_hub])
        self.hubs = Links(np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(parts), None, links.mass)

    def _met_by_hubs(self, seen: np.ndarray, least: int) -> bool:
        """Whether nodes from ``least`` have all bits after three rounds, the second by way of hubs; if not, other ways may do."""
        table = seen[: self.n_hubs].copy()
        for rows, bits in _sums(self.links, seen, np.arange(self.n_hubs), np.bitwise_or):
            table[rows] |= bits
        return _are_met(self.links, seen, least, self.hubs, table)

    def longest(self, sources: np.ndarray, most: int) -> int:
        """The longest distance from any of ``sources`` to a node it reaches, or ``most`` if that is longer.

        Whether all distances are within ``most`` is asked some rounds before; if not, the rounds go on. Nodes
        before the first source are not asked: they are sources of another search, or known to reach all within ``most``.
        """
        seen = np.zeros((len(self.links.first) - 1, -(-len(sources) // 64)), np.uint64)
        at = np.arange(len(sources))
        np.bitwise_or.at(seen, (sources, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
        if len(sources) % 64:
            seen[:, -1] |= FULL << np.uint64(len(sources) % 64)
        last, level, least = np.unique(sources), 0, int(sources.min())
        while True:
            if level == most - 3 and self.misses < MISSES:
                if self._met_by_hubs(seen, least):
                    self.misses = 0
                    return most
                self.misses += 1
            if level == most - 2 and _are_met(self.links, seen, least, self.links, seen):
                return most
            seen, last = _bit_round(self.links, seen, last)
            if not len(last):
                return max(most, level)
            level += 1


def farthest(links: DataFrame, n: int, sources: DataFrame) -> int:
    """The longest distance from any of ``sources`` (node) to a node it reaches, over links that go both ways.

    ``links`` are ``src, dst`` by number from 0. Every task holds them, nodes in the order of their numbers of
    links. The longest distance from the sources with fewest links comes first; the others are asked for longer ones.
    All nodes that may lie farther apart are sources, so each pair is asked once, from the node with more links.
    """
    spark = links.sparkSession
    table = links.where("src < dst").select(*(F.col(name).cast("int") for name in ("src", "dst"))).toArrow()
    src, dst = (table.column(name).to_numpy() for name in ("src", "dst"))
    degree = np.bincount(src, minlength=n) + np.bincount(dst, minlength=n)
    rank = np.empty(n, np.int64)
    rank[np.argsort(-degree, kind="stable")] = np.arange(n)
    ends = np.empty(2 * len(src), np.int64)
    ends[: len(src)] = rank[src] * n + rank[dst]
    ends[len(src) :] = rank[dst] * n + rank[src]
    del table, src, dst
    ends.sort()
    to = np.empty(len(ends), np.int32)
    for low in range(0, len(ends), TABLE):
        to[low : low + TABLE] = ends[low : low + TABLE] % n
    del ends
    first = np.concatenate([[0], np.cumsum(-np.sort(-degree))])
    shared = spark.sparkContext.broadcast((first, to))
    del to
    at_once = 64
    while at_once < 64 * MOST_WORDS and at_once * n <= 96 * TABLE:
        at_once *= 2
    asked = np.sort(rank[sources.select(F.col("node").cast("long")).toArrow().column("node").to_numpy()])
    tasks = 4 * spark.sparkContext.defaultParallelism

    def longest(some: np.ndarray, most: int) -> int:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = [batch.column("node").to_numpy() for batch in batches]
            if not own:
                return
            nodes, found = np.sort(np.concatenate(own)), most
            searches = Searches(Links(*shared.value, None, np.zeros(0)))
            for low in range(0, len(nodes), at_once):
                found = searches.longest(nodes[low : low + at_once], found)
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.int64())], ["far"])

        given = spark.createDataFrame(pa.table({"node": some}))
        found = given.repartition(tasks, F.xxhash64("node")).mapInArrow(run, "far long")
        return found.agg(F.coalesce(F.max("far"), F.lit(most))).first()[0]

    cut = max(0, len(asked) - 64 * tasks)
    most = longest(asked[cut:], 0) if len(asked) else 0
    return longest(asked[:cut], most) if cut else most
