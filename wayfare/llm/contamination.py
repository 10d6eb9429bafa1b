"""Benchmark contamination by canonical templates.

Numbers, units and names of a text become typed placeholders. Windows of the resulting templates
are joined by hash with those of the benchmark. Matches are counted along one alignment of a
document and an item, and only where a slot's value is what stands for the item's value in most
places, which also catches a question that was given other numbers and names. Each text is read
three ways (``WAYS``); the one that covers most of an item counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.bytewords import LOWER, buffer_of, hashes, in_bytes, rolled, spans
from wayfare.llm.tables import columns, in_slices, text_keys
from wayfare.session import cut_lineage

#: Template tokens in a window; shorter items are one window of their own length, and items of
#: fewer than ``LEAST_TOKENS`` are passed over, as any text holds such.
WINDOW = 8
LEAST_TOKENS = 5
#: Share of an item's windows that a document has to hold.
LEAST_COVERED = 0.5
#: A window says something only with so many literal words in it.
LEAST_LITERAL = 3
#: How a text is read: sentence openers are words; every capitalised word is a name, wherever it
#: stands; every token is a literal in lower case. Each way has windows of its own.
OPENERS_ARE_WORDS, ALL_ARE_NAMES, LITERAL = WAYS = (0, 1, 2)
#: Bits of the filter on benchmark windows, at most (4 MB); it prunes windows of documents before
#: the join and decides nothing, so a benchmark of any size may fill it.
FILTER_BITS = 1 << 25

# Unit names that follow a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams ton tons pound pounds ounce ounces ml"
    " l liter liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month"
    " months year years dollar dollars euro euros cent cents percent mph kmh".split()
)

WORD, NUMBER, NAME, UNIT = 0, 1, 2, 3
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_INSIDE = _DIGIT.copy()
_INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True
#: Marks after which a capital letter is no sign of a name.
_END = np.isin(np.arange(256), list(b".!?:;\n\r\"()[]|"))


def _hash_words(texts: list[str]) -> np.ndarray:
    data, offsets = buffer_of(pa.array(texts))
    return hashes(data, offsets[:-1], offsets[1:])


class Words:
    """Words of a column of texts and what tells their kinds, which all ways of reading share.

    A word is a run of ASCII letters and digits and of other characters' UTF-8 bytes, save general
    punctuation; points and commas between digits belong to the number. ``first[t]`` to
    ``first[t + 1]`` are the words of text ``t``. Rare bytes are looked up by their places.
    """

    def __init__(self, texts: pa.Array) -> None:
        self.raw, self.offsets = raw, offsets = buffer_of(texts)
        n = len(raw)
        self.data = LOWER[raw]
        # Latin-1 capitals are C3 80..9E, their small letters 32 further on.
        latin = np.flatnonzero(raw[: max(0, n - 1)] == 0xC3)
        second = raw[latin + 1]
        latin = latin[(second >= 0x80) & (second <= 0x9E) & (second != 0x97)]
        self.data[latin + 1] += 32
        inside = _INSIDE[raw]
        # C2 xx are Latin-1 signs, E2 80 xx is general punctuation: dashes, quotes, ellipsis.
        sign = np.flatnonzero(raw == 0xC2)
        dash = np.flatnonzero(raw[: max(0, n - 1)] == 0xE2)
        dash = dash[raw[dash + 1] == 0x80]
        signs = np.concatenate([sign, sign + 1, dash, dash + 1, dash + 2])
        inside[signs[signs < n]] = False
        points = np.flatnonzero((raw == 44) | (raw == 46))
        between = points[(points > 0) & (points < n - 1)]
        inside[between[_DIGIT[raw[between - 1]] & _DIGIT[raw[between + 1]]]] = True
        self.starts, self.ends, self.first = starts, ends, first = spans(inside, offsets)
        self.hashes = hashes(self.data, starts, ends)
        #: Numbers hold digits and points only; a sentence opener stands first or behind an end mark.
        digits = np.sort(np.concatenate([np.flatnonzero((raw >= 48) & (raw <= 57)), points]))
        head = raw[starts]
        may = np.flatnonzero(_DIGIT[head] | (head == 44) | (head == 46))
        held = np.searchsorted(digits, ends[may]) - np.searchsorted(digits, starts[may])
        self.numbers = may[held == ends[may] - starts[may]]
        self.openers = np.zeros(len(starts), bool)
        marks = np.flatnonzero(_END[raw])
        after = np.searchsorted(starts, marks, "right")
        marks, after = marks[(after > 0) & (after < len(starts))], after[(after > 0) & (after < len(starts))]
        self.openers[after[marks >= ends[after - 1]]] = True
        self.heads = first[:-1][first[:-1] < len(starts)]
        self.openers[self.heads] = True
        #: Words of two bytes or more with one capital, in front.
        capital = np.concatenate([np.flatnonzero((raw >= 65) & (raw <= 90)), latin])
        capital = capital[inside[capital]]
        of = np.searchsorted(starts, capital, "right") - 1
        single = np.bincount(of, minlength=len(starts)) == 1
        front = of[starts[of] == capital]
        self.capitalised = front[single[front] & (ends[front] - starts[front] > 1)]


def readings(texts: pa.Array) -> Iterator[Templates]:
    """The templates of the texts in each of ``WAYS``, from one search for their words.

    In lower case they are searched again only where case changes more than ``Words`` knows.
    """
    words = Words(texts)
    for way in WAYS:
        if way == LITERAL:
            lower = pc.utf8_lower(texts)
            raw, offsets = buffer_of(lower)
            if not (np.array_equal(raw, words.data) and np.array_equal(offsets, words.offsets)):
                words = Words(lower)
        yield Templates(texts, way, words)


class Templates:
    """Canonical templates of a column of texts, one token array for all of them.

    Units count as such after a number only. A capitalised word (ASCII or Latin-1) is a name unless
    it begins a sentence; names in a row are one slot. ``first[t]`` to ``first[t + 1]`` are the
    tokens of text ``t``. Other ways of reading are those of ``WAYS``; a literal one takes words in
    lower case.
    """

    def __init__(self, texts: pa.Array, way: int = OPENERS_ARE_WORDS, words: Words | None = None) -> None:
        words = words or Words(pc.utf8_lower(texts) if way == LITERAL else texts)
        raw, starts, ends, first, found = words.raw, words.starts, words.ends, words.first, words.hashes
        kinds = np.zeros(len(starts), np.int8)
        if len(starts) and way != LITERAL:
            opens = words.openers
            kinds[words.numbers] = NUMBER
            names = words.capitalised
            kinds[names if way == ALL_ARE_NAMES else names[~opens[names]]] = NAME
            follows = words.numbers[words.numbers + 1 < len(starts)] + 1
            follows = follows[kinds[follows] == WORD]
            follows = np.setdiff1d(follows, words.heads, assume_unique=True)
            kinds[follows[np.isin(found[follows], _UNIT_HASHES)]] = UNIT
            goes_on = np.zeros(len(starts), bool)
            goes_on[1:] = (kinds[1:] == NAME) & (kinds[:-1] == NAME) & ~opens[1:]
            keep = np.flatnonzero(~goes_on)
            last = np.append(keep[1:], len(starts)) - 1
            first = np.searchsorted(keep, first)
            # A run of names ends with its last name, not before the next token.
            starts, ends = starts[keep], ends[np.where(kinds[keep] == NAME, last, keep)]
            kinds, found = kinds[keep], found[keep]
        self.raw, self.starts, self.ends, self.first, self.kinds = raw, starts, ends, first, kinds
        self.hashes = np.where(kinds == WORD, found, kinds.astype(np.uint64))
        self.way = np.uint64(way * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)
        self.literal = np.concatenate([[0], np.cumsum(kinds == WORD)])

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, text) of the windows of ``length`` tokens that lie in one text, text -1 elsewhere."""
        found = rolled(self.hashes, length) ^ self.way
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))[: len(found)]
        text[self.first[text + 1] - np.arange(len(found)) < length] = -1
        return found, text

    def slots(self, at: int, length: int) -> list[str]:
        """Values in the slots of a window, in order, each after its kind."""
        return [
            f"{self.kinds[i]}{self.raw[self.starts[i] : self.ends[i]].tobytes().decode('utf-8', 'replace')}"
            for i in range(at, at + length)
            if self.kinds[i] != WORD
        ]


    def places(self, at: int, length: int) -> list[int]:
        """Places in its text of the slots of a window, in order."""
        text = np.searchsorted(self.first, at, "right") - 1
        return [int(i - self.first[text]) for i in range(at, at + length) if self.kinds[i] != WORD]


_UNIT_HASHES = _hash_words(list(UNITS))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(hash, item_id, way, item_at, length, n_windows, item_slots, item_places) of every window of the benchmark.

    Items of fewer than ``LEAST_TOKENS`` tokens have no window. Windows with fewer than ``LEAST_LITERAL`` literal words do
    not count, unless an item has no other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_bytes(batches):
            rows: list[tuple] = []
            for way, all_ in zip(WAYS, readings(batch.column("text"))):
                sizes = np.diff(all_.first)
                for length in np.unique(np.minimum(sizes, WINDOW)):
                    if length < LEAST_TOKENS:
                        continue
                    found, text = all_.windows(int(length))
                    good = all_.literal[length:] - all_.literal[:-length] >= min(LEAST_LITERAL, length)
                    for t in np.flatnonzero(np.minimum(sizes, WINDOW) == length):
                        own = np.flatnonzero(text[all_.first[t] : all_.first[t + 1]] == t) + all_.first[t]
                        own = own[good[own]] if good[own].any() else own
                        item = batch.column("item_id")[int(t)].as_py()
                        rows += (
                            (int(found[at].astype(np.int64)), item, way, int(at - all_.first[t]), int(length), len(own), all_.slots(at, length), all_.places(at, length))
                            for at in own
                        )
            kinds_ = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()))
            values = list(map(list, zip(*rows))) if rows else [[] for _ in kinds_]
            names = ["hash", "item_id", "way", "item_at", "length", "n_windows", "item_slots", "item_places"]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds_)], names)

    rows = columns(benchmark, "item_id", "text").withColumn("item_id", F.col("item_id").cast("long"))
    schema = "hash long, item_id long, way int, item_at int, length int, n_windows int, item_slots array<string>, item_places array<int>"
    return rows.where("item_id IS NOT NULL AND text IS NOT NULL").mapInArrow(run, schema)


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of each hash."""
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) * np.uint64(0x9E3779B1) >> np.uint64(5) & mask


def filter_of(items: DataFrame, count: int) -> np.ndarray:
    """A Bloom filter of the items' window hashes as words of 64 bits, merged by Spark."""
    bits = 1 << max(10, min(FILTER_BITS, 32 * max(count, 1)).bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy().astype(np.uint64)
            at = np.unique(np.concatenate(_places(hashes, bits)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).astype(np.int64))],
                ["word", "bit"],
            )

    words = items.select("hash").mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = words.toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().astype(np.uint64)
    return out


def consistent(windows: list[dict]) -> list[tuple[int, bool]]:
    """(item_at, whether all slots are equal) of the windows of an alignment that agree with the others.

    An item's value stands for the document's value that it meets in most places, on a tie for
    itself if it is among them and else for nothing. Windows with another value in a slot are left
    out, save those whose slots are all equal. Two values may stand for one.
    """
    met: dict[str, dict[int, str]] = {}
    for window in windows:
        for place, item, doc in zip(window["item_places"], window["item_slots"], window["slots"]):
            met.setdefault(item, {})[place] = doc
    stands: dict[str, str | None] = {}
    for item, places in met.items():
        counts = Counter(places.values())
        most = max(counts.values())
        top = [doc for doc, n in counts.items() if n == most]
        stands[item] = top[0] if len(top) == 1 else item if item in top else None
    out = []
    for window in windows:
        same = window["item_slots"] == window["slots"]
        if same or all(stands[item] == doc for item, doc in zip(window["item_slots"], window["slots"])):
            out.append((window["item_at"], same))
    return out


def _kept_windows(aligned: DataFrame) -> DataFrame:
    """(doc_id, key, key2, item_id, way, n_windows, item_at, same) of the consistent windows of each alignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1024):
            rows, at, same = [], [], []
            for i, windows in enumerate(batch.column("windows")):
                for item_at, equal in consistent(windows.as_py()):
                    rows.append(i)
                    at.append(item_at)
                    same.append(equal)
            named = batch.select(names).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*named.columns, pa.array(at, pa.int32()), pa.array(same, pa.bool_())], [*names, "item_at", "same"])

    names = ["doc_id", "key", "key2", "item_id", "way", "n_windows"]
    schema = "doc_id long, key long, key2 long, item_id long, way int, n_windows int, item_at int, same boolean"
    return aligned.select(*names, "windows").mapInArrow(run, schema)


def find_in_texts(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_COVERED) -> DataFrame:
    """(doc_id, key, key2, item_id, covered, n_windows, kind) of texts that hold an item.

    ``key`` and ``key2`` are ``text_keys``. As ``find``, but each text of a doc_id is judged by
    itself, and rows without doc_id are reported too.
    """
    items = cut_lineage(item_windows(benchmark))
    lengths = [row[0] for row in items.select("length").distinct().collect()]  # at most WINDOW
    bits = filter_of(items, items.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(bits) << 6
        for batch in in_bytes(batches):
            rows: list[tuple] = []
            for all_ in readings(batch.column("text")):
                for length in lengths:
                    found, text = all_.windows(length)
                    near = np.arange(len(found))
                    for place in _places(found, size):
                        place = place[near]
                        near = near[(bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)]
                    for at in near[text[near] >= 0]:
                        t = text[at]
                        rows.append((int(t), int(found[at].astype(np.int64)), int(at - all_.first[t]), all_.slots(at, length)))
            kinds_ = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()))
            row, *values = map(list, zip(*rows)) if rows else [[] for _ in kinds_]
            named = batch.select(["doc_id", "key", "key2"]).take(pa.array(row, pa.int64()))
            found_ = [pa.array(v, k) for v, k in zip(values, kinds_[1:])]
            yield pa.RecordBatch.from_arrays([*named.columns, *found_], ["doc_id", "key", "key2", "hash", "at", "slots"])

    texts = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).where("text IS NOT NULL")
    hits = texts.select("*", *text_keys()).mapInArrow(run, "doc_id long, key long, key2 long, hash long, at int, slots array<string>")
    joined = hits.join(items, "hash").where("size(slots) = size(item_slots)")
    aligned = (
        joined.groupBy("doc_id", "key", "key2", "item_id", "way", "n_windows", (F.col("at") - F.col("item_at")).alias("shift"))
        # Bounded by the item: a window of it stands at one place of the text.
        .agg(F.collect_set(F.struct("item_at", "item_places", "item_slots", "slots")).alias("windows"))
    )
    of = ["doc_id", "key", "key2", "item_id"]
    best = (
        _kept_windows(aligned)
        .groupBy(*of, "way", "n_windows", "item_at")
        .agg(F.max("same").alias("same"))
        .groupBy(*of, "way", "n_windows")
        .agg(F.count(F.lit(1)).alias("found"), F.min("same").alias("same"))
        .withColumn("covered", F.col("found") / F.col("n_windows"))
        .groupBy(*of)
        .agg(F.max(F.struct("covered", (-F.col("way")).alias("way"), "n_windows", "same")).alias("best"))
        .select(*of, "best.covered", F.col("best.n_windows").cast("long").alias("n_windows"), "best.same")
    )
    kind = F.when(F.col("same"), "verbatim").otherwise("changed").alias("kind")
    return best.where(F.col("covered") >= least).select(*of, "covered", "n_windows", kind)


def find(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_COVERED) -> DataFrame:
    """(doc_id, item_id, covered, n_windows, kind) of documents that hold an item.

    ``covered`` is the share of the item's windows found in the document, counted once each along
    alignments, without those that contradict the others (see ``consistent``), in the way of reading
    that covers most; ``kind`` is ``verbatim`` where all slots counted are equal, else ``changed``. Texts
    are read whole. Null or empty texts hold nothing; rows without doc_id are not reported; repeated
    rows of one doc_id count once, by the text that covers most. Either table may be empty.
    """
    found = find_in_texts(docs.where("doc_id IS NOT NULL"), benchmark, least)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("covered", "kind", "n_windows")).alias("best"))
    return best.select("doc_id", "item_id", "best.covered", "best.n_windows", "best.kind")
