"""Alignment of two tokenizers' tokens by the byte offsets where tokens of both end.

A text is cut into units, each beginning with a space after a character that is no white space; both
tokenizers always end a token there. In a unit the shorter list of token ends drives a galloping
search, exponential steps and then bisection, into the longer one; all ends of many units take their
steps together. Ends found in both slice the tokens
into groups; differences of the ranks found give the range of tokens each token overlaps.

Links are counted over the corpus by chunk: workers turn some megabytes of texts into one row with the
chunk's distinct id pairs, how many of its documents hold each, and which units its documents hold.
Only the distinct pairs of chunks are shuffled, never the links of documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.packing import SPACE
from wayfare.llm.tables import columns
from wayfare.session import cut_lineage

#: UTF-8 bytes of the texts of one chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: A worker forgets the units it has aligned beyond so many, or so many bytes of them.
REMEMBERED, REMEMBERED_BYTES = 200_000, 16 << 20
#: Texts are cut into units, and new units aligned, so many bytes at a time or so many units; a chunk's
#: documents meet their pairs so many units at a time. A longer text goes alone.
AT_ONCE, BYTES_AT_ONCE = 1 << 15, 1 << 19
#: A unit: spaces after white space do not begin another.
UNIT = re.compile(f" [^ ]*(?:(?<=[{SPACE}]) +[^ ]*)*")
#: A pair of ids as one number, and a unit's pair.
SHIFT, UNIT_SHIFT = 20, 36

COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]


def vocabularies() -> tuple[str, str, str]:
    """Path of the ranks of the installed byte-level vocabulary, its pattern, and path of the piece model."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")


class Tokenizers:
    """Ids of both tokenizers without special tokens, and the bytes of each id."""

    def __init__(self, ranks_path: str, pattern: str, piece_path: str) -> None:
        import base64

        import tiktoken
        from sentencepiece import SentencePieceProcessor

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.first = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.first_bytes = sorted(ranks, key=ranks.__getitem__)
        self.second = SentencePieceProcessor(model_file=piece_path)
        pieces = [self.second.id_to_piece(at) for at in range(self.second.get_piece_size())]
        self.second_bytes = [
            bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("\u2581", " ").encode() for piece in pieces
        ]
        self.space = self.second.piece_to_id("\u2581")
        self.first_sizes, self.second_sizes = (np.array(list(map(len, table))) for table in (self.first_bytes, self.second_bytes))

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of units, which begin with a space; the second tokenizer adds that space itself.

        It adds none to an empty text; a lone space ends a longer text.
        """
        second = self.second.encode([unit[1:] for unit in units], num_threads=1)
        return list(map(self.first.encode_ordinary, units)), [ids or [self.space] for ids in second]


def gallop(values: np.ndarray, targets: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """For each target the first place in ``starts .. stops`` of the ascending ``values`` not below it, else its stop.

    All targets take their doubling steps together, then bisect what is left of their ranges.
    """
    low, high = starts.copy(), stops.copy()
    open_, step = np.flatnonzero(low < high), 1
    while len(open_):
        probe = np.minimum(starts[open_] + step, stops[open_]) - 1
        below = values[probe] < targets[open_]
        high[open_[~below]] = probe[~below]
        low[open_[below]] = probe[below] + 1
        open_ = open_[below & (probe + 1 < stops[open_])]
        step *= 2
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        below = values[middle] < targets[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
    return low


def common_ends(first: np.ndarray, first_sizes: np.ndarray, second: np.ndarray, second_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks of the tokens of both sides that end together, and the pairs of overlapping tokens of each unit.

    ``first`` and ``second`` are the ends of the tokens of units that follow each other, ``*_sizes``
    the numbers of tokens of each unit. In a unit, the side with fewer tokens searches the other.
    """
    marks = [np.zeros(len(first), bool), np.zeros(len(second), bool)]
    overlaps = np.zeros(len(first_sizes), np.int64)
    ends, sizes = [first, second], [first_sizes, second_sizes]
    stops = [np.cumsum(each) for each in sizes]
    for short, drives in ((0, first_sizes <= second_sizes), (1, first_sizes > second_sizes)):
        long = 1 - short
        unit = np.repeat(np.arange(len(drives)), sizes[short])
        own = np.flatnonzero(drives[unit])
        unit = unit[own]
        begin = (stops[long] - sizes[long])[unit]
        rank = gallop(ends[long], ends[short][own], begin, stops[long][unit])
        common = ends[long][rank] == ends[short][own] if len(own) else np.zeros(0, bool)
        marks[short][own[common]] = True
        marks[long][rank[common]] = True
        # A token overlaps from the first that ends beyond its start to the one that reaches its end.
        before = np.concatenate([[0], (rank + common)[:-1]])[: len(rank)]
        before = np.maximum(before, begin)
        overlaps += np.bincount(unit, rank - before + 1, len(drives)).astype(np.int64)
    return marks[0], marks[1], overlaps


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges ``starts .. starts + sizes``, one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Units:
    """Units aligned so far, by number; a unit whose bytes either tokenizer changes has no counts."""

    def __init__(self, ranks_path: str, pattern: str, piece_path: str) -> None:
        self.tokenizers = Tokenizers(ranks_path, pattern, piece_path)
        most = max(len(self.tokenizers.first_bytes), len(self.tokenizers.second_bytes))
        self.shown = [f"{at}{mark}" for mark in ",|;" for at in range(most)]
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.texts: list[str] = []
        self.size = 0
        self.counts = np.empty((0, len(COUNTS)), np.int64)
        self.known = np.empty(0, bool)
        #: Distinct pairs of each unit, with the unit's links of each.
        self.sizes, self.codes, self.times = (np.empty(0, np.int64) for _ in range(3))

    def learn(self, units: list[str]) -> None:
        """Aligns units not met before."""
        batch, size = [], 0
        for unit in units:
            if batch and (len(batch) == AT_ONCE or size + len(unit) > BYTES_AT_ONCE):
                self._add(batch)
                batch, size = [], 0
            batch.append(unit)
            size += len(unit)
        if batch:
            self._add(batch)

    def _add(self, units: list[str]) -> None:
        ids = self.tokenizers.encode(units)
        same = self._given_back(units, ids)
        self.numbers.update(zip(units, range(len(self.numbers), len(self.numbers) + len(units))))
        a_sizes, a_ids = _csr(ids[0])
        b_sizes, b_ids = _csr(ids[1])
        a_common, b_common, overlaps = common_ends(
            np.cumsum(self.tokenizers.first_sizes[a_ids]), a_sizes, np.cumsum(self.tokenizers.second_sizes[b_ids]), b_sizes
        )
        # Tokens up to a common end form a group; groups by their last tokens.
        a_to, b_to = np.flatnonzero(a_common) + 1, np.flatnonzero(b_common) + 1
        unit_of = np.repeat(np.arange(len(units)), a_sizes)[a_to - 1]
        a_in, b_in = np.diff(a_to, prepend=0), np.diff(b_to, prepend=0)
        links = np.bincount(unit_of, a_in * b_in, len(units)).astype(np.int64)
        counts = np.stack([a_sizes, b_sizes, np.bincount(unit_of, minlength=len(units)), links, overlaps], axis=1)
        a_group, b_group = np.repeat(np.arange(len(a_to)), a_in), np.repeat(np.arange(len(b_to)), b_in)
        self.texts += self._texts(a_ids, a_group, a_to, b_ids, b_group, b_to, a_sizes + b_sizes)
        # Distinct ids of each group on both sides, all pairs of those, then the distinct pairs of each unit.
        a_keys, a_times = np.unique(a_group << SHIFT | a_ids, return_counts=True)
        b_keys, b_times = np.unique(b_group << SHIFT | b_ids, return_counts=True)
        b_per = np.bincount(b_keys >> SHIFT, minlength=len(b_to))
        group = a_keys >> SHIFT
        at = _spread((np.cumsum(b_per) - b_per)[group], b_per[group])
        low = (1 << SHIFT) - 1
        a_code = np.repeat((unit_of[group] << UNIT_SHIFT) | ((a_keys & low) << SHIFT), b_per[group])
        pairs, place = np.unique(a_code | (b_keys[at] & low), return_inverse=True)
        times = np.bincount(place, np.repeat(a_times, b_per[group]) * b_times[at], len(pairs)).astype(np.int64)
        self.counts, self.known = np.concatenate([self.counts, counts]), np.concatenate([self.known, same])
        self.sizes = np.concatenate([self.sizes, np.bincount(pairs >> UNIT_SHIFT, minlength=len(units))])
        self.codes, self.times = np.concatenate([self.codes, pairs & ((1 << UNIT_SHIFT) - 1)]), np.concatenate([self.times, times])

    def _given_back(self, units: list[str], ids: tuple[list[list[int]], list[list[int]]]) -> np.ndarray:
        """Whether both sides' bytes are those of the unit; ids of other units are taken away."""
        own = list(map(str.encode, units))
        sizes = np.array(list(map(len, own)))
        self.size += int(sizes.sum())
        same, whole = np.ones(len(units), bool), b"".join(own)
        for table, lengths, side in zip(
            (self.tokenizers.first_bytes, self.tokenizers.second_bytes), (self.tokenizers.first_sizes, self.tokenizers.second_sizes), ids
        ):
            n, flat = _csr(side)
            if (_summed(n, lengths[flat]) == sizes).all() and b"".join(map(table.__getitem__, flat.tolist())) == whole:
                continue
            same &= np.array([b"".join(map(table.__getitem__, each)) == data for each, data in zip(side, own)], bool)
        for at in np.flatnonzero(~same):
            ids[0][at] = ids[1][at] = []
        return same

    def _texts(self, a_ids, a_group, a_to, b_ids, b_group, b_to, sizes) -> list[str]:
        """Each unit's groups as a text: ids of a side behind commas, sides parted by a bar, groups by a semicolon."""
        marked = np.empty(len(a_ids) + len(b_ids), np.int64)
        a_marked, b_marked = a_ids.copy(), b_ids.copy()
        a_marked[a_to - 1] += self.most
        b_marked[b_to - 1] += 2 * self.most
        marked[np.arange(len(a_ids)) + np.concatenate([[0], b_to])[a_group]] = a_marked
        marked[np.arange(len(b_ids)) + a_to[b_group]] = b_marked
        shown = list(map(self.shown.__getitem__, marked.tolist()))
        stops = np.cumsum(sizes).tolist()
        return ["".join(shown[start:stop])[:-1] for start, stop in zip([0, *stops], stops)]


def _csr(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return sizes, np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))


CHUNK = (
    "chunk long, doc_id array<long>, groups_sha256 array<string>, "
    + ", ".join(f"{name} array<long>" for name in COUNTS)
    + ", codes array<long>, docs array<long>, unit_sizes binary, unit_pairs binary, unit_times binary, doc_sizes binary, doc_units binary, doc_times binary"
)
_PACKED = ["unit_sizes", "unit_pairs", "unit_times", "doc_sizes", "doc_units", "doc_times"]


def _packed(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.astype("<i4").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i4").astype(np.int64)


def _summed(sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums over ranges of ``values`` that follow each other."""
    totals = np.concatenate([[0], np.cumsum(values)])
    stops = np.cumsum(sizes)
    return totals[stops] - totals[stops - sizes]


def _ranges(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that follow each other, of at most ``most`` in ``sizes``; a larger row comes alone."""
    start, total = 0, 0
    for at, size in enumerate(sizes):
        if at > start and total + size > most:
            yield start, at
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _numbered(units: Units, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """How many units each text has, and the numbers of all; units not met before are aligned."""
    parts = []
    for start, stop in _ranges([len(text or "") for text in texts], BYTES_AT_ONCE):
        found = [UNIT.findall(" " + text) if text else [] for text in texts[start:stop]]
        units.learn([unit for unit in dict.fromkeys(chain.from_iterable(found)) if unit not in units.numbers])
        parts.append(_csr([list(map(units.numbers.__getitem__, each)) for each in found]))
    sizes, numbers = map(np.concatenate, zip(*parts))
    return sizes, numbers


def _chunk_row(units: Units, ids: list[int | None], texts: list[str | None]) -> dict:
    """What ``CHUNK`` names, of the documents of one chunk."""
    sizes, numbers = _numbered(units, texts)
    bad = _summed(sizes, ~units.known[numbers]) > 0
    numbers, sizes = numbers[np.repeat(~bad, sizes)], np.where(bad, 0, sizes)
    stops = np.cumsum(sizes)
    hashes = []
    for start, stop in zip((stops - sizes).tolist(), stops.tolist()):
        shown = ";".join(map(units.texts.__getitem__, numbers[start:stop].tolist()))
        hashes.append(hashlib.sha256(shown.encode()).hexdigest() if start < stop else "")
    held = np.flatnonzero(np.bincount(numbers, minlength=len(units.texts)))
    unit_sizes = units.sizes[held]
    at = _spread((np.cumsum(units.sizes) - units.sizes)[held], unit_sizes)
    codes, unit_pairs = np.unique(units.codes[at], return_inverse=True)
    unit_starts, place = np.cumsum(unit_sizes) - unit_sizes, np.zeros(len(units.texts), np.int64)
    place[held] = np.arange(len(held))
    docs = np.zeros(len(codes), np.int64)
    of_docs = []
    for start, stop in _ranges(sizes.tolist(), AT_ONCE):
        # Distinct units of each document, then its distinct pairs.
        own = sizes[start:stop]
        local = place[numbers[stops[start] - own[0] : stops[stop - 1]]]
        keys, doc_times = np.unique(np.repeat(np.arange(stop - start), own) * max(1, len(held)) + local, return_counts=True)
        doc, doc_units = np.divmod(keys, max(1, len(held)))
        spread = unit_sizes[doc_units]
        in_doc = unit_pairs[_spread(unit_starts[doc_units], spread)]
        pairs = np.sort(np.repeat(doc, spread) * max(1, len(codes)) + in_doc)
        docs += np.bincount(pairs[np.diff(pairs, prepend=-1) > 0] % max(1, len(codes)), minlength=len(codes))
        of_docs.append((np.bincount(doc, minlength=stop - start), doc_units, doc_times))
    doc_sizes, doc_units, doc_times = map(np.concatenate, zip(*of_docs))
    row = {
        "doc_id": ids,
        "groups_sha256": hashes,
        "codes": codes,
        "docs": docs,
        "unit_sizes": _packed(unit_sizes),
        "unit_pairs": _packed(unit_pairs),
        "unit_times": _packed(units.times[at]),
        "doc_sizes": _packed(doc_sizes),
        "doc_units": _packed(doc_units),
        "doc_times": _packed(doc_times),
    }
    return row | {name: _summed(sizes, units.counts[numbers, column]) for column, name in enumerate(COUNTS)}


def chunked(docs: DataFrame, ranks_path: str, pattern: str, piece_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row (``CHUNK``) for every ``chunk_bytes`` of texts that a task reads, in the task's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, made, first = Units(ranks_path, pattern, piece_path), 0, TaskContext.get().partitionId() << 33
        ids: list[int | None] = []
        texts: list[str | None] = []
        size = 0

        def flush() -> pa.RecordBatch:
            row = {"chunk": first + made} | _chunk_row(units, ids, texts)
            lists = {name: pa.list_(pa.int64()) for name in ("doc_id", "codes", "docs", *COUNTS)} | {"groups_sha256": pa.list_(pa.string())}
            kinds = {"chunk": pa.int64()} | lists | {name: pa.binary() for name in _PACKED}
            names = [part.split()[0] for part in CHUNK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([row[name]], kinds[name]) for name in names], names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                data = text.as_py()
                if ids and size + len(data or b"") > chunk_bytes:
                    yield flush()
                    ids, texts, size, made = [], [], 0, made + 1
                    if len(units.texts) > REMEMBERED or units.size > REMEMBERED_BYTES:
                        units.forget()
                ids.append(doc_id.as_py())
                texts.append(None if data is None else data.decode(errors="replace"))
                size += len(data or b"")
        if ids:
            yield flush()

    rows = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, CHUNK)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(code, count, best): how many documents link each id pair, and whether no pair of its first id has more."""
    pairs = chunks.select(F.explode(F.arrays_zip("codes", "docs")).alias("pair")).select("pair.codes", "pair.docs")
    counts = cut_lineage(pairs.groupBy(F.col("codes").alias("code")).agg(F.sum("docs").alias("count")))
    of = F.shiftrightunsigned("code", SHIFT).alias("first")
    most = counts.groupBy(of).agg(F.max("count").alias("most"))
    return counts.select("code", "count", of).join(most, "first").select("code", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, ranks_path: str, pattern: str, piece_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps) of every row of ``docs``.

    Each row is a document of its own, repeated ones too; a null doc_id stays null. Texts that are null
    or empty, or whose bytes either tokenizer does not give back, have zeros and an empty hash. Invalid
    UTF-8 is not given back. A text of any length is aligned whole, in one task. An empty table gives no rows.
    """
    chunks = cut_lineage(chunked(docs, ranks_path, pattern, piece_path, chunk_bytes))
    counts = cut_lineage(pair_counts(chunks))
    places = chunks.select("chunk", F.posexplode("codes").alias("place", "code")).join(counts, "code")
    # A chunk's pairs are bounded by its bytes.
    found = places.groupBy("chunk").agg(F.collect_list(F.struct("place", "count", "best")).alias("found"))
    found = found.select("chunk", *(F.col(f"found.{name}").alias(name) for name in ("place", "count", "best")))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                packed = {name: _unpacked(row[name].as_py()) for name in _PACKED}
                lists = {name: row[name].values for name in ("doc_id", "groups_sha256", *COUNTS)}
                of_docs = {}
                for name, value in (("count_sum", "count"), ("n_best", "best")):
                    by_pair = np.zeros(len(row["codes"].values), np.int64)
                    if row["place"].is_valid:
                        own = row[value].values.cast(pa.int64()).to_numpy(zero_copy_only=False)
                        by_pair[row["place"].values.to_numpy(zero_copy_only=False)] = own
                    by_unit = _summed(packed["unit_sizes"], packed["unit_times"] * by_pair[packed["unit_pairs"]])
                    of_docs[name] = pa.array(_summed(packed["doc_sizes"], packed["doc_times"] * by_unit[packed["doc_units"]]))
                yield pa.RecordBatch.from_arrays([lists[name] if name in lists else of_docs[name] for name in names], names)

    kinds = {"doc_id": "long", "groups_sha256": "string"}
    return chunks.drop("docs").join(found, "chunk", "left").mapInArrow(run, ", ".join(f"{name} {kinds.get(name, 'long')}" for name in names))
