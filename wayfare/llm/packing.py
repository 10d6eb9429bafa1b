"""Packing by power-of-two decomposition.

A document of n tokens is cut by the binary digits of n: full sequences first, then one piece for
every digit set in the rest. Each piece fills a sequence of its own length, so nothing is padded
and no sequence holds two documents; pieces of equal length form a bucket of equal sequences.
"""

from __future__ import annotations

import array
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.tables import columns, in_slices
from wayfare.session import cut_lineage

END = 0
#: Entries of a worker's table of pieces of text it has already split, about 120 MB, and their characters.
REMEMBERED, LONGEST_REMEMBERED = 500_000, 64

#: White space as the tokenizer's pattern sees it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Cuts where the tokenizer's own pattern always cuts: around runs of Latin letters that an ASCII
#: character other than a letter follows, and around white space.
PIECES = re.compile(
    f" ?[A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff]+(?=[\\x00-@\\[-`{{-\\x7f]|\\Z)"
    f"| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)

PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary, task int, nth long"


def vocabulary() -> tuple[str, str, str]:
    """Paths of the installed public tokenizer's file and ranks, and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


class Tokens:
    """Ids of texts as little-endian unsigned 32-bit numbers, the same as the tokenizer file's.

    Prose repeats its words, so ids are remembered by piece of text. New pieces are encoded from
    the rank file of the same vocabulary; texts that hold a special token go to the tokenizer.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str) -> None:
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        coding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.encode = coding.encode_ordinary
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        pieces = PIECES.findall(text)
        found = list(map(self.known.get, pieces))
        if None in found:
            for at, piece in enumerate(pieces):
                if found[at] is None:
                    found[at] = self._new(piece)
        return b"".join(found)

    def _new(self, piece: str) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            ids = array.array("I", self.encode(piece)).tobytes()
            if len(self.known) < REMEMBERED and len(piece) <= LONGEST_REMEMBERED:
                self.known[piece] = ids
        return ids


def cuts(tokens: int, most: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document: powers of two, longest first, at most ``most``."""
    start = 0
    while start < tokens:
        length = min(most, 1 << ((tokens - start).bit_length() - 1))
        yield start, length
        start += length


def decompose(docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, most: int = 1024) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, ids, task, nth) of every row of ``docs`` (doc_id, text).

    ``ids`` holds the piece's tokens as little-endian unsigned 32-bit numbers; the document's last
    token is ``END``. ``nth`` numbers the pieces of one length in one task, from 0. Null and empty texts are documents of that one token. ``most`` is a power of
    two. Repeated rows are documents of their own; a null doc_id stays null. The vocabulary files
    are opened by path in the workers and belong to the installation, not to the data.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("the longest piece must be a power of two")
    end = array.array("I", [END]).tobytes()
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
    schema = pa.schema([*kinds, ("task", pa.int32()), ("nth", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, task, made = Tokens(tokenizer_path, ranks_path, pattern), TaskContext.get().partitionId(), Counter()
        for batch in in_slices(batches, 256):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = tokens.ids(text.as_py() or "") + end
                n = len(ids) // 4
                for at, size in cuts(n, most):
                    rows.append((doc_id.as_py(), at, size, n, ids[4 * at : 4 * (at + size)], task, made[size]))
                    made[size] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(map(list, zip(*rows)), schema)]
                if rows
                else [pa.array([], field.type) for field in schema],
                schema=schema,
            )

    rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, PIECE)


def sequences(pieces: DataFrame) -> DataFrame:
    """``pieces`` with (sequence_id, offset) for (task, nth), gapless from 0 by bucket of equal length, longest first.

    Every piece is a sequence of its own power-of-two length. Tasks have numbered their pieces, so only
    the numbers of pieces of each task and length are added up; the ids stay where they were written.
    ``pieces`` is read twice, so it should be written before.
    """
    # At most tasks x (1 + log2(most)) rows, in one window for each length.
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    within = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("within"))
    longer = Window.orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    lengths = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    first = lengths.select("length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("first"))
    # Written first, so that the pieces are not shuffled to meet a table that turns out to be small.
    base = cut_lineage(within.join(first, "length").select("length", "task", (F.col("first") + F.col("within")).alias("base")))
    names = [name for name in pieces.columns if name not in ("task", "nth")]
    numbered = pieces.join(base, ["length", "task"])
    return numbered.select(*names, (F.col("base") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, most: int = 1024, digest: bool = False) -> DataFrame:
    """Packed pieces of ``docs``; with ``digest`` their ``ids_crc32`` takes the place of ``ids``.

    The pieces are written to the shared folder once, so that texts are tokenized once.
    """
    pieces = decompose(docs, tokenizer_path, ranks_path, pattern, most)
    if digest:
        pieces = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "task", "nth")
    return sequences(cut_lineage(pieces))
