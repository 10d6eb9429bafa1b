"""Language identification by compression.

Each language has a raw-content zstandard dictionary cut from labelled texts. A text is
encoded once per language; the language whose dictionary makes it smallest is chosen, and
the choice is rejected when the second smallest is hardly larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.tables import columns, in_slices, text_keys

UNKNOWN = "und"

#: What fitting may gather: so many texts a language, so many characters of each. The dictionaries
#: hold ``DICTIONARY_BYTES`` a language, whatever the corpus holds.
SAMPLE_TEXTS = 200
SAMPLE_CHARS = 500
DICTIONARY_BYTES = 48 * 1024
#: Text of the language that stands before every block, so that letter statistics of the language
#: are in the block's own tables and even a text of a few bytes costs less in its language.
PRIMER_BYTES = 1024
#: Longer texts are encoded in blocks of this size, each against the whole dictionary.
BLOCK_BYTES = 16 * 1024
#: Relative gap between the two smallest encodings at or below which a choice is rejected, at least.
MARGIN = 0.0005
#: Every so many-th sampled text is kept out of the dictionaries. Clean texts of these lengths are cut
#: from them, so many a length; ``SLACK`` times the gap that all but a share of ``LOW`` of them exceed
#: is the least gap of a text of that length. Lengths with fewer than ``LEAST_PIECES`` have none.
HELD_OUT = 4
LENGTHS = (16, 64, 256, 1024, 4096, 16384)
PIECES, LEAST_PIECES = 400, 40
LOW, SLACK = 0.01, 0.5

RESULT = "doc_id long, lang_pred string, score double, margin double, rejected boolean"


@dataclass(frozen=True)
class Languages:
    """Primer and dictionary by language: ``LANGUAGES x 49 KB``, the bound of what is broadcast."""

    samples: dict[str, bytes]
    #: Least gap by length, of ``LENGTHS``.
    margins: tuple[float, ...] = ()


def fit(labelled: DataFrame) -> Languages:
    """Dictionaries from rows (doc_id, text, lang); rows without text or language are passed over.

    Every ``HELD_OUT``-th row of a sample gives no dictionary but the least margins.
    The sample of a language is its ``2 * SAMPLE_TEXTS`` rows with the smallest hash of their id (modulo 2**30). Rows
    are first drawn by that hash with a share that leaves some four times as many, so a language
    that holds most rows gathers no more of them than any other.
    """
    rows = (
        columns(labelled, "doc_id", "text", "lang")
        .where("lang IS NOT NULL AND text IS NOT NULL AND text RLIKE '\\\\p{L}'")
        .select("lang", F.xxhash64("doc_id").alias("at"), F.substring("text", 1, LENGTHS[-1]).alias("text"))
    )
    # One row a language.
    totals = rows.groupBy("lang").count().collect()
    drawn, share = F.pmod("at", F.lit(1 << 30)), F.lit(0)
    for row in totals:
        most = int((1 << 30) * min(1.0, 4 * SAMPLE_TEXTS / row["count"]))
        share = F.when(F.col("lang") == row["lang"], F.lit(most)).otherwise(share)
    order = Window.partitionBy("lang").orderBy(drawn, "at", "text")
    sample = rows.where(drawn < share).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= 2 * SAMPLE_TEXTS)
    found: dict[str, list[str]] = {}
    held: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "nth").select("lang", "nth", "text").collect():
        if row["nth"] % HELD_OUT == 0:
            held.setdefault(row["lang"], []).append(row["text"])
        elif len(found.setdefault(row["lang"], [])) < SAMPLE_TEXTS:
            found[row["lang"]].append(row["text"][:SAMPLE_CHARS])
    joined = {lang: "\n".join(texts).lower().encode() for lang, texts in found.items()}
    samples = {lang: text[: DICTIONARY_BYTES + PRIMER_BYTES] for lang, text in joined.items()}
    return Languages(samples, least_margins(Encoder(Languages(samples)), held) if len(samples) > 1 else ())


def least_margins(encoder: Encoder, held: dict[str, list[str]]) -> tuple[float, ...]:
    """The gap at or below which a text is rejected, for each of ``LENGTHS``, from texts held out."""
    out = []
    for length in LENGTHS:
        gaps = []
        for texts in held.values():
            whole = "\n".join(texts)
            starts = range(0, len(whole) - length + 1, length)
            step = max(1, -(-len(starts) * len(held) // PIECES))
            for start in starts[::step]:
                piece = whole[start : start + length]
                if any(map(str.isalpha, piece)):
                    best, second = sorted(encoder.sizes(piece))[:2]
                    gaps.append((second - best) / max(second, 1))
        gaps.sort()
        out.append(max(MARGIN, SLACK * gaps[int(LOW * len(gaps))]) if len(gaps) >= LEAST_PIECES else MARGIN)
    return tuple(out)


class Encoder:
    """Encoded sizes of a text in every language."""

    def __init__(self, languages: Languages) -> None:
        import zstandard as zstd

        self.names, self.margins = sorted(languages.samples), languages.margins
        params = zstd.ZstdCompressionParameters(
            strategy=zstd.STRATEGY_GREEDY,
            window_log=17,
            hash_log=16,
            chain_log=17,
            search_log=3,
            min_match=4,
            target_length=32,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        self.coders = []
        for name in self.names:
            primer, rest = languages.samples[name][:PRIMER_BYTES], languages.samples[name][PRIMER_BYTES:]
            if rest:
                content = zstd.ZstdCompressionDict(rest, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(compression_params=params)
                coder = zstd.ZstdCompressor(compression_params=params, dict_data=content)
            else:
                coder = zstd.ZstdCompressor(compression_params=params)
            self.coders.append((coder.compress, primer, len(coder.compress(primer))))

    def sizes(self, text: str) -> list[int]:
        """Bytes that ``text`` adds to each language's primer, over all its blocks."""
        data = text.lower().encode("utf-8", "replace")
        blocks = [data[at : at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)]
        return [sum(len(encode(primer + block)) - base for block in blocks) for encode, primer, base in self.coders]

    def least(self, text: str) -> float:
        """The gap at or below which ``text`` is rejected; between two lengths, by their logarithms."""
        at = np.log(max(1, len(text)))
        return float(np.interp(at, np.log(LENGTHS), self.margins)) if self.margins else MARGIN

    def choose(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score, margin, rejected."""
        if text is None or not any(map(str.isalpha, text)) or not self.names:
            return UNKNOWN, 0.0, 0.0, True
        sizes = self.sizes(text)
        ranked = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.names[i]))
        if len(ranked) == 1:
            return self.names[ranked[0]], 1.0, 1.0, False
        best, second = sizes[ranked[0]], sizes[ranked[1]]
        margin = (second - best) / max(second, 1)
        return self.names[ranked[0]], margin / (margin + 0.02), margin, margin <= self.least(text)


def identify(docs: DataFrame, languages: Languages, keyed: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) of every row of ``docs`` (doc_id, text).

    Whole texts are encoded. Null texts and texts without a letter are ``und``, score 0, rejected.
    Equal sizes go to the first name in order and have margin 0, which is rejected: a text that no
    dictionary shortens more than another says nothing about its language. A text is also rejected
    where its margin is far below those of clean texts of its length. ``score`` is
    ``margin / (margin + 0.02)``. A null doc_id stays null; repeated rows give repeated results. ``keyed`` adds the
    ``text_keys``.
    """
    keys = ["key", "key2"] if keyed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(languages)
        for batch in in_slices(batches, 512):
            found = [encoder.choose(text.as_py()) for text in batch.column("text")]
            lang, score, margin, rejected = map(list, zip(*found)) if found else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(margin, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                    *(batch.column(name) for name in keys),
                ],
                ["doc_id", "lang_pred", "score", "margin", "rejected", *keys],
            )

    rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.select("*", *text_keys()) if keyed else rows
    return rows.mapInArrow(run, RESULT + "".join(f", {name} long" for name in keys))


def drop(docs: DataFrame, languages: Languages) -> DataFrame:
    """The rows of ``docs`` that ``identify`` does not reject, whole; each is judged by its own text in the pass that reads it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(languages)
        for batch in in_slices(batches, 512):
            yield batch.filter(pa.array([not encoder.choose(text.as_py())[3] for text in batch.column("text")], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
