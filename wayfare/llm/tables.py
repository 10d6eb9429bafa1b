"""What the operators share: reading tables, hashes of rows, distributed ranks, worker batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: ``1 << 64`` as an offset, so that a signed hash becomes an unsigned one.
RANK = "__rank"


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever else ``df`` carries; clashing names end here."""
    return df.select(*(F.col(f"`{name}`") for name in names))


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_keys(name: str | Column = "text") -> list[Column]:
    """key and key2, two hashes that tell texts apart; those of null differ from all others."""
    return [F.xxhash64(name).alias("key"), F.xxhash64(F.lit(1), name).alias("key2")]


def text_crc32(name: str = "text") -> Column:
    return F.crc32(F.encode(text_of(name), "UTF-8"))


def fold(doc_id: Column, modulus: int) -> Column:
    """``crc32`` of the id written as text, modulo the number of folds."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % modulus


def buckets_of(df: DataFrame, least: int = 16) -> int:
    """Number of salts: follows the shuffle width, which grows with the cluster and the data."""
    return max(least, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


#: 64-bit words of the filter that ``maybe_among`` sends to every task: 4 MB with their numbers, whatever it holds.
FILTER_WORDS = 1 << 18


def maybe_among(df: DataFrame, hashed: Column, wanted: DataFrame, name: str) -> DataFrame:
    """``df`` with the flag ``name``: false only where ``hashed`` is not among the hashes of ``wanted`` (hashed).

    A filter of fixed size, so that rows which a join would not meet need no shuffle.
    """
    place = F.pmod(F.col("hashed"), F.lit(FILTER_WORDS * 64))
    bits = wanted.select(place.alias("place")).groupBy(F.expr("place div 64").alias("__word"))
    bits = bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 AS int))")).alias("__bits"))
    at = F.pmod(hashed, F.lit(FILTER_WORDS * 64))
    marked = df.withColumn("__place", at).withColumn("__word", F.expr("__place div 64")).join(F.broadcast(bits), "__word", "left")
    held = F.expr("coalesce(shiftright(__bits, cast(__place % 64 AS int)) & 1L, 0L) = 1L")
    return marked.withColumn(name, held).drop("__word", "__place", "__bits")


def with_rank(df: DataFrame, group: str, order: list[str], salts: int, name: str = RANK) -> DataFrame:
    """Gapless positions from 0 within ``group``, without gathering a group in one task.

    Rows of a group are dealt by a hash of ``order`` over ``salts`` buckets. Each bucket
    numbers its rows; the offset of a bucket is the number of rows in the buckets before
    it. The table of offsets has at most groups x salts rows. Rows equal in ``order`` are
    interchangeable and are numbered in any order.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    before = Window.partitionBy(group).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        salted.groupBy(group, "__salt")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(group, "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    within = Window.partitionBy(group, "__salt").orderBy(*order)
    return (
        salted.withColumn("__row", F.row_number().over(within).cast("long") - 1)
        .join(offsets, [group, "__salt"])
        .withColumn(name, F.col("__row") + F.col("__offset"))
        .drop("__salt", "__row", "__offset")
    )


def in_slices(batches: Iterable, rows: int) -> Iterator:
    """Arrow batches cut into pieces of at most ``rows`` rows, so that Python holds few texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
