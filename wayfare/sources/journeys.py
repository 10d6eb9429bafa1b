"""Journey, network, taxonomy and report tables on disk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.constants import COUNTABLE
from wayfare.functions.features import text_to_multiset
from wayfare.schemas import ADJACENCY, RAW_JOURNEY, TAXON


def read_extracts(
    spark: SparkSession,
    path: str,
    stub: str = "",
    sep: str = "\t",
    schema: T.StructType | None = RAW_JOURNEY,
) -> DataFrame:
    """All delimited extracts of a folder whose name holds ``stub``.

    Rows without a sequence are dropped. Compressed files are read as they are. Without
    a schema, columns are named by the header, counts and lengths are numbers and all
    else is text.
    """
    reader = (
        spark.read.option("sep", sep)
        .option("header", True)
        .option("pathGlobFilter", f"*{stub}*")
        .option("recursiveFileLookup", True)
    )
    if schema is not None:
        return reader.schema(schema).csv(path).dropna(subset=["Sequence"])
    df = reader.csv(path)
    numbers = [name for name in ("Occurrences", "PageSeq_Length", "Actions_Length") if name in df.columns]
    return df.withColumns({name: F.col(name).cast("bigint") for name in numbers}).dropna(subset=["Sequence"])


def parse_multisets(df: DataFrame, names: Sequence[str] = COUNTABLE) -> DataFrame:
    """The countable columns of ``df`` that are comma texts, as ``map<string,bigint>``."""
    texts = [name for name, kind in df.dtypes if name in names and kind == "string"]
    return df.withColumns({name: text_to_multiset(F.col(name)) for name in texts})


def write_extract(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Delimited text, gzip compressed, with a header."""
    df.write.mode("overwrite").option("sep", sep).option("header", True).option(
        "compression", "gzip"
    ).csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet with its nested types."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_columns(spark: SparkSession, path: str, wanted: Sequence[str]) -> DataFrame:
    """Only those of the wanted columns that the table has."""
    df = spark.read.parquet(path)
    return df.select(*[name for name in wanted if name in df.columns])


def render_multiset(multiset: Column) -> Column:
    """``a,a,b`` text of a multiset, the form of the delimited extracts."""
    repeated = F.transform(
        F.array_sort(F.map_entries(multiset)),
        lambda e: F.array_repeat(e["key"], e["value"].cast("int")),
    )
    return F.array_join(F.flatten(repeated), ",")


def read_taxonomy(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(TAXON).option("multiLine", multi_line).json(path)


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ADJACENCY).option("header", True).csv(path)
