"""Scans of listings, with one key column whatever the source calls it."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lookups import NA_TOKENS
from ..schema import raw_listings


def read_csv(spark: SparkSession, path: str, schema: str | None = None, na_tokens: Sequence[str] = NA_TOKENS, multi_line: bool = False, reasons: bool = False, header: bool = True) -> DataFrame:
    """CSV, with a header unless said otherwise, typed by a schema; the tokens are null in every column. An empty sequence keeps them as text.
    `multi_line` reads line breaks inside quotes, at the price of one task for each file.

    With `reasons`, columns `reason` and `record` are added: a record with too few or too many fields is "corrupt", one that
    holds text where its type asks for something else "unreadable" (null for all others), with the record's text."""
    from pyspark.sql.types import StringType, StructField, StructType

    fields = spark.createDataFrame([], schema or raw_listings()).schema.fields
    text = StructType([StructField(f.name, StringType()) for f in fields])
    if reasons:
        text = text.add("_record", StringType())
    raw = spark.read.schema(text).option("header", header).option("columnNameOfCorruptRecord", "_record").option("quote", '"').option("escape", '"').option("multiLine", multi_line).csv(path)
    value = lambda c: F.when(F.trim(c).isin(*na_tokens), F.lit(None)).otherwise(c) if na_tokens else c

    def typed(f):
        c = value(F.col(f.name))
        kind = f.dataType.simpleString()
        if kind in ("bigint", "int"):  # "1300.0" is an integer too
            return c.try_cast("double").try_cast(kind).alias(f.name)
        return (c if kind == "string" else c.try_cast(kind)).alias(f.name)

    if not reasons:
        return raw.select(*[typed(f) for f in fields])
    bad = reduce(lambda a, b: a | b, [value(F.col(f.name)).isNotNull() & typed(f).isNull() for f in fields if f.dataType.simpleString() != "string"], F.lit(False))
    why = F.when(F.col("_record").isNotNull(), "corrupt").when(bad, "unreadable")
    record = F.when(why.isNotNull(), F.coalesce("_record", F.to_csv(F.struct(*[F.col(f.name) for f in fields]))))
    return raw.select(*[typed(f) for f in fields], why.alias("reason"), record.alias("record"))


def read_jdbc(spark: SparkSession, url: str, table: str, *, partitions: int = 16, limit: int | None = None, **options: str) -> DataFrame:
    """A database table, read in `partitions` ranges of its numeric `id` (in any case), which becomes source_pk."""

    def scan(**more):
        return spark.read.format("jdbc").options(url=url, **options, **more).load()

    key = _key(scan(dbtable=table))
    quoted = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(key)
    low, high = scan(query=f"select min({quoted}) as lo, max({quoted}) as hi from {table}").first()
    bounds = {} if low is None else {"partitionColumn": quoted, "lowerBound": low, "upperBound": high + 1, "numPartitions": partitions}
    return _from_database(scan(dbtable=table, **bounds), limit)


def read_table(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """A Parquet copy of the database table."""
    return _from_database(spark.read.parquet(path), limit)


def _key(df: DataFrame) -> str:
    found = [c for c in df.columns if c.lower() == "id"]
    if not found:
        raise ValueError("the table has no column 'id'")
    return found[0]


def _from_database(df: DataFrame, limit: int | None) -> DataFrame:
    df = df.withColumnRenamed(_key(df), "source_pk")
    return df.limit(limit) if limit is not None else df


def read_listings(spark: SparkSession, source: str, **options) -> DataFrame:
    """By the name of the source: csv, parquet or jdbc."""
    readers = {"csv": read_csv, "parquet": read_table, "jdbc": read_jdbc}
    if source not in readers:
        raise ValueError(f"unknown source '{source}'; it is one of {sorted(readers)}")
    return readers[source](spark, **options)


def spread(df: DataFrame, per_core: int = 4) -> DataFrame:
    """Rows dealt out evenly over `per_core` tasks for each core, before costly work on each. A scan splits a table by bytes,
    so a small, well packed file of many rows would be one task's. The number is given, as Spark would join small parts."""
    return df.repartition(max(32, per_core * df.sparkSession.sparkContext.defaultParallelism))


def attach_source_pk(df: DataFrame) -> DataFrame:
    """source_pk as it is, else from id, else, with a warning, from listing_id."""
    if "source_pk" in df.columns:
        return df
    if "id" in df.columns:
        return df.withColumnRenamed("id", "source_pk")
    if "listing_id" in df.columns:
        warnings.warn("no source key: listing_id is used", stacklevel=2)
        return df.withColumn("source_pk", F.col("listing_id"))
    raise ValueError("no source_pk, id or listing_id")
