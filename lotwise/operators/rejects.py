"""Rows that a step turns away, kept with the reason."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

KEPT = "kept"


def reason(rules: Mapping[str, Column]) -> Column:
    """The first rule that a row breaks, null if none; a rule that is null is broken."""
    return F.coalesce(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()], F.lit(None).cast("string"))


def reason_counts(names: list[str]) -> list[Column]:
    """Counts of rows, kept rows and each reason's rows, for an observation."""
    return [F.count("*").alias("n_rows"), F.count_if(F.col("reason").isNull()).alias("n_kept"), *[F.count_if(F.col("reason") == n).alias(f"n_{n}") for n in names]]


def split(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) rows of a table with `reason`, which is null for rows to keep, written in one pass, apart by reason. The
    rejected keep their reason; reading either side reads its files alone."""
    kind = df.drop("reason").schema
    df.withColumn("reason", F.coalesce("reason", F.lit(KEPT))).write.partitionBy("reason").parquet(path)
    # An empty table has no folder of its own for a reason.
    rows = df.sparkSession.read.schema(kind.add("reason", "string")).option("basePath", path).parquet(path)
    return rows.filter(F.col("reason") == KEPT).drop("reason"), rows.filter(F.col("reason") != KEPT)


def counts_of(df: DataFrame, seen: Observation) -> DataFrame:
    """The counts that an observation took while `df`'s session wrote it, as a row."""
    found = seen.get
    return df.sparkSession.createDataFrame([tuple(found.values())], ", ".join(f"{c} long" for c in found))
