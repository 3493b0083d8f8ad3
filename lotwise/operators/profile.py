"""Counters of what cleaning changed, each in one pass over the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broken_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, n_failed): rows that fail each rule; one row can fail several."""
    one = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return one.unpivot([], list(rules), "rule", "n_failed")


def standardisation_counts(df: DataFrame, before: Column, after: Column, ignore_case: bool = False) -> DataFrame:
    """(n_changed, n_same, n_unknown) of a column and its standard form."""
    fold = F.lower if ignore_case else (lambda c: c)
    changed = fold(F.trim(F.coalesce(before, F.lit("")))) != fold(after)
    return df.agg(F.count_if(changed).alias("n_changed"), F.count_if(~changed).alias("n_same"), F.count_if(after == "Unknown").alias("n_unknown"))


def repair_counts(df: DataFrame, missing: Column, after: Column) -> DataFrame:
    """(n_filled, n_unknown) of a column after repair: rows that were missing and got a value, and those that found none."""
    return df.agg(F.count_if(missing & (after != "Unknown")).alias("n_filled"), F.count_if(missing & (after == "Unknown")).alias("n_unknown"))


def removal(before: DataFrame, after: DataFrame) -> DataFrame:
    """(n_before, n_after, percent_removed); an empty table has lost nothing."""
    n = before.agg(F.count("*").alias("n_before")).crossJoin(after.agg(F.count("*").alias("n_after")))
    return n.withColumn("percent_removed", F.coalesce(F.try_divide(F.col("n_before") - F.col("n_after"), F.col("n_before")) * 100, F.lit(0.0)))


def summary(df: DataFrame, means: list[str], flags: list[str]) -> DataFrame:
    return df.agg(*[F.avg(c).alias(f"avg_{c}") for c in means], *[F.count_if(F.col(c)).alias(f"n_{c}") for c in flags])


def max_key(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias(f"max_{column}"))


def distinct_counts(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    return df.agg((F.approx_count_distinct(column) if approximate else F.countDistinct(column)).alias(f"n_{column}"))
