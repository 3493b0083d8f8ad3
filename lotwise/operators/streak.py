"""Runs of consecutive rows, such as known ads in a row on a feed or refused requests in a row in a log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import staged


def _ranged(df: DataFrame, hit: Column, order: Sequence[str], per: Sequence[str]) -> DataFrame:
    """Rows written sorted in ranges of (per, order), with `_hit`, `_range` and `_run`, the misses of the range up to the row."""
    marked = df.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    ranged = staged(marked.repartitionByRange(*per, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    return ranged.withColumn("_run", F.sum((~F.col("_hit")).cast("int")).over(Window.partitionBy(*per, "_range").orderBy(*order)))


def streaks(df: DataFrame, hit: Column, order: Sequence[str], per: Sequence[str] = ()) -> DataFrame:
    """`df` with `streak`: how many rows up to this one hit in a row, 0 where it does not.

    Rows are written sorted in ranges of (per, order), so a feed of any size spreads over many tasks. Streaks are counted
    inside each range; what one range carries into the next, a row at most for each range, is added to its first run. The
    order must tell the rows of a feed apart. Null feeds are feeds; a null hit is none; an empty table stays empty."""
    misses = F.sum((~F.col("_hit")).cast("int"))
    runs = _ranged(df, hit, order, per)
    counted = runs.withColumn("streak", F.sum(F.col("_hit").cast("int")).over(Window.partitionBy(*per, "_range", "_run").orderBy(*order)))
    ends = counted.groupBy(*per, "_range").agg(misses.alias("_misses"), F.max_by("streak", F.struct(*order)).alias("_tail"))
    along = Window.partitionBy(*per).orderBy("_range")
    group = ends.withColumn("_group", F.sum((F.col("_misses") > 0).cast("int")).over(along))
    sums = group.withColumn("_sum", F.sum("_tail").over(Window.partitionBy(*per, "_group").orderBy("_range")))
    into = sums.withColumn("_carried", F.lag("_sum").over(along)).filter("_carried > 0")
    into = F.broadcast(into.select(*[F.col(c).alias(f"_k{k}") for k, c in enumerate(per)], F.col("_range").alias("_kr"), "_carried"))
    same = reduce(lambda a, b: a & b, [counted[c].eqNullSafe(into[f"_k{k}"]) for k, c in enumerate(per)], counted["_range"] == into["_kr"])
    carried = F.when(F.col("_hit") & (F.col("_run") == 0), F.coalesce("_carried", F.lit(0))).otherwise(0)
    return counted.join(into, same, "left").select(*df.columns, (F.col("streak") + carried).alias("streak"))


SUMMARY = "struct<n:bigint,head:bigint,tail:bigint,longest:bigint,missed:boolean>"


def joined(a: Column, b: Column) -> Column:
    """The summary of rows in order from those of a first and a second part. A summary has the number of rows, the hits
    before the first miss and after the last one (all rows, without a miss), the longest run, and whether any row missed."""
    return F.struct(
        (a["n"] + b["n"]).alias("n"),
        F.when(a["missed"], a["head"]).otherwise(a["n"] + b["head"]).alias("head"),
        F.when(b["missed"], b["tail"]).otherwise(a["tail"] + b["n"]).alias("tail"),
        F.greatest(a["longest"], b["longest"], a["tail"] + b["head"]).alias("longest"),
        (a["missed"] | b["missed"]).alias("missed"),
    ).cast(SUMMARY)


def summaries(df: DataFrame, hit: Column, order: Sequence[str], per: Sequence[str]) -> DataFrame:
    """(per, summary) of each feed's rows in their order (see `joined`). Runs are counted inside ranges of the sorted rows, so a
    feed of any size spreads over many tasks; what is put together is a row a range."""
    runs = _ranged(df, hit, order, per).groupBy(*per, "_range", "_run").agg(F.count("*").alias("_n"), F.count_if("_hit").alias("_hits"))
    parts = runs.groupBy(*per, "_range").agg(
        F.sum("_n").alias("n"), F.coalesce(F.max(F.when(F.col("_run") == 0, F.col("_hits"))), F.lit(0)).alias("head"), F.max_by("_hits", "_run").alias("tail"),
        F.max("_hits").alias("longest"), (F.max("_run") > 0).alias("missed"),
    )
    listed = parts.groupBy(*per).agg(F.sort_array(F.collect_list(F.struct("_range", F.struct("n", "head", "tail", "longest", "missed").cast(SUMMARY).alias("s")))).alias("_parts"))
    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("head"), F.lit(0).alias("tail"), F.lit(0).alias("longest"), F.lit(False).alias("missed")).cast(SUMMARY)
    return listed.select(*per, F.aggregate("_parts", nothing, lambda a, x: joined(a, x["s"])).alias("summary"))


def first_cutoff(df: DataFrame, hit: Column, order: Sequence[str], per: Sequence[str], limit: int) -> DataFrame:
    """Per feed, the first row at which `limit` rows in a row have hit: where a catch-up run may stop."""
    rest = [c for c in df.columns if c not in per]
    at = streaks(df, hit, order, per).filter(F.col("streak") >= limit)
    best = at.groupBy(*per).agg(F.min_by(F.struct(*rest, "streak"), F.struct(*order)).alias("_first"))
    return best.select(*per, "_first.*").select(*df.columns, "streak")
