"""Streams of landed rows: idempotent merges, run metrics and streaks that live across batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import streak
from ..sources import sinks
from ..sources.scratch import staged


def upsert_stream(stream: DataFrame, table: sinks.SnapshotTable, order: str, checkpoint: str, log_path: str | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """Merges every new row once and ends when none is left. Of a key's rows, in a batch and in the table, the one of the
    greatest `order` stays, so rows may come late.

    The table's version holds the number of its last batch, so a batch that is run again after a failure is either merged
    whole or, if its version was made, not at all; its log is written before that version and then stays as it is."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        def log(counts: dict[str, int]) -> None:
            row = (counts["new"] + counts["updated"] + counts["late"], counts["new"], counts["updated"], counts["late"], batch_id)
            table.spark.createDataFrame([row], "ads_scraped long, new_ads long, updated_ads long, late_ads long, batch_id long").write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")

        if not table.applied((checkpoint, batch_id)):
            rows = sinks.latest(prepare(batch) if prepare else batch, table.key, order)
            table.write(rows, "upsert", newer=order, batch=(checkpoint, batch_id), on_counts=log if log_path else None)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


STREAKS = f"feed string, summary {streak.SUMMARY}, seen timestamp"


def streak_stream(stream: DataFrame, table: sinks.SnapshotTable, hit: Column, feed: str, order: list[str], checkpoint: str):
    """Keeps each feed's run summary in a table of STREAKS with the key `feed`, and ends when no row is left.

    A batch's rows are summed up by `streak.summaries`, where a feed of any size spreads over tasks, and one row a feed is
    joined to the state. Batches come in the order of their rows. The table holds the number of its last batch, so a batch
    that is run again changes nothing. Null feeds are a feed; an empty batch changes nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        if table.applied((checkpoint, batch_id)):
            return
        rows = batch.withColumn("_feed", F.col(feed).cast("string")).select("_feed", *order, F.coalesce(hit, F.lit(False)).alias("_is_hit"))
        new = staged(streak.summaries(rows, F.col("_is_hit"), order, ["_feed"]).withColumnRenamed("_feed", "feed"), "streaks")
        old = table.rows_of(new.select("feed")).select(F.col("feed").alias("_old"), F.col("summary").alias("_before"))
        both = new.join(old, new["feed"].eqNullSafe(old["_old"]), "left")
        merged = both.select("feed", F.when(F.col("_before").isNull(), F.col("summary")).otherwise(streak.joined(F.col("_before"), F.col("summary"))).alias("summary"), F.current_timestamp().alias("seen"))
        table.write(merged, "upsert", batch=(checkpoint, batch_id))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def streaks_of(table: sinks.SnapshotTable, limit: int) -> DataFrame:
    """(feed, streak, cut_off): the run of hits at a feed's end, and whether any run has reached `limit`."""
    return table.read().select("feed", F.col("summary.tail").alias("streak"), (F.col("summary.longest") >= limit).alias("cut_off"))


def forget_feeds(table: sinks.SnapshotTable, before) -> dict[str, int] | None:
    """Drops the state of feeds that no batch has had rows of since `before`."""
    idle = staged(table.read().filter(F.col("seen") < F.lit(before).cast("timestamp")).select("feed"), "idle")
    return table.write(table.spark.createDataFrame([], STREAKS), "upsert", keys=idle)
