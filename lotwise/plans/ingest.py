"""Landed pages to the raw listings table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import numeric, text, web
from ..operators import features, rejects
from ..sources import sinks

TEXT_FIELDS = ["title", "brand", "model", "city", "fuel_type", "transmission", "color", "body_type", "description", "seller_comments", "registered_in", "assembly"]


def item_rules() -> dict[str, Column]:
    """What an item must have."""
    return {"no_id": F.col("listing_id").isNotNull() & (F.col("listing_id") != 0), "no_address": F.length(F.coalesce("ad_url", F.lit(""))) > 0}


def valid_items(items: DataFrame) -> DataFrame:
    """Items with an id and an address."""
    return items.filter(rejects.reason(item_rules()).isNull())


def split_items(items: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) items; the latter with the reason."""
    return rejects.split(items.withColumn("reason", rejects.reason(item_rules())), path)


def clean_items(items: DataFrame) -> DataFrame:
    """Text fields cleaned and numbers read out of their raw texts."""
    typed = {
        "year": numeric.clean_year(F.col("year_raw")),
        "mileage": numeric.clean_number(F.col("mileage_raw")),
        "engine_capacity": numeric.clean_number(F.col("engine_capacity_raw")).cast("double"),
        "price": numeric.clean_price(F.col("price_raw")),
    }
    return items.withColumns({c: text.clean_text(F.col(c)) for c in TEXT_FIELDS} | typed)


def items_to_listings(items: DataFrame, known: Sequence[str] = schema.FEAT) -> DataFrame:
    """The fixed columns and one boolean for each known feature."""
    return features.pivot_features(clean_items(valid_items(items)), known).select(*schema.ITEM_COLUMNS, *known)


def pages_to_listings(pages: DataFrame, known: Sequence[str] = schema.FEAT) -> DataFrame:
    return items_to_listings(web.extract_items(pages), known)


def merge_listings(table: sinks.SnapshotTable, listings: DataFrame, start, end, order: str | None = None) -> DataFrame:
    """Upserts a batch into the raw table and returns its run log, counted while the rows are written. Of several rows of an
    ad the latest by `order` counts."""
    one = sinks.latest(listings, "listing_id", order) if order else listings.dropDuplicates(["listing_id"])
    counts = table.write(one.withColumn("scrape_date", F.lit(end).cast("timestamp")), "upsert")
    return sinks.log_of(table.spark, counts, start, end)
