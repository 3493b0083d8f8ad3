"""Raw listings to the processed table: clean, derive, compare, project."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import lookups, schema
from ..config import DEFAULTS, Settings
from ..functions import color, flags, numeric, text
from ..operators import cleaning, features, market, rejects
from ..sources.readers import attach_source_pk
from ..sources.scratch import shares, staged

#: Distinct values of all text columns that are broadcast at most.
MAX_VALUES = 200_000


def clean_nulls(df: DataFrame, modes: DataFrame | None = None) -> DataFrame:
    """Electric engines, body types from the commonest of brand and model, unfeatured ads, then rows with any null go."""
    df = cleaning.fill_electric_engine(df)
    df = cleaning.fill_from_mode(df, "body_type", ["brand", "model"], modes=modes)
    return cleaning.drop_null_rows(cleaning.fill_false(df))


def clean_duplicates_and_impossibles(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The first row of each listing, then rows that break no rule: a bad first duplicate takes the others with it."""
    return cleaning.drop_impossible(cleaning.keep_first(df, ["listing_id"], ["source_pk"]), settings=settings)


def clean_rows(df: DataFrame, settings: Settings = DEFAULTS, modes: DataFrame | None = None) -> DataFrame:
    """Clean rows with colours as they were, written once: repair reads the input twice (narrow, for body types, and whole),
    and everything after it reads the written rows. Many ads are moved in shares, one after the other, and flags as bits. `modes`
    are body types by brand and model of a larger table."""
    packed, unpacked, _ = flags.packed_flags(clean_nulls(cleaning.fill_blank(df, schema.OPTIONAL_TEXT), modes))
    n = shares(df)
    of = [packed] if n == 1 else [packed.filter(F.pmod(F.xxhash64("listing_id"), F.lit(n)) == k) for k in range(n)]
    return staged([unpacked(clean_duplicates_and_impossibles(some, settings)) for some in of], "clean")


def clean_columns(df: DataFrame, columns: Collection[str], settings: Settings = DEFAULTS, modes: DataFrame | None = None) -> DataFrame:
    """Those of `columns` that clean rows have, written once, with what a row tells alone (`row_features`, standard colours) but texts as they
    were. Rules and features are told where a row is read, so that it is moved and sorted with these columns alone. A repaired body
    type is never null, so it turns no row away and is not looked up unless it is one of them."""
    rows = cleaning.fill_blank(df, schema.OPTIONAL_TEXT)
    whole = clean_nulls(rows, modes) if "body_type" in columns else cleaning.drop_null_rows(cleaning.fill_false(cleaning.fill_electric_engine(rows.drop("body_type"))))
    marked = whole.withColumn("_possible", cleaning.is_possible(cleaning.listing_rules(settings)))
    built = row_features(marked.withColumn("color", color.standardize_color(F.col("color"))), settings)
    moved = {*columns, "listing_id", "source_pk", "_possible"}
    first = cleaning.keep_first(built.select(*[c for c in built.columns if c in moved]), ["listing_id"], ["source_pk"])
    return staged(first.filter("_possible").select(*[c for c in built.columns if c in columns]), "clean")


def clean_with_rejects(df: DataFrame, path: str, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame, Observation]:
    """`clean_rows`, the rows that it turns away with their reasons, and counts of both and of repaired body types, all from
    the one pass that writes them. Kept and rejected rows are those of `df`. Flags are moved as bits."""
    seen = Observation()
    lacked = cleaning.is_missing_label(F.col("body_type")).alias("_lacked")
    rows = cleaning.fill_blank(df, schema.OPTIONAL_TEXT)
    modes = cleaning.modes_of(cleaning.label_counts(rows, "body_type", ["brand", "model"]), ["brand", "model"])
    marked, unpacked, there = flags.packed_flags(cleaning.fill_false(cleaning.fill_electric_engine(rows)).select("*", lacked))
    full = cleaning.fill_from_mode(marked, "body_type", ["brand", "model"], modes=modes)
    rules = cleaning.listing_rules(settings)
    told = unpacked(cleaning.cleaning_reason(full, ["listing_id"], ["source_pk"], rules, there))
    unknown = F.col("body_type") == "Unknown"
    repaired = [F.count_if(F.col("_lacked") & ~F.coalesce(unknown, F.lit(False))).alias("n_filled"), F.count_if(F.col("_lacked") & unknown).alias("n_unknown")]
    kept, rejected = rejects.split(told.observe(seen, *rejects.reason_counts(["null_value", "duplicate", *rules]), *repaired).drop("_lacked"), path)
    return kept, rejected, seen


def clean_listings(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """No rule looks at a colour, so colours come last, from one narrow pass over the rows that are left."""
    return color.clean_color_column(clean_rows(df, settings)).drop("color").withColumnRenamed("color_clean", "color")


def standard_text(df: DataFrame, columns: Sequence[str] = schema.TEXT_COLUMNS, most: int = MAX_VALUES) -> Callable[[DataFrame, Sequence[str]], DataFrame]:
    """A function that puts columns of `df`, or of parts of it, in standard form. The rules run once for each distinct value,
    in a written table that is broadcast while it has at most `most` rows; beyond, they run on every row."""
    values = staged(text.standard_values(df, columns), "values")
    if values.count() > most:
        return text.standardize_text_columns
    return lambda rows, some: text.with_standard_values(rows, some, values)


def row_features(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """What a row with standard text tells alone; flags come before scores."""
    df = text.keyword_flags(df, lookups.SELLER_PHRASES | lookups.CONTAINS_PHRASES)
    df = features.add_scores(df, schema.SCORES | schema.SELLER_SCORES)
    date = F.col("scrape_date") if "scrape_date" in df.columns else None
    return df.withColumns(numeric.numeric_features(F.col("year"), F.col("mileage"), F.col("engine_capacity"), F.col("price"), date, settings))


def with_equipment_score(df: DataFrame) -> DataFrame:
    return features.add_scores(df, {"equipment_score": schema.SCORES["equipment_score"]})


def compared(df: DataFrame) -> DataFrame:
    """What segments and cities are made of. The score is counted before texts are joined, so that flags do not pass the joins."""
    return with_equipment_score(df).select(*market.SEGMENT, "city", "price", "mileage", "equipment_score")


def statistics_of(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segments, cities) of rows with standard text, written once: what later runs read to score single ads."""
    df = df if "equipment_score" in df.columns else compared(df)
    return staged(market.segment_statistics(df), "segments"), staged(market.city_statistics(df), "cities")


def build_features(df: DataFrame, settings: Settings = DEFAULTS, include_log_price: bool = False, statistics: tuple[DataFrame, DataFrame] | None = None, standard: bool = False) -> DataFrame:
    """All derived columns. Standard text (`standard`: the rows have it) comes before what groups by it. Segments and cities
    are compared with their own rows, or with `statistics` (segments, cities) that an earlier run saved, so that one ad or
    a stream of them gets the same columns."""
    df = df if standard else text.standardize_text_columns(df, schema.TEXT_COLUMNS)
    segments, cities = statistics or statistics_of(df)
    df = market.location_features(market.market_features(row_features(df, settings), statistics=segments), statistics=cities)
    log_price = F.log1p(F.greatest("price", F.lit(0))) if include_log_price else F.lit(None).cast("double")
    return df.withColumn("log_price", log_price)


def select_processed(df: DataFrame, columns: list[str] = schema.PROCESSED) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def process_listings(raw: DataFrame, settings: Settings = DEFAULTS, include_log_price: bool = False, rows: DataFrame | None = None) -> DataFrame:
    """End to end. The processed listing_id is the raw table's own key, not the ad's number. `rows` are clean rows that were
    written before (`clean_with_rejects`)."""
    rows = rows if rows is not None else clean_rows(attach_source_pk(raw), settings)
    standard = standard_text(rows)
    statistics = statistics_of(standard(compared(rows), [*market.SEGMENT[:2], "city"]))  # before colours, which they do not need
    df = color.clean_color_column(rows).drop("color").withColumnRenamed("color_clean", "color")
    df = build_features(standard(df, schema.TEXT_COLUMNS), settings, include_log_price, statistics, standard=True)
    return select_processed(df.drop("listing_id").withColumnRenamed("source_pk", "listing_id"))


def refresh_segments(raw: DataFrame, changed: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Processed rows to merge after some raw rows changed (`changed`: brand, model, year and city of rows before and
    after, in standard form): those of every touched segment or city, rebuilt. Features are built for these rows alone, and
    statistics for their segments and cities, but all raw rows are cleaned first: this keeps no state. `store.ListingStore`
    does, and reads the changed ads alone."""
    rows = clean_rows(attach_source_pk(raw), settings)
    ready = standard_text(rows)(rows, schema.TEXT_COLUMNS)
    # What is looked up is written first, so that its size is known when a join is planned: while it is small, no ad is moved.
    changed = staged(changed.select(*market.SEGMENT, "city").distinct(), "changed")
    in_segment = staged(changed.select(*market.SEGMENT).distinct().withColumn("_segment", F.lit(True)), "in_segment")
    in_city = staged(changed.select("city").distinct().withColumn("_city", F.lit(True)), "in_city")
    marked = ready.join(in_segment, list(market.SEGMENT), "left").join(in_city, "city", "left")
    touched = staged(marked.filter("_segment or _city").drop("_segment", "_city"), "touched")
    narrow = with_equipment_score(ready).select(*market.SEGMENT, "city", "price", "mileage", "equipment_score")
    their_segments, their_cities = staged(touched.select(*market.SEGMENT).distinct(), "segments"), staged(touched.select("city").distinct(), "cities")
    segments = staged(market.segment_statistics(narrow.join(their_segments, list(market.SEGMENT), "left_semi")), "segments")
    cities = staged(market.city_statistics(narrow.join(their_cities, "city", "left_semi")), "cities")
    colored = color.clean_color_column(touched).drop("color").withColumnRenamed("color_clean", "color")
    built = build_features(colored, settings, statistics=(segments, cities), standard=True)
    return select_processed(built.drop("listing_id").withColumnRenamed("source_pk", "listing_id"))
