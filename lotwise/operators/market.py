"""Comparisons of each row with its segment and its city."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..lookups import LARGE_CITIES
from ..sources.scratch import staged

SEGMENT = ("brand", "model", "year")
#: Distinct prices of a segment whose median one task finds.
MAX_IN_TASK = 1_000_000


def price_points(df: DataFrame, keys: Sequence[str] = SEGMENT, price: str = "price", mileage: str = "mileage", score: str = "equipment_score") -> DataFrame:
    """(keys, price, n, and counts and sums of mileage and score): a row for each segment and price, rows with a null key left
    out. All that `statistics_of_points` needs, and additive: the points of two tables are those of both, summed, and a row
    that goes takes its own off again (`added`)."""
    for column in (*keys, price, mileage, score):
        if column not in df.columns:
            raise ValueError(f"segment statistics need the column '{column}'")
    return df.select(*keys, F.col(price).alias("price"), F.col(mileage).alias("_mileage"), F.col(score).alias("_score")).dropna(subset=list(keys)).groupBy(*keys, "price").agg(
        F.count("*").alias("n"), F.count("_mileage").alias("n_mileage"), F.sum("_mileage").alias("mileage"), F.count("_score").alias("n_score"), F.sum("_score").alias("score"),
    )


def city_points(df: DataFrame, city: str = "city", price: str = "price") -> DataFrame:
    """(city, n, n_price, total), additive; rows without a city left out."""
    return df.select(F.col(city).alias("city"), F.col(price).alias("_price")).dropna(subset=["city"]).groupBy("city").agg(F.count("*").alias("n"), F.count("_price").alias("n_price"), F.sum("_price").alias("total"))


def negated(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Points to take off: all counts and sums with the other sign."""
    return points.select(*keys, *[(-F.col(c)).alias(c) for c in points.columns if c not in keys])


def added(points: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Points after a signed change; what has come down to no rows is gone."""
    sums = [F.sum(c).alias(c) for c in points.columns if c not in keys]
    return points.unionByName(delta.select(*points.columns)).groupBy(*keys).agg(*sums).filter("n <> 0")


def _variance(total: Column, squares: Column, n: Column, whole: bool) -> Column:
    """Sample variance from sums. Of whole numbers the sums are exact: total**2 / n is taken off in integers but for the
    remainder of total by n, so that no digits cancel out."""
    if not whole:
        return F.when(n > 1, F.greatest((squares - total * (total / n)) / (n - 1), F.lit(0.0)))
    q, r = F.expr("_total div _n"), F.expr("_total % _n")
    exact = (squares - q.cast("decimal(38,0)") * (total + r)).cast("double")
    return F.try_divide(exact - r.cast("double") * F.try_divide(r.cast("double"), n), n - 1)


def statistics_of_points(points: DataFrame, keys: Sequence[str] = SEGMENT, most: int = MAX_IN_TASK) -> DataFrame:
    """One row per segment: the dimension that comparisons, scoring and increments read. `points` are read three times, and
    best written before.

    Averages and deviations are sums of partial sums. A segment of up to `most` distinct prices has its median from their
    counts in one task; the prices of a larger one are sorted over many tasks (`_medians_of_ranges`)."""
    whole = points.schema["price"].dataType.typeName() != "double"
    kind = "decimal(38,0)" if whole else "double"
    n = F.when(F.col("price").isNotNull(), F.col("n"))
    p, w = F.col("price").cast(kind), n.cast(kind)
    sums = [
        F.sum(n).alias("_n"), F.sum((p * w).cast(kind)).alias("_total"), F.sum((p * p * w).cast(kind)).alias("_squares"), F.sum("n_mileage").alias("_n_mileage"),
        F.sum("mileage").alias("_mileage"), F.sum("n_score").alias("_n_score"), F.sum("score").alias("_score"),
    ]
    hot = points.groupBy(*keys).count().filter(F.col("count") > most).drop("count")
    median = F.expr("percentile(price, 0.5, n)").cast("double").alias("market_median_price")
    if not hot.isEmpty():
        small = points.join(hot, list(keys), "left_anti").groupBy(*keys).agg(median)
        medians = small.unionByName(_medians_of_ranges(points.join(hot, list(keys), "left_semi"), keys))
        stats = points.groupBy(*keys).agg(*sums).join(medians, list(keys), "left")
    else:
        stats = points.groupBy(*keys).agg(*sums, median)
    total, count = F.col("_total").cast("double"), F.col("_n").cast("double")
    return stats.select(
        *keys,
        F.try_divide(total, count).alias("market_avg_price"),
        "market_median_price",
        F.sqrt(_variance(F.col("_total"), F.col("_squares"), count, whole)).alias("market_std_price"),
        F.coalesce("_n", F.lit(0)).alias("market_listing_count"),
        F.try_divide(F.col("_mileage").cast("double"), F.col("_n_mileage")).alias("market_avg_mileage"),
        F.try_divide(F.col("_score").cast("double"), F.col("_n_score")).alias("market_avg_equipment_score"),
    )


def _medians_of_ranges(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact medians of segments of any size. Prices are dealt out in ranges of (segment, price); counts of the ranges, a row
    for each and segment, tell which range holds a middle row and how many of the segment lie before it; only these
    ranges are then looked into, each by itself."""
    ranged = staged(points.filter("price is not null").select(*keys, "price", "n").repartitionByRange(*keys, "price").withColumn("_range", F.spark_partition_id()), "ranges")
    along = Window.partitionBy(*keys).orderBy("_range")
    counted = ranged.groupBy(*keys, "_range").agg(F.sum("n").alias("_n"))
    placed = counted.withColumn("_before", F.sum("_n").over(along) - F.col("_n")).withColumn("_all", F.sum("_n").over(Window.partitionBy(*keys)))
    middle = placed.withColumn("_at", F.explode(F.array_distinct(F.array(F.expr("(_all - 1) div 2"), F.expr("_all div 2"))))).filter("_at >= _before and _at < _before + _n")
    wanted = middle.select(*keys, "_range", (F.col("_at") - F.col("_before")).alias("_at"))
    inside = ranged.join(wanted.select(*keys, "_range").distinct(), [*keys, "_range"], "left_semi")
    upto = inside.withColumn("_upto", F.sum("n").over(Window.partitionBy(*keys, "_range").orderBy("price")))
    found = upto.join(wanted, [*keys, "_range"]).filter("_at < _upto and _at >= _upto - n")
    return found.groupBy(*keys).agg(F.avg(F.col("price").cast("double")).alias("market_median_price"))


def segment_statistics(df: DataFrame, keys: Sequence[str] = SEGMENT, price: str = "price", mileage: str = "mileage", score: str = "equipment_score", most: int = MAX_IN_TASK) -> DataFrame:
    """Statistics of each segment of `df` (see `statistics_of_points`), by way of its points, written once."""
    return statistics_of_points(staged(price_points(df, keys, price, mileage, score), "points"), keys, most)


def comparisons(price: Column, mileage: Column, score: Column) -> dict[str, Column]:
    mean = F.col("market_avg_price")
    return {
        "market_price_difference": price - mean,
        "market_price_ratio": ratio(price, mean),
        "percent_below_market": ratio(mean - price, mean) * 100,
        "mileage_difference": mileage - F.col("market_avg_mileage"),
        "better_equipped_than_average": F.coalesce(score > F.col("market_avg_equipment_score"), F.lit(False)),
    }


def market_features(df: DataFrame, keys: Sequence[str] = SEGMENT, price: str = "price", mileage: str = "mileage", score: str = "equipment_score", statistics: DataFrame | None = None) -> DataFrame:
    """`df` with its segment's statistics and its own distance from them. Statistics come from narrow rows and are joined
    back (or given, saved by an earlier run), so wide rows are moved at most once and rows with a null key keep nulls."""
    stats = statistics if statistics is not None else segment_statistics(df, keys, price, mileage, score)
    return df.join(stats, list(keys), "left").withColumns(comparisons(F.col(price), F.col(mileage), F.col(score)))


def segment_counts(df: DataFrame, keys: Sequence[str] = SEGMENT) -> DataFrame:
    """(segments, singletons)."""
    return df.groupBy(*keys).count().agg(F.count("*").alias("segments"), F.count_if(F.col("count") == 1).alias("singletons"))


def city_statistics(df: DataFrame, city: str = "city", price: str = "price") -> DataFrame:
    return statistics_of_cities(city_points(df, city, price)).withColumnRenamed("city", city)


def statistics_of_cities(points: DataFrame) -> DataFrame:
    return points.select("city", F.try_divide(F.col("total").cast("double"), F.col("n_price")).alias("city_avg_price"), F.col("n_price").alias("city_listing_count"), F.col("total").alias("_total"))


def location_features(df: DataFrame, city: str = "city", price: str = "price", large: Sequence[str] = LARGE_CITIES, leave_one_out: bool = False, statistics: DataFrame | None = None) -> DataFrame:
    """City size, mean price and count, from `statistics` where an earlier run saved them. The mean includes the row itself,
    which leaks a target into small cities; `leave_one_out` takes it out (null for the only row)."""
    joined = df.join(statistics if statistics is not None else city_statistics(df, city, price), city, "left").withColumn("is_large_city", F.coalesce(F.col(city).isin(*large), F.lit(False)))
    if leave_one_out:
        own = F.col(price).isNotNull().cast("int")
        joined = joined.withColumn("city_avg_price", ratio(F.col("_total") - F.coalesce(price, F.lit(0)), F.col("city_listing_count") - own))
    return joined.drop("_total")


def best_deals(df: DataFrame, by: str = "percent_below_market", top: int = 20, per: Sequence[str] = (), tie: Sequence[str] = ()) -> DataFrame:
    """The `top` rows furthest below market, of all or of each group in `per`."""
    order = [F.desc_nulls_last(by), *tie]
    if not per:
        return df.orderBy(*order).limit(top)
    return df.withColumn("deal_rank", F.row_number().over(Window.partitionBy(*per).orderBy(*order))).filter(F.col("deal_rank") <= top)


def flag_totals(df: DataFrame, flags: Mapping[str, object] | Sequence[str]) -> DataFrame:
    """(flag, hits) of boolean columns, in one pass."""
    names = list(flags)
    one = df.agg(*[F.count_if(F.col(c)).alias(c) for c in names])
    return one.unpivot([], names, "flag", "hits")


def top_flags(df: DataFrame, flags: Sequence[str], top: int = 5) -> DataFrame:
    return flag_totals(df, flags).orderBy(F.desc("hits"), "flag").limit(top)
