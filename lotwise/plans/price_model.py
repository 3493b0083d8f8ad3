"""Fair prices by a random forest over the leakage-screened columns, and deals by their distance from them."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows that one task of a tree's training holds at most, each as a number of a few bytes for every feature.
ROWS_IN_TASK = 500_000


def encoders(df: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> PipelineModel:
    """The stages in front of the trees, which give `features`."""
    as_numbers = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `{c}_number`" for c in numbers)
    stages = [
        SQLTransformer(statement=f"SELECT *, {as_numbers} FROM __THIS__"),
        StringIndexer(inputCols=list(categories), outputCols=[f"{c}_index" for c in categories], handleInvalid="keep", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=[f"{c}_index" for c in categories], outputCols=[f"{c}_one" for c in categories], handleInvalid="keep"),
        Imputer(inputCols=[f"{c}_number" for c in numbers], outputCols=[f"{c}_full" for c in numbers], strategy="median"),
        VectorAssembler(inputCols=[*[f"{c}_one" for c in categories], *[f"{c}_full" for c in numbers]], outputCol="features"),
    ]
    if not categories:
        stages = [stages[0], *stages[3:]]
    return Pipeline(stages=stages).fit(df)


def trees_of(target: str = "price", *, trees: int = 20, depth: int = 8, max_categories: int = 128, seed: int = 7) -> DecisionTreeRegressor | RandomForestRegressor:
    tree = {"featuresCol": "features", "labelCol": target, "predictionCol": "predicted_price", "maxDepth": depth, "maxBins": max_categories, "seed": seed}
    return DecisionTreeRegressor(**tree) if trees == 1 else RandomForestRegressor(numTrees=trees, **tree)


def dealt(rows: DataFrame, n: int, most: int = ROWS_IN_TASK) -> DataFrame:
    """The `n` rows of a scan, dealt over so many tasks that none gets more than about `most`: a scan splits a table by bytes, and
    well packed rows are many times as large once they are features. As they stand, if their tasks are enough."""
    return rows.repartition(-(-n // most)) if n > most * rows.rdd.getNumPartitions() else rows


def train(df: DataFrame, categories: Sequence[str], numbers: Sequence[str], target: str = "price", **settings: int) -> PipelineModel:
    """Categories are indexed by frequency (unseen ones get a place of their own), numbers (flags too) imputed by their median.
    `settings` are those of `trees_of`; one tree is a plain regression tree over all rows. The target is not read when the model
    scores. What training reads of `df` is kept while it runs, as it is read in several passes."""
    rows = df.select(*dict.fromkeys([*categories, *numbers, target])).persist()
    try:
        made = encoders(rows, categories, numbers)
        tree = trees_of(target, **settings).fit(dealt(made.transform(rows).select("features", target), rows.count()))
        return PipelineModel([*made.stages, tree])
    finally:
        rows.unpersist()


def save(model: PipelineModel, path: str) -> None:
    """The model with its encoders, in a folder that `load` reads; an older one there is replaced."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, target: str = "price") -> DataFrame:
    """`df` with predicted_price and, where it has a price, price_difference, the asked minus the fair price; works on one row or
    a stream."""
    out = model.transform(df).select(*df.columns, "predicted_price")
    return out.withColumn("price_difference", F.col(target) - F.col("predicted_price")) if target in df.columns else out


def place_of(key: str) -> Column:
    """0 to 99, by the key alone."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long") % 100


def split_by_key(df: DataFrame, key: str, percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """(training, test) rows: a key's side depends on the key alone, so an ad never changes sides between runs."""
    marked = df.withColumn("_place", place_of(key))
    return marked.filter(F.col("_place") >= percent).drop("_place"), marked.filter(F.col("_place") < percent).drop("_place")


def metrics(scored: DataFrame, slices: Sequence[str] = (), target: str = "price", predicted: str = "predicted_price") -> DataFrame:
    """(slice, value, n, rmse, mae, r2) of all rows (slice "all") and of each value of each column in `slices`, in one aggregate.
    Rows without a price or a prediction are left out; r2 is null where the price doesn't vary."""
    rows = scored.select(F.col(target).cast("double").alias("_y"), F.col(predicted).cast("double").alias("_p"), *slices).dropna(subset=["_y", "_p"])
    parts = [F.struct(F.lit("all").alias("slice"), F.lit(None).cast("string").alias("value")), *[F.struct(F.lit(c).alias("slice"), F.col(c).cast("string").alias("value")) for c in slices]]
    error = F.col("_y") - F.col("_p")
    sums = rows.select("_y", "_p", F.explode(F.array(*parts)).alias("_s")).groupBy("_s").agg(
        F.count("*").alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("_mse"), F.var_pop("_y").alias("_var"),
    )
    return sums.select("_s.slice", "_s.value", "n", "rmse", "mae", (1 - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2"))


def select_model(df: DataFrame, categories: Sequence[str], numbers: Sequence[str], grid: Sequence[Mapping[str, int]], key: str, target: str = "price", percent: int = 20, metric: str = "rmse") -> tuple[PipelineModel, DataFrame]:
    """The model of the `grid` (settings of `train`) that does best on held-out keys, fitted on the others, and the metrics of
    all of them. The split is by key (as `split_by_key`), so no ad stands on both sides; held-out rows are scored once a model.
    `df` is read once for both sides, and dealt over tasks before its rows grow to features. Settings are of trees alone, so rows
    are encoded once for all models."""
    read = list(dict.fromkeys([*categories, *numbers, target]))
    kept = [df.select(*read, (place_of(key) < percent).alias("_held")).persist()]
    try:
        sides = [kept[0].filter(side).select(*read) for side in ("not _held", "_held")]
        made = encoders(sides[0], categories, numbers)
        training, test = (made.transform(side).select("features", target) for side in (dealt(sides[0], sides[0].count()), sides[1]))
        kept.append(training.persist())
        best, tried = None, []
        for n, setting in enumerate(grid):
            tree = trees_of(target, **setting).fit(training)
            row = metrics(tree.transform(test), target=target).first()
            tried.append((n, json.dumps(dict(setting)), row["n"], row["rmse"], row["mae"], row["r2"]))
            value = -row[metric] if metric == "r2" else row[metric]
            if best is None or value < best[0]:
                best = (value, tree)
        return PipelineModel([*made.stages, best[1]]), df.sparkSession.createDataFrame(tried, "model int, setting string, n long, rmse double, mae double, r2 double")
    finally:
        for rows in kept:
            rows.unpersist()


def evaluate(scored: DataFrame, target: str = "price") -> dict[str, float]:
    typed = scored.withColumn(target, F.col(target).cast("double"))
    return {m: RegressionEvaluator(labelCol=target, predictionCol="predicted_price", metricName=m).evaluate(typed) for m in ("rmse", "mae", "r2")}


def error_by_market_distance(scored: DataFrame, target: str = "price", distance: str = "percent_below_market") -> DataFrame:
    """Mean absolute error by how far the asked price is below the market, in steps of 10 percent."""
    error = F.abs(F.col(target) - F.col("predicted_price"))
    return scored.groupBy((F.floor(F.col(distance) / 10) * 10).alias("bucket")).agg(F.count("*").alias("n"), F.avg(error).alias("mae"))
