"""Features and price model as one saved artefact that scores raw ads, one or a stream of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..config import DEFAULTS, Settings
from ..functions import color, text
from ..operators import cleaning, market
from ..sources.readers import attach_source_pk
from ..sources.scratch import staged
from . import listings, price_model


class _TableWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        for name, table in self.stage.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/tables/{name}")


class _TableReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind({name: self.sparkSession.read.parquet(f"{path}/tables/{name}") for name in self.kind.NAMES})
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class _WithTables(Transformer, MLReadable, MLWritable):
    """A stage that saves tables beside its parameters."""

    NAMES: Sequence[str] = ()

    def __init__(self, tables: dict[str, DataFrame] | None = None):
        super().__init__()
        self.tables = tables or {}

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class RepairAds(_WithTables):
    """Blanks, electric engines, and body types by the saved labels of brand and model. No row is dropped: what can't be repaired
    stays null, for the model's own stages to fill."""

    NAMES = ("modes",)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = cleaning.fill_electric_engine(cleaning.fill_blank(dataset, schema.OPTIONAL_TEXT))
        return cleaning.fill_false(cleaning.fill_from_mode(df, "body_type", ["brand", "model"], modes=self.tables["modes"]))


class AdFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Colours and texts in standard form, flags, scores and numeric features: what an ad tells alone. The settings are
    parameters of the stage. Of a table each distinct text is put in standard form once, of a stream each row's."""

    km_per_year = Param(Params._dummy(), "km_per_year", "usual distance a year", TypeConverters.toFloat)
    fallback_year = Param(Params._dummy(), "fallback_year", "year of ads without a date", TypeConverters.toInt)

    def __init__(self, settings: Settings = DEFAULTS):
        super().__init__()
        self._setDefault(km_per_year=DEFAULTS.km_per_year, fallback_year=DEFAULTS.fallback_year)
        self._set(km_per_year=settings.km_per_year, fallback_year=settings.fallback_year)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        settings = Settings(**asdict(DEFAULTS) | {"km_per_year": self.getOrDefault(self.km_per_year), "fallback_year": self.getOrDefault(self.fallback_year)})
        columns = [c for c in schema.TEXT_COLUMNS if c in dataset.columns]
        df = text.standardize_text_columns(dataset, columns) if dataset.isStreaming else listings.standard_text(dataset, columns)(dataset, columns)
        return listings.row_features(df.withColumn("color", color.standardize_color(F.col("color"))), settings)


class CompareAds(_WithTables):
    """Comparisons with the segments and cities of the rows that the model learned from."""

    NAMES = ("segments", "cities")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = market.market_features(dataset, statistics=self.tables["segments"])
        # Each city stands once, as the optimizer is told: it leaves the join out where no column of it is read.
        return market.location_features(df, statistics=self.tables["cities"].dropDuplicates(["city"]))


def fit(raw: DataFrame, categories: Sequence[str], numbers: Sequence[str], settings: Settings = DEFAULTS, **model: int) -> PipelineModel:
    """Repair, features, saved statistics and a price model (`price_model.train`), learned from clean rows of `raw`, as one
    pipeline. It takes raw ads, with or without a price, as rows or as a stream, and adds all features and
    predicted_price; `price_model.save` and `load` keep it with its tables. Columns that hold the price are refused."""
    leaks = sorted({*categories, *numbers} & {schema.TARGET, *schema.ANALYSIS_ONLY})
    if leaks:
        raise ValueError(f"these columns hold the price or stem from it: {leaks}")
    ads = attach_source_pk(raw)
    modes = staged(cleaning.modes_of(cleaning.label_counts(ads, "body_type", ["brand", "model"]), ["brand", "model"]), "modes")
    # Read by statistics and by each pass of training: what these read, so that no other column is moved or made.
    read = {*market.SEGMENT, "city", schema.TARGET, "mileage", "equipment_score", *categories, *numbers}
    rows = listings.clean_columns(ads, read, settings, modes)
    texts = [c for c in schema.TEXT_COLUMNS if c in rows.columns]
    ready = staged(listings.standard_text(rows, texts)(rows, texts), "ready")
    segments, cities = listings.statistics_of(ready)
    stages = [RepairAds({"modes": modes}), AdFeatures(settings), CompareAds({"segments": segments, "cities": cities})]
    # Each pass of training looks segments and cities up only where it reads a comparison with them.
    rows = ready if {*categories, *numbers} <= {*ready.columns} else stages[2].transform(ready)
    trained = price_model.train(rows, categories, numbers, schema.TARGET, **model)
    return PipelineModel([*stages, *trained.stages])
