"""What the reviewer's projections to 6 GB led to."""

from lotwise import queries, schema
from lotwise.functions import web
from lotwise.operators import cleaning
from lotwise.plans import artefact, listings, price_model
from lotwise.sources import scratch
from pyspark.sql import functions as F


def test_training_moves_only_the_columns_it_reads(spark, monkeypatch):
    """rules and scores are told where a raw row is read; nothing else of it is written."""
    made = {}
    for module in (listings, artefact, cleaning):
        monkeypatch.setattr(module, "staged", lambda df, name: made.setdefault(name, scratch.staged(df, name)))
    artefact.fit(queries.raw_view(spark, "/root/testdata/sf0.001"), [], ["mileage"], trees=1, depth=1)
    assert set(made["clean"].columns) == {"brand", "model", "year", "city", "mileage", "price", "equipment_score"}


def test_clean_columns_are_those_of_clean_rows(spark):
    """a bad first duplicate takes the others with it, and a null in a column that isn't kept drops its row."""
    raw = queries.raw_view(spark, "/root/testdata/sf0.001").withColumnRenamed("id", "source_pk")
    raw = raw.withColumns({"price": F.when(F.col("source_pk") % 31 == 0, 0).otherwise(F.col("price")), "feat_abs": F.when(F.col("source_pk") % 23 == 0, F.lit(None)).otherwise(F.col("feat_abs"))})
    wide = listings.with_equipment_score(listings.clean_rows(raw)).select("source_pk", "body_type", "price", "equipment_score")
    some = listings.clean_columns(raw, {"source_pk", "body_type", "price", "equipment_score"}).select(*wide.columns)
    assert 0 < wide.count() < raw.count() and not wide.exceptAll(some).count() and not some.exceptAll(wide).count()


def test_no_method_of_a_wide_row_is_only_interpreted(spark):
    """the JVM compiles no method of over 8,000 bytes; stages that are written have none."""
    assert len(schema.FEAT) > 30
    key = "spark.sql.codegen.hugeMethodLimit"
    was = spark.conf.get(key)
    with scratch.compiled(spark):
        assert int(spark.conf.get(key)) <= 8000
    assert spark.conf.get(key) == was


def test_training_deals_more_rows_than_a_task_should_hold(spark):
    """tasks follow from the number of rows, not from the bytes of a scan."""
    rows = spark.range(1000).coalesce(1)
    assert price_model.dealt(rows, 1000, most=100).rdd.getNumPartitions() == 10
    assert price_model.dealt(rows, 1000, most=1000).rdd.getNumPartitions() == 1


def test_encoders_are_fitted_once_for_all_models(spark, monkeypatch):
    """settings are of trees alone; the best model still holds the encoders."""
    fitted, fit = [], price_model.encoders
    monkeypatch.setattr(price_model, "encoders", lambda *args: fitted.append(1) or fit(*args))
    df = queries.offers(spark, "/root/testdata/sf0.001")
    model, tried = price_model.select_model(df, ["brand"], ["year", "mileage"], [{"trees": 2, "depth": 2}, {"trees": 1, "depth": 3}], "l_orderkey")
    assert len(fitted) == 1 and tried.count() == 2
    assert price_model.score(model, df).filter("predicted_price is null").isEmpty()


def test_pages_cross_to_python_by_few(spark):
    """a worker holds a hundred pages at a time, not an Arrow batch of ten thousand."""
    pages = spark.createDataFrame([("https://ads.example/x-7", '<ul id="scroll_car_detail"><li>Mileage</li><li>9 km</li></ul>'), ("https://ads.example/x-8", None)], "url string, html string")
    items = web.extract_items(pages)
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython [parse_ad_html" in plan and not [line for line in plan.splitlines() if "ArrowEvalPython" in line and "parse_ad_html" in line]
    assert [(r.listing_id, r.mileage_raw) for r in items.orderBy("listing_id").collect()] == [(7, "9 km"), (8, None)]


def test_texts_that_nobody_reads_are_not_looked_up(spark):
    """each value stands once, so the join of an unread column is left out; nulls still become 'Unknown'."""
    df = spark.createDataFrame([(1, "LAHORE", None), (2, None, "petrol")], "id int, city string, fuel_type string")
    done = listings.standard_text(df, ["city", "fuel_type"])(df, ["city", "fuel_type"])
    joins = lambda rows: rows._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")
    assert [joins(done.select(*some)) for some in (["id"], ["id", "city"], ["id", "city", "fuel_type"])] == [0, 1, 2]
    assert sorted(tuple(r) for r in done.collect()) == [(1, "Lahore", "Unknown"), (2, "Unknown", "Petrol")]


def test_cities_that_nobody_reads_are_not_looked_up(spark):
    """scoring joins the cities of an artefact only where a column of theirs is read."""
    ads = spark.createDataFrame([("b", "m", 2000, "c", 5, 7, 1)], "brand string, model string, year int, city string, price long, mileage long, equipment_score int")
    segments, cities = listings.statistics_of(ads)
    compared = artefact.CompareAds({"segments": segments, "cities": cities}).transform(ads)
    joins = lambda rows: rows._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")
    assert joins(compared.select("market_avg_mileage")) == 1 and joins(compared.select("market_avg_mileage", "city_avg_price")) == 2
    assert compared.first().city_avg_price == 5


def test_body_types_that_are_not_kept_are_not_repaired(spark, monkeypatch):
    """a repaired body type is never null, so no row depends on it."""
    raw = queries.raw_view(spark, "/root/testdata/sf0.001").withColumnRenamed("id", "source_pk")
    wide = listings.clean_rows(raw).select("source_pk", "price")
    monkeypatch.setattr(cleaning, "fill_from_mode", None)
    some = listings.clean_columns(raw, {"source_pk", "price"}).select(*wide.columns)
    assert 0 < wide.count() < raw.count() and not wide.exceptAll(some).count() and not some.exceptAll(wide).count()


def test_both_sides_of_a_grid_come_from_one_read(spark):
    """the table is read once for training and held-out rows, which lie as `split_by_key` deals them."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for rows in batches:
            read.add(len(rows))
            yield rows

    df = queries.offers(spark, "/root/testdata/sf0.001").select("l_orderkey", "brand", "year", "price")
    n = df.count()
    tried = price_model.select_model(df.mapInPandas(counted, df.schema), ["brand"], ["year"], [{"trees": 1, "depth": 2}], "l_orderkey")[1]
    assert read.value == n and tried.first().n == price_model.split_by_key(df, "l_orderkey")[1].count()
