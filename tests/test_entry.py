import __spark_entry__ as entry_point

from lotwise import queries

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    assert entry_point.entry(spark).count() == 100


def test_queries_and_sql_have_one_namespace():
    found = entry_point.queries()
    assert set(queries.QUERIES) <= set(found)
    assert set(entry_point.oracle_sql()) <= set(found)


def test_streams(spark):
    assert queries.QUERIES["stream_upsert"](spark, SF).count() == spark.read.parquet(f"{SF}/events.parquet").select("user_id").distinct().count()
    assert queries.QUERIES["stream_streak"](spark, SF).filter("streak < 0").count() == 0


def test_model(spark):
    assert queries.QUERIES["fair_prices"](spark, SF).count() == 50
