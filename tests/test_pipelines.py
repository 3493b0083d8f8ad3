from lotwise import schema
from lotwise.config import Settings
from lotwise.plans import ingest, listings
from lotwise.sources import sinks

BASE = {
    "title": "t", "brand": "zed", "model": "one gli", "year": 2021, "city": "lahore", "mileage": 25000, "fuel_type": "petrol", "transmission": "manual", "engine_capacity": 1300.0,
    "color": "wite", "body_type": "sedan", "price": 4000000, "ad_url": "u", "description": None, "seller_comments": None, "scrape_date": None, "registered_in": "lahore",
    "assembly": "local", "is_featured": None,
}


def raw(spark, changes):
    import datetime

    rows = []
    for k, change in enumerate(changes, 1):
        row = {"id": k, "listing_id": 1000 + k, **BASE, "scrape_date": datetime.datetime(2026, 6, 1), **{c: False for c in schema.FEAT}, **change}
        rows.append(tuple(row[c] for c in schema.RAW_COLUMNS))
    return spark.createDataFrame(rows, schema.raw_listings())


def test_listings_end_to_end(spark):
    df = raw(spark, [
        {"feat_abs": True, "description": "Urgent sale. Price is flexible.", "price": 4000000},
        {"brand": "Zed", "model": "One GLi", "city": "Lahore", "price": 4200000, "color": "black & white", "mileage": 41000},
        {"fuel_type": "EV", "engine_capacity": None, "brand": "byd", "color": "سفید", "city": "swat"},
        {"body_type": "N/A", "price": 4100000}, {"body_type": None, "brand": "kia"},
        {"listing_id": 1001}, {"registered_in": None}, {"price": -1}, {"year": 1800}, {"mileage": -5}, {"engine_capacity": -1.0},
    ])
    out = listings.process_listings(df, Settings(km_per_year=12000.0), include_log_price=True)
    assert out.columns == schema.PROCESSED
    got = {r.listing_id: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    one, two, three, four, five = (got[k] for k in range(1, 6))
    assert (one.brand, one.model, one.color, one.car_age, one.is_featured, one.body_type) == ("Zed", "One GLi", "White", 5, False, "sedan".title())
    assert (one.market_listing_count, one.market_avg_price, one.market_median_price) == (3, 4100000.0, 4100000.0)
    assert abs(one.mileage_ratio - 25000 / 60000) < 1e-12 and one.seller_urgency_score == 2 and one.safety_score == 1
    assert (two.color, three.engine_size_category, three.price_per_cc, three.brand, three.color) == ("Multi", "Electric", None, "Byd", "White")
    assert (four.body_type, five.body_type, five.brand, five.is_large_city, three.is_large_city) == ("Sedan", "Unknown", "KIA", True, False)
    assert one.city_listing_count == 4 and one.log_price > 15


def test_values_beyond_the_bound_are_standardised_row_by_row(spark):
    df = spark.createDataFrame([(" alto  vxr", None), ("n/a", "Ａudi"), (None, "x-y")], "a string, b string")
    one, two = (listings.standard_text(df, ["a", "b"], most)(df, ["a", "b"]) for most in (1, 100))
    assert sorted(one.collect()) == sorted(two.collect()) == [("Alto VXR", "Unknown"), ("Unknown", "Audi"), ("Unknown", "X-Y")]


def test_refresh_rebuilds_touched_segments_only(spark):
    df = raw(spark, [{}, {"brand": "ace", "city": "swat"}, {"price": 4200000}])
    whole = listings.process_listings(df)
    changed = whole.filter("brand = 'Zed'").select("brand", "model", "year", "city")
    part = listings.refresh_segments(df, changed)
    assert sorted(r.listing_id for r in part.collect()) == [1, 3]
    assert part.exceptAll(whole).count() == 0


def test_ingest(spark, tmp_path):
    html = "<title>Ace Two 2015 for sale in Swat</title><meta name='description' content='for PKR 31.5 lacs . See a 1600 cc, Maroon 88,400 KM Driven, Automatic Car.'><img class='feature-icon' alt='ABS'>"
    pages = spark.createDataFrame([("https://a.example/ace-9", html), ("https://a.example/noid", html), ("https://a.example/ace-9", html)], "url string, html string")
    got = ingest.pages_to_listings(pages)
    row = got.first()
    assert (row.listing_id, row.price, row.mileage, row.engine_capacity, row.year, row.city, row.feat_abs, row.feat_drls) == (9, 3150000, 88400, 1600.0, 2015, "Swat", True, False)
    table = sinks.SnapshotTable(spark, f"file://{tmp_path}/raw", "listing_id", got.schema.simpleString()[7:-1].replace(":", " ") + ", scrape_date timestamp")
    for want in ((1, 1, 0), (1, 0, 1)):
        log = ingest.merge_listings(table, got, "2026-01-01 00:00:00", "2026-01-01 00:01:00").first()
        assert (log.ads_scraped, log.new_ads, log.updated_ads) == want
    assert table.read().count() == 1
