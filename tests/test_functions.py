import re

import pytest
from pyspark.sql import functions as F

from lotwise import lookups, schema
from lotwise.functions import color, numeric, text, web


def values(spark, rows, make, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.select(make(F.col("v")).alias("o"), "i").orderBy("i").select("o").collect()]


def test_schema_groups():
    schema.assert_unique()
    with pytest.raises(ValueError):
        schema.assert_unique(["a", "a"])
    assert (len(schema.PROCESSED), len(schema.TRAINING), len(schema.FEAT), len(schema.RAW_COLUMNS)) == (127, 113, 35, 56)
    assert not set(schema.TRAINING) & {*schema.ANALYSIS_ONLY, schema.TARGET}
    assert set(schema.SELLER_FLAGS) == set(lookups.SELLER_PHRASES)


def test_prices(spark):
    rows = ["PKR 4,350,000", "PKR 42.7 lacs", "1.2 crore", "Call for price", "1 crore 20 lacs", "1,042 lacs", "1.13 lacs", ",", "", None, "4270000", "3 Cr"]
    assert values(spark, rows, numeric.clean_price) == [4350000, 4270000, 12000000, None, 10000000, 4200000, 113000, None, None, None, 4270000, 30000000]
    assert values(spark, ["1.13 lacs"], lambda c: numeric.clean_price(c, exact=False)) == [112999]


def test_numbers_and_years(spark):
    assert values(spark, ["80,000 km", "1800 cc", "1300.9", ",", None, "x"], numeric.clean_number) == [80000, 1800, 1300, None, None, None]
    assert values(spark, ["2017", "2017-01-01", "Model 1999", "187", None], numeric.clean_year) == [2017, 2017, 1999, None, None]


def test_bins_are_closed_on_the_right(spark):
    got = values(spark, [0.0, 660.0, 800.0, 900.0, 1000.0, 1300.0, 1800.0, 3500.0, None], lambda c: numeric.binned(c, numeric.ENGINE_BINS), "double")
    assert got == ["Electric", "<=800cc", "<=800cc", "801-1000cc", "801-1000cc", "1001-1300cc", "1601-2000cc", "3000cc+", None]
    got = values(spark, [5000, 20000, 30000, 50000, 75000, 120000, 200000], lambda c: numeric.binned(c, numeric.MILEAGE_BINS), "long")
    assert got == ["<20k", "<20k", "20k-50k", "20k-50k", "50k-100k", "100k-150k", "150k+"]


def test_text_cleaning(spark):
    rows = ["  mercedes-benz  c class ", "BMW", "corolla gli,", "n/a", "--", None, "BYD", "alto vxr", "Ａudi", ""]
    assert values(spark, rows, text.standardize_text) == ["Mercedes-Benz C Class", "BMW", "Corolla GLi,", "Unknown", "Unknown", "Unknown", "Byd", "Alto VXR", "Audi", "Unknown"]
    assert values(spark, [" a   b ", "", None], text.clean_text) == ["a b", None, None]
    assert values(spark, ["Air Conditioning", " ABS! ", "x" * 80], text.slugify_feature) == ["feat_air_conditioning", "feat_abs", "feat_" + "x" * 58]
    df = spark.createDataFrame([([" ABS ", "", None, "Air  Bags"],)], "f array<string>")
    assert df.select(text.clean_feature_list(F.col("f"))).first()[0] == ["ABS", "Air Bags"]


def test_missing_columns_are_skipped(spark):
    df = spark.createDataFrame([("x y",)], "brand string")
    assert text.standardize_text_columns(df, schema.TEXT_COLUMNS).first()[0] == "X Y"
    assert df.select(text.search_corpus(df, ["no"])).first()[0] == ""


@pytest.mark.parametrize(("raw", "want"), [
    ("wite", "White"), ("bule", "Blue"), ("gun matalic", "Grey"), ("olive", "Green"), ("two tone black and white", "Multi"), ("black & red", "Multi"),
    ("white with stripe", "Multi"), ("سفید", "White"), ("metallicblue", "Blue"), ("colored", "Red"), ("wine", "Red"), ("123", "Unknown"), ("n/a", "Unknown"),
    ("", "Unknown"), (None, "Unknown"), ("read", "Red"), ("pearl", "Unknown"), ("silky-silver", "Silver"),
])
def test_colors(spark, raw, want):
    assert values(spark, [raw], color.standardize_color) == [want]


def test_color_column(spark):
    df = spark.createDataFrame([(1, "wite"), (2, None), (3, "wite")], "i int, color string")
    assert {r.i: r.color_clean for r in color.clean_color_column(df).collect()} == {1: "White", 2: "Unknown", 3: "White"}
    with pytest.raises(ValueError):
        color.clean_color_column(df, "paint")


def test_every_phrase_sets_its_flag(spark):
    phrases = lookups.SELLER_PHRASES | lookups.CONTAINS_PHRASES
    rows = [(name, f"Well, {p.upper()}!") for name, ps in phrases.items() for p in ps]
    df = spark.createDataFrame(rows, "name string, description string")
    for r in text.keyword_flags(df, phrases).collect():
        assert r[r.name], r


def test_phrases_are_whole_and_stay_in_their_field(spark):
    df = spark.createDataFrame([("genuine", "condition"), ("non accidental", None), (None, None), ("", "urgently")], "description string, seller_comments string")
    rows = text.keyword_flags(df, lookups.SELLER_PHRASES).collect()
    assert [r.seller_genuine_condition for r in rows] == [False] * 4
    assert [r.seller_non_accidental for r in rows] == [False] * 4
    assert [r.seller_urgent_sale for r in rows] == [False, False, False, True]
    assert text.phrase_pattern([" "]) is None


def test_urls(spark):
    urls = ["https://a.example/used-cars/x-2017-for-sale-123?p=1", "https://a.example/x", "https://a.example/s/?page=3&sort=a&empty=&sort=b#t", "https://a.example/s"]
    assert values(spark, urls, web.listing_id) == [123, None, None, None]
    assert values(spark, urls, web.page_number) == [1, 1, 3, 1]
    assert values(spark, urls, web.next_page_url)[2:] == ["https://a.example/s/?page=4&sort=a#t", "https://a.example/s?page=2"]
    assert values(spark, ["<b>Please solve the CAPTCHA</b>", "ok", None], web.looks_blocked) == [True, False, False]


LD = '<script type="application/ld+json">{}</script>'
CAR = '{"@type": ["Thing", "Car"], "brand": {"name": "Zed"}, "model": "One", "modelDate": 2019, "mileageFromOdometer": "12,000 km", "vehicleEngine": {"engineDisplacement": "1300cc"}, "offers": {"price": 4270000, "priceCurrency": "PKR"}}'
PAGES = {
    "https://a.example/a-1": f"<title>Zed One 2019 for sale in Lahore | Site</title>{LD.format(CAR)}<div id='myCarousel'><div class='x featured-ribbon'></div></div>",
    "https://a.example/a-2": f"<title>T</title>{LD.format('{broken')}{LD.format('[{}]'.format('{' + chr(34) + '@type' + chr(34) + ': ' + chr(34) + 'BreadcrumbList' + chr(34) + '},' + CAR))}<div id='myCarousel'></div>",
    "https://a.example/a-3": "<title>Ace Two X 2015 for sale in Swat</title><ul id='scroll_car_detail'><li>Mileage</li><li><b>90,000</b> km</li><li>Colour</li><li>red</li><li>Registered In</li><li>Swat</li><li>odd</li></ul><img class='feature-icon' alt='ABS'><img class='feature-icon' alt=' Air Bags '>",
    "https://a.example/a-4": "<title>Ace</title><meta name='description' content='Yours for PKR 31.5 lacs . See a 1600 cc, Maroon 88400 KM Driven, Automatic Car.'><h2 id='scroll_seller_comments'>C</h2><p>no</p><div>Very <b>good</b><br>car</div><div>not this</div>",
    "https://a.example/none": "<title>Q</title><input id='id' value='77'><ul class='car-feature-list'><li>Sun <i>Roof</i></li></ul>",
    "https://a.example/empty-5": None,
    "https://a.example/cut-6": "<ul id='scroll_car_detail'><li>Color</li><li>teal",
}


def test_extraction_layers(spark):
    pages = spark.createDataFrame(list(PAGES.items()), "url string, html string")
    one, two, three, four, five, six = (r for r in web.extract_items(pages).filter("listing_id < 5").orderBy("ad_url").collect() + web.extract_items(pages).filter("ad_url like '%none'").collect() + web.extract_items(pages).filter("ad_url like '%empty%'").collect())
    assert (one.listing_id, one.brand, one.model, one.year_raw, one.engine_capacity_raw, one.price_raw, one.city, one.is_featured) == (1, "Zed", "One", "2019", "1300cc", "4270000", "Lahore", True)
    assert (two.brand, two.model, two.is_featured) == ("Zed", "One", False)
    assert (three.brand, three.model, three.year_raw, three.mileage_raw, three.color, three.registered_in, three.features) == ("Ace", "Two X", "2015", "90,000  km", "red", "Swat", ["ABS", "Air Bags"])
    assert (four.engine_capacity_raw, four.color, four.mileage_raw, four.transmission, four.price_raw, four.seller_comments, four.is_featured) == ("1600", "Maroon", "88400", "Automatic", "31.5 lacs", "Very good car", None)
    assert (five.listing_id, five.features) == (77, ["Sun  Roof"])  # nodes are joined by a blank; cleaning squeezes it
    cleaned = web.extract_items(pages).filter("listing_id = 77").select(text.clean_feature_list(F.col("features")).alias("f"))
    assert cleaned.first().f == ["Sun Roof"]
    cut = web.extract_items(pages).filter("listing_id = 6").first()
    assert (cut.color, cut.title) == ("teal", None)
    assert (six.listing_id, six.title, six.brand) == (5, None, None)


def test_phrases_overlap_in_one_scan(spark):
    phrases = {"a": ["urgent sale", "sale price"], "b": ["sale"], "c": ["sale price negotiable"], "d": ["price negotiable"], "e": ["paint", "painted"], "f": ["touch-up", "x+y"], "g": ["never"], "h": []}
    texts = ["urgent sale price negotiable", "painted", "repaint salesman", "Touch-Up, x+y!", "SALE", "", None, "prepaint paint-job", "no sale price"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, description string")
    got = text.keyword_flags(df, phrases).orderBy("k").collect()
    for row in got:
        corpus = (texts[row.k] or "").lower()
        for name, words in phrases.items():
            assert row[name] == any(re.search(rf"\b{re.escape(w)}\b", corpus) for w in words), (row.k, name)
    assert text.keyword_flags(df, {"h": []}).filter("h").count() == 0


def test_titles_hold_all_references(spark):
    pages = ["<title>Caf&eacute; &#8211; A&amp;B &lt;x&gt; &#x41;&nbsp;b | site</title>", "<title>plain</title>", "", None]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    assert [r.t for r in df.select(web.page_title(F.col("html")).alias("t")).collect()] == ["Caf\u00e9 \u2013 A&B <x> A b", "plain", None, None]
