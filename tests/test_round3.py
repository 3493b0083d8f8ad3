"""What the reviewer's third round found."""

from lotwise import lookups, queries, schema
from lotwise.functions import text
from lotwise.plans import artefact, ingest
from lotwise.plans import listings as plans


def test_page_fields_resolve_ampersands_alone(spark, tmp_path):
    titles = ["A &amp; B token = &quot;x&quot; | site", "cut &amp", "&amp;lt;", None]
    pages = [(k, "http://a.example/1?page=2", t and f"<title>{t}</title>") for k, t in enumerate(titles)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.title for r in queries.QUERIES["page_fields"](spark, str(tmp_path)).collect()}
    assert got == {0: "A & B token = &quot;x&quot;", 1: "cut &amp", 2: "&lt;", 3: None}


def test_pages_are_parsed_once_and_by_many_tasks(spark):
    made = ingest.pages_to_listings(queries.built_pages(spark, "/root/testdata/sf0.001"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.splitlines() if "ArrowEvalPython" in line and "parse_ad_html" in line]) == 1
    assert queries.built_pages(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 32


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_flags_are_looked_up_in_one_text(spark):
    df = spark.createDataFrame([("URGENT sale, first owner", "Price is flexible."), (None, "")], "description string, seller_comments string")
    flags = text.keyword_flags(df, lookups.SELLER_PHRASES | lookups.CONTAINS_PHRASES)
    one, two = flags.select("seller_urgent_sale", "contains_first_owner", "seller_price_negotiable", "contains_token").collect()
    assert (tuple(one), tuple(two)) == ((True, True, True, False), (False,) * 4)
    assert "arrays_overlap" not in _plan(flags)


def test_a_table_of_ads_has_each_text_put_in_form_once(spark):
    rows = queries.raw_view(spark, "/root/testdata/sf0.001").withColumnRenamed("id", "source_pk")
    assert "_nfkc" not in _plan(artefact.AdFeatures().transform(rows).select("brand", "model", "city"))


def test_training_reads_no_more_columns_than_it_needs(spark, monkeypatch):
    seen = {}
    keep = artefact.staged
    monkeypatch.setattr(artefact, "staged", lambda df, name: seen.setdefault(name, keep(df, name)))
    artefact.fit(queries.raw_view(spark, "/root/testdata/sf0.001"), [], ["mileage"], trees=1, depth=1)
    assert set(seen["ready"].columns) == {"brand", "model", "year", "city", "price", "mileage", "equipment_score"}


def test_statistics_are_made_of_narrow_rows(spark):
    rows = queries.raw_view(spark, "/root/testdata/sf0.001")
    assert not set(plans.compared(rows).columns) & set(schema.FEAT)
