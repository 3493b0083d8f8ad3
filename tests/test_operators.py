import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from lotwise.operators import cleaning, features, market, profile, streak
from lotwise.schema import SCORES, SELLER_SCORES
from lotwise.sources import readers, sinks


def test_market(spark):
    rows = [("a", "x", 2020, 100, 10, 4), ("a", "x", 2020, 300, 30, 2), ("b", "x", 2020, 50, 5, 1), (None, "x", 2020, 70, 1, 1)]
    df = spark.createDataFrame(rows, "brand string, model string, year int, price long, mileage long, equipment_score int")
    got = {r.price: r for r in market.market_features(df).collect()}
    assert (got[100].market_avg_price, got[100].market_listing_count, got[100].percent_below_market, got[100].better_equipped_than_average) == (200, 2, 50, True)
    assert got[50].market_std_price is None and got[50].market_price_ratio == 1
    assert got[70].market_avg_price is None and got[70].better_equipped_than_average is False
    with pytest.raises(ValueError):
        market.market_features(df.drop("equipment_score"))
    assert market.segment_counts(df.filter("brand is not null")).first() == (2, 1)


def test_location(spark):
    df = spark.createDataFrame([("Lahore", 10), ("Lahore", 30), ("Swat", 5), (None, 1)], "city string, price long")
    got = {r.price: (r.is_large_city, r.city_avg_price, r.city_listing_count) for r in market.location_features(df).collect()}
    assert got == {10: (True, 20.0, 2), 30: (True, 20.0, 2), 5: (False, 5.0, 1), 1: (False, None, None)}
    assert {r.price: r.city_avg_price for r in market.location_features(df, leave_one_out=True).collect()} == {10: 30.0, 30: 10.0, 5: None, 1: None}


def test_mode_fill(spark):
    rows = [("a", "x", "suv"), ("a", "x", "van"), ("a", "x", " n/a"), ("a", "y", None), (None, "x", None)]
    df = spark.createDataFrame(rows, "brand string, model string, body string")
    assert sorted(r.body for r in cleaning.fill_from_mode(df, "body", ["brand", "model"]).collect()) == ["Unknown", "Unknown", "suv", "suv", "van"]


def test_cleaning_rules(spark):
    df = spark.createDataFrame([(1, "5", "2000", "1", "1"), (2, "0", "2000", "1", "1"), (3, "x", "2000", "1", "1"), (4, "5", "1800", "1", "1"), (5, "5", "2000", "-1", "1")], "listing_id long, price string, year string, mileage string, engine_capacity string")
    assert [r.listing_id for r in cleaning.drop_impossible(df).collect()] == [1]
    assert {r.rule: r.n_failed for r in profile.broken_rules(df, cleaning.listing_rules()).collect()} == {"price": 2, "year": 1, "mileage": 1, "engine_capacity": 0, "listing_id": 0}
    twice = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "k int, o int, v string")
    assert cleaning.keep_first(twice, ["k"], ["o"]).first().v == "a"
    cars = spark.createDataFrame([(" ev ", None), ("petrol", None)], "fuel_type string, engine_capacity double")
    assert [r.engine_capacity for r in cleaning.fill_electric_engine(cars).collect()] == [0.0, None]


def test_scores_and_features(spark):
    df = spark.createDataFrame([(True, True, None)], "feat_abs boolean, feat_power_seats boolean, feat_drls boolean")
    row = features.add_scores(df, SCORES | SELLER_SCORES).first()
    assert (row.equipment_score, row.safety_score, row.comfort_score, row.luxury_score, row.seller_risk_score) == (2, 1, 1, 1, 0)
    ads = spark.createDataFrame([(1, ["ABS ", "Sun Roof"]), (2, None)], "id int, features array<string>")
    got = {r.id: (r.feat_abs, r.feat_sun_roof, r.feat_new) for r in features.pivot_features(ads, ["feat_abs", "feat_sun_roof", "feat_new"]).collect()}
    assert got == {1: (True, True, False), 2: (False, False, False)}


def test_streaks(spark):
    df = spark.createDataFrame([("f", i, k) for i, k in enumerate([1, 1, 0, 1, 1, 1])], "feed string, n int, known int")
    got = streak.streaks(df, F.col("known") == 1, ["n"], ["feed"]).orderBy("n").collect()
    assert [r.streak for r in got] == [1, 2, 0, 1, 2, 3]
    assert streak.first_cutoff(df, F.col("known") == 1, ["n"], ["feed"], 3).first().n == 5
    # one long feed, a null feed and short ones, over several ranges
    rows = [("long", k, int(k % 97 != 5 and not 300 < k < 310)) for k in range(700)] + [(None, k, 1) for k in range(40)] + [(f"f{k % 9}", k, k % 2) for k in range(90)]
    many = spark.createDataFrame(rows, "feed string, n int, known int")
    want, state = {}, {}
    for feed, n, known in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        state[feed] = want[feed, n] = state.get(feed, 0) + 1 if known else 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # four ranges, however few the rows
    try:
        got = streak.streaks(many, F.col("known") == 1, ["n"], ["feed"]).collect()
        alone = streak.streaks(many.filter("feed = 'long'"), F.col("known") == 1, ["n"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r.feed, r.n): r.streak for r in got} == want
    assert {("long", r.n): r.streak for r in alone} == {k: v for k, v in want.items() if k[0] == "long"}
    assert streak.streaks(many.limit(0), F.col("known") == 1, ["n"], ["feed"]).count() == 0


def test_profile_of_empty_tables(spark):
    empty = spark.createDataFrame([], "v string")
    assert profile.removal(empty, empty).first().percent_removed == 0
    assert profile.max_key(empty.select(F.col("v").cast("long").alias("id")), "id").first()[0] == 0


def test_sinks(spark, tmp_path):
    table = sinks.SnapshotTable(spark, f"file://{tmp_path}/t", "id", "id long, v string")
    assert table.read().count() == 0
    one, two = (spark.createDataFrame(r, "id long, v string") for r in ([(1, "a"), (2, "b")], [(2, None), (3, "c")]))
    table.write(one)
    table.write(two, "upsert")
    assert sorted(table.read().collect()) == [(1, "a"), (2, None), (3, "c")]
    table.write(one, "append")
    assert table.read().count() == 5
    table.write(spark.createDataFrame([(9, "z", 1)], "id long, v string, extra int"), "append")
    assert table.read().count() == 6 and table.read().columns == ["id", "v", "extra"]
    assert len(list((tmp_path / "t").glob("data-*"))) == 4  # an append leaves the others' files alone
    with pytest.raises(ValueError):
        table.write(one, "merge")
    with pytest.raises(ValueError):
        table.write(one.drop("id"))
    table.vacuum(1)
    table.reset()
    assert table.read().count() == 0
    assert sorted(r.id for r in sinks.insert_absent(one, two.unionByName(two), "id").collect()) == [1, 2, 3]
    tagged = sinks.tag_new(two, one, "id")
    assert sinks.run_log(tagged, "2026-01-01 00:00:00", "2026-01-01 00:00:05").select("ads_scraped", "new_ads", "updated_ads", "errors", "duration_seconds").first() == (2, 1, 1, 0, 5)
    log = sinks.run_log(tagged, "2026-01-01 00:00:00", "2026-01-01 00:00:05", failed=F.col("v").isNull()).first()
    assert (log.ads_scraped, log.new_ads, log.updated_ads, log.errors) == (1, 1, 0, 1)


def _files(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_upserts_write_their_buckets_alone(spark, tmp_path):
    table = sinks.SnapshotTable(spark, f"file://{tmp_path}/t", "id", "id long, v string", buckets=16)
    rows = spark.range(2000).select("id", F.lit("old").alias("v"))
    assert table.write(rows) == {"new": 2000, "updated": 0, "late": 0}
    before = _files(tmp_path)
    few = spark.createDataFrame([(7, "new"), (5000, "new"), (None, "new")], "id long, v string")
    assert table.write(few, "upsert") == {"new": 2, "updated": 1, "late": 0}
    made = set(_files(tmp_path)) - set(before)
    touched = {p.parent.name for p in made}
    assert len(touched) <= 3 and {p: t for p, t in _files(tmp_path).items() if p in before} == before
    assert table.read().count() == 2002 and sorted(r.v for r in table.rows_of(few).collect()) == ["new"] * 3
    # A null key is a key; all rows of given keys go, whatever stands for them.
    assert table.write(few.filter("id is null").withColumn("v", F.lit("again")), "upsert", keys=few.select("id")) == {"new": 0, "updated": 1, "late": 0}
    assert sorted((r.id is None, r.v) for r in table.rows_of(few).collect()) == [(True, "again")] and table.read().count() == 2000
    # A row that is older than the stored one is left out, an equally old one is not.
    one = table.write(spark.createDataFrame([(8, "a"), (9, "old"), (10, "z"), (6000, "a")], "id long, v string"), "upsert", newer="v")
    assert one == {"new": 1, "updated": 2, "late": 1} and [r.v for r in table.read().filter("id in (8, 9, 10)").orderBy("id").collect()] == ["old", "old", "z"]
    table.vacuum(1)
    assert len(list((tmp_path / "t").glob("v=*.json"))) == 1 and table.read().count() == 2001
    assert {p.parts[-3] for p in _files(tmp_path)} == {p.name for p in (tmp_path / "t").glob("data-*")}


def test_batches_are_written_once(spark, tmp_path):
    table = sinks.SnapshotTable(spark, f"file://{tmp_path}/t", "id", "id long, v string", buckets=4)
    rows, seen = spark.createDataFrame([(1, "a")], "id long, v string"), []
    assert table.write(rows, "upsert", batch=("s", 0), on_counts=seen.append)["new"] == 1
    assert table.write(rows, "upsert", batch=("s", 0), on_counts=seen.append) is None and table.write(rows, "append", batch=("s", 0)) is None
    assert table.write(rows, "upsert", batch=("other", 0)) == {"new": 0, "updated": 1, "late": 0}
    assert seen == [{"new": 1, "updated": 0, "late": 0}] and table.read().count() == 1 and table.applied(("s", 0)) and not table.applied(("s", 1))


def test_writers_at_once_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    table = sinks.SnapshotTable(spark, f"file://{tmp_path}/t", "id", "id long, v string", buckets=4)
    table.write(spark.createDataFrame([(0, "a")], "id long, v string"))

    def write(k):
        rows = spark.createDataFrame([(k, "a"), (0, f"by {k}")] if k % 2 else [(k, "a")], "id long, v string")
        return table.write(rows, "upsert" if k % 2 else "append")

    with ThreadPoolExecutor(6) as pool:
        counts = list(pool.map(write, range(1, 7)))
    assert sorted(r.id for r in table.read().collect()) == list(range(7)) and sum(c["new"] for c in counts) == 6
    assert not list((tmp_path / "t").glob("attempt-*"))


def test_databases(spark, tmp_path):
    url = "jdbc:derby:memory:lotwise;create=true"
    for key in ("id", "ID"):
        rows = spark.range(1, 41).select(F.col("id").alias(key), F.concat(F.lit("v"), "id").alias("label"))
        sinks.write_jdbc(rows.filter("id <= 30"), url, f"ads_{key}", numPartitions="2")
        sinks.write_jdbc(rows.filter("id > 30"), url, f"ads_{key}", "append")
        got = readers.read_listings(spark, "jdbc", url=url, table=f"ads_{key}", partitions=4)
        assert got.rdd.getNumPartitions() == 4 and sorted(r.source_pk for r in got.collect()) == list(range(1, 41))
        sinks.write_jdbc(rows.filter("id = 7"), url, f"ads_{key}")
        assert [(r.source_pk, r.label) for r in readers.read_jdbc(spark, url, f"ads_{key}", limit=5).collect()] == [(7, "v7")]
        sinks.write_jdbc(rows.limit(0), url, f"ads_{key}")
        assert readers.read_jdbc(spark, url, f"ads_{key}").count() == 0
    with pytest.raises(ValueError):
        sinks.write_jdbc(rows, url, "ads", "upsert")


def test_database_writes_are_whole(spark, monkeypatch):
    url, cols = "jdbc:derby:memory:whole;create=true", "id long, v string"
    read = lambda: sorted(tuple(r) for r in readers.read_jdbc(spark, url, "ads").collect())
    sinks.write_jdbc(spark.createDataFrame([(k, "old") for k in range(5)], cols).repartition(3), url, "ads")
    new = spark.createDataFrame([(3, "new"), (9, "new")], cols)
    run = sinks._statements

    def fails(spark, url, statements, options):
        return run(spark, url, [*statements, "DELETE FROM not_there"] if statements[-1].startswith("INSERT") else statements, options)

    for mode in ("replace", "upsert"):  # the last statement fails: the rows before are there
        monkeypatch.setattr(sinks, "_statements", fails)
        with pytest.raises(Py4JJavaError):
            sinks.write_jdbc(new, url, "ads", mode, "id")
        monkeypatch.undo()
        assert read() == [(k, "old") for k in range(5)]
    for _ in range(2):
        sinks.write_jdbc(new, url, "ads", "upsert", "id")
        assert read() == [(0, "old"), (1, "old"), (2, "old"), (3, "new"), (4, "old"), (9, "new")]
    sinks.write_jdbc(new, url, "ads")
    sinks.write_jdbc(new.filter("id = 9").withColumn("id", F.lit(10).cast("long")), url, "ads", "append")
    assert read() == [(3, "new"), (9, "new"), (10, "new")]
    tables = spark.read.format("jdbc").options(url=url, query="SELECT tablename AS t FROM sys.systables WHERE tabletype = 'T'").load()
    assert [r[0] for r in tables.collect()] == ["ADS"]


def test_csv_keeps_quotes_and_breaks(spark, tmp_path):
    rows = [(1, 'say "hi", ok'), (2, 'two\nlines, "and" more'), (3, '"'), (4, "back\\slash")]
    sinks.write_csv(spark.createDataFrame(rows, "id long, v string"), f"file://{tmp_path}/c")
    got = readers.read_csv(spark, f"file://{tmp_path}/c", "id long, v string", multi_line=True)
    assert sorted(tuple(r) for r in got.collect()) == rows


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,price,v\n1,1300.0,"x ""y"""\n2,N/A,null\n')
    rows = readers.read_listings(spark, "csv", path=f"file://{tmp_path}/a.csv", schema="id long, price long, v string").collect()
    assert [tuple(r) for r in rows] == [(1, 1300, 'x "y"'), (2, None, None)]
    with pytest.raises(ValueError):
        readers.read_listings(spark, "xml")
    with pytest.raises(ValueError):
        readers.attach_source_pk(spark.createDataFrame([(1,)], "a int"))
    with pytest.warns(UserWarning):
        assert "source_pk" in readers.attach_source_pk(spark.createDataFrame([(1,)], "listing_id int")).columns
