"""States that follow changes: the listing store, medians over ranges, streaks, the artefact."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from lotwise import schema
from lotwise.operators import market, rejects, streak
from lotwise.plans import artefact, ingest, listings, price_model
from lotwise.plans.store import ListingStore
from lotwise.sources import readers, scratch, sinks
from lotwise.streaming import ingest as streaming

from test_pipelines import raw

KEYS = ["brand", "model", "year"]


def _same(store, rows):
    """The store's table and a rebuild from the raw rows agree on all columns of all rows."""
    got, want = store.processed(), listings.process_listings(rows)
    assert got.columns == want.columns == schema.PROCESSED
    a, b = ({r.listing_id: r.asDict() for r in df.collect()} for df in (got, want))
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == b[k], {c: (x, b[k][c]) for c, x in a[k].items() if x != b[k][c]}


def test_store_follows_the_ads(spark, tmp_path, monkeypatch):
    changes = [
        {"body_type": "suv"}, {"body_type": "suv"}, {"body_type": "sedan"}, {"body_type": None, "price": 100}, {"city": "swat", "body_type": "N/A", "price": 300},
        {"brand": "kia", "price": 700, "feat_abs": True}, {"brand": "kia", "price": 900}, {"listing_id": 1006, "brand": "kia", "price": 50}, {"registered_in": None}, {"brand": None}, {"price": -3}, {"city": None},
    ]
    store = ListingStore(spark, f"file://{tmp_path}/s", buckets=4)
    first = raw(spark, changes)
    assert store.refresh(first, batch=0) and not store.refresh(first, batch=0)
    _same(store, first)
    # Two labels change, so that unlabelled ads of the pair get another; one ad moves, one is withdrawn with its repeat, one is new.
    changes[0] = {"body_type": "sedan"}
    changes[1] = {"body_type": "sedan", "city": "swat", "price": 5}
    changes[6] = {"brand": "kia", "price": 900, "year": 2019}
    later = [c for c in raw(spark, [*changes, {"brand": "kia", "city": "swat", "price": 12}]).collect() if c.listing_id != 1006]
    second = spark.createDataFrame(later, schema.raw_listings())
    moved = second.filter("listing_id in (1001, 1002, 1007, 1013)")
    ads = spark.createDataFrame([(k,) for k in (1001, 1002, 1006, 1007, 1013)], "listing_id long")

    failing = sinks.SnapshotTable.write

    def write(self, *args, **kw):
        if self.path.endswith("/cities"):
            raise RuntimeError("lost")
        return failing(self, *args, **kw)

    monkeypatch.setattr(sinks.SnapshotTable, "write", write)
    with pytest.raises(RuntimeError):
        store.refresh(moved, ads, batch=1)
    monkeypatch.undo()
    assert store.refresh(moved.limit(0), batch=1)  # goes on with what was worked out
    _same(store, second)
    assert {r.body_type for r in store.processed().filter("listing_id in (4, 5)").collect()} == {"Sedan"}
    store.vacuum(1)
    _same(store, second)
    store.refresh(second.limit(0), second.select("listing_id"), batch=2)
    assert store.processed().count() == 0 and store.points.read().count() == 0


def test_refresh_reads_no_other_buckets(spark, tmp_path):
    store = ListingStore(spark, f"file://{tmp_path}/s", buckets=16)
    store.refresh(raw(spark, [{"brand": f"b{k}", "city": f"c{k}"} for k in range(60)]), batch=0)
    before = {p for p in (tmp_path / "s").rglob("*.parquet")}
    store.refresh(raw(spark, [{"brand": "b0", "city": "c0", "price": 7}]), batch=1)
    made = {p for p in (tmp_path / "s").rglob("*.parquet")} - before
    assert {(p.parts[-4], p.parts[-2]) for p in made} and all(sum(p.parts[-4] == t for p in made) == 1 for t in ("raw", "ads", "segments", "cities"))


@pytest.mark.parametrize("kind", ["long", "double"])
def test_medians_of_hot_segments(spark, kind):
    rng = random.Random(3)
    rows = [("hot", "m", 1, rng.randrange(4000)) for _ in range(6001)] + [("even", "m", 1, rng.randrange(900)) for _ in range(3000)]
    rows += [("one", "m", 1, 7), ("flat", "m", 1, 5), ("flat", "m", 1, 5), ("none", "m", 1, None), (None, "m", 1, 3), ("two", "m", 1, 3), ("two", "m", 1, 8)]
    rows = [(*r[:3], None if r[3] is None else float(r[3]) if kind == "double" else r[3], 10 * k, k % 3) for k, r in enumerate(rows)]
    df = spark.createDataFrame(rows, f"brand string, model string, year int, price {kind}, mileage long, equipment_score int").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        whole, spread = ({r.brand: r for r in market.segment_statistics(df, most=most).collect()} for most in (10**6, 500))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert whole == spread
    for brand in ("hot", "even", "one", "flat", "two"):
        prices = [r[3] for r in rows if r[0] == brand]
        r = spread[brand]
        assert r.market_median_price == statistics.median(prices) and r.market_listing_count == len(prices) and r.market_avg_price == pytest.approx(statistics.fmean(prices), rel=1e-12)
        assert r.market_std_price == (pytest.approx(statistics.stdev(prices), rel=1e-9) if len(prices) > 1 else None)
    assert spread["none"].market_listing_count == 0 and spread["none"].market_median_price is None and spread["none"].market_avg_mileage is not None and None not in spread


def test_points_are_additive(spark):
    cols = "brand string, model string, year int, price long, mileage long, equipment_score int"
    one = spark.createDataFrame([("a", "m", 1, 10**15 + k % 5, k, None) for k in range(50)], cols)
    gone = one.filter("price % 2 = 0")
    keys = [*KEYS, "price"]
    left = market.added(market.price_points(one), market.negated(market.price_points(gone), keys), keys)
    assert sorted(left.collect()) == sorted(market.price_points(one.exceptAll(gone)).collect())
    stats = market.statistics_of_points(left).first()
    assert stats.market_std_price == pytest.approx(statistics.stdev([10**15 + k % 5 for k in range(50) if (10**15 + k % 5) % 2]), rel=1e-9)  # no digits cancel


def test_summaries_join(spark):
    rng = random.Random(1)
    rows = [("hot", k, rng.random() < 0.8) for k in range(3000)] + [(f"f{k % 5}", k, rng.random() < 0.5) for k in range(60)] + [(None, k, True) for k in range(9)]
    df = spark.createDataFrame(rows, "feed string, n int, hit boolean").repartition(5)
    parts = [streak.summaries(df.filter(c), F.col("hit"), ["n"], ["feed"]) for c in ("n < 700", "n >= 700", "true")]
    one, two, whole = ({r.feed: r.summary for r in p.collect()} for p in parts)
    for feed, s in whole.items():
        hits = [h for f, _, h in sorted(rows, key=lambda r: r[1]) if f == feed]
        runs = "".join("x" if h else " " for h in hits)
        assert (s.n, s.head, s.tail, s.longest, s.missed) == (len(hits), len(runs) - len(runs.lstrip("x")), len(runs) - len(runs.rstrip("x")), max(map(len, runs.split(" "))), " " in runs)
    both = spark.createDataFrame([(one["hot"], two["hot"])], f"a {streak.SUMMARY}, b {streak.SUMMARY}").select(streak.joined(F.col("a"), F.col("b")).alias("s")).first().s
    assert both == whole["hot"]


def test_streams_are_replay_safe(spark, tmp_path):
    """Commit marks of batches are removed, so that each is run again: tables and logs stay as they were."""
    events = "user string, n int, hit boolean"
    landed, logs = f"file://{tmp_path}/in", f"file://{tmp_path}/runs"
    feeds = sinks.SnapshotTable(spark, f"file://{tmp_path}/feeds", "feed", streaming.STREAKS, buckets=2)
    latest = sinks.SnapshotTable(spark, f"file://{tmp_path}/latest", "user", events, buckets=2)

    def run():
        stream = streaming.read_stream(spark, landed, events)
        streaming.streak_stream(stream, feeds, F.col("hit"), "user", ["n"], f"file://{tmp_path}/c1").awaitTermination()
        streaming.upsert_stream(stream, latest, "n", f"file://{tmp_path}/c2", logs).awaitTermination()
        log = spark.read.option("basePath", logs).parquet(f"{logs}/batch=*").select("batch_id", "ads_scraped", "new_ads", "updated_ads", "late_ads")
        return sorted(streaming.streaks_of(feeds, 3).collect(), key=repr), sorted(map(tuple, log.collect())), sorted(latest.read().collect())

    rows = [("a", 1, True), ("a", 2, True), ("b", 1, False), ("a", 3, True), ("b", 2, True), ("c", 9, None), ("b", 3, True), ("b", 4, True), ("c", 1, True)]
    for part in (rows[:4], rows[4:6], rows[6:]):
        spark.createDataFrame(part, events).coalesce(1).write.mode("append").parquet(landed)
        before = run()
    assert [tuple(r) for r in before[0]] == [("a", 3, True), ("b", 3, True), ("c", 1, False)]
    assert before[1] == [(0, 2, 2, 0, 0), (1, 2, 1, 1, 0), (2, 2, 0, 1, 1)] and before[2] == [("a", 3, True), ("b", 4, True), ("c", 9, None)]
    for c in ("c1", "c2"):
        (tmp_path / c / "commits" / "2").unlink()
        (tmp_path / c / "commits" / ".2.crc").unlink(missing_ok=True)
    assert run() == before
    idle = datetime.datetime.now() + datetime.timedelta(days=1)
    streaming.forget_feeds(feeds, idle)
    assert feeds.read().count() == 0


def test_artefact_scores_rows_and_streams(spark, tmp_path):
    rng = random.Random(5)
    rows = raw(spark, [{"brand": rng.choice(["ace", "kia"]), "mileage": m, "price": 9_000_000 - 50 * m, "city": rng.choice(["lahore", "swat"]), "feat_abs": m % 2 == 0} for m in rng.sample(range(1000, 90_000), 60)])
    model = artefact.fit(rows, ["brand"], ["mileage", "feat_abs", "market_avg_mileage"], trees=3, depth=3)
    path = f"file://{tmp_path}/model"
    price_model.save(model, path)
    loaded = price_model.load(path)
    ads = raw(spark, [{"mileage": 2000}, {"mileage": 80_000, "body_type": None, "brand": " KIA", "fuel_type": None}, {"brand": "never seen", "engine_capacity": None, "color": "سفید"}]).drop("price").withColumn("price", F.lit(None).cast("long"))
    ads = readers.attach_source_pk(ads)
    one, two = (sorted((r.source_pk, r.predicted_price, r.brand, r.color, r.market_avg_mileage) for r in m.transform(ads).collect()) for m in (model, loaded))
    assert one == two and one[0][1] > one[1][1] and one[1][2] == "KIA" and one[2][3:] == ("White", None)
    ads.write.parquet(f"file://{tmp_path}/ads")
    out = []
    keep = lambda b, _: out.extend((r.source_pk, r.predicted_price, r.brand, r.color, r.market_avg_mileage) for r in b.collect())
    loaded.transform(streaming.read_stream(spark, f"file://{tmp_path}/ads", ads.schema)).writeStream.foreachBatch(keep).trigger(availableNow=True).option("checkpointLocation", f"file://{tmp_path}/c").start().awaitTermination()
    assert sorted(out) == one
    assert "price_difference" not in price_model.score(loaded, ads, target="absent").columns
    with pytest.raises(ValueError):
        artefact.fit(rows, ["brand"], ["market_avg_price"])


def test_metrics_and_model_choice(spark):
    rows = [("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 5.0, None), ("b", 4.0, 6.0), (None, 2.0, 2.0)]
    got = {(r.slice, r.value): (r.n, r.rmse, r.mae, r.r2) for r in price_model.metrics(spark.createDataFrame(rows, "part string, price double, predicted_price double"), ["part"]).collect()}
    assert got["all", None] == pytest.approx((4, (5 / 4) ** 0.5, 0.75, 1 - 5 / 4 / 1.25)) and got["part", "b"] == (1, 2.0, 2.0, None) and got["part", None][:3] == (1, 0.0, 0.0)
    training, test = price_model.split_by_key(spark.range(2000), "id", 30)
    assert 500 < test.count() < 700 and training.count() + test.count() == 2000 and training.join(test, "id").count() == 0
    df = spark.range(400).select("id", F.col("id").alias("x"), (F.col("id") * F.col("id")).alias("price"))
    model, tried = price_model.select_model(df, [], ["x"], [{"trees": 1, "depth": 1}, {"trees": 1, "depth": 5}], "id")
    by = {r.model: r for r in tried.collect()}
    assert by[1].rmse < by[0].rmse and model.stages[-1].depth == 5


def test_rejects(spark, tmp_path):
    items = spark.createDataFrame([(1, "u"), (None, "u"), (0, ""), (2, ""), (3, None), (4, "v")], "listing_id long, ad_url string")
    kept, rejected = ingest.split_items(items, f"file://{tmp_path}/items")
    assert sorted(r.listing_id for r in kept.collect()) == [1, 4] and sorted(r.reason for r in rejected.collect()) == ["no_address", "no_address", "no_id", "no_id"]
    (tmp_path / "a.csv").write_text('id,price,v\n1,13,"x"\n2,ten,y\n3,1\n4,5,z,w\n5,N/A,\n')
    rows = {r.id: r for r in readers.read_csv(spark, f"file://{tmp_path}/a.csv", "id long, price long, v string", reasons=True).collect()}
    assert {k: r.reason for k, r in rows.items()} == {1: None, 2: "unreadable", 3: "corrupt", 4: "corrupt", 5: None} and rows[3].record == "3,1" and rows[2].record == "2,ten,y"
    kept, rejected = rejects.split(items.limit(0).withColumn("reason", F.lit(None).cast("string")), f"file://{tmp_path}/none")
    assert kept.count() == rejected.count() == 0 and kept.columns == items.columns


def test_clean_with_rejects_is_clean_rows(spark, tmp_path):
    df = readers.attach_source_pk(raw(spark, [{}, {"listing_id": 1001}, {"registered_in": None}, {"price": -1}, {"listing_id": 1004}, {"body_type": None}, {"body_type": "N/A", "brand": "x"}]))
    kept, rejected, seen = listings.clean_with_rejects(df, f"file://{tmp_path}/r")
    assert sorted(kept.select(*df.columns).collect(), key=str) == sorted(listings.clean_rows(df).select(*df.columns).collect(), key=str)
    assert sorted((r.source_pk, r.reason) for r in rejected.collect()) == [(2, "duplicate"), (3, "null_value"), (4, "price"), (5, "duplicate")]
    counts = rejects.counts_of(kept, seen).first()
    assert counts.n_rows == df.count() == kept.count() + rejected.count() and (counts.n_filled, counts.n_unknown) == (1, 1)


def test_scratch_is_cleared(spark):
    df = scratch.staged(spark.range(3), "some")
    assert df.count() == 3 and scratch.clear(spark) >= 1 and scratch.clear(spark) == 0
