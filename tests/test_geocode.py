import pytest
from conftest import explained, rows, ts
from pyspark.sql import functions as F

from kerbside.operators import geocode
from kerbside.plans.catalog import Tables
from kerbside.schemas import GAZETTEER_SCHEMA, GEOCODE_COLUMNS, GEOCODE_SCHEMA, OVERRIDE_SCHEMA

NOW = ts("2024-01-05 06:07:08")
SF = "/root/testdata/sf0.001"


def now():
    return F.lit("2024-01-05 06:07:08").cast("timestamp")


@pytest.fixture(scope="module")
def gazetteer(spark):
    def hit(query, rank, postal, lat="1.30001", lon="103.80001", name="N"):
        return (query, rank, postal, lat, lon, f"{query} Road", name)

    return spark.createDataFrame([
        hit("vivo", 1, "098585"), hit("plaza", 1, "111111"), hit("plaza", 2, "222222"), hit("plaza lobby", 1, "NIL"),
        hit("bugis", 1, "NIL"), hit("bugis", 2, "188024", lat="1.5"), hit("bugis", 3, " 188024 "),
        hit("530100", 1, "999999"), hit("530100", 2, " 530100 "), hit("530102", 1, "999999"),
        hit("broken", 1, "123456", lat="?"), hit("530300", 1, "530300", lon=None),
        hit("Bedok MRT Station", 1, "460001", name="BUS STOP"), hit("Bedok MRT Station", 2, "460002", name="BEDOK MRT"),
        hit("Dover MRT Station", 1, "NIL"), hit("Expo MRT Station", 2, "500002", name=""), hit("Expo MRT Station", 1, "500001", lat=" "),
    ], GAZETTEER_SCHEMA)


def locate(spark, *texts):
    requests = spark.createDataFrame([(t, None) for t in texts], "pickup_location string, dropoff_location string")
    return geocode.distinct_locations(requests)


def outcome(df):
    return {(r.normalized_location, r.postal_code): (r.resolution_status, r.resolution_source, r.result_count, r.latitude) for r in df.collect()}


def test_places_walk_their_fallbacks(spark, gazetteer):
    got = outcome(geocode.resolve_places(locate(spark, "KSL  City", "Vivo Lobby", "Plaza lobby", "bugis", "broken hotel"), gazetteer))
    assert got == {
        ("ksl city", None): ("no_match", "onemap", 0, None),
        ("vivo lobby", "098585"): ("resolved", "onemap", 1, 1.30001),
        ("plaza lobby", None): ("ambiguous", "onemap", 2, None),
        ("bugis", "188024"): ("resolved", "onemap", 3, 1.5),
        ("broken hotel", None): ("error", "onemap", 0, None),
    }


def test_every_postal_code_is_settled(spark, gazetteer):
    got = geocode.resolve_postals(locate(spark, "Blk 530100 / 530102, again 530100", "at 530300"), gazetteer)
    assert outcome(got) == {
        ("blk 530100 / 530102, again 530100", "530100"): ("resolved", "onemap", 2, 1.30001),
        ("blk 530100 / 530102, again 530100", "530102"): ("resolved", "rule", 1, None),
        ("at 530300", "530300"): ("resolved", "rule", 0, None),
    }
    reasons = {r.postal_code: r.error_message for r in got.collect()}
    assert reasons["530100"] is None and reasons["530102"].endswith("postal code 530102")


def test_a_run_is_the_union_of_its_parts(spark, gazetteer):
    places = ["KSL  City", "Vivo Lobby", "Plaza", "bugis", "JB", "Anywhere", "Blk 530100 / 530102", "jb 530100"]
    requests = spark.createDataFrame([(p, None) for p in places], "pickup_location string, dropoff_location string")
    empty = spark.createDataFrame([], GEOCODE_SCHEMA)
    whole = geocode.geocode_run(requests, empty, gazetteer, now())
    assert whole.columns == GEOCODE_COLUMNS
    found = geocode.distinct_locations(requests)
    plain = found.where(~F.col("normalized_location").isin("jb", "anywhere") & ~F.col("original_location").rlike("[0-9]{6}"))
    parts = (geocode.resolve_places(plain, gazetteer).unionByName(geocode.resolve_postals(found, gazetteer))
             .unionByName(geocode.non_specific_rule(found)))
    assert rows(whole) == rows(geocode.geocode_row(parts, now()))
    cached = geocode.geocode_replace(empty, whole)
    assert geocode.locations_to_resolve(requests, cached).count() == 0
    assert geocode.locations_to_resolve(requests, empty, limit=3).count() == 3


def test_rows_are_shaped(spark, gazetteer):
    long = geocode.resolve_places(locate(spark, "nowhere"), gazetteer).withColumn("error_message", F.repeat(F.lit("x"), 3000))
    assert len(geocode.geocode_row(long, now()).collect()[0].error_message) == 3000
    r = geocode.geocode_row(long, now(), reason_length=1000).collect()[0]
    assert len(r.error_message) == 1000 and r.attempted_at == NOW and r.resolved_at is None


def test_what_is_looked_up_again(spark):
    def cached(place, code, status):
        return (place, place, code, None, None, None, None, status, "onemap", 0, None, NOW, None)

    cache = spark.createDataFrame([
        cached("failed", None, "error"), cached("known", "111111", "resolved"), cached("no code 123456", None, "no_match"),
        cached("123456 654321", "123456,654321", "resolved"), cached("one 123456", "123456", "resolved"),
        cached("123456", "1,2", "resolved"), cached("none", None, "no_match"),
        cached("two rows 123456", "123456", "resolved"), cached("two rows 123456", None, "resolved")], GEOCODE_SCHEMA)
    names = [r.normalized_location for r in cache.select("normalized_location").distinct().collect()] + ["New"]
    requests = spark.createDataFrame([(n, n.upper()) for n in names], "pickup_location string, dropoff_location string")
    got = {r.normalized_location for r in geocode.locations_to_resolve(requests, cache).collect()}
    assert got == {"failed", "no code 123456", "123456 654321", "two rows 123456", "new"}


def test_stations(spark, gazetteer):
    made, failed = geocode.build_overrides(geocode.town_queries(spark), gazetteer, now())
    got = {r.normalized_location: (r.postal_code, r.formatted_address, r.notes) for r in made.collect()}
    assert set(got) == {"bedok", "expo"} and got["bedok"][0] == "460002" and got["expo"][0] == "500002"
    assert got["bedok"][2] == "Town-level override to OneMap MRT station search: Bedok MRT Station"
    missing = {r.normalized_location: r.hit_count for r in failed.collect()}
    assert len(missing) == 50 and missing["dover"] == 1 and missing["yishun"] == 0


def test_overrides_rewrite_every_row_of_a_place(spark):
    t = Tables(spark, SF)
    overrides = spark.createDataFrame([("  BUGIS ", "1", 1.0, 2.0, "a", "n", ts("2024-01-01 00:00:00")),
                                       ("bugis", "2", 1.0, 2.0, "b", "n", ts("2024-02-01 00:00:00")),
                                       ("nowhere yet", "3", None, None, None, None, None)], OVERRIDE_SCHEMA)
    twice = t.cache.unionByName(t.cache.where("normalized_location = 'bugis'"))
    got = geocode.apply_overrides(twice, overrides, now())
    assert got.count() == twice.count() + 1
    changed = got.where("normalized_location in ('bugis', 'nowhere yet')").select(
        "normalized_location", "postal_code", "resolution_source", "result_count", "search_value").collect()
    assert sorted(map(tuple, changed)) == [("bugis", "2", "override", 1, "bugis")] * 2 + [("nowhere yet", "3", "override", 1, "nowhere yet")]
    kept = geocode.geocode_replace(got, got.where("normalized_location = 'bugis'").limit(1).withColumn("resolution_source", F.lit("onemap")))
    assert kept.where("normalized_location = 'bugis'").count() == 3


def test_hot_places_are_reduced_before_the_shuffle(spark):
    plan = explained(geocode.distinct_locations(Tables(spark, SF).silver_table))
    assert "HashAggregate" in plan and "partial_count" in plan and "partial_min" in plan
