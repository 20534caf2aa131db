import pytest
from conftest import rows
from pyspark.sql import functions as F

from kerbside.operators.upsert import SchemaMismatch, merge_counts, replace_by_key, require_schema, schema_guard, upsert

SCHEMA = "channel string, id long, topic_id long, message string"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, 7, "old"), ("a", 2, None, "keep"), ("b", 1, 9, "old")], SCHEMA)


def test_matched_rows_take_the_source_and_keep_a_known_topic(spark, target):
    source = spark.createDataFrame([("a", 1, None, None), ("b", 1, 5, "new"), ("c", 1, None, "added")], SCHEMA)
    once = upsert(target, source, ["channel", "id"], ["topic_id"])
    want = sorted([("a", 1, 7, None), ("a", 2, None, "keep"), ("b", 1, 5, "new"), ("c", 1, None, "added")], key=repr)
    assert rows(once) == want
    assert rows(upsert(once, source, ["channel", "id"], ["topic_id"])) == want


def test_an_older_source_row_only_fills_a_gap(spark):
    target = spark.createDataFrame([("a", 5, None, "now"), ("b", 5, 1, "now")], "k string, at int, topic int, m string")
    source = spark.createDataFrame([("a", 4, 9, "before"), ("b", 5, None, "again"), ("c", 1, None, "new")], target.schema)
    assert rows(upsert(target, source, ["k"], ["topic"], "at")) == sorted(
        [("a", 5, 9, "now"), ("b", 5, 1, "again"), ("c", 1, None, "new")], key=repr)


def test_two_source_rows_for_one_target_row_raise(spark, target):
    source = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y")], SCHEMA)
    with pytest.raises(Exception, match="several source rows match"):
        upsert(target, source, ["channel", "id"]).collect()
    with pytest.raises(Exception, match="several source rows match"):
        upsert(target, source, ["channel", "id"]).select("channel").collect()


def test_two_source_rows_for_a_new_key_are_both_added(spark, target):
    source = spark.createDataFrame([("z", 1, 1, "x"), ("z", 1, 2, "y")], SCHEMA)
    assert upsert(target, source, ["channel", "id"]).where("channel = 'z'").count() == 2


def test_replace_spares_protected_rows(spark):
    target = spark.createDataFrame([("p", "override"), ("p", "onemap"), ("p", None), ("q", "rule")], "place string, source string")
    batch = spark.createDataFrame([("p", "rule"), ("p", "rule")], "place string, source string")
    got = rows(replace_by_key(target, batch, ["place"], protect=F.col("source") == "override"))
    assert got == sorted([("p", "override"), ("p", None), ("p", "rule"), ("p", "rule"), ("q", "rule")], key=repr)
    assert rows(replace_by_key(target, batch, ["place"])) == sorted([("p", "rule"), ("p", "rule"), ("q", "rule")], key=repr)


def test_a_merge_is_counted(spark, target):
    source = spark.createDataFrame([("a", 1, None, "old"), ("a", 2, 3, "keep"), ("b", 1, 9, "old"), ("b", 1, None, None), ("c", 1, None, "x"), (None, 1, None, "x")], SCHEMA)
    assert rows(merge_counts(target, source, ["channel", "id"], ["topic_id"])) == [(2, 2, 2)]  # a topic filled in is an update
    assert rows(merge_counts(target, source, ["channel", "id"])) == [(2, 3, 1)]
    assert rows(merge_counts(target, source.limit(0), ["channel", "id"])) == [(0, 0, 0)]
    merged = upsert(target, source.where("message IS NOT NULL"), ["channel", "id"], ["topic_id"])
    assert rows(merge_counts(merged, source.where("message IS NOT NULL AND channel IS NOT NULL"), ["channel", "id"], ["topic_id"])) == [(0, 0, 4)]


def test_schema_guard(spark):
    legacy = spark.createDataFrame([(1, "x", "m")], "id long, date string, message string")
    expected = ["channel", "id", "message"]
    assert rows(schema_guard(legacy, expected)) == [
        ("channel", "missing", 1), ("date", "extra", 1), ("id", "expected", 1), ("message", "expected", 1)]
    with pytest.raises(SchemaMismatch, match="missing columns: channel; extra columns: date"):
        require_schema(legacy, expected)
    assert require_schema(legacy.drop("date").withColumn("channel", F.lit("c")), expected).columns == expected
