"""Bucketed tables: merges equal the plain ones, the table is not exchanged, other slices stay."""

import uuid
from pathlib import Path

import pytest
from conftest import explained, rows
from pyspark.sql import functions as F

from kerbside.operators.upsert import upsert
from kerbside.sources import buckets
from kerbside.sources.workspace import stored

SCHEMA = "channel string, id long, topic_id long, message string"


def table_of(spark, data, keys=("channel", "id"), n=8, slices=4):
    df = spark.createDataFrame(data, SCHEMA)
    return df, buckets.create_bucketed(df, f"t_{uuid.uuid4().hex}", keys, n, slices)


def posts(n):
    return [(f"c{i % 3}", i, i % 5 or None, f"m{i}") for i in range(n)]


def slice_files(spark, table):
    folder = spark.sql(f"DESCRIBE FORMATTED {table.name}").where("col_name = 'Location'").first().data_type.removeprefix("file:")
    return {p.parent.name: p.name for p in Path(folder).rglob("*.parquet")}


def test_a_merge_equals_the_plain_one(spark):
    df, table = table_of(spark, posts(200))
    source = stored(spark.createDataFrame([("c0", 3, None, "new"), ("c1", 1, 9, None), ("z", 5, 1, "added"), ("z", 5, 1, "added"), (None, 7, 1, "no key")], SCHEMA), "source")
    want = rows(upsert(df, source, ["channel", "id"], ["topic_id"]))
    touched = buckets.upsert_bucketed(table, source, ["topic_id"])
    assert rows(table.read()) == want and touched
    buckets.upsert_bucketed(table, source.where("channel <> 'z' AND channel IS NOT NULL"), ["topic_id"])
    assert rows(table.read()) == want  # again changes nothing


def test_the_table_is_not_exchanged_and_only_touched_slices_are_opened(spark):
    _, table = table_of(spark, posts(500))
    source = stored(spark.createDataFrame([("c0", 3, None, "new")], SCHEMA), "source")
    numbers = table.touched(source)
    assert len(numbers) == 1
    plan = explained(upsert(table.target(numbers), source, ["channel", "id"]))
    tree = plan.split("\n\n")[0].splitlines()
    scans = [i for i, line in enumerate(tree) if "Scan parquet" in line and table.name in line]
    assert len(scans) == 1
    depth = lambda line: len(line) - len(line.lstrip(" :+-|*"))
    above, at = [], depth(tree[scans[0]])
    for line in reversed(tree[:scans[0]]):
        if line.strip() and depth(line) < at:
            above.append(line)
            at = depth(line)
    assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above)
    assert f"PartitionFilters: [isnotnull({buckets.SLICE}" in plan or f"({buckets.SLICE}#" in plan
    assert "Bucketed: true" in plan
    opened = {Path(r[0]).parent.name for r in table.target(numbers).select(F.input_file_name()).distinct().collect()}
    assert opened == {f"{buckets.SLICE}={numbers[0]}"}


def test_other_slices_keep_their_files(spark):
    _, table = table_of(spark, posts(300))
    before = slice_files(spark, table)
    source = stored(spark.createDataFrame([("c0", 3, None, "new")], SCHEMA), "source")
    (number,) = buckets.upsert_bucketed(table, source)
    after = slice_files(spark, table)
    assert set(before) == set(after) and len(before) == 4
    assert {s for s in after if after[s] != before[s]} == {f"{buckets.SLICE}={number}"}


def test_a_slice_may_lose_all_rows_and_get_new_ones(spark):
    df, table = table_of(spark, posts(40))
    (number,) = table.touched(df.limit(1))
    own = stored(df.where(table.slice_of() == number), "gone")
    buckets.replace_bucketed(table, own, stored(df.limit(0), "fresh"))
    assert rows(table.read()) == rows(df.where(table.slice_of() != number))
    one = stored(own.limit(1), "one")
    buckets.replace_bucketed(table, one, one)
    assert rows(table.read()) == rows(df.where(table.slice_of() != number).union(one))


def test_replace_deletes_and_adds(spark):
    df, table = table_of(spark, posts(60))
    gone = stored(spark.createDataFrame([("c1", 1, None, ""), ("c2", 2, None, ""), ("absent", 2, None, "")], SCHEMA), "gone")
    fresh = stored(spark.createDataFrame([("c2", 2, 1, "again"), ("c2", 2, 2, "twice"), ("n", 1, 1, "new")], SCHEMA), "fresh")
    buckets.replace_bucketed(table, gone, fresh)
    assert rows(table.read()) == rows(df.join(gone, ["channel", "id"], "left_anti").select(*df.columns).union(fresh))


def test_several_source_rows_for_one_row_leave_the_table_as_it_was(spark):
    df, table = table_of(spark, posts(30))
    source = stored(spark.createDataFrame([("c0", 3, 1, "x"), ("c0", 3, 1, "y")], SCHEMA), "source")
    with pytest.raises(Exception, match="several source rows match"):
        buckets.upsert_bucketed(table, source)
    assert rows(table.read()) == rows(df)


def test_an_empty_batch_and_an_empty_table(spark):
    df, table = table_of(spark, posts(10))
    assert buckets.upsert_bucketed(table, stored(df.limit(0), "none")) == []
    empty, table = table_of(spark, [])
    buckets.upsert_bucketed(table, stored(df, "all"))
    assert rows(table.read()) == rows(df)


def test_buckets_are_a_multiple_of_slices(spark):
    df = spark.createDataFrame(posts(20), SCHEMA)
    table = buckets.create_bucketed(df, f"t_{uuid.uuid4().hex}", ["id"], 10, 4)
    assert (table.buckets, table.slices) == (12, 4) and rows(table.read()) == rows(df)
    assert buckets.create_bucketed(df, f"t_{uuid.uuid4().hex}", ["id"]).slices == 2  # as many as shuffle partitions
