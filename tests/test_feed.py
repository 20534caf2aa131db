"""The feed laid out by channel and ids: same pages, fewer files."""

import pytest
from conftest import explained, rows, ts
from pyspark.sql import functions as F

from kerbside.operators import ingest
from kerbside.plans.catalog import PAGE, PER_RUN, Tables
from kerbside.schemas import MESSAGE_COLUMNS, MESSAGE_SCHEMA, SOURCE_SCHEMA, STATE_SCHEMA
from kerbside.sources import feed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    """Channels a to d with ids 1 to 1000 in ten folders each; every fifth message has topic 7."""
    at = ts("2024-05-01 00:00:00")
    data = [(c, 7 if i % 5 == 0 else None, i, at, f"{c}{i}", 1, "u", at) for c in "abcd" for i in range(1, 1001)]
    where = str(tmp_path_factory.mktemp("feed"))
    messages = spark.createDataFrame(data, MESSAGE_SCHEMA)
    feed.write_feed(messages.where("id <= 500"), where, 100)
    feed.write_feed(messages.where("id > 500"), where, 100)
    return where


def plan_of(spark, sources, state, **limits):
    keyed = [(c, t, c if t is None else f"{c}#topic={t}") for c, t in sources]
    return ingest.source_plan(spark.createDataFrame(keyed, SOURCE_SCHEMA), spark.createDataFrame(state, STATE_SCHEMA), **limits)


def opened(df):
    """Folders of the rows."""
    return {(f"channel={r.channel}", f"id_block={r.block}") for r in df.select("channel", F.floor(F.col("id") / 100).alias("block")).distinct().collect()}


def check(spark, path, plan, limited):
    got = ingest.scan_sources(feed.pending_feed(spark, path, plan), plan, limited)
    want = ingest.scan_sources(feed.read_feed(spark, path).select(*MESSAGE_COLUMNS), plan, limited)
    assert rows(got) == rows(want)
    return rows(got)


def test_pages_are_the_same(spark, path):
    state = [("a", 1000, True), ("b", 250, False), ("c", 999, True), ("d#topic=7", 480, False)]
    sources = [("a", None), ("b", None), ("c", None), ("d", 7), ("d", None)]
    for per_run, page in ((0, 0), (3, 120), (50, 1), (0, 301)):
        assert check(spark, path, plan_of(spark, sources, state, per_run=per_run, page=page), bool(per_run or page))


def test_a_source_that_has_read_everything_opens_no_file(spark, path):
    plan = plan_of(spark, [("a", None), ("b", None), ("c", None)], [("a", 1000, True), ("b", 2000, True), ("c", 950, True)])
    pending = feed.pending_feed(spark, path, plan)
    assert opened(feed.read_feed(spark, path)) == {(f"channel={c}", f"id_block={n}") for c in "abcd" for n in range(11)}
    assert opened(pending) == {("channel=c", "id_block=9"), ("channel=c", "id_block=10")}
    pending.collect()
    assert _files(pending) == [2]


def _files(df):
    """How many files each scan of the executed plan has read."""
    found, plans = [], [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif name == "FileSourceScanExec" and "dynamicpruning" in plan.toString() and plan.metrics().contains("numFiles"):
            found.append(plan.metrics().apply("numFiles").value())
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return found


def test_a_page_opens_as_many_folders_as_it_needs(spark, path):
    plan = plan_of(spark, [("b", None)], [("b", 250, False)], page=120)
    assert opened(feed.pending_feed(spark, path, plan)) == {("channel=b", f"id_block={n}") for n in (2, 3, 4)}
    plan = plan_of(spark, [("d", 7)], [("d#topic=7", 880, False)], page=1)
    assert opened(feed.pending_feed(spark, path, plan)) == {("channel=d", f"id_block={n}") for n in (8, 9, 10)}


def test_partitions_are_pruned_by_the_plan_table(spark, path):
    plan = plan_of(spark, [("a", None)], [("a", 900, True)])
    assert "dynamicpruning" in explained(feed.pending_feed(spark, path, plan))


def test_an_empty_plan_and_a_source_without_messages(spark, path):
    assert feed.pending_feed(spark, path, plan_of(spark, [], [])).count() == 0
    assert feed.pending_feed(spark, path, plan_of(spark, [("nobody", None)], [], page=10)).count() == 0


def test_the_sample_tables(spark, tmp_path):
    t = Tables(spark, SF)
    feed.write_feed(t.messages, str(tmp_path), 100)
    pending = feed.pending_feed(spark, str(tmp_path), t.plan)
    assert rows(ingest.scan_sources(pending, t.plan)) == rows(ingest.scan_sources(t.messages, t.plan)) and PER_RUN and PAGE
    assert pending.count() < t.messages.count()


def test_many_small_ranges_share_folders(spark, tmp_path, monkeypatch):
    """400 ranges of ten ids become at most 16 folders; later runs keep to them, and pages are the same."""
    monkeypatch.setattr(feed, "MOST_FOLDERS", 16)
    at = ts("2024-05-01 00:00:00")
    data = [(c, 7 if i % 5 == 0 else None, i, at, f"{c}{i}", 1, "u", at) for c in "abcd" for i in range(1, 1001)]
    messages = spark.createDataFrame(data, MESSAGE_SCHEMA)
    path = str(tmp_path)
    feed.write_feed(messages.where("id <= 900"), path, 10)
    feed.write_feed(messages.where("id > 900"), path, 10)
    assert len(list(tmp_path.glob("rows/channel=*/id_block=*"))) <= 16
    sources, state = [("a", None), ("b", None), ("c", None), ("d", 7), ("d", None)], [("a", 1000, True), ("b", 250, False), ("c", 899, True), ("d#topic=7", 480, False)]
    for per_run, page in ((0, 0), (3, 120), (50, 1), (0, 301)):
        assert check(spark, path, plan_of(spark, sources, state, per_run=per_run, page=page), bool(per_run or page))
    pending = feed.pending_feed(spark, path, plan_of(spark, [("b", None)], [("b", 250, False)], page=120))
    assert 120 < pending.count() < 1000 and pending.where("channel <> 'b'").isEmpty()
