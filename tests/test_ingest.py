import pytest
from conftest import explained, rows, ts

from kerbside.operators import ingest
from kerbside.schemas import MESSAGE_SCHEMA, SOURCE_SCHEMA, STATE_SCHEMA


def messages(spark, ids, channel="a", topic=None, year=2024):
    at = ts(f"{year}-05-01 00:00:00")
    return spark.createDataFrame([(channel, topic, i, at, f"m{i}", 1, "u", at) for i in ids], MESSAGE_SCHEMA)


def sources(spark, *entries):
    return spark.createDataFrame([(c, t, c.lower() if t is None else f"{c.lower()}#topic={t}") for c, t in entries], SOURCE_SCHEMA)


def state(spark, *entries):
    return spark.createDataFrame(list(entries), STATE_SCHEMA)


@pytest.mark.parametrize(("done", "per_run", "page", "mode", "limit"), [
    (False, 100, 0, "full_history", None), (False, 100, 250, "full_history", 250),
    (True, 100, 0, "incremental", 100), (True, 0, 250, "incremental", None)])
def test_mode_and_limit(spark, done, per_run, page, mode, limit):
    plan = ingest.source_plan(sources(spark, ("A", None)), state(spark, ("a", 123, done)), per_run, page).collect()[0]
    assert (plan.sync_mode, plan.row_limit, plan.channel) == (mode, limit, "a")


def test_invalid_limits_and_marks(spark):
    s, empty = sources(spark, ("a", None)), state(spark)
    with pytest.raises(ValueError, match="per_run"):
        ingest.source_plan(s, empty, per_run=-1)
    with pytest.raises(ValueError, match="page"):
        ingest.source_plan(s, empty, page=-1)
    with pytest.raises(Exception, match="last_message_id"):
        ingest.source_plan(s, state(spark, ("a", -1, True))).collect()


@pytest.mark.parametrize("limit", [1, 2, 3, 64, 500])
def test_pages_equal_the_first_rows_by_id(spark, monkeypatch, limit):
    """Small blocks, so that the page end falls inside, at and after block borders."""
    monkeypatch.setattr(ingest, "PAGE_BLOCK", 8)
    ids = [3, 5, 6, 7, 8, 9, 15, 16, 17, 40, 41, 42, 43, 90, 91] + list(range(100, 160))
    all_rows = messages(spark, ids).unionByName(messages(spark, [2, 4, 1000], "b"))
    plan = ingest.source_plan(sources(spark, ("@A", None), ("b", None)), state(spark, ("a", 5, True)), limit, 2)
    got = ingest.scan_sources(all_rows, plan)
    assert sorted(r.id for r in got.where("state_key = '@a'").collect()) == ids[:2]
    plan = ingest.source_plan(sources(spark, ("a", None), ("b", None)), state(spark, ("a", 5, True)), limit, 2)
    got = ingest.scan_sources(all_rows, plan)
    assert sorted(r.id for r in got.where("state_key = 'a'").collect()) == [i for i in ids if i > 5][:limit]
    assert sorted(r.id for r in got.where("state_key = 'b'").collect()) == [2, 4]


def test_copies_of_the_last_id_stay_together(spark):
    copies = messages(spark, [1, 2, 2, 2, 3])
    plan = ingest.source_plan(sources(spark, ("a", None)), state(spark), 0, 2)
    assert sorted(r.id for r in ingest.scan_sources(copies, plan).collect()) == [1, 2, 2, 2]


def test_a_topic_source_sees_its_topic_and_stamps_it(spark):
    both = messages(spark, [1, 2], topic=7).unionByName(messages(spark, [3], topic=8)).unionByName(messages(spark, [4]))
    got = ingest.incremental_fetch(both, sources(spark, ("a", 7), ("a", None)), state(spark), scraped_at="2025-01-01 00:00:00")
    assert {(r.state_key, r.topic_id, r.id, r.sender_handle, str(r.scraped_at_gmt8)) for r in got.collect()} == {
        ("a#topic=7", 7, i, "@u", "2025-01-01 00:00:00") for i in (1, 2)} | {
        ("a", None, i, "@u", "2025-01-01 00:00:00") for i in (1, 2, 3, 4)}


def test_checkpoints_advance_and_backfill_ends_on_a_short_page(spark):
    s = sources(spark, ("a", None), ("b", None), ("c", None), ("d", None))
    known = state(spark, ("b", 50, True), ("d", 9, False))
    log = messages(spark, range(1, 6)).unionByName(messages(spark, [60, 61, 62], "b")).unionByName(messages(spark, [1], "d"))
    plan = ingest.source_plan(s, known, per_run=3, page=4)
    page = ingest.scan_sources(log, plan)
    assert rows(ingest.checkpoint_advance(plan, page)) == [
        ("a", 4, False), ("b", 62, True), ("c", 0, True), ("d", 9, True)]
    assert rows(ingest.sync_summary(plan, page)) == [(4, 7, 7, "mixed")]


def test_a_year_filter_does_not_end_a_full_page(spark):
    log = messages(spark, [1, 2], year=2019).unionByName(messages(spark, [3, 4]))
    plan = ingest.source_plan(sources(spark, ("a", None)), state(spark), 0, 2)
    page = ingest.scan_sources(log, plan)
    assert ingest.since_year_filter(page, 2020).count() == 0
    assert rows(ingest.checkpoint_advance(plan, page)) == [("a", 2, False)]


def test_rebuild(spark):
    log = messages(spark, [1, 9]).unionByName(messages(spark, [4], topic=7))
    assert rows(ingest.checkpoint_rebuild(log)) == [("a#topic=7", 4), ("a", 9)]


def test_messages_are_not_shuffled_to_find_pages(spark, tmp_path):
    messages(spark, range(50)).write.parquet(str(tmp_path / "m"))
    log = spark.read.schema(MESSAGE_SCHEMA).parquet(str(tmp_path / "m"))
    plan = ingest.source_plan(sources(spark, ("a", None)), state(spark), 0, 10)
    nodes = explained(ingest.scan_sources(log, plan)).split("\n\n")
    exchanges = [n for n in nodes if ") Exchange" in n.split("\n")[0] or n.startswith("\n") and ") Exchange" in n.split("\n")[1]]
    assert not any("message_date_gmt8" in n for n in exchanges)
    assert ingest.scan_sources(log, plan).count() == 10


def test_topics_are_matched_by_equal_keys(spark):
    """Two thousand topics of one channel: no message is compared with all of them."""
    many = sources(spark, *[("a", n) for n in range(2000)], ("a", None))
    rows_in = messages(spark, [1, 2, 3], topic=7)
    got = ingest.scan_sources(rows_in, ingest.source_plan(many, state(spark)))
    assert sorted((r.state_key, r.id) for r in got.collect()) == sorted([("a", n) for n in (1, 2, 3)] + [("a#topic=7", n) for n in (1, 2, 3)])
    keys = [line for line in explained(got).split("\n") if line.startswith("Left keys")]
    assert any("channel" in k and "topic_id" in k for k in keys), keys
    assert "NestedLoop" not in got._jdf.queryExecution().sparkPlan().toString()


def test_marks_never_move_back(spark):
    stored, run = state(spark, ("a", 9, True), ("b", 2, False)), state(spark, ("a", 5, False), ("c", 1, False), ("b", 7, True))
    assert rows(ingest.advance_state(stored, run)) == [("a", 9, True), ("b", 7, True), ("c", 1, False)]
