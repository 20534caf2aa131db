"""Dashboard rows from kept partials against those of all of Gold, after every run."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import explained, rows

from kerbside.operators import partials, serving
from kerbside.schemas import DRIVER, HITCHER

GOLD = "gold_request_id string, request_type string, message_date_gmt8 timestamp_ntz"


def posts(r, end, n):
    """Ids repeat within a minute, a window and over midnight; times lie on and beside minutes."""
    out = []
    for _ in range(n):
        at = end - timedelta(minutes=r.randrange(-60, 4 * 1440), microseconds=r.choice([0, 0, 1, -1, 30_000_000]))
        if r.random() < 0.3:
            at = datetime(at.year, at.month, at.day) + timedelta(microseconds=r.choice([-1, 0, 1, -30_000_000]))
        out.append((f"id{r.randrange(40)}", r.choice([HITCHER, DRIVER, "other"]), at))
    return [*out, (None, HITCHER, end), ("x", HITCHER, None)]


@pytest.mark.parametrize("seed", range(2))
def test_updates_equal_all_of_gold(spark, tmp_path, seed):
    r, root = random.Random(seed), str(tmp_path / "partials")
    end = datetime(2024, 1, 8, 0, 7)
    now = posts(r, end, 120)
    partials.write_partials(spark.createDataFrame(now, GOLD), root)
    for run in range(3):
        before = now
        gone = set(r.sample(range(len(now)), 15))
        if run == 1:  # a whole day goes
            gone |= {i for i, p in enumerate(now) if p[2] and p[2].day == 6}
        now = [p for i, p in enumerate(now) if i not in gone] + (posts(r, end, 10) if run != 1 else [])
        changed = [p for p in before + now if (p in before) != (p in now)] + [p for p in now if before.count(p) != now.count(p)]
        gold = spark.createDataFrame(now, GOLD)
        days = partials.changed_days(spark.createDataFrame(changed, GOLD))
        for _ in range(2 if run == 2 else 1):  # a repeated update changes nothing
            partials.update_partials(gold, root, days)
        kept = partials.read_partials(spark, root)
        for as_of in ("2024-01-08 00:07:21", "2024-01-06 23:59:00"):
            assert rows(partials.dashboard_rows(kept, gold, as_of)) == rows(serving.dashboard_rows(gold, as_of))
    got, want = partials.rolling_counts(kept, "2024-01-07 12:01:00", (2, 5), 20, 60), serving.rolling_counts(gold, "2024-01-07 12:01:00", (2, 5), 20, 60)
    assert rows(got) == rows(want)


def test_size_and_days_read(spark, tmp_path):
    root, at = str(tmp_path / "partials"), datetime(2024, 3, 1, 12)
    many = [(f"id{i}", HITCHER, at - timedelta(days=i % 60)) for i in range(3000)]
    partials.write_partials(spark.createDataFrame(many, GOLD), root)
    kept = partials.read_partials(spark, root)
    assert kept.count() == 60 and kept.groupBy().sum("n").collect()[0][0] == 3000
    plan = explained(partials.rolling_counts(kept, at))
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "day" in filters and "2024-02-1" in filters
    used = partials.daily_counts(kept, at)
    assert used.groupBy().sum("total_count").collect()[0][0] == 14 * 50
    with pytest.raises(ValueError, match="reach"):
        partials.rolling_counts(kept, at, (7,))
    partials.update_partials(spark.createDataFrame([], GOLD), root, [])
    assert kept.count() == 60
    empty = partials.read_partials(spark, str(tmp_path / "none"))
    assert rows(partials.daily_counts(empty, at)) == rows(serving.daily_counts(spark.createDataFrame([], GOLD), at))
