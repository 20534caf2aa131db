"""Repost suppression with state per key: a post is decided in the micro-batch it comes in.

The windowed form (``streams.stream_repost_dedup``) waits until a slot closes. This one
answers at once and takes an answer back where a late, earlier post makes it wrong: its
result is a log of changes, and what stands after them is what ``gold.repost_dedup`` gives.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from kerbside.functions import clock
from kerbside.streaming.streams import POST_KEYS

ADD, RETRACT = "add", "retract"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = "runs array<struct<at: bigint, cid: string, channel: string, message_id: bigint, last: bigint>>"
_OUT = ", ".join(f"{k} string" for k in POST_KEYS) + ", at bigint, channel string, message_id bigint, change string"

Run = list  # [at, cid, channel, message_id, last]: a first post and the time of the last one


def place_post(runs: list[Run], post: tuple[int, str, str, int], gap: int) -> list[tuple[str, tuple]]:
    """Put a post into ``runs``, which are sorted, and return what changes.

    A run is a longest chain of posts each at most ``gap`` after the one before; only its
    first post stays. A post within a run, or up to a gap after it, is a repost. Else it
    stays, and the next run's first post goes if it is within the gap. Either way two runs
    may become one.
    """
    at, cid = post[:2]
    n = bisect.bisect_right(runs, [at, cid], key=lambda r: r[:2])
    before = runs[n - 1] if n else None
    changes = []
    if before is not None and at <= before[4] + gap:
        before[4] = max(before[4], at)
        own, n = before, n - 1
    else:
        own = [*post, at]
        runs.insert(n, own)
        changes.append((ADD, post))
    while n + 1 < len(runs) and runs[n + 1][0] - own[4] <= gap:
        after = runs.pop(n + 1)
        own[4] = max(own[4], after[4])
        changes.append((RETRACT, tuple(after[:4])))
    return changes


class RepostRuns(StatefulProcessor):
    """The state of a key is its runs, at most one a gap between the watermark and the newest
    post, however many posts there are; a timer drops them when no post can reach them."""

    def __init__(self, gap_hours: int):
        self._gap = gap_hours * 3_600_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._runs = handle.getValueState("runs", _STATE)

    def _read(self) -> list[Run]:
        held = self._runs.get() if self._runs.exists() else None
        return [list(r) for r in held[0]] if held else []

    def _keep(self, runs: list[Run], watermark_ms: int) -> None:
        runs = [r for r in runs if (r[4] + self._gap) // 1000 >= watermark_ms]
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        if runs:
            self._runs.update(([tuple(r) for r in runs],))
            self._handle.registerTimer((min(r[4] for r in runs) + self._gap) // 1000 + 1)
        else:
            self._runs.clear()

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        runs, net = self._read(), {}
        for frame in rows:
            for post in zip(frame["at"].tolist(), frame["cid"].tolist(), frame["channel"].tolist(), frame["message_id"].tolist(), strict=True):
                for change, changed in place_post(runs, post, self._gap):
                    if net.pop(changed, change) == change:  # what comes and goes in one batch is not told
                        net[changed] = change
        self._keep(runs, timerValues.getCurrentWatermarkInMs())
        if net:
            columns = {k: [v] * len(net) for k, v in zip(POST_KEYS, key, strict=True)}
            at, _, channel, message_id = zip(*net, strict=True)
            yield pd.DataFrame({**columns, "at": at, "channel": channel, "message_id": message_id, "change": list(net.values())})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._keep(self._read(), timerValues.getCurrentWatermarkInMs())
        return iter(())

    def close(self) -> None:
        pass


def stream_repost_changes(stream: DataFrame, gap_hours: int = 2, delay: str = "10 minutes") -> DataFrame:
    """Changes (``change`` is add or retract) to the posts that are no repost, with their key,
    time, channel and message (append mode); ``standing_posts`` sums them up.

    Posts that tie in time go by ``channel#id``; a post that is repeated changes nothing. A
    post later than ``delay`` behind the newest one may be dropped, as in every stream with a
    watermark. Posts with a null in the key stay, and pass without state. Keyed state lives
    in RocksDB, on each executor's disk and in the checkpoint; this sets the session to it.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    ts = F.col("message_date_gmt8")
    keyless = F.lit(False)
    for name in [*POST_KEYS, "message_date_gmt8"]:
        keyless = keyless | F.col(name).isNull()
    columns = [*POST_KEYS, "message_date_gmt8", "channel", "message_id"]
    timed = stream.withColumn("event_time", clock.gmt8_instant(ts)).withWatermark("event_time", delay).where("channel IS NOT NULL")
    passing = timed.where(keyless).select(*columns, F.lit(ADD).alias("change"))
    posts = timed.where(~keyless).select(*POST_KEYS, "event_time", F.unix_micros("event_time").alias("at"), "channel", "message_id",
                                         F.concat("channel", F.lit("#"), F.col("message_id").cast("string")).alias("cid"))
    changes = posts.groupBy(*POST_KEYS).transformWithStateInPandas(RepostRuns(gap_hours), _OUT, "Append", "EventTime")
    decided = changes.select(*POST_KEYS, clock.to_gmt8(F.timestamp_micros("at"), instant=True).alias("message_date_gmt8"), "channel", "message_id", "change")
    return passing.unionByName(decided)


def standing_posts(changes: DataFrame) -> DataFrame:
    """The posts that stay after all of a log of changes, once each."""
    columns = [c for c in changes.columns if c != "change"]
    sign = F.when(F.col("change") == ADD, 1).otherwise(-1)
    return changes.groupBy(*columns).agg(F.sum(sign).alias("_n")).where("_n > 0").select(*columns)
