"""State of feeds, as a fold over their checks: batch and streaming share the same step."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship

#: Days and successes that probation takes, the failures it bears, and the streaks that fail a feed.
DAYS, SUCCESSES, MAX_FAILURE, FAIL_PROBATION, FAIL_APPROVED, RECOVER = 14, 10, 0.3, 20, 30, 5
#: Minutes between checks by priority, after an error, and DNS errors in a row that put a feed on hold.
INTERVALS, ERROR_MINUTES, DNS_STREAK = {"high": 15, "medium": 180, "low": 720, "dormant": 10080}, 60, 3

STATE = "feed string, status string, success_count long, failure_count long, consecutive_failures long, added timestamp, checked timestamp"


@dataclass
class Feed:
    status: str = "probation"
    success_count: int = 0
    failure_count: int = 0
    consecutive_failures: int = 0
    added: pd.Timestamp | None = None
    checked: pd.Timestamp | None = None

    def step(self, ok: bool, at: pd.Timestamp) -> None:
        """One check: counts first, then at most one change of status."""
        if self.added is None:
            self.added = at
        self.checked = at
        if ok:
            self.success_count, self.consecutive_failures = self.success_count + 1, 0
        else:
            self.failure_count, self.consecutive_failures = self.failure_count + 1, self.consecutive_failures + 1
        share = self.failure_count / (self.success_count + self.failure_count)
        grown = (at - self.added).days >= DAYS and self.success_count >= SUCCESSES and share <= MAX_FAILURE
        change = {
            "probation": "approved" if grown else "failing" if self.consecutive_failures >= FAIL_PROBATION else None,
            "approved": "failing" if self.consecutive_failures >= FAIL_APPROVED else None,
            "failing": "probation" if ok and self.success_count >= RECOVER else None,
        }[self.status]
        self.status = change or self.status


def _fold(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Checks sorted by feed and time, to a row for each feed; a feed may go on in the next batch."""
    name, now = None, None
    row = lambda: pd.DataFrame([{"feed": name} | asdict(now)])
    for pdf in batches:
        for feed, ok, at in zip(pdf["feed"], pdf["ok"], pdf["at"]):
            if feed != name or now is None:
                if now is not None:
                    yield row()
                name, now = feed, Feed()
            now.step(bool(ok), at)
    if now is not None:
        yield row()


def probation(checks: DataFrame, feed: str = "feed", ok: str = "ok", at: str = "at", seq: str = "seq") -> DataFrame:
    """STATE of each feed after its checks in order. A feed's checks stream through one task in constant memory."""
    ship(checks.sparkSession)
    rows = checks.select(F.col(feed).cast("string").alias("feed"), F.col(ok).cast("boolean").alias("ok"), F.col(at).cast("timestamp").alias("at"), F.col(seq).alias("seq")).filter("feed IS NOT NULL AND at IS NOT NULL")
    return rows.repartition("feed").sortWithinPartitions("feed", "at", "seq").drop("seq").mapInPandas(_fold, STATE)


def _stream_step(key, batches, state):
    now = Feed(*state.get) if state.exists else Feed()
    frames = [b for b in batches]
    if frames:
        pdf = pd.concat(frames).sort_values(["at", "seq"])
        for ok, at in zip(pdf["ok"], pdf["at"]):
            now.step(bool(ok), at)
        state.update((now.status, now.success_count, now.failure_count, now.consecutive_failures, now.added, now.checked))
    yield pd.DataFrame([{"feed": key[0]} | asdict(now)])


def probation_stream(checks: DataFrame) -> DataFrame:
    """The same over a stream of (feed, ok, at, seq): each micro-batch gives the new state of the feeds in it."""
    ship(checks.sparkSession)
    return checks.groupBy("feed").applyInPandasWithState(
        _stream_step, STATE, "status string, success_count long, failure_count long, consecutive_failures long, added timestamp, checked timestamp", "update", "NoTimeout"
    )


def next_check(priority: Column, ok: Column, checked: Column) -> Column:
    """When a feed is due again: by its priority, or an hour after an error."""
    minutes = F.lit(INTERVALS["high"])
    for name, m in INTERVALS.items():
        minutes = F.when(priority == name, m).otherwise(minutes)
    minutes = F.when(ok, minutes).otherwise(ERROR_MINUTES)
    return checked + F.make_dt_interval(mins=minutes)


def dns_streaks(checks: DataFrame, feed: str, dns: Column, at: str, least: int = DNS_STREAK) -> DataFrame:
    """(feed, streak) of feeds whose last least checks or more all failed at DNS: checks after the last other one."""
    rows = checks.select(F.col(feed).alias("feed"), dns.alias("dns"), F.col(at).alias("at"))
    last = rows.groupBy("feed").agg(F.max(F.when(~F.col("dns"), F.col("at"))).alias("other"))
    return rows.join(last, "feed").filter("dns AND (other IS NULL OR at > other)").groupBy("feed").agg(F.count("*").alias("streak")).filter(F.col("streak") >= least)


def latest(checks: DataFrame, feed: str, at: str, *columns: str) -> DataFrame:
    """The last check of each feed."""
    return checks.groupBy(feed).agg(F.max_by(F.struct(at, *columns), F.struct(at, *columns)).alias("x")).select(feed, "x.*")
