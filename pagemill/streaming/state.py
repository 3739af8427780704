"""Crawl state over a stream: first visits and running source counts in one keyed
state that expires by event time."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pagemill import fixed
from pagemill.functions.urls import host
from pagemill.operators.tables import latest_by_key

# Keys of one source, so that a hot one is in several tasks.
PARTS = 16
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = datetime(1970, 1, 1)
CHANGES = "domain string, part int, n bigint, url string, first_visit timestamp, replaces timestamp, rel bigint, nonrel bigint"


def _micros(when: datetime) -> int:
    return (when - _EPOCH) // timedelta(microseconds=1)


def _moment(micros: int) -> datetime:
    return _EPOCH + timedelta(microseconds=micros)


class CrawlState(StatefulProcessor):
    """State of one part of a source: the first visit of each URL with its label, and
    the counts of relevant and other first visits. A visit `delay` or more after the
    first one is a first visit again; one before it takes its place. The state of a
    URL goes when the watermark has passed its first visit by `delay`; the counts
    stay."""

    def __init__(self, delay: timedelta):
        self.delay = delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "url string", "first_visit timestamp, label int")
        self.counts = handle.getValueState("counts", "n bigint, rel bigint, nonrel bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        visits = pd.concat(rows).sort_values(["fetch_time", "label"], ascending=[True, False], kind="stable")
        n, rel, nonrel = self.counts.get() if self.counts.exists() else (0, 0, 0)
        # URLs do not depend on each other: the state of each is read and written once,
        # and of its visits only those that change it are looked at.
        firsts, due = [], set()
        times = visits["fetch_time"].to_numpy("datetime64[us]").astype("int64")
        labels = (visits["label"] == 1).to_numpy().astype(int)
        codes, urls = pd.factorize(visits["url"], use_na_sentinel=False)
        order = np.argsort(codes, kind="stable")
        for code, places in enumerate(np.split(order, np.cumsum(np.bincount(codes, minlength=len(urls)))[:-1])):
            url = urls[code] if isinstance(urls[code], str) else None
            new = self.first_visits(self.seen.getValue((url,)), places, times[places], labels[places])
            if new:
                firsts += [(place, url, *visit) for place, *visit in new]
                last = _moment(new[-1][1])
                self.seen.updateValue((url,), (last, new[-1][2]))
                due.add(self.expiry(last))
        for when in due:
            self.handle.registerTimer(when)
        fresh = []
        for _, url, when, label, old in sorted(firsts, key=lambda f: f[0]):
            if old is not None:
                rel, nonrel = rel - old[1], nonrel - (1 - old[1])
            n, rel, nonrel = n + 1, rel + label, nonrel + 1 - label
            fresh.append((*key, n, url, _moment(when), None if old is None else _moment(old[0]), rel, nonrel))
        if fresh:
            self.counts.update((n, rel, nonrel))
            changed = pd.DataFrame(fresh, columns=["domain", "part", "n", "url", "first_visit", "replaces", "rel", "nonrel"])
            yield changed.astype({"first_visit": "datetime64[us]", "replaces": "datetime64[us]"})

    def first_visits(self, known, places, times, labels) -> list[tuple]:
        """(place, time, label, replaced) of the visits of one URL, in the order of time
        and falling label, that are its first one or take the place of `known`. Between
        them lie visits that a search passes over."""
        delay, found, at = self.delay // timedelta(microseconds=1), [], 0
        current = None if known is None else (_micros(known[0]), known[1])
        if current is not None:  # those of an earlier time than the state still knows
            at = int(np.searchsorted(times, current[0] - delay, "right"))
        while at < len(times):
            visit, old = (int(times[at]), int(labels[at])), None
            if current is not None and visit[0] < current[0] + delay:
                if (visit[0], -visit[1]) >= (current[0], -current[1]):
                    at = int(np.searchsorted(times, current[0] + delay, "left"))
                    continue
                old = current
            found.append((int(places[at]), *visit, old))
            current = visit
            at = max(at + 1, int(np.searchsorted(times, current[0] + delay, "left")))
        return found

    def expiry(self, when) -> int:
        """Milliseconds at which a first visit is forgotten."""
        return int((pd.Timestamp(when) + self.delay).timestamp() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        for (url,) in [u for u, first in self.seen.iterator() if self.expiry(first[0]) <= due]:
            self.seen.removeKey((url,))
        return iter([])

    def close(self) -> None:
        pass


def crawl_state(scored: DataFrame, delay: str = "1 day", parts: int = PARTS) -> DataFrame:
    """Stream of scored pages (url, fetch_time, label) to its first visits (CHANGES),
    each with the counts of its part of the source after it. Visits that arrive more
    than `delay` behind the newest are dropped. Where all visits of a URL lie within
    one `delay` the order in which they arrive does not matter; beyond it they count
    in that order. For `flows.update_stream`."""
    spark = scored.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    keyed = scored.select(
        host(F.col("url")).alias("domain"), F.pmod(F.xxhash64("url"), F.lit(parts)).cast("int").alias("part"), "url",
        "fetch_time", F.col("label").cast("int").alias("label"),
    ).withWatermark("fetch_time", delay)
    return keyed.groupBy("domain", "part").transformWithStateInPandas(
        statefulProcessor=CrawlState(pd.Timedelta(delay).to_pytimedelta()), outputStructType=CHANGES, outputMode="Update", timeMode="EventTime"
    )


def visits_of(changes: DataFrame) -> DataFrame:
    """(url, first_visit) of stored changes, without those that others replaced."""
    # A visit may be replaced by one of the same time; its last row is the valid one.
    last = changes.groupBy("url", "first_visit").agg(F.max("n").alias("n"))
    later = changes.where("replaces IS NOT NULL").groupBy("url", F.col("replaces").alias("first_visit")).agg(F.max("n").alias("gone"))
    return last.join(later, ["url", "first_visit"], "left").where("gone IS NULL OR n >= gone").select("url", "first_visit")


def source_totals(changes: DataFrame) -> DataFrame:
    """(domain, rel, nonrel) of stored changes: the newest counts of every part, summed,
    with the prior of source_counts."""
    newest = latest_by_key(changes.select(F.struct("domain", "part").alias("key"), "n", "rel", "nonrel"), "key", F.col("n"))
    prior = F.lit(fixed.SOURCE_PRIOR)
    return newest.groupBy("key.domain").agg((F.sum("rel") + prior).alias("rel"), (F.sum("nonrel") + prior).alias("nonrel"))
