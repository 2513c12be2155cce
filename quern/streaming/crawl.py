"""Crawling as streams: listing pages up to what is known, and attempts at a polite rate.

Fetching is the caller's: a function from a page's number to its markup. The
offset of a listing is the next page to read and whether the known mark was
met, so a run that is started again goes on where the last one ended, and reads
no page twice.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quern.functions.convert import MONTHS_OF
from quern.operators.elements import Page

_DAY = re.compile(r"(\d{1,2})\s+(\w+)\s+(\d{4})")


def oldest_listed(html: str, place: str = ".start") -> date | None:
    """The earliest date of a listing page's items, which is where ``place`` selects; null if none can be read."""
    page, found = Page(html), []
    for k in page.select(place):
        m = _DAY.search(page.plain(k))
        if m and m[2] in MONTHS_OF and 1 <= int(m[1]) <= 31:
            found.append(date(int(m[3]), MONTHS_OF.index(m[2]) + 1, int(m[1])))
    return min(found, default=None)


def listing_stream(spark: SparkSession, fetch: Callable[[int], str | None], mark: date | None = None, pages: int = 10, oldest: Callable[[str], date | None] = oldest_listed, name: str = "listing") -> DataFrame:
    """A stream of (page_no, html) of a listing, newest items first, ``pages`` a batch.

    It ends after the first page with an item that isn't newer than ``mark``,
    and where ``fetch`` has no page.
    """

    class Reader(SimpleDataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {"page": 1, "done": False}

        def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
            rows, page, done = [], start["page"], start["done"]
            while not done and len(rows) < pages:
                html = fetch(page)
                if html is None:
                    done = True
                    break
                rows.append((page, html))
                page += 1
                old = oldest(html)
                done = mark is not None and old is not None and old <= mark
            return iter(rows), {"page": page, "done": done}

        def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
            """Only after a failure within a batch."""
            return iter([(page, fetch(page)) for page in range(start["page"], end["page"])])

        def commit(self, end: dict) -> None:
            pass

    class Listing(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "page_no int, html string"

        def simpleStreamReader(self, schema: object) -> SimpleDataSourceStreamReader:
            return Reader()

    spark.dataSource.register(Listing)
    return spark.readStream.format(name).load()


class Turns:
    """The attempts at one host: at most ``cap`` at a time, ``gap`` milliseconds from one to the next, retries after waits that double.

    ``waiting`` has (ready, order, url, tries); times are milliseconds.
    """

    def __init__(self, cap: int, gap: int, wait: int, tries: int):
        self.cap, self.gap, self.wait, self.tries = cap, gap, wait, tries
        self.waiting: list[tuple[int, int, str, int]] = []
        self.next = self.open = self.order = 0

    def due(self) -> int | None:
        """When the next attempt is made, as far as is known."""
        return max(self.next, min(self.waiting)[0]) if self.waiting and self.open < self.cap else None

    def until(self, now: int) -> list[tuple[str, int, int]]:
        """(url, attempt, time) of all that is due up to a time."""
        out = []
        while (at := self.due()) is not None and at <= now:
            # of those that are ready by then the one that came first
            entry = min((x for x in self.waiting if x[0] <= at), key=lambda x: x[1])
            self.waiting.remove(entry)
            out.append((entry[2], entry[3] + 1, at))
            self.open, self.next = self.open + 1, at + self.gap
        return out

    def take(self, at: int, url: str, outcome: str | None, attempt: int | None) -> None:
        """A new address (no outcome), or what became of an attempt; a failed one waits for its next turn, unless it was the last."""
        if outcome is not None:
            self.open = max(0, self.open - 1)
        tries = attempt or 0
        if outcome is None or (outcome != "ok" and tries < self.tries):
            self.order += 1
            self.waiting.append((at + (self.wait << (tries - 1) if outcome is not None else 0), self.order, url, tries))


class _Polite(StatefulProcessor):
    def __init__(self, cap: int, gap: int, wait: int, tries: int):
        self.settings = (cap, gap, wait, tries)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "next long, open int, seen long, timer long")
        self.waiting = handle.getListState("waiting", "ready long, seen long, url string, tries int")

    def _turns(self) -> tuple[Turns, int]:
        turns, timer = Turns(*self.settings), -1
        if self.counts.exists():
            turns.next, turns.open, turns.order, timer = self.counts.get()
            turns.waiting = [tuple(x) for x in self.waiting.get()]
        return turns, timer

    def _keep(self, turns: Turns, timer: int) -> None:
        due = turns.due()
        due = -1 if due is None else due
        if due != timer:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            if due >= 0:
                self.handle.registerTimer(due)
        self.counts.update((turns.next, turns.open, turns.order, due))
        self.waiting.put(turns.waiting) if turns.waiting else self.waiting.clear()

    @staticmethod
    def _frames(key: tuple, made: list[tuple[str, int, int]]) -> Iterator[pd.DataFrame]:
        if made:
            url, attempt, at = zip(*made, strict=True)
            yield pd.DataFrame({"host": [key[0]] * len(made), "url": list(url), "attempt": list(attempt), "at": [pd.Timestamp(t, unit="ms") for t in at]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N803
        turns, timer = self._turns()
        made: list[tuple[str, int, int]] = []
        events = pd.concat(list(rows))
        events = [(int(t.timestamp() * 1000), u, None if pd.isna(o) else o, None if pd.isna(a) else int(a)) for t, u, o, a in zip(events["ts"], events["url"], events["outcome"], events["attempt"], strict=True)]
        for at, url, outcome, attempt in sorted(events, key=lambda e: (e[0], e[1], e[2] or "")):
            made += turns.until(at - 1)
            turns.take(at, url, outcome, attempt)
        made += turns.until(events and max(e[0] for e in events) - 1)
        self._keep(turns, timer)
        yield from self._frames(key, made)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N803
        turns, _ = self._turns()
        made = turns.until(expiredTimerInfo.getExpiryTimeInMs())
        self._keep(turns, -1)
        yield from self._frames(key, made)

    def close(self) -> None:
        pass


def polite(events: DataFrame, late: str = "10 seconds", cap: int = 2, gap: int = 1000, wait: int = 5000, tries: int = 3) -> DataFrame:
    """The attempts (host, url, attempt, at) for a stream of events (host, url, ts, outcome, attempt).

    An event without outcome asks for an address; one with it says what became
    of an attempt (ok or anything else). A host's state is its queue; a timer of
    event time wakes it when its next turn comes, whether events come or not.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = events.select("host", "url", "ts", "outcome", "attempt").withWatermark("ts", late)
    return rows.groupBy("host").transformWithStateInPandas(_Polite(cap, gap, wait, tries), "host string, url string, attempt int, at timestamp", "Append", "EventTime")
