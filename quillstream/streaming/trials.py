"""Trials of candidates as a stream: started, checked once a day, sampled on their first days, decided, then cooling down.

Events of a candidate are folded into facts of each day (the earliest check, the earliest sample, whether a start was
asked for), which are kept in its state until the watermark closes the day. Only closed days move the machine, one after
the other, so that its result depends on event times alone and not on how events arrived in micro-batches or runs. One
event-time timer a candidate stands at the next moment that something can change: the end of the earliest open day that
has facts, or of the day on which its trial is decided.
"""

from __future__ import annotations

import contextlib
import datetime
from collections.abc import Iterable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

# Days of a trial (all of them sampled), days with articles that it needs, the mean that samples need, and
# the days until a candidate may be tried again, by outcome.
TRIAL_DAYS, LEAST_DAYS, LEAST_MEAN = 3, 2, 0.5
COOLDOWN = {"pass": 7, "fail_quantity": 30, "fail_quality": 30}

DAY_MS = 86_400_000
DECISION = "trial_id string, start_date date, decided_on date, articles long, days long, mean double, n_samples long, outcome string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class Facts(NamedTuple):
    """Of one candidate and day. The earliest check and sample by (time, seq); None where there is none."""

    asked: bool = False
    check: tuple[int, int, bool, int] | None = None
    sample: tuple[int, int, float, int] | None = None

    def with_event(self, kind: str, at: int, seq: int, accessible: bool, articles: int, scores: list[float]) -> Facts:
        if kind == "start":
            return self._replace(asked=True)
        if kind == "check":
            own = (at, seq, accessible, articles)
            return self._replace(check=own if self.check is None else min(self.check, own))
        own = (at, seq, sum(scores), len(scores))
        return self._replace(sample=own if self.sample is None else min(self.sample, own))


class Trial(NamedTuple):
    """A candidate's machine. start: first day of the running trial, -1 without one; until: first day on which one may
    start; closed: days before it have been worked off."""

    start: int = -1
    articles: int = 0
    days: int = 0
    total: float = 0.0
    n_samples: int = 0
    until: int = 0
    closed: int = 0

    def on(self, day: int, facts: Facts) -> Trial:
        """After a day of a running trial."""
        out = self
        if facts.check and facts.check[2]:
            out = out._replace(articles=out.articles + facts.check[3], days=out.days + (facts.check[3] > 0))
        if facts.sample and day - self.start < TRIAL_DAYS:
            out = out._replace(total=out.total + facts.sample[2], n_samples=out.n_samples + facts.sample[3])
        return out

    def outcome(self) -> str:
        if self.days < LEAST_DAYS:
            return "fail_quantity"
        return "pass" if self.n_samples and self.total / self.n_samples >= LEAST_MEAN else "fail_quality"

    def next_change(self, open_days: Iterable[int]) -> int | None:
        """The first day at whose end something may change."""
        wanted = [*open_days, *([self.start + TRIAL_DAYS] if self.start >= 0 else [])]
        return min(wanted, default=None)


def advance(trial: Trial, facts: dict[int, Facts], closed: int) -> tuple[Trial, list[tuple]]:
    """The machine after all days before `closed`, and what was decided on the way. A trial takes in the checks of its days
    and of the day on which it is decided, TRIAL_DAYS after its start."""
    decided = []
    days = sorted(d for d in facts if trial.closed <= d < closed)
    while days or 0 <= trial.start < closed - TRIAL_DAYS:
        end = trial.start + TRIAL_DAYS if trial.start >= 0 else None
        day = min([*days[:1], *([end] if end is not None and end < closed else [])])
        own = facts.get(day, Facts()) if days and days[0] == day else Facts()
        days = days[1:] if days and days[0] == day else days
        if trial.start < 0:
            if own.asked and day >= trial.until:
                trial = Trial(day, closed=trial.closed).on(day, own)
            continue
        trial = trial.on(day, own)
        if day == end:
            outcome = trial.outcome()
            mean = trial.total / trial.n_samples if trial.n_samples else 0.0
            decided.append((trial.start, day, trial.articles, trial.days, round(mean, 3), trial.n_samples, outcome))
            trial = Trial(until=day + COOLDOWN[outcome])
    return trial._replace(closed=max(closed, trial.closed)), decided


CHECK, SAMPLE = "struct<at: long, seq: long, accessible: boolean, articles: long>", "struct<at: long, seq: long, total: double, n: long>"
MACHINE = f"start int, articles long, days long, total double, n_samples long, until int, closed int, timer int, facts array<struct<day: int, asked: boolean, check: {CHECK}, sample: {SAMPLE}>>"


class TrialMachine(StatefulProcessor):
    """Rows(trial_id, kind, at, seq, accessible, articles, scores) of a candidate to decisions. Late rows, of days that are
    closed, change nothing.

    A candidate's machine, the facts of its open days (a row for each day that the watermark has not closed) and the day at
    whose end its timer stands (-1: none) are one value: every access to state is a call from Python to the executor, so
    it is read once and written once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.machine = handle.getValueState("machine", MACHINE)

    def _read(self) -> tuple[Trial, int, dict[int, Facts]]:
        held = self.machine.get()
        if held is None:
            return Trial(), -1, {}
        *trial, timer, facts = held
        return Trial(*trial), timer, {day: Facts(asked, check and tuple(check), sample and tuple(sample)) for day, asked, check, sample in facts}

    def _write(self, trial: Trial, timer: int, facts: dict[int, Facts]) -> None:
        """With one timer, at the end of the first day that may change something; `timer` is what there is."""
        wanted = trial.next_change(facts)
        day = -1 if wanted is None else wanted
        if day != timer:
            if timer >= 0:
                self.handle.deleteTimer((timer + 1) * DAY_MS)
            if day >= 0:
                self.handle.registerTimer((day + 1) * DAY_MS)
        self.machine.update((*trial, day, [(d, *own) for d, own in sorted(facts.items())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        trial, timer, facts = self._read()
        changed = False
        for row in rows:
            at = row["at_us"]
            day = at // (1000 * DAY_MS)
            if day >= trial.closed:
                facts[day] = facts.get(day, Facts()).with_event(row["kind"], at, row["seq"], bool(row["accessible"]), row["articles"] or 0, list(row["scores"] or []))
                changed = True
        if changed:
            self._write(trial, timer, facts)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        trial, _, facts = self._read()
        closed = timerValues.getCurrentWatermarkInMs() // DAY_MS
        trial, decided = advance(trial, {d: own for d, own in facts.items() if d < closed}, closed)
        self._write(trial, -1, {d: own for d, own in facts.items() if d >= closed})
        date = lambda d: datetime.date(1970, 1, 1) + datetime.timedelta(d)
        for start, day, *rest in decided:
            yield Row(trial_id=key[0], start_date=date(start), decided_on=date(day), **dict(zip(("articles", "days", "mean", "n_samples", "outcome"), rest, strict=True)))


def trial_decisions(events: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Decisions over a stream of events(trial_id, kind, at, seq, accessible, articles, scores), where kind is start, check
    or sample; at is the event time, by which events may be late by `delay`."""
    rows = events.withWatermark("at", delay).selectExpr("cast(trial_id as string) trial_id", "kind", "at", "unix_micros(at) at_us", "cast(seq as long) seq", "accessible", "cast(articles as long) articles", "cast(scores as array<double>) scores")
    return rows.groupBy("trial_id").transformWithState(TrialMachine(), DECISION, "Append", "EventTime")


@contextlib.contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which timers need."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def run_trials(events: DataFrame, table: str, checkpoint: str, delay: str = "0 seconds") -> StreamingQuery:
    """Appends the decisions over what has arrived to a Parquet table; a later run goes on from the checkpoint."""
    with keyed_state(events.sparkSession):
        out = trial_decisions(events, delay).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
        return out.outputMode("append").trigger(availableNow=True).start()
