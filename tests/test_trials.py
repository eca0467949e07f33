"""The trial machine: day by day, over any cuts of its days, and as a stream in several runs."""

import datetime

import numpy as np
from pyspark.sql import functions as F

from quillstream.sources import shared
from quillstream.streaming import trials
from quillstream.streaming.trials import Facts, Trial, advance


def by_the_day(facts, last):
    """The machine as it runs once a day: check, sample, decide, then start."""
    out, start, until = [], None, 0
    for day in range(last):
        f = facts.get(day, Facts())
        if start is None and f.asked and day >= until:
            start, checks, scores = day, [], []
        if start is None:
            continue
        if f.check:
            checks.append(f.check)
        if f.sample and day - start + 1 in (1, 2, 3):
            scores += [f.sample[2] / f.sample[3]] * f.sample[3]
        if day - start >= 3:
            days = sum(c[2] and c[3] > 0 for c in checks)
            mean = sum(scores) / len(scores) if scores else 0.0
            outcome = "fail_quantity" if days < 2 else "fail_quality" if not scores or mean < 0.5 else "pass"
            out.append((start, day, sum(c[3] for c in checks if c[2]), days, round(mean, 3), len(scores), outcome))
            start, until = None, day + (7 if outcome == "pass" else 30)
    return out


def random_facts(rng, last):
    facts = {}
    for day in range(last):
        if rng.random() < 0.7:
            check = (day, 0, bool(rng.random() < 0.8), int(rng.integers(0, 4))) if rng.random() < 0.8 else None
            sample = (day, 0, float(rng.integers(0, 5)) / 2, 2) if rng.random() < 0.6 else None
            facts[day] = Facts(bool(rng.random() < 0.4), check, sample)
    return facts


def test_machine_equals_daily_runs_however_days_are_closed():
    rng = np.random.default_rng(0)
    seen = set()
    for _ in range(300):
        facts, last = random_facts(rng, 90), 90
        want = by_the_day(facts, last)
        seen |= {w[-1] for w in want}
        for cuts in ([last], sorted({*rng.integers(0, last, 6).tolist(), last}), range(last + 1)):
            trial, got = Trial(), []
            for closed in cuts:
                trial, decided = advance(trial, facts, closed)
                got += decided
            assert got == want
    assert seen == {"pass", "fail_quantity", "fail_quality"}


def test_the_earliest_check_and_sample_of_a_day_count():
    f = Facts()
    for kind, at, n in (("check", 5, 9), ("sample", 7, 1), ("check", 3, 2), ("start", 1, 0), ("sample", 6, 0)):
        f = f.with_event(kind, at, 0, True, n, [n / 2])
    assert f == Facts(True, (3, 0, True, 2), (6, 0, 0.0, 1))


def moment(day, hour=9):
    return datetime.datetime(2024, 1, 1, hour) + datetime.timedelta(day)


def events(spark, rows):
    schema = "trial_id string, kind string, at timestamp, seq long, accessible boolean, articles long, scores array<double>"
    return spark.createDataFrame([(t, kind, moment(day, hour), n, True, articles, scores) for n, (t, kind, day, hour, articles, scores) in enumerate(rows)], schema)


def decisions(spark, parts, delay="0 seconds"):
    """Runs of the stream, each a new query on the checkpoint of the one before."""
    arrived, out, state = (shared.scratch(spark, n) for n in ("trial-events", "decisions", "state"))
    for part in parts:
        part.write.mode("append").parquet(arrived)
        trials.run_trials(spark.readStream.schema(part.schema).parquet(arrived), out, state, delay).awaitTermination()
    rows = spark.read.schema(trials.DECISION).parquet(out).orderBy("trial_id", "start_date").collect()
    return [(r["trial_id"], (r["decided_on"] - datetime.date(2024, 1, 1)).days, r["articles"], r["days"], r["mean"], r["n_samples"], r["outcome"]) for r in rows]


def story(name):
    """Started on day 0, checked for four days, sampled on the first three; asked for again on day 8 and 11."""
    own = [(name, "start", 0, 8, None, None)]
    own += [(name, "check", d, h, d + h % 2, None) for d in range(4) for h in (9, 12)]
    own += [(name, "sample", d, 10, None, [0.5, 1.0]) for d in range(5)]
    return own + [(name, "start", d, 8, None, None) for d in (5, 8, 11)] + [(name, "check", d, 9, 1, None) for d in (11, 12, 13, 14)]


WANT = [3, 1 + 2 + 3 + 4, 4, 0.75, 6, "pass"]


def test_stream_in_runs_decides_once(spark):
    end = [("z", "check", 16, 1, 1, None)]
    rows = events(spark, story("a") + story("b") + [("c", "start", 1, 1, None, None)] + end)
    whole = decisions(spark, [rows])
    assert whole == [("a", *WANT), ("a", 14, 4, 4, 0.0, 0, "fail_quality"), ("b", *WANT), ("b", 14, 4, 4, 0.0, 0, "fail_quality"), ("c", 4, 0, 0, 0.0, 0, "fail_quantity")]
    cut = lambda lo, hi: rows.where((F.col("at") >= moment(lo, 0)) & (F.col("at") < moment(hi, 0)))
    assert decisions(spark, [cut(0, 2), cut(2, 4), cut(4, 12), cut(12, 99)]) == whole


def test_late_rows_within_the_delay_count_and_others_do_not(spark):
    rows = story("a")
    first, late = [r for r in rows if r[2] != 1], [r for r in rows if r[2] == 1]
    end = [("z", "check", 30, 1, 1, None)]
    assert decisions(spark, [events(spark, first), events(spark, late), events(spark, end)], "20 days")[0] == ("a", *WANT)
    assert decisions(spark, [events(spark, first), events(spark, late), events(spark, end)])[0] == ("a", 3, 8, 3, 0.75, 4, "pass")


def test_undecided_trials_stay(spark):
    assert decisions(spark, [events(spark, story("a")[:8])]) == []


def test_state_is_read_once_and_written_once():
    """A call to the executor for each day of a candidate made the stream's time grow with days and candidates."""

    class Handle:
        def __init__(self):
            self.calls, self.value = 0, None

        def __getattr__(self, name):
            def call(*args):
                self.calls += 1
                if name == "update":
                    self.value = args[0]
                return self.value if name == "get" else self

            return call

    machine, handle = trials.TrialMachine(), Handle()
    machine.init(handle)
    handle.calls = 0
    rows = [{"at_us": day * 86_400_000_000 + 1, "kind": "check", "seq": day, "accessible": True, "articles": 1, "scores": None} for day in range(30)]
    assert list(machine.handleInputRows(("a",), iter(rows), None)) == []
    assert handle.calls == 3  # read, a timer, written
