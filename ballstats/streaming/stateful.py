"""Live queries that keep state of their own per innings or batter.

Both sum the runs of a micro-batch's tasks before the shuffle, so that of a batter with a third of all
balls each task sends one row per Arrow batch, and the state of a key is read and written once per trigger.
Results go to :mod:`ballstats.streaming.sinks` under the batch's number: a repeated batch replaces its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ballstats import schemas
from ballstats.operators import topk
from ballstats.operators.metrics import SCORE_KEYS
from ballstats.operators.milestones import MARKS
from ballstats.streaming import runner, sinks

#: State of a batter or innings goes after this long without a ball.
IDLE_MS = 24 * 60 * 60 * 1000
_KEYS = "match_id string, batting_team string, innings int"
MILESTONE = f"{_KEYS}, striker string, milestone int, runs long"
TOP = f"{_KEYS}, total_runs long, strikers array<string>"


def partial_runs(deliveries: DataFrame) -> DataFrame:
    """Runs per batter and innings of each Arrow batch of a task; unreadable ones are left out."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            summed = pa.Table.from_batches([batch]).group_by(SCORE_KEYS).aggregate([("runs", "sum")])
            yield from summed.rename_columns([*SCORE_KEYS, "runs"]).to_batches()

    readable = deliveries.select(*SCORE_KEYS, F.col("runs_of_bat").cast("long").alias("runs")).where("runs is not null")
    return readable.mapInArrow(add, f"{_KEYS}, striker string, runs long")


class _Expiring(StatefulProcessor):
    """State that goes when a key has had no input for a time."""

    def __init__(self, idle_ms: int) -> None:
        self.idle_ms = idle_ms

    def wait_again(self, now: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(now + self.idle_ms)

    def close(self) -> None:
        pass


class Milestones(_Expiring):
    """Sums a batter's runs and tells each mark once, when the sum first is no less."""

    def __init__(self, marks: Sequence[int], idle_ms: int) -> None:
        super().__init__(idle_ms)
        self.marks = tuple(marks)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getValueState("runs", "runs long, best long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        before, best = self.runs.get() if self.runs.exists() else (0, 0)
        runs = before + sum(int(frame["runs"].sum()) for frame in rows)
        self.runs.update((runs, max(runs, best)))
        self.wait_again(timerValues.getCurrentProcessingTimeInMs())
        passed = [mark for mark in self.marks if best < mark <= runs]
        if passed:
            yield pd.DataFrame([(*key, mark, runs) for mark in passed], columns=[*SCORE_KEYS, "milestone", "runs"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.runs.clear()
        yield from ()


class TopScorers(_Expiring):
    """Keeps the totals of an innings' batters and ranks them again when one of them has batted."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getMapState("totals", "striker string", "runs long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        added: dict[str, int] = {}
        for frame in rows:
            for striker, runs in zip(frame["striker"], frame["runs"], strict=True):
                # A state's key may not be null: names are marked, the unknown batter is not.
                name = "" if striker is None else f"={striker}"
                added[name] = added.get(name, 0) + int(runs)
        for name, runs in added.items():
            kept = self.totals.getValue((name,)) if self.totals.containsKey((name,)) else (0,)
            self.totals.updateValue((name,), (kept[0] + runs,))
        self.wait_again(timerValues.getCurrentProcessingTimeInMs())
        totals = [(name[0], runs[0]) for name, runs in self.totals.iterator()]
        best = max(runs for _, runs in totals)
        first = sorted(name for name, runs in totals if runs == best)
        strikers = [name[1:] if name else None for name in first]
        yield pd.DataFrame([(*key, best, strikers)], columns=[*schemas.INNINGS_KEYS, "total_runs", "strikers"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.totals.clear()
        yield from ()


def start_milestones(
    deliveries: DataFrame,
    path: str,
    trigger: runner.Trigger | None = None,
    marks: Sequence[int] = MARKS,
    idle_ms: int = IDLE_MS,
) -> StreamingQuery:
    """Tell each mark that a batter reaches in an innings once, in the trigger in which it is reached.

    ``deliveries`` are typed. Balls count in the order they come in; ``runs`` are those at the end of
    the trigger. After ``idle_ms`` without a ball the sum is forgotten, as the innings is over.
    """
    reached = partial_runs(deliveries).groupBy(*SCORE_KEYS).transformWithStateInPandas(
        Milestones(marks, idle_ms), MILESTONE, "Update", "ProcessingTime"
    )
    writer = runner.writer(reached, "milestones", path, "update", trigger)
    return writer.foreachBatch(sinks.part_writer(f"{path}/data")).start()


def read_milestones(spark: SparkSession, path: str) -> DataFrame:
    return sinks.read_parts(spark, f"{path}/data", MILESTONE)


def start_top_scorers(
    deliveries: DataFrame, path: str, trigger: runner.Trigger | None = None, idle_ms: int = IDLE_MS
) -> StreamingQuery:
    """The top scorers of the innings that a trigger has touched, one row per innings.

    The totals of an innings are its state, so only those of touched innings are read and ranked, and
    only their rows are written, however many innings there have been.
    """
    known = deliveries.where(topk.known(schemas.INNINGS_KEYS))
    best = partial_runs(known).groupBy(*schemas.INNINGS_KEYS).transformWithStateInPandas(
        TopScorers(idle_ms), TOP, "Update", "ProcessingTime"
    )
    writer = runner.writer(best, "top_scorers", path, "update", trigger)
    return writer.foreachBatch(sinks.change_writer(f"{path}/data", tuple(schemas.INNINGS_KEYS))).start()


def read_top_scorers(spark: SparkSession, path: str) -> DataFrame:
    """One row per innings and top scorer, all of them on a tie."""
    newest = sinks.read_changes(spark, f"{path}/data", tuple(schemas.INNINGS_KEYS))
    return newest.select(*schemas.INNINGS_KEYS, F.explode("strikers").alias("striker"), "total_runs")
