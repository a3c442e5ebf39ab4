"""Several live queries at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ballstats.plans.batch import PHASE_SCORES
from ballstats.plans.catalog import JOBS, METRICS
from ballstats.streaming import routed, runner


def start_job(
    messages: Callable[[str], DataFrame],
    job: str,
    path: str,
    trigger: runner.Trigger | None = None,
    mode: str = "update",
    rows: int | None = None,
) -> list[StreamingQuery]:
    """All queries of a job; results go under ``path``, and :func:`read_job` reads them.

    ``messages`` gives the stream of a topic. ``update`` and ``complete`` are those of
    :func:`ballstats.streaming.runner.start_metric`, each query on its own stream; ``routed`` is one query
    for all metrics on runs, with a quarantine (:mod:`ballstats.streaming.routed`). With ``rows`` so many
    rows of each result are printed instead.
    """
    if mode == "routed":
        _check_routed(job)
        return [routed.start(messages(PHASE_SCORES.topic), path, trigger)]
    running = []
    for metric in (METRICS[name] for name in JOBS[job]):
        deliveries, own = runner.decoded(messages(metric.topic), metric.topic), f"{path}/{metric.name}"
        if rows is not None:
            running.append(runner.start_console(deliveries, metric, own, trigger, rows))
        else:
            running.append(runner.start_metric(deliveries, metric, own, mode if metric.keys else "append", trigger))
    return running


def read_job(spark: SparkSession, job: str, name: str, path: str, mode: str = "update") -> DataFrame:
    """The current result of one metric of a job started with the same mode."""
    if mode == "routed":
        _check_routed(job)
        return routed.read_metric(spark, path, name)
    metric = METRICS[name]
    return runner.read_metric(spark, metric, f"{path}/{name}", mode if metric.keys else "append")


def _check_routed(job: str) -> None:
    if any(METRICS[name].topic != PHASE_SCORES.topic for name in JOBS[job]):
        raise ValueError(f"{job} has metrics that are not made of topic {PHASE_SCORES.topic}")


def start_shared(
    messages: Callable[[str], DataFrame], path: str, trigger: runner.Trigger | None = None
) -> StreamingQuery:
    """One query for all metrics on runs: topic ``rate`` is read and decoded once.

    Kept are the changes of runs and balls per striker, innings and phase. Any metric on runs is
    read from these with :func:`read_shared`.
    """
    deliveries = runner.decoded(messages(PHASE_SCORES.topic), PHASE_SCORES.topic)
    return runner.start_metric(deliveries, PHASE_SCORES, path, "update", trigger)


def read_shared(spark: SparkSession, path: str, name: str) -> DataFrame:
    return METRICS[name].batch(runner.read_metric(spark, PHASE_SCORES, path, "update"))
