"""When a batter's runs in an innings reach 50, 100 and so on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballstats.functions import parse
from ballstats.operators.metrics import SCORE_KEYS

MARKS = (50, 100)


def milestones(deliveries: DataFrame, order: Sequence[str] = (), marks: Sequence[int] = MARKS) -> DataFrame:
    """One row per striker, innings and mark reached: the ball (``over``) and the runs there.

    ``over`` is text, ``o.b``. Balls are put in order by over number and ball number as whole numbers (as
    a fraction, ball 10 would come before ball 2), then by the columns of ``order``; balls of an unknown
    over come first. Unreadable runs add nothing. A mark is reached once, by the first ball after
    which the running sum is no less: the best sum before it is kept beside the sum, so that a
    correction by negative runs does not report it again.

    Both sums are windows over one partitioning and order, so the deliveries are shuffled and sorted once.
    A window holds what one batter faced in one innings.
    """
    balls = deliveries.select(
        *SCORE_KEYS,
        "over",
        parse.over_number("over").alias("over_num"),
        parse.ball_number("over").alias("ball_num"),
        F.coalesce(F.col("runs_of_bat").try_cast("int"), F.lit(0)).alias("of_bat"),
        *order,
    )
    in_order = Window.partitionBy(*SCORE_KEYS).orderBy("over_num", "ball_num", *order)
    so_far = F.sum("of_bat").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.max("runs").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    summed = balls.withColumn("runs", so_far).withColumn("before", F.coalesce(before, F.lit(0)))
    passed = F.filter(
        F.array(*map(F.lit, marks)), lambda mark: (mark > F.col("before")) & (mark <= F.col("runs"))
    )
    return summed.select(*SCORE_KEYS, F.explode(passed).alias("milestone"), "over", "runs")
