"""Predicates on deliveries. A missing value is null or the empty string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POWERPLAY_OVERS = 6


def present(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def is_wicket() -> Column:
    """1 where the field is there at all, blank or not; filters use :func:`real_wicket`."""
    return F.col("wicket_type").isNotNull().cast("int")


def real_wicket(credited_only: bool = False) -> Column:
    """A dismissal fell. Run-outs count for the bowler unless ``credited_only``."""
    fell = present("wicket_type")
    return fell & (F.col("wicket_type") != "run out") if credited_only else fell


def caught() -> Column:
    """Caught, and the batter is known."""
    return (F.col("wicket_type") == "caught") & present("player_dismissed")


def powerplay() -> Column:
    """First six overs; an unknown over is not in the powerplay."""
    return F.col("over") < POWERPLAY_OVERS


def legal_ball() -> Column:
    """Neither a wide nor a no-ball."""
    return (F.coalesce("wides", F.lit(0)) == 0) & (F.coalesce("noballs", F.lit(0)) == 0)
