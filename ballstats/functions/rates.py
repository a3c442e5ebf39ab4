"""Ratios rounded half-up without passing through a binary fraction.

``round(sum(a) / sum(b) * 6, 2)`` on doubles depends on which side of a tie the quotient
happens to fall. Numerator and denominator are whole numbers here, so the rounding is done
on whole numbers: half-up of ``n/d`` to k digits is ``(2*n*10^k + d) div (2*d)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BALLS_PER_OVER = 6


def exact_ratio(numerator: str, denominator: str, factor: int = 1, digits: int = 2) -> Column:
    """``round(factor * numerator / denominator, digits)`` of two bigint columns, as double.

    Null where either is null or the denominator is 0. The names are column names.
    """
    unit = 10**digits
    n = f"cast(`{numerator}` as bigint)"
    d = f"nullif(cast(`{denominator}` as bigint), 0L)"
    whole = f"(abs({n}) * {2 * factor * unit}L + {d}) div (2L * {d})"
    return F.expr(f"sign({n}) * ({whole}) / {unit}D")


def per_over(runs: str, balls: str) -> Column:
    """Runs per six balls, two decimals."""
    return exact_ratio(runs, balls, BALLS_PER_OVER)


def percentage(part: str, whole: str) -> Column:
    return exact_ratio(part, whole, 100)


def net_run_rate(scored: str, faced: str, conceded: str, bowled: str) -> Column:
    """Runs per over scored minus runs per over conceded, three decimals, half away from zero.

    The common denominator of two large ratios leaves the bigint range, so this one is
    computed in doubles, with the rounding spelled out.
    """
    diff = (
        f"({BALLS_PER_OVER}D * `{scored}` / nullif(`{faced}`, 0L)"
        f" - {BALLS_PER_OVER}D * `{conceded}` / nullif(`{bowled}`, 0L))"
    )
    return F.expr(f"cast(sign({diff}) * floor(abs({diff}) * 1000D + 0.5D) / 1000D as decimal(10,3))")
