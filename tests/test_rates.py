from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction
from random import Random

from ballstats.functions import rates


def half_up(value: Fraction, digits: int) -> Decimal:
    exact = Decimal(value.numerator) / Decimal(value.denominator)
    return exact.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def test_exact_ratio_rounds_half_up(spark):
    random = Random(1)
    pairs = [(514, 160), (0, 5), (1, 3), (10**13, 7), (None, 4), (4, None), (4, 0), (-514, 160)]
    pairs += [(random.randrange(3000), random.randrange(1, 700)) for _ in range(2000)]
    df = spark.createDataFrame(pairs, "runs bigint, balls bigint")
    for runs, balls, rate in df.withColumn("r", rates.per_over("runs", "balls")).collect():
        if runs is None or not balls:
            assert rate is None
        else:
            assert rate == float(half_up(Fraction(6 * runs, balls), 2)), (runs, balls)


def test_net_run_rate(spark):
    df = spark.createDataFrame(
        [(300, 240, 250, 240), (250, 240, 300, 240), (1, 0, 1, 6)],
        "scored bigint, faced bigint, conceded bigint, bowled bigint",
    )
    got = df.select(rates.net_run_rate("scored", "faced", "conceded", "bowled")).collect()
    assert [row[0] for row in got] == [Decimal("1.250"), Decimal("-1.250"), None]
