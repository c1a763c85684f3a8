"""Exact rounding helpers against Python's Decimal, ties included."""

import random
from decimal import ROUND_HALF_DOWN, ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from adpulse.functions.numeric import div6, ecpm, round_div

MODES = {"half_up": ROUND_HALF_UP, "half_down": ROUND_HALF_DOWN, "half_even": ROUND_HALF_EVEN}


def _cases():
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        den = rnd.randint(1, 5000)
        num = Decimal(rnd.randint(-10 ** 9, 10 ** 9)) / Decimal(10 ** rnd.randint(0, 8))
        rows.append((num, den))
    # exact ties at the 7th decimal
    for den in (2, 4, 8, 16, 2000, 3125):
        for k in range(1, 40, 3):
            num = (Decimal(2 * k + 1) * den / 2) / Decimal(10 ** 6)
            rows.append((num, den))
            rows.append((-num, den))
    return rows


@pytest.mark.parametrize("mode", sorted(MODES))
def test_round_div_matches_decimal(spark, mode):
    rows = _cases()
    df = spark.createDataFrame([(str(n), d) for n, d in rows], "num string, den long") \
              .withColumn("num", F.col("num").cast("decimal(30,10)"))
    got = [r[0] for r in df.select(round_div("num", "den", 6, mode)).collect()]
    got_col = [r[0] for r in df.select(round_div(F.col("num"), F.col("den"), 6, mode)).collect()]
    want = [(n / d).quantize(Decimal("0.000001"), rounding=MODES[mode]) for n, d in rows]
    assert got == want
    assert got_col == want


def test_zero_denominator_defaults(spark):
    df = spark.createDataFrame([(5, 0), (None, 3), (1, 3)], "a long, b long")
    assert [r[0] for r in df.select(div6("a", "b")).collect()] == [Decimal("0"), Decimal("0"),
                                                                   Decimal("0.333333")]


def test_ecpm_half_down_tie(spark):
    # 0.0000005 * 1000 / 1 -> 0.0005 exactly representable; 1/2000*1000 = 0.5 per mille
    df = spark.createDataFrame([("0.000000250", 1), ("0.0000025", 1)], "m string, i long") \
              .withColumn("m", F.col("m").cast("decimal(20,9)"))
    down = [r[0] for r in df.select(ecpm("m", "i", "half_down")).collect()]
    up = [r[0] for r in df.select(ecpm("m", "i", "half_up")).collect()]
    assert down == [Decimal("0.000250"), Decimal("0.002500")]
    assert up == down
    df2 = spark.createDataFrame([("0.0000000005", 1)], "m string, i long") \
               .withColumn("m", F.col("m").cast("decimal(20,10)"))
    assert df2.select(ecpm("m", "i", "half_down")).first()[0] == Decimal("0.000000")
    assert df2.select(ecpm("m", "i", "half_up")).first()[0] == Decimal("0.000001")
