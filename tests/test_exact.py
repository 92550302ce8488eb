"""Exact sums against fractions."""

import math
import random
import statistics
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoreloom.functions import exact

SCHEMA = "g int, x double, y double"


def found(spark, rows, pieces=4, split=None):
    df = spark.createDataFrame(rows, SCHEMA).repartition(pieces)
    measures = {"x": F.col("x"), "y": F.col("y")}
    if split is None:
        partials = exact.partial_moments(df, ["g"], measures)
    else:
        parts = [exact.partial_moments(df.where(F.pmod(F.xxhash64("x", "y"), F.lit(split)) == i), ["g"], measures) for i in range(split)]
        partials = parts[0]
        for part in parts[1:]:
            partials = exact.merged(partials.unionByName(part), ["g"], ["x", "y"])
    return {r.g: tuple(r)[2:] for r in exact.moments(partials, ["g"], ["x", "y"]).collect()}


def want(values):
    values = [v for v in values if v is not None]
    if not values:
        return 0, None, None
    mean = float(sum(map(Fraction, values)) / len(values))
    return len(values), mean, statistics.stdev(map(Fraction, values)) if len(values) > 1 else 0.0


def test_any_magnitudes_and_partitions(spark):
    rng = random.Random(3)
    rows = [(0, 0.1, None)] * 10
    rows += [(1, math.ldexp(rng.uniform(-1, 1), rng.randrange(-1070, 1020)), rng.choice([1e300, -1e300, 1.0, 5e-324])) for _ in range(300)]
    rows += [(2, x, x) for x in (1e16, 1.0, -1e16)] + [(3, 0.0, -0.0), (4, None, 2.5), (5, 1e308, 1e308), (5, 1e308, 1.5e308)]
    rows += [(6, rng.uniform(0, 1), rng.gauss(1e6, 1e-6)) for _ in range(3000)]
    groups = {g: ([x for k, x, _ in rows if k == g], [y for k, _, y in rows if k == g]) for g in range(7)}
    for pieces, split in ((1, None), (7, None), (3, 4)):
        got = found(spark, rows, pieces, split)
        for g, (x, y) in groups.items():
            (n, mean, std), (m, mean_y, std_y) = want(x), want(y)
            assert got[g][:2] == (n, m), g
            assert got[g][2] == mean and got[g][4] == mean_y, g
            for a, b in ((got[g][3], std), (got[g][5], std_y)):
                assert a == b or a == pytest.approx(b, rel=1e-15), (g, a, b)
    assert found(spark, rows[:10])[0][2] == 0.1


def test_no_numbers(spark):
    rows = [(0, math.nan, 1.0), (0, 1.0, math.inf), (1, math.inf, -math.inf), (1, -math.inf, 1.0), (2, math.inf, 1.0)]
    got = found(spark, rows)
    assert math.isnan(got[0][2]) and got[0][4] == math.inf and math.isnan(got[1][2]) and got[1][4] == -math.inf
    assert got[2] == (1, 1, math.inf, 0.0, 1.0, 0.0)
    assert found(spark, []) == {}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=1, max_size=30))
def test_last_step(values):
    """The sums, made here as the columns make them, give what fractions give."""
    classes: dict = {}
    for x in values:
        c = math.floor(math.floor(math.log2(abs(x) or 1.0)) / exact.CLASS)
        units = Fraction(x) / Fraction(2) ** (exact.CLASS * c - exact.LOWEST)
        assert units.denominator == 1 and abs(units) < 2**86 and exact.FIRST <= c <= exact.LAST
        hi, lo = divmod(int(units), 1 << exact.HALF)
        one = classes.setdefault(c, {"class": c, "n": 0} | dict.fromkeys(exact._SUMS, 0))
        for name, part in zip(("n", *exact._SUMS), (1, hi, lo, hi * hi, hi * lo, lo * lo)):
            one[name] += part
    mean, std = exact.mean_and_spread_of(list(classes.values()))
    assert mean == float(sum(map(Fraction, values)) / len(values))
    if len(values) > 1:
        exactly = statistics.variance(map(Fraction, values))
        if math.isfinite(std) and std > 1e-300:
            below, above = Fraction(math.nextafter(std, 0)), Fraction(math.nextafter(std, math.inf) if std < 1.7e308 else std)
            assert ((Fraction(std) + below) / 2) ** 2 <= exactly <= ((Fraction(std) + above) / 2) ** 2 or std > 1.7e308
