"""Means and spreads without rounding on the way, from sums that combine in any order.

A double is a whole number of units of a power of two. Values are put into classes of 32 exponents; in a class
all are whole multiples of one unit, with at most 86 bits, and are summed as two halves in decimals, and so are their squares as
three products of the halves. These sums are exact, so they do not depend on partitions, batches or order, and the
sums of two tables add up to those of both. Only the last step rounds: once for a mean, once for a spread.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.session import ship_with_tasks

ship_with_tasks(__name__)

#: Exponents of a class; the unit of class c is 2 ** (CLASS * c - LOWEST).
CLASS, LOWEST, HALF = 32, 53, 43
#: Classes of the smallest and the largest doubles, the first one lower for a logarithm rounded down.
FIRST, LAST = -35, 32
#: Classes of values that are no numbers to add.
NAN, PLUS, MINUS = 100, 101, 102

_SUMS = ("hi", "lo", "hihi", "hilo", "lolo")


def _class_of(value: Column) -> Column:
    size = F.abs(value)
    exponent = F.floor(F.floor(F.log2(F.when(size == 0, F.lit(1.0)).otherwise(size))) / CLASS)
    return (
        F.when(F.isnan(value), NAN)
        .when(value == math.inf, PLUS)
        .when(value == -math.inf, MINUS)
        .when(value.isNotNull(), exponent)
        .cast("int")
    )


def _factors() -> tuple[Column, Column]:
    """For each class two powers of two whose product turns the unit into 1; neither leaves the range of doubles."""
    powers = [LOWEST - CLASS * c for c in range(FIRST, LAST + 1)]
    return (F.array(*(F.lit(math.ldexp(1.0, p // 2)) for p in powers)), F.array(*(F.lit(math.ldexp(1.0, p - p // 2)) for p in powers)))


def partial_moments(
    df: DataFrame, by: Sequence[str], measures: Mapping[str, Column], others: Sequence[Column] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Exact sums per group and class of each measure, as a table that ``merged`` and ``moments`` take.

    A group has a row for each combination of classes, some ten at most in real data; they combine on the map side.
    ``others`` are further aggregates of the same groups, over the columns in ``keep``.
    """
    first, second = _factors()
    rows = df.select(*by, *keep, *(value.cast("double").alias(f"_{name}") for name, value in measures.items()))
    rows = rows.select("*", *(_class_of(F.col(f"_{name}")).alias(f"{name}_class") for name in measures))
    for name in measures:
        place = F.col(f"{name}_class") - FIRST
        units = F.col(f"_{name}") * F.get(first, place) * F.get(second, place)
        rows = rows.withColumn(f"_{name}", units).withColumn(f"_{name}_hi", F.floor(F.col(f"_{name}") / 2.0**HALF))
        rows = rows.withColumn(f"_{name}_lo", (F.col(f"_{name}") - F.col(f"_{name}_hi") * 2.0**HALF).cast("bigint"))
    sums = []
    for name in measures:
        hi, lo = (F.col(f"_{name}_{half}").cast("decimal(14,0)") for half in ("hi", "lo"))
        parts = dict(zip(_SUMS, (hi, lo, hi * hi, hi * lo, lo * lo)))
        sums.append(F.count(f"{name}_class").alias(f"{name}_n"))
        sums += [F.coalesce(F.sum(part), F.lit(0)).cast("decimal(38,0)").alias(f"{name}_{s}") for s, part in parts.items()]
    return rows.groupBy(*by, *(f"{name}_class" for name in measures)).agg(F.count(F.lit(1)).alias("rows"), *sums, *others)


def merged(partials: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The table of partial sums that one pass over all rows would have given."""
    sums = [F.sum(f"{name}_n").alias(f"{name}_n") for name in measures]
    sums += [F.sum(f"{name}_{s}").cast("decimal(38,0)").alias(f"{name}_{s}") for name in measures for s in _SUMS]
    return partials.groupBy(*by, *(f"{name}_class" for name in measures)).agg(F.sum("rows").alias("rows"), *sums)


def _quotient(above: int, below: int, exponent: int) -> float:
    """The double nearest to ``above / below * 2 ** exponent``."""
    try:
        return (above << max(exponent, 0)) / (below << max(-exponent, 0))
    except OverflowError:
        return math.copysign(math.inf, above)


def _root(above: int, below: int, exponent: int) -> float:
    """The double nearest to ``sqrt(above / below) * 2 ** exponent``."""
    if above == 0:
        return 0.0
    # enough bits that what is cut off shows as a last bit of its own
    shift = max(0, (below.bit_length() - above.bit_length()) // 2 + 64)
    square, rest = divmod(above << 2 * shift, below)
    root = math.isqrt(square)
    return _quotient(2 * root + (root * root != square or rest != 0), 2, exponent - shift)


def mean_and_spread_of(classes: Sequence[Mapping]) -> tuple[float | None, float | None]:
    """Mean and sample standard deviation of a measure from its sums: 0.0 for one value, None for none."""
    found = [c for c in classes if c["class"] is not None]
    n = sum(c["n"] for c in found)
    if n == 0:
        return None, None
    odd = {c["class"] for c in found if c["class"] >= NAN}
    if odd:
        mean = math.inf if odd == {PLUS} else -math.inf if odd == {MINUS} else math.nan
        return mean, math.nan if n > 1 else 0.0
    lowest = min(c["class"] for c in found)
    total = squares = 0
    for c in found:
        up = CLASS * (c["class"] - lowest)
        hi, lo, hihi, hilo, lolo = (int(c[s]) for s in _SUMS)
        total += ((hi << HALF) + lo) << up
        squares += ((hihi << 2 * HALF) + (hilo << HALF + 1) + lolo) << 2 * up
    unit = CLASS * lowest - LOWEST
    return _quotient(total, n, unit), _root(n * squares - total * total, n * (n - 1), unit) if n > 1 else 0.0


def _finished(groups: pa.Array) -> pa.Array:
    done = [mean_and_spread_of(classes) for classes in groups.to_pylist()]
    columns = [pa.array(c, pa.float64()) for c in (zip(*done) if done else ([], []))]
    return pa.StructArray.from_arrays(columns, names=["mean", "std"])


def moments(partials: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``(*by, rows, <measure>_n, <measure>_mean, <measure>_std)`` from partial sums, each rounded once.

    A spread is the sample standard deviation; 0.0 for one value and NULL for none. Nulls are not counted. A group with a
    NaN or with both infinities has the mean NaN.
    """
    columns = [F.sum("rows").alias("rows")]
    for name in measures:
        fields = [F.col(f"{name}_class").alias("class"), F.col(f"{name}_n").alias("n")]
        fields += [F.col(f"{name}_{s}").alias(s) for s in _SUMS]
        columns += [F.sum(f"{name}_n").alias(f"{name}_n"), F.collect_list(F.struct(*fields)).alias(f"_{name}")]
    rows = partials.groupBy(*by).agg(*columns)
    finished = F.arrow_udf(_finished, "struct<mean: double, std: double>")
    rows = rows.select("*", *(finished(f"_{name}").alias(f"_{name}_done") for name in measures))
    done = [(F.col(f"_{name}_done.{s}").alias(f"{name}_{s}")) for name in measures for s in ("mean", "std")]
    return rows.select(*by, "rows", *(f"{name}_n" for name in measures), *done)
