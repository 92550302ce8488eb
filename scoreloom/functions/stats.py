"""Aggregate rules: mean, spread, standard error, pass@k."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(value: Column | str) -> Column:
    """Mean over the non-null values, NULL if there are none."""
    return F.avg(value)


def spread(value: Column | str) -> Column:
    """Sample standard deviation; 0.0 for a single value, NULL for none."""
    n = F.count(value)
    return F.when(n > 1, F.stddev_samp(value)).when(n == 1, F.lit(0.0))


def standard_error(value: Column | str) -> Column:
    """Standard error of the mean; NULL for fewer than two values."""
    n = F.count(value)
    return F.when(n > 1, F.stddev_samp(value) / F.sqrt(n))


def pass_at_k(n: Column, c: Column, k: int) -> Column:
    """Unbiased pass@k for ``c`` correct samples out of ``n``.

    1 - C(n-c, k) / C(n, k) as a product of k ratios, so the work per row depends on
    k alone and not on the number of samples.
    """
    n, c = n.cast("double"), c.cast("double")
    all_wrong = F.lit(1.0)
    for j in range(k):
        all_wrong = all_wrong * (n - c - j) / (n - j)
    return F.when(c <= 0, F.lit(0.0)).when(n - c < k, F.lit(1.0)).otherwise(1 - all_wrong)
