"""Order statistics of a sorted array column. The arrays hold one history that the calendar bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: scales a median absolute deviation to a normal standard deviation.
MAD_TO_SIGMA = 1.4826


def sorted_median(sorted_array: Column) -> Column:
    n = F.size(sorted_array)
    low = F.get(sorted_array, F.floor((n - 1) / 2).cast("int"))
    high = F.get(sorted_array, F.floor(n / 2).cast("int"))
    return (low + high) / F.lit(2.0)


def sorted_mad(sorted_array: Column, median: Column) -> Column:
    deviations = F.sort_array(F.transform(sorted_array, lambda x: F.abs(x - median)))
    return sorted_median(deviations)


def robust_sigma(mad: Column) -> Column:
    return F.when(mad > 0, F.lit(MAD_TO_SIGMA) * mad)
