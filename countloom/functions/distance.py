"""Distances of two arrays of equal length, as Column functions, with a registry by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(a: Column, b: Column, term) -> Column:
    return F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda s, x: s + x)


def sq_euclidean(a: Column, b: Column) -> Column:
    return _sum(a, b, lambda x, y: (x - y) * (x - y))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(sq_euclidean(a, b))


def manhattan(a: Column, b: Column) -> Column:
    return _sum(a, b, lambda x, y: F.abs(x - y))


def chebyshev(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def minkowski(a: Column, b: Column, p: float = 3.0) -> Column:
    return F.pow(_sum(a, b, lambda x, y: F.pow(F.abs(x - y), F.lit(p))), F.lit(1 / p))


def canberra(a: Column, b: Column) -> Column:
    """Sum of differences over the sum of both arrays' magnitudes (one quotient, not one for each place)."""
    return manhattan(a, b) / _sum(a, b, lambda x, y: F.abs(x) + F.abs(y))


def bray_curtis(a: Column, b: Column) -> Column:
    return manhattan(a, b) / _sum(a, b, lambda x, y: F.abs(x + y))


def jaccard(a: Column, b: Column) -> Column:
    """1 / (J + 1e-9) over the arrays as sets."""
    return 1 / (F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)) + 1e-9)


def error_sum(a: Column, b: Column) -> Column:
    """The error sum of squares of two points about their mean."""
    return sq_euclidean(a, b) / 2


def chi_square(a: Column, b: Column) -> Column:
    """The root of the sum of both arrays of transformed values; places where a value is missing are left out."""
    return F.sqrt(_sum(a, b, lambda x, y: F.coalesce(F.nanvl(x + y, F.lit(0.0)), F.lit(0.0))))


def _mean(a: Column, term) -> Column:
    return F.aggregate(F.transform(a, term), F.lit(0.0), lambda s, x: s + x) / F.size(a)


def _distance_covariance(a: Column, b: Column) -> Column:
    """The square of the distance covariance of two series, from means of distances instead of centred matrices."""
    mean_a = F.transform(a, lambda x: _mean(a, lambda y: F.abs(x - y)))
    mean_b = F.transform(b, lambda x: _mean(b, lambda y: F.abs(x - y)))
    both = F.arrays_zip(a.alias("a"), b.alias("b"))
    joint = _mean(both, lambda x: _mean(both, lambda y: F.abs(x["a"] - y["a"]) * F.abs(x["b"] - y["b"])))
    return joint - 2 * _sum(mean_a, mean_b, lambda x, y: x * y) / F.size(a) + _mean(mean_a, lambda x: x) * _mean(mean_b, lambda x: x)


def distance_correlation(a: Column, b: Column) -> Column:
    """The distance correlation of two series (arrays of one length), 0 where one is constant. The work has the square of their length."""
    ab, aa, bb = (_distance_covariance(x, y) for x, y in ((a, b), (a, a), (b, b)))
    return F.when(aa * bb > 1e-30, F.sqrt(F.greatest(ab, F.lit(0.0)) / F.sqrt(aa * bb))).otherwise(0.0)


METRICS = {f.__name__: f for f in (euclidean, sq_euclidean, manhattan, chebyshev, minkowski, canberra, bray_curtis, jaccard, error_sum, chi_square)}
