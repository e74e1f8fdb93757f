"""Matrices in long form (row, column, value), as joins and sums, and curves through a few fixed points as Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def product(a: DataFrame, b: DataFrame) -> DataFrame:
    """The matrix product; rows of the join stand for products of single values, which are added up before the result."""
    x = a.select("row", F.col("column").alias("_k"), F.col("value").alias("_a"))
    y = b.select(F.col("row").alias("_k"), "column", F.col("value").alias("_b"))
    return x.join(y, "_k").groupBy("row", "column").agg(F.sum(F.col("_a") * F.col("_b")).alias("value"))


def combined(a: DataFrame, b: DataFrame, s: float = 1.0, t: float = 1.0) -> DataFrame:
    """s a + t b."""
    scaled = lambda d, f: d.select("row", "column", (F.col("value") * f).alias("value"))
    return scaled(a, s).unionByName(scaled(b, t)).groupBy("row", "column").agg(F.sum("value").alias("value"))


def elementwise(a: DataFrame, b: DataFrame) -> DataFrame:
    """The product of values at equal places."""
    y = b.withColumnRenamed("value", "_b")
    return a.join(y, ["row", "column"]).select("row", "column", (F.col("value") * F.col("_b")).alias("value"))


def trace(a: DataFrame) -> DataFrame:
    return a.filter(F.col("row") == F.col("column")).agg(F.sum("value").alias("trace"))


def lagrange(x: Column, xs: list[float], ys: list[float]) -> Column:
    """The polynomial through the points, at x."""
    terms = [reduce(Column.__mul__, [(x - a) / (xi - a) for j, a in enumerate(xs) if j != i], F.lit(yi)) for i, (xi, yi) in enumerate(zip(xs, ys, strict=True))]
    return reduce(Column.__add__, terms)


def second_derivatives(xs: list[float], ys: list[float]) -> list[float]:
    """Of the natural cubic spline at its points: a tridiagonal system, 0 at both ends."""
    n = len(xs)
    upper, right = [0.0] * n, [0.0] * n
    for i in range(1, n - 1):
        left, after = xs[i] - xs[i - 1], xs[i + 1] - xs[i]
        slope = (ys[i + 1] - ys[i]) / after - (ys[i] - ys[i - 1]) / left
        pivot = 2 * (left + after) - left * upper[i - 1]
        upper[i], right[i] = after / pivot, (6 * slope - left * right[i - 1]) / pivot
    out = [0.0] * n
    for i in range(n - 2, 0, -1):
        out[i] = right[i] - upper[i] * out[i + 1]
    return out


def natural_spline(x: Column, xs: list[float], ys: list[float]) -> Column:
    """The natural cubic spline through the points, at x; outside them the outermost piece goes on."""
    m = second_derivatives(xs, ys)
    out = None
    for i in range(len(xs) - 1):
        h = xs[i + 1] - xs[i]
        a, b = (xs[i + 1] - x) / h, (x - xs[i]) / h
        y = a * ys[i] + b * ys[i + 1] + ((a * a * a - a) * m[i] + (b * b * b - b) * m[i + 1]) * (h * h / 6)
        last = i == len(xs) - 2
        out = F.when(x < xs[i + 1], y) if out is None and not last else y if out is None else out.otherwise(y) if last else out.when(x < xs[i + 1], y)
    return out


def bicubic(x: Column, y: Column, xs: list[float], ys: list[float], zs: list[list[float]]) -> Column:
    """The surface through the values zs[i][j] at (xs[i], ys[j]), at (x, y): natural splines along y, and one along x through what they give.

    A spline is linear in its values, so the one along x is a sum of the splines that are 1 at one point and 0 at the others.
    """
    unit = lambda i: [1.0 if k == i else 0.0 for k in range(len(xs))]
    return reduce(Column.__add__, [natural_spline(x, xs, unit(i)) * natural_spline(y, ys, row) for i, row in enumerate(zs)])
