"""Log odds of two classes of values by smoothed densities. Fitted from counted values: what comes to the driver is a row for each bin of each class."""

from __future__ import annotations

import math
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .algebra import second_derivatives
from .ranks import running_totals

#: Densities below this count as this.
LEAST = 1e-12


def equal_count_bins(d: DataFrame, x: str, positive: Column, bins: int) -> DataFrame:
    """positive, bin (from 0), n, low and high of bins that hold equally many of a class's values in order: bin b has the ranks from b n div bins up to (b + 1) n div bins. Null values are left out.

    Values are counted first and ranked over ranges of their order, so neither a frequent value nor a class is one task's.
    """
    v = d.filter(F.col(x).isNotNull()).groupBy(positive.alias("positive"), F.col(x).cast("double").alias("_x")).agg(F.count("*").alias("_n"))
    v = running_totals(v, ["positive", "_x"], "_n", "_before")
    totals = v.groupBy("positive").agg(F.sum("_n").alias("_all"), F.min("_before").alias("_start"))
    v = v.join(F.broadcast(totals), "positive").withColumn("_before", F.col("_before") - F.col("_start"))
    exact = lambda c: f"(({c}) * {bins} + _all - 1) div _all"
    low = v.withColumn("bin", F.explode(F.expr(f"filter(sequence({exact('_before')}, greatest({exact('_before')}, {exact('_before + _n')} - 1)), b -> b < {exact('_before + _n')} and b < {bins})"))).select("positive", "bin", F.col("_x").alias("low"))
    high = v.withColumn("_c", F.explode(F.expr(f"filter(sequence({exact('_before + 1')}, greatest({exact('_before + 1')}, {exact('_before + _n + 1')} - 1)), c -> c < {exact('_before + _n + 1')} and c between 1 and {bins})")))
    high = high.select("positive", (F.col("_c") - 1).alias("bin"), F.col("_x").alias("high"))
    count = F.expr(f"(bin + 1) * _all div {bins} - bin * _all div {bins}")
    return low.join(high, ["positive", "bin"]).join(F.broadcast(totals), "positive").select("positive", "bin", count.alias("n"), "low", "high", F.col("_all").alias("n_class"))


def _densities(d: DataFrame, x: str, positive: Column, bins: int) -> tuple[dict[bool, list[tuple[float, float]]], float, float]:
    """The middles and densities of each class's bins, without bins of no width, and the least and greatest value of both."""
    rows = sorted(equal_count_bins(d, x, positive, bins).collect(), key=lambda r: (r["positive"], r["bin"]))
    of = {k: [((r["low"] + r["high"]) / 2, r["n"] / (r["high"] - r["low"]) / r["n_class"]) for r in rows if r["positive"] == k and r["high"] > r["low"]] for k in (False, True)}
    if not all(of.values()):
        raise ValueError("both classes need bins of some width")
    return of, min(r["low"] for r in rows), max(r["high"] for r in rows)


def interpolated(x: float, points: list[tuple[float, float]]) -> float:
    """Along straight lines between the points, and level outside them."""
    k = bisect_left(points, (x, -math.inf))
    if k == 0 or k == len(points):
        return points[max(0, k - 1)][1]
    (x0, y0), (x1, y1) = points[k - 1], points[k]
    return y1 if x1 == x0 else y0 + (y1 - y0) * (x - x0) / (x1 - x0)


def splined(x: float, points: list[tuple[float, float]], bends: list[float]) -> float:
    """Along the natural cubic spline, and level outside the points."""
    k = bisect_left(points, (x, -math.inf))
    if k == 0 or k == len(points):
        return points[max(0, k - 1)][1]
    (x0, y0), (x1, y1) = points[k - 1], points[k]
    h = x1 - x0
    a, b = (x1 - x) / h, (x - x0) / h
    return a * y0 + b * y1 + ((a**3 - a) * bends[k - 1] + (b**3 - b) * bends[k]) * h * h / 6


def _clamped(values: list[float]) -> list[float]:
    """Level from the greatest value on, and before the least one; of equal ones the first counts."""
    top, low = values.index(max(values)), values.index(min(values))
    out = [values[top] if i > top else v for i, v in enumerate(values)]
    return [values[low] if i < low else v for i, v in enumerate(out)]


def _fitted(d: DataFrame, x: str, positive: Column, bins: int, points: int, spline: bool) -> DataFrame:
    of, low, high = _densities(d, x, positive, bins)
    step = (high - low) / points
    curve = {}
    for k, p in of.items():
        bends = second_derivatives([a for a, _ in p], [b for _, b in p]) if spline else []
        curve[k] = [max(LEAST, splined(low + i * step, p, bends) if spline else interpolated(low + i * step, p)) for i in range(points)]
    odds = _clamped([math.log10(a / b) for a, b in zip(curve[True], curve[False], strict=True)])
    return d.sparkSession.createDataFrame([(i, low + i * step, v) for i, v in enumerate(odds)], "point long, x double, log_odds double")


def step_log_odds(d: DataFrame, x: str, positive: Column, bins: int = 50, points: int = 1000) -> DataFrame:
    """point, x and log_odds (base 10) at points from the least value to the greatest: densities of equal-count bins, straight between their middles; clamped outside the extrema."""
    return _fitted(d, x, positive, bins, points, False)


def spline_log_odds(d: DataFrame, x: str, positive: Column, bins: int = 12, points: int = 1000) -> DataFrame:
    """As step_log_odds, along natural cubic splines through the densities."""
    return _fitted(d, x, positive, bins, points, True)


def smoothed_log_odds(d: DataFrame, x: str, positive: Column, low: float, high: float, bins: int) -> DataFrame:
    """bin and log_odds of fixed bins from low to high; values outside go to the outermost bins. Shares are means over bins div 40 bins to each side (always divided by their full number) and count as 5 positive values at least. Null values are left out."""
    w = bins // 40
    k = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col(x) - low) * bins / (high - low)))).cast("long")
    n = d.filter(F.col(x).isNotNull()).groupBy(k.alias("_k")).agg(F.count_if(positive).alias("_p"), F.count_if(~positive).alias("_q"))
    totals = F.broadcast(n.agg(F.sum("_p").alias("_all_p"), F.sum("_q").alias("_all_q")))
    # Each bin gives its counts to the bins around it; there are no more rows than bins times the width.
    near = n.withColumn("bin", F.explode(F.sequence(F.greatest(F.col("_k") - w, F.lit(0)), F.least(F.col("_k") + w, F.lit(bins - 1))))).groupBy("bin").agg(F.sum("_p").alias("_p"), F.sum("_q").alias("_q"))
    every = d.sparkSession.range(bins).select(F.col("id").alias("bin")).join(near, "bin", "left").join(totals)
    share = lambda c, a: F.greatest(F.coalesce(F.col(c), F.lit(0)) / (2 * w + 1) / F.col(a), 5 / F.col("_all_p"))
    return every.select("bin", F.log10(share("_p", "_all_p") / share("_q", "_all_q")).alias("log_odds"))
