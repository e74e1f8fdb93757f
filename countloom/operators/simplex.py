"""Downhill simplex minimisation of many small problems at once: all groups and starts of an Arrow batch step together."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def descended(f: Callable[[np.ndarray, np.ndarray], np.ndarray], starts: np.ndarray, size: float, tolerance: float, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best points (problems by dimensions), their values and the steps taken. f gets the problems' numbers and a point for each.

    A simplex reflects its worst corner at the others' centre, goes twice as far if that is best, halfway if it isn't better, and shrinks to its best corner if that doesn't help. A problem is done
    when its corners' values and the corners themselves differ by no more than the tolerance, relatively.
    """
    n, k = starts.shape
    corners = np.repeat(starts[:, None, :], k + 1, axis=1)
    for j in range(k):
        corners[:, j + 1, j] += np.where(starts[:, j] != 0, size * np.abs(starts[:, j]), size)
    everyone = np.arange(n)
    values = np.stack([f(everyone, corners[:, j]) for j in range(k + 1)], axis=1)
    taken, open_ = np.zeros(n, np.int64), everyone
    for _ in range(steps):
        order = np.argsort(values[open_], axis=1, kind="stable")
        corners[open_], values[open_] = np.take_along_axis(corners[open_], order[:, :, None], axis=1), np.take_along_axis(values[open_], order, axis=1)
        c, v = corners[open_], values[open_]
        wide = np.abs(c - c[:, :1]).max(axis=(1, 2)) > tolerance * (1e-9 + np.abs(c[:, 0]).max(axis=1))
        uneven = v[:, -1] - v[:, 0] > tolerance * tolerance * (1e-30 + np.abs(v[:, 0]))
        open_ = open_[wide | uneven]
        if not len(open_):
            break
        taken[open_] += 1
        c, v = corners[open_], values[open_]
        centre, worst = c[:, :-1].mean(axis=1), c[:, -1]
        once = centre + (centre - worst)
        f_once = f(open_, once)
        far, near = centre + 2 * (centre - worst), np.where((f_once < v[:, -1])[:, None], (centre + once) / 2, (centre + worst) / 2)
        best, middling = f_once < v[:, 0], f_once < v[:, -2]
        second = np.where(best[:, None], far, near)
        f_second = f(open_, second)
        take_second = np.where(best, f_second < f_once, ~middling & (f_second < np.minimum(f_once, v[:, -1])))
        take_once = ~take_second & (best | middling)
        shrink = ~take_second & ~take_once
        c[:, -1] = np.where(take_second[:, None], second, np.where(take_once[:, None], once, worst))
        v[:, -1] = np.where(take_second, f_second, np.where(take_once, f_once, v[:, -1]))
        if shrink.any():
            c[shrink, 1:] = (c[shrink, 1:] + c[shrink, :1]) / 2
            for j in range(1, k + 1):
                v[shrink, j] = f(open_[shrink], c[shrink, j])
        corners[open_], values[open_] = c, v
    best = values.argmin(axis=1)
    return corners[everyone, best], values[everyone, best], taken


def minimised(d: DataFrame, keys: list[str], starts: list[str], data: list[str], objective: Callable[[np.ndarray, dict[str, np.ndarray]], np.ndarray], size: float = 0.1, tolerance: float = 1e-9, steps: int = 2000) -> DataFrame:
    """keys, x (the point), value and steps of the least value found from each row's start; keep the best start of a group by grouping the result.

    starts and data are columns of numbers; objective gets points (rows by dimensions) and the data columns for them and returns their values. Null numbers count as not a number, and such rows end where they start.
    """
    kinds = [d.schema[c].dataType.simpleString() for c in keys]
    cols = [*keys, *starts, *data]
    d = d.select(*keys, *(F.col(c).cast("double").alias(c) for c in [*starts, *data]))

    def run(batches):
        for b in batches:
            number = lambda c: b.column(c).to_numpy(zero_copy_only=False).astype(float)  # noqa: B023, E731
            at = np.stack([number(c) for c in starts], axis=1)
            held = {c: number(c) for c in data}
            with np.errstate(all="ignore"):
                points, values, n = descended(lambda i, x: np.nan_to_num(objective(x, {c: v[i] for c, v in held.items()}), nan=np.inf), at, size, tolerance, steps)  # noqa: B023
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keys), pa.array(points.tolist(), pa.list_(pa.float64())), pa.array(values), pa.array(n)], [*keys, "x", "value", "steps"])

    names = ", ".join(f"`{c}` {k}" for c, k in zip(keys, kinds, strict=True))
    return d.select(*cols).mapInArrow(run, f"{names}, x array<double>, value double, steps long")
