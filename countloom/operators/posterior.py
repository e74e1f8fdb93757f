"""The posterior of a number of molecules, given how many reads each of their labels has.

With m molecules a label of frequency f is on n of them with binomial chance, and has its reads out of all with the chance n / z, where z labelled molecules
are expected; labels are multiplied up. The prior is a negative binomial. All in logarithms. Labels with the same frequency and number of reads have
the same factor, so a group is described by counted pairs, and groups with equal descriptions are worked out once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The share of the mode's probability at which the tail ends.
TAIL = 0.05


def _summed(x: np.ndarray) -> float:
    """The logarithm of the sum of exp(x)."""
    top = x.max(initial=-np.inf)
    return float(top + np.log(np.exp(x - top).sum())) if np.isfinite(top) else -np.inf


class Posterior:
    """The unnormed log posterior over m for the counted labels (frequency, reads, labels)."""

    def __init__(self, labels: list[tuple[float, int, int]], mean: float, variance: float, outer: bool = False):
        if variance <= mean:
            raise ValueError("the prior's variance must exceed its mean")
        self.labels, self.outer = labels, outer
        self.reads = sum(k * n for _, k, n in labels)
        self.efficiency = sum(f * n for f, _, n in labels)
        self.r, self.log_p, self.log_q = mean * mean / (variance - mean), math.log(mean / variance), math.log1p(-mean / variance)
        self.known: dict[int, float] = {}

    def _for_labelled(self, m: int, z: int) -> float:
        """The log likelihood where z of m molecules are labelled: n of them, below z, have a label."""
        n = np.arange(z)
        lg = math.lgamma
        ways = np.array([lg(m + 1) - lg(i + 1) - lg(m - i + 1) if i <= m else -np.inf for i in range(z)])
        total = 0.0
        with np.errstate(divide="ignore", invalid="ignore"):
            log_n, log_rest = np.log(n / z), np.log1p(-n / z)
            for f, k, times in self.labels:
                held = ways + n * math.log(f) + (m - n) * math.log1p(-f)
                read = lg(self.reads + 1) - lg(k + 1) - lg(self.reads - k + 1) + (k * log_n if k else 0) + (self.reads - k) * log_rest
                total += times * _summed(held + read)
                if total == -np.inf:
                    break
        return total

    def __call__(self, m: int) -> float:
        if m not in self.known:
            expected = self.efficiency * m
            if self.outer:
                z = range(1, m + 1)
                chances = np.array([self._for_labelled(m, i) + i * math.log(expected) - expected - math.lgamma(i + 1) for i in z])
                likelihood = _summed(chances)
            else:
                likelihood = self._for_labelled(m, max(1, round(expected)))
            self.known[m] = likelihood + self._prior(m)
        return self.known[m]

    def _prior(self, m: int) -> float:
        return math.lgamma(self.r + m) - math.lgamma(self.r) - math.lgamma(m + 1) + self.r * self.log_p + m * self.log_q

    def mode(self) -> int:
        """The most likely number, of equally likely ones the least.

        The posterior may have several peaks (labels with like numbers of reads fit every multiple of their number), so all numbers are tried, up to where none can win: a likelihood is
        at most 1, and past its own peak the prior only falls, so the search ends where the prior alone is below the best found.
        """
        best, top, m = 1, self(1), 1
        while top == -np.inf or self._prior(m + 1) > top or self._prior(m + 1) >= self._prior(m):
            m += 1
            if self(m) > top:
                best, top = m, self(m)
        return best

    def mean(self) -> int:
        """The rounded mean, from 1 to the first number past the mode whose probability is below ``TAIL`` of the mode's."""
        m = self.mode()
        top, values = self(m), [self(i) for i in range(1, m + 1)]
        while values[-1] >= top + math.log(TAIL):
            values.append(self(len(values) + 1))
        p = np.exp(np.array(values) - top)
        return round(float((p * np.arange(1, len(p) + 1)).sum() / p.sum()))


def _estimated(batches, mean: float, variance: float, outer: bool):
    for b in batches:
        found = []
        for profile in b.column("profile").to_pylist():
            p = Posterior([(x["frequency"], x["reads"], x["labels"]) for x in profile], mean, variance, outer)
            found.append((p.mean(), p.mode()))
        columns = [b.column("profile"), *(pa.array([x[i] for x in found], pa.int64()) for i in range(2))]
        yield pa.RecordBatch.from_arrays(columns, ["profile", "mean", "mode"])


def posterior_counts(observed: DataFrame, keys: list[str], reads: str, labels: int, efficiency: float, mean: float, variance: float, frequency: str | None = None, outer: bool = False) -> DataFrame:
    """keys, mean and mode of the molecules of each group, from its labels (a row each) and their reads.

    Labels share the efficiency equally, and those without a row have no reads; with a column frequency every label has a row, with 0 reads too. The prior has the given mean and variance, ``outer``
    also adds over how many molecules are labelled. Null reads count as 0. A group's description has one entry for each of its frequencies and numbers of reads, at most one a label.
    """
    f = F.lit(efficiency / labels) if frequency is None else F.col(frequency).cast("double")
    d = observed.groupBy(*keys, f.alias("frequency"), F.coalesce(F.col(reads), F.lit(0)).cast("long").alias("reads")).agg(F.count("*").alias("labels"))
    if frequency is None:
        rest = d.groupBy(*keys).agg((F.lit(labels) - F.sum("labels")).alias("labels")).filter("labels > 0")
        d = d.unionByName(rest.withColumn("frequency", f).withColumn("reads", F.lit(0).cast("long"))).groupBy(*keys, "frequency", "reads").agg(F.sum("labels").alias("labels"))
    d = d.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("frequency", "reads", "labels"))).alias("profile"))
    kind = d.schema["profile"].dataType.simpleString()
    found = d.select("profile").distinct().mapInArrow(lambda b: _estimated(b, mean, variance, outer), f"profile {kind}, mean long, mode long")
    return d.join(found, "profile").select(*keys, "mean", "mode")
