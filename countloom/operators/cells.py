"""Filters, totals and summaries of count matrices in long form (feature, cell, value), and pairs of features or cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .counting import one_and_two_off
from .ranks import running_totals
from .storage import kept, small_or_not


def kept_cells(d: DataFrame, cell: str, value: str, part: float = 100.0) -> DataFrame:
    """Rows of cells whose total is at least the mean total over part. One row with the mean is broadcast."""
    sums = d.groupBy(cell).agg(F.sum(value).alias("_total"))
    mean = F.broadcast(sums.agg(F.avg("_total").alias("_mean")))
    return d.join(sums.join(mean).filter(F.col("_total") >= F.col("_mean") / part).select(cell), cell, "left_semi")


def kept_features(d: DataFrame, feature: str, value: str, least: float, cells: int) -> DataFrame:
    """Rows of features whose mean over so many cells (absent ones are 0) is at least a value."""
    high = d.groupBy(feature).agg((F.sum(value) / cells).alias("_mean")).filter(F.col("_mean") >= least)
    return d.join(high.select(feature), feature, "left_semi")


def kept_columns(d: DataFrame, column: str, value: str, least: float) -> DataFrame:
    """Rows of columns whose numeric total is at least a value; columns without a number stay."""
    sums = d.groupBy(column).agg(F.sum(F.expr(f"try_cast({value} as double)")).alias("_total"))
    return d.join(sums.filter(F.col("_total").isNull() | (F.col("_total") >= least)).select(column), column, "left_semi")


def both_at_least(a: Column, b: Column, least: float, how: str = "both") -> tuple[Column, Column]:
    """The places of two arrays where both, or either, reach a value (or all, for "none"), as two arrays."""
    z = F.arrays_zip(a.alias("a"), b.alias("b"))
    test = {"both": lambda x: (x["a"] >= least) & (x["b"] >= least), "either": lambda x: (x["a"] >= least) | (x["b"] >= least), "none": lambda x: F.lit(True)}[how]
    some = F.filter(z, test)
    return F.transform(some, lambda x: x["a"]), F.transform(some, lambda x: x["b"])


def spike_efficiency(d: DataFrame, cell: str, feature: str, value: str, added: DataFrame) -> DataFrame:
    """cell and efficiency: its spike molecules over those added (feature, n_added); spikes without counts weigh too."""
    total = F.broadcast(added.agg(F.sum("n_added").alias("_all")))
    found = d.join(small_or_not(added.select(feature)), feature).groupBy(cell).agg(F.sum(value).alias("_n"))
    return found.join(total).select(cell, (F.col("_n") / F.col("_all")).alias("efficiency"))


def spike_efficiency_by_spike(d: DataFrame, feature: str, value: str, added: DataFrame, cells: int) -> DataFrame:
    """feature and efficiency over all cells."""
    found = d.groupBy(feature).agg(F.sum(value).alias("_n"))
    return added.join(found, feature, "left").select(feature, (F.coalesce("_n", F.lit(0)) / (F.col("n_added") * cells)).alias("efficiency"))


def expressed(d: DataFrame, feature: str, value: str, kinds: dict[str, Column], by: list[str] = ()) -> DataFrame:
    """How many features of each kind have a count, overall or by group."""
    on = F.col(value) > 0
    return d.groupBy(*by).agg(*[F.countDistinct(F.when(on & k, F.col(feature))).alias(name) for name, k in kinds.items()])


def totals_by_cell(d: DataFrame, cell: str, value: str, unique: str, is_main: Column) -> DataFrame:
    """Totals of cells: main variants give all their hits, other variants their unique ones."""
    return d.groupBy(cell).agg(F.sum(F.when(is_main, F.col(value)).otherwise(F.col(unique))).alias("total"))


def rpkm(d: DataFrame, cell: str, feature: str, value: str, lengths: DataFrame) -> DataFrame:
    """Adds rpkm: value per million of the cell's total and per 1000 bases of the feature (feature, length)."""
    sums = d.groupBy(cell).agg(F.sum(value).alias("_total"))
    e = d.join(sums, cell).join(lengths, feature)
    return e.withColumn("rpkm", F.when(F.col("_total") > 0, F.col(value) * 1e9 / (F.col("_total") * F.col("length"))).otherwise(0.0)).drop("_total", "length")


def gene_summary(d: DataFrame, gene: str, tag: str, value: str) -> DataFrame:
    """For each gene the hits of all its tags (most) and of those that no other gene has (least). Tags are counted before the join."""
    alone = d.groupBy(tag).agg((F.countDistinct(gene) == 1).alias("_one"))
    e = d.join(alone, tag)
    return e.groupBy(gene).agg(F.sum(value).alias("most"), F.sum(F.when(F.col("_one"), F.col(value)).otherwise(0)).alias("least"))


def distinct_mappings(d: DataFrame, by: list[str], places: list[str]) -> DataFrame:
    return d.groupBy(*by).agg(F.countDistinct(*places).alias("n_places"))


def totals_and_cases(counts: DataFrame, limit: Column, keys: list[str]) -> DataFrame:
    """n_umis (codes of a place), n_cases (places with so many), and their reads, all and above the limit."""
    n = counts.groupBy(*keys).agg(F.count("*").alias("n_umis"), F.sum("n_reads").alias("_all"), F.sum(F.when(F.col("n_reads") > limit, F.col("n_reads")).otherwise(0)).alias("_kept"))
    return n.groupBy("n_umis").agg(F.count("*").alias("n_cases"), F.sum("_all").alias("n_reads"), F.sum("_kept").alias("n_kept"))


def sense_ratio(d: DataFrame, by: list[str], sense: Column, length: str) -> DataFrame:
    """Sense and antisense hits per 1000 bases and their ratio (0 without a length, null without antisense hits)."""
    n = d.groupBy(*by).agg(F.count_if(sense).alias("n_sense"), F.count_if(~sense).alias("n_anti"), F.max(length).alias("_length"))
    per = lambda c: F.when(F.col("_length") > 0, F.col(c) * 1000 / F.col("_length")).otherwise(0.0)
    n = n.withColumn("sense_kb", per("n_sense")).withColumn("anti_kb", per("n_anti"))
    return n.withColumn("ratio", F.when(F.col("anti_kb") > 0, F.col("sense_kb") / F.col("anti_kb"))).drop("_length")


def cv_histogram(d: DataFrame, feature: str, cell: str, value: str, most: int = 1000, bins: int = 40, small: float = 20.0) -> DataFrame:
    """bin (from 0) and n: the coefficients of variation of the top features by total, over cells with more than 1/small of the mean total.

    Absent values count as 0, so moments come from sums over a feature's own rows. Bins cut the range of the coefficients evenly; top
    features are at most most, so their range is one row.
    """
    sums = d.groupBy(cell).agg(F.sum(value).alias("_total"))
    good = sums.join(F.broadcast(sums.agg(F.avg("_total").alias("_mean")))).filter(F.col("_total") > F.col("_mean") / small).select(cell)
    n_cells = F.broadcast(good.agg(F.count("*").alias("_n")))
    x = F.col(value).cast("double")
    f = d.join(good, cell, "left_semi").groupBy(feature).agg(F.sum(x).alias("_s"), F.sum(x * x).alias("_q")).orderBy(F.desc("_s"), feature).limit(most).join(n_cells)
    var = (F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n")) / (F.col("_n") - 1)
    f = f.filter("_s > 0 and _n > 1").select((F.sqrt(F.greatest(var, F.lit(0.0))) / (F.col("_s") / F.col("_n"))).alias("cv"))
    ends = F.broadcast(f.agg(F.min("cv").alias("_lo"), F.max("cv").alias("_hi")))
    at = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col("cv") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))), F.lit(bins - 1))).otherwise(0)
    return f.join(ends).groupBy(at.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def pairs(items: DataFrame, item: str, bucket: str | None = None) -> DataFrame:
    """first < second: all pairs of items, within a class if one is given. The result itself has the square of a class; items (features) are few."""
    a = items.select(*([bucket] if bucket else []), F.col(item).alias("first"))
    b = items.select(*([F.col(bucket).alias("_b")] if bucket else []), F.col(item).alias("second"))
    on = (F.col("first") < F.col("second")) & ((F.col(bucket) == F.col("_b")) if bucket else F.lit(True))
    return a.join(b, on).drop("_b")


def neighbours(cells: DataFrame, cell: str, x: str, y: str, rook: bool) -> DataFrame:
    """first < second: cells whose grid places touch; with rook not at a corner only. Each place makes its 8 (4) neighbours, so the join is by equality."""
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if not (rook and i and j)]
    near = F.explode(F.array(*[F.struct((F.col(x) + i).alias("x"), (F.col(y) + j).alias("y")) for i, j in steps]))
    a = cells.select(F.col(cell).alias("first"), near.alias("at")).select("first", "at.x", "at.y")
    b = cells.select(F.col(cell).alias("second"), F.col(x).alias("x"), F.col(y).alias("y"))
    return a.join(b, ["x", "y"]).filter("first < second").select("first", "second")


def five_prime(pos: Column, strand: Column, length: Column) -> Column:
    """The place of a read's 5' end: on the - strand that is its last base."""
    return F.when(strand == "-", pos + length - 1).otherwise(pos)


def position_clusters(tags: DataFrame, place: list[str], umi: str, length: int) -> DataFrame:
    """Of the read counts of codes (of so many bases) at a place: reads, molecules, those with more than one read, and those that are no mutation of another.

    A code of one read is a mutation if a code one base off has more reads, or one too and a lower number. Each such code asks for the codes one base off, by equality.
    """
    masks = F.array(*(F.lit(m).cast("long") for m in one_and_two_off(length)[0]))
    single = tags.filter("n_reads = 1").select(*place, F.col(umi).cast("long").alias("_code"), F.explode(masks).alias("_m"))
    asks = single.select(*place, "_code", F.col("_code").bitwiseXOR(F.col("_m")).alias("_other"))
    others = tags.select(*place, F.col(umi).cast("long").alias("_other"), F.col("n_reads").alias("_n"))
    mutated = asks.join(others, [*place, "_other"]).filter("_n > 1 or _other < _code").select(*place, F.col("_code").alias("_c")).distinct().withColumn("_mutated", F.lit(True))
    d = tags.withColumn("_c", F.col(umi).cast("long")).join(mutated, [*place, "_c"], "left")
    return d.groupBy(*place).agg(F.sum("n_reads").alias("n_reads"), F.count("*").alias("n_mols"), F.count_if(F.col("n_reads") > 1).alias("n_multi"), F.count_if(F.col("_mutated").isNull()).alias("n_unmutated"))


def level_bins(features: DataFrame, feature: str, mean: str, least: int) -> DataFrame:
    """feature and bin: features in order of their mean, so many in each bin, the rest in the last. Places in the order are counted over ranges of it."""
    d = running_totals(features.select(feature, mean, F.lit(1).cast("long").alias("_one")), [mean, feature], "_one", "_k")
    d = d.join(F.broadcast(d.agg(F.count("*").alias("_n"))))
    last = F.greatest(F.floor(F.col("_n") / least) - 1, F.lit(0))
    return d.select(feature, mean, F.least(F.floor(F.col("_k") / least), last).cast("long").alias("bin"))


def shuffled_within(d: DataFrame, group: list[str], value: str, order: list[str], seed: str) -> DataFrame:
    """d with shuffled: the values of each group dealt anew, by a hash of the rows' keys, so that reruns agree. Groups are single cells or bins of them."""
    key = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in order]))
    w = Window.partitionBy(*group)
    a = d.withColumn("_k", F.row_number().over(w.orderBy(*order)))
    b = d.select(*group, F.row_number().over(w.orderBy(key, *order)).alias("_k"), F.col(value).alias("shuffled"))
    return a.join(b, [*group, "_k"]).drop("_k")


def saturated_labels(n_seen: Column, n_labels: int, efficiency: float) -> Column:
    """The number of molecules behind so many seen labels, where a share of them is caught."""
    return F.log(1 - n_seen / n_labels) / F.log(F.lit(1 - efficiency / n_labels))


def count_bins(values: DataFrame, count: str, least: int) -> DataFrame:
    """count, n, bin (from 0): the different counts in order, gathered into bins of at least so many values each; what is left at the end is a bin too.

    A bin's start depends on where the one before it ended, so one task walks over the different counts, a row each, not over the values.
    """
    n = values.groupBy(count).agg(F.count("*").alias("n"))

    def walk(t: pa.Table) -> pa.Table:
        t = t.sort_by(count)
        bins, k, held = [], 0, 0
        for x in t.column("n").to_pylist():
            bins.append(k)
            held += x
            if held >= least:
                k, held = k + 1, 0
        return t.append_column("bin", pa.array(bins, pa.int64()))

    kind = n.schema[count].dataType.simpleString()
    return n.groupBy(F.lit(0).alias("_g")).applyInArrow(lambda t: walk(t.select([count, "n"])), f"`{count}` {kind}, n long, bin long")


def drawn_correlations(d: DataFrame, feature: str, cell: str, count: str, pairs: DataFrame, least: int, times: int, seed: str) -> DataFrame:
    """first, second, mean and variance of Pearson's r of pairs over so many rounds, in which every count stands for the mean of a feature drawn from its bin of counts.

    A bin holds the means of the features that have a count in it, one for each such value. Its values are numbered over ranges of their order, so that the many values of a frequent count are no one task's;
    a draw is a number by the hash of seed, round, feature and cell, and finds its value by an equality join. Pairs without variation count as 0.
    """
    d = d.select(feature, cell, F.col(count).alias("_count"))
    means = d.groupBy(feature).agg(F.avg("_count").alias("_mean"))
    bins = kept(count_bins(d, "_count", least))  # a row for each different count
    v = d.join(bins.select("_count", "bin"), "_count").join(means, feature)
    numbered = running_totals(v.select("bin", feature, cell, "_mean", F.lit(1).cast("long").alias("_one")), ["bin", feature, cell], "_one", "_before")
    sizes = bins.groupBy("bin").agg(F.sum("n").alias("_size"))
    starts = sizes.select("bin", "_size", F.coalesce(F.sum("_size").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))  # a row for each bin
    starts = small_or_not(starts)
    numbered = numbered.join(starts, "bin").select("bin", (F.col("_before") - F.col("_start")).alias("_k"), F.col("_mean").alias("_value"))
    rounds = v.join(starts, "bin").withColumn("_t", F.explode(F.sequence(F.lit(1), F.lit(times))))
    hashed = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col("_t").cast("string"), F.col(feature).cast("string"), F.col(cell).cast("string"))), 1, 12), 16, 10).cast("long")
    drawn = kept(rounds.withColumn("_k", hashed % F.col("_size")).join(numbered, ["bin", "_k"]).select(F.col(feature).alias("_f"), F.col(cell).alias("_c"), "_t", "_value"))
    a = pairs.select("first", "second").join(drawn.select(F.col("_f").alias("first"), "_c", "_t", F.col("_value").alias("_a")), "first")
    both = a.join(drawn.select(F.col("_f").alias("second"), "_c", "_t", F.col("_value").alias("_b")), ["second", "_c", "_t"])
    s = lambda c, n: F.sum(c).alias(n)
    x, y = F.col("_a"), F.col("_b")
    m = both.groupBy("first", "second", "_t").agg(F.count("*").alias("n"), s(x, "sx"), s(y, "sy"), s(x * x, "sxx"), s(y * y, "syy"), s(x * y, "sxy"))
    spread = (F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")) * (F.col("syy") - F.col("sy") * F.col("sy") / F.col("n"))
    r = F.when(spread > 1e-9, (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / F.sqrt(spread)).otherwise(0.0)
    return m.withColumn("_r", r).groupBy("first", "second").agg(F.avg("_r").alias("mean"), F.var_samp("_r").alias("variance"))


def class_correlations(pairs: DataFrame, r: str, same: Column, bins: int) -> DataFrame:
    """bin, n and n_background, and their shares: how many pairs of one class, and how many others, have a correlation of that size; a correlation of 1 falls in the last bin."""
    k = F.least(F.floor(F.abs(F.col(r)) * bins), F.lit(bins - 1)).cast("long")
    return _with_shares(pairs.groupBy(k.alias("bin")).agg(F.count_if(same).alias("n"), F.count_if(~same).alias("n_background")))


def _with_shares(n: DataFrame) -> DataFrame:
    total = F.broadcast(n.agg(F.sum("n").alias("_n"), F.sum("n_background").alias("_b")))
    share = lambda c, a: F.coalesce(F.try_divide(F.col(c), F.col(a)), F.lit(0.0))
    return n.join(total).select("bin", "n", "n_background", share("n", "_n").alias("share"), share("n_background", "_b").alias("share_background"))


#: Blocks that features are dealt to at least, bytes of a block, and features of a side of what is multiplied at once.
BLOCKS, BLOCK_BYTES, SIDE = 16, 16 << 20, 512


def _dense(t: pa.Table, n_cells: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of up to ``SIDE`` features (fewer where cells are many): their values with 0 for absent ones, what is present, and their classes."""
    side, out = max(16, min(SIDE, (8 << 20) // max(1, n_cells))), []
    for lo in range(0, t.num_rows, side):
        part = t.slice(lo, side)
        x = np.zeros((part.num_rows, n_cells))
        m = np.zeros_like(x)
        lists = part.column("values").combine_chunks()
        row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
        at, v = (lists.flatten().field(k).to_numpy() for k in (0, 1))
        x[row, at], m[row, at] = v, 1.0
        out.append((x, m, part.column("class").to_numpy()))
    return out


def _correlations(x: np.ndarray, mx: np.ndarray, y: np.ndarray, my: np.ndarray) -> np.ndarray:
    """Pearson's r of each row of x with each of y over the places that both have, by sums that are exact for whole numbers; nan without variation."""
    if mx.all() and my.all():
        n, sx, sy, sxx, syy = x.shape[1], x.sum(1)[:, None], y.sum(1)[None], (x * x).sum(1)[:, None], (y * y).sum(1)[None]
    else:
        n, sx, sy, sxx, syy = mx @ my.T, x @ my.T, mx @ y.T, (x * x) @ my.T, mx @ (y * y).T
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    ok = (vx > 1e-14 * n * sxx) & (vy > 1e-14 * n * syy)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(ok, (n * (x @ y.T) - sx * sy) / np.sqrt(vx * vy), np.nan)


def _tile(t: pa.Table, n_cells: int, bins: int) -> pa.Table:
    """Counts by bin of the pairs of two blocks' features, or of one block's own."""
    own = t.column("i")[0].as_py() == t.column("j")[0].as_py()
    code = t.column("class").combine_chunks().dictionary_encode().indices.fill_null(-1)
    t = t.select(["side", "values"]).append_column("class", code)
    sides = np.array(t.column("side").to_numpy())
    a = _dense(t.filter(pa.array(sides == 0)), n_cells)
    b = a if own else _dense(t.filter(pa.array(sides == 1)), n_cells)
    counts = np.zeros(2 * bins, np.int64)
    for p, (x, mx, kx) in enumerate(a):
        for q, (y, my, ky) in enumerate(b):
            if own and q < p:
                continue
            r = np.abs(_correlations(x, mx, y, my))
            ok = ~np.isnan(r)
            if own and p == q:
                ok &= np.triu(np.ones_like(ok), 1)
            at = np.minimum(np.floor(r[ok] * bins), bins - 1).astype(np.int64)
            other = ~((kx[:, None] == ky[None]) & (kx[:, None] >= 0))[ok]
            counts += np.bincount(at + bins * other, minlength=2 * bins)
    return pa.table({"bin": np.arange(bins), "n": counts[:bins], "n_background": counts[bins:]})


def correlation_classes(d: DataFrame, feature: str, cell: str, value: str, kind: Column, bins: int) -> DataFrame:
    """What ``class_correlations`` gives for Pearson's r of all pairs of features over the cells that both have a row in; kind is a feature's class. A feature and a cell have one row at most; rows with a null are left out.

    All pairs have the square of the features, by definition, but no row for a pair leaves a task: features are dealt to blocks, each two blocks make a tile, and a tile multiplies its blocks' values part by part and
    gives a row for each bin. So what is shuffled is the matrix once for each block, blocks of bounded bytes, and a task holds two blocks and one part's products.
    """
    d = d.select(F.col(feature).alias("feature"), kind.alias("class"), F.col(cell).alias("_cell"), F.col(value).cast("double").alias("_v")).dropna(subset=["feature", "_cell", "_v"])
    cells = kept(d.select("_cell").distinct().select("_cell", (F.row_number().over(Window.orderBy("_cell")) - 1).alias("_at")))  # a row for each cell
    n_cells, n_rows = cells.count(), d.count()
    blocks = max(BLOCKS, -(-n_rows * 16 // BLOCK_BYTES))
    f = d.join(small_or_not(cells), "_cell").groupBy("feature", "class").agg(F.collect_list(F.struct("_at", "_v")).alias("values"))
    f = f.withColumn("_b", F.pmod(F.xxhash64("feature"), F.lit(blocks))).withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    f = f.select(F.least("_b", "_o").alias("i"), F.greatest("_b", "_o").alias("j"), (F.col("_b") > F.col("_o")).cast("int").alias("side"), F.col("class").cast("string").alias("class"), "values")
    n = f.groupBy("i", "j").applyInArrow(lambda t: _tile(t, n_cells, bins), "bin long, n long, n_background long")
    return _with_shares(n.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("n_background").alias("n_background")).filter("n + n_background > 0"))


def aligned_grids(a: DataFrame, b: DataFrame, features: DataFrame, reach: int) -> DataFrame:
    """dx, dy, score and n: the shift of grid b, each way from -reach up to but without reach, whose values times a's at the features (x, y) are greatest on average; of equal ones the least shift. Grids have x, y and value.

    Every feature asks for the place that a shift brings over it, so the join is by equality and has features times shifts rows.
    """
    step = F.sequence(F.lit(-reach), F.lit(reach - 1))
    f = features.select("x", "y").join(a.select("x", "y", F.col("value").alias("_a")), ["x", "y"]).withColumn("dx", F.explode(step)).withColumn("dy", F.explode(step))
    f = f.select("dx", "dy", "_a", (F.col("x") - F.col("dx")).alias("x"), (F.col("y") - F.col("dy")).alias("y"))
    s = f.join(b, ["x", "y"]).groupBy("dx", "dy").agg(F.avg(F.col("_a") * F.col("value")).alias("score"), F.count("*").alias("n"))
    return s.orderBy(F.desc("score"), "dx", "dy").limit(1)
