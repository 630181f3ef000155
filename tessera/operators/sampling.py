"""Samples with exact sizes, by keyed thresholds: no sort of all rows, the same rows at every run."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.bins import inner_bin
from tessera.sources.shared import save


def uniform(seed: int, tag: str, id_col: str) -> Column:
    """A number between 0 and 1 (neither itself) that seed, tag and id fix."""
    return (F.pmod(F.xxhash64(F.lit(seed), F.lit(tag), F.col(id_col)), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def smallest(df: DataFrame, by: list[str], key: str, coarse: Column, id_col: str, want: DataFrame) -> DataFrame:
    """Of each group of `by` the `want` rows with the smallest keys, ties by id. want: (by..., want), a row a group.

    coarse is a coarse monotone function of the key: counts of its values tell which of them are wanted whole, and only
    rows of the one value that the threshold cuts are ranked.
    """
    group = lambda: F.struct(F.lit(0).alias("_one"), *by)
    rows = df.withColumn("_g", group()).withColumn("_c", coarse)
    counts = rows.groupBy("_g", "_c").agg(F.count(F.lit(1)).alias("_n"))
    end = F.sum("_n").over(Window.partitionBy("_g").orderBy("_c"))
    counts = counts.withColumn("_before", end - F.col("_n")).join(want.select(group().alias("_g"), "want"), "_g")
    counts = counts.withColumn("_take", F.least("_n", F.col("want") - F.col("_before"))).where("_take > 0").select("_g", "_c", "_n", "_take")
    marked = rows.join(counts, ["_g", "_c"])
    rank = F.row_number().over(Window.partitionBy("_g", "_c").orderBy(key, id_col))
    cut = marked.where("_take < _n").withColumn("_r", rank).where("_r <= _take").drop("_r")
    return marked.where("_take = _n").unionByName(cut).select(*df.columns)


def log_edges_of(low: float | None, high: float | None, bins: int) -> list[float]:
    """bins + 1 edges at equal distances of the logarithm; a single value is widened, none gives 1e-6 to 1."""
    if low is None or high is None:
        low, high = 1e-6, 1.0
    elif low == high:
        low, high = low * 0.9, high * 1.1
    return [10 ** (math.log10(low) + (math.log10(high) - math.log10(low)) * i / bins) for i in range(bins + 1)]


def quota_sample(df: DataFrame, id_col: str, metrics: list[str], size: int, bins: int = 10, seed: int = 0) -> DataFrame:
    """(id, metrics..., one bin per metric as bin_<metric>, via): `size` rows (all, if there are no more) whose metrics
    spread as those of df, and rare combinations besides.

    Each metric has a share of the size (the last one the rest). Its values lie in bins of equal width of the logarithm,
    non-positive ones in the first; a multinomial draw deals the share to bins by their rows, and each bin gives as many
    rows as it was dealt, or all it has; what bins lacked is drawn from the rows that other bins, of those that were dealt
    any, have left. Rows that two metrics chose count once, and what is then missing is drawn from all other rows with the
    weight 1 / (product of the sizes of the row's bins), without replacement (smallest -ln(u) / weight).

    via: the first metric that chose the row, or "rest". Rows with a null id or metrics that are not finite take no part;
    of rows with one id the smallest counts. The driver sees the counts of bins only.
    """
    finite = F.col(id_col).isNotNull()
    for m in metrics:
        finite = finite & F.col(m).isNotNull() & ~F.isnan(F.col(m).cast("double")) & (F.abs(F.col(m).cast("double")) != F.lit(math.inf))
    rows = df.where(finite).groupBy(id_col).agg(F.min(F.struct(*[F.col(m).cast("double").alias(m) for m in metrics])).alias("_m")).select(id_col, "_m.*")
    ends = [f(F.when(F.col(m) > 0, F.col(m))) for m in metrics for f in (F.min, F.max)]
    total, *ends = rows.agg(F.count(F.lit(1)), *ends).first()
    names = [f"bin_{m}" for m in metrics]
    for i, (m, name) in enumerate(zip(metrics, names, strict=True)):
        rows = rows.withColumn(name, inner_bin(F.col(m), log_edges_of(ends[2 * i], ends[2 * i + 1], bins)[1:-1]))
    rows = save(rows, "sample-binned")
    size = min(size, total)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(n).alias("b")) for i, n in enumerate(names)]))
    found = rows.select(each.alias("x")).groupBy("x.i", "x.b").count().collect()  # metrics x bins
    sizes = np.zeros((len(metrics), bins), np.int64)
    for i, b, n in found:
        sizes[i, b] = n
    rng = np.random.default_rng(seed)
    part = size // len(metrics)
    shares = [part] * (len(metrics) - 1) + [size - part * (len(metrics) - 1)]
    spark, picks = df.sparkSession, []
    for i, (m, name) in enumerate(zip(metrics, names, strict=True)):
        dealt = rng.multinomial(shares[i], sizes[i] / max(1, sizes[i].sum())) if total else np.zeros(bins, np.int64)
        want = spark.createDataFrame([(b, int(min(dealt[b], sizes[i, b]))) for b in range(bins) if dealt[b]], f"{name} int, want long")
        keyed = rows.select(id_col, name, uniform(seed, m, id_col).alias("_u"))
        taken = save(smallest(keyed, [name], "_u", F.floor(F.col("_u") * 4096), id_col, want).select(id_col), "sample-taken")
        picks.append(taken.withColumn("_i", F.lit(i)))
        lacking = int(np.maximum(dealt - sizes[i], 0).sum())
        open_bins = [b for b in range(bins) if 0 < dealt[b] < sizes[i, b]]
        if lacking and open_bins:
            pool = rows.where(F.col(name).isin(open_bins)).join(taken, id_col, "left_anti").select(id_col, uniform(seed, f"more {m}", id_col).alias("_u"))
            one = spark.createDataFrame([(lacking,)], "want long")
            picks.append(smallest(pool, [], "_u", F.floor(F.col("_u") * 4096), id_col, one).select(id_col, F.lit(i).alias("_i")))
    chosen = picks[0]
    for more in picks[1:]:
        chosen = chosen.unionByName(more)
    chosen = save(chosen.groupBy(id_col).agg(F.min("_i").alias("_i")), "sample-chosen")
    missing = size - chosen.count()
    product = F.lit(1.0)
    for i, name in enumerate(names):
        product = product * F.element_at(F.array(*[F.lit(float(n)) for n in sizes[i]]), F.col(name) + 1)
    rest = rows.join(chosen, id_col, "left_anti").select(id_col, (-F.ln(uniform(seed, "rest", id_col)) * product).alias("_u"))
    extra = smallest(rest, [], "_u", F.floor(F.ln("_u") * 64), id_col, spark.createDataFrame([(missing,)], "want long"))
    chosen = chosen.unionByName(extra.select(id_col, F.lit(len(metrics)).alias("_i")))
    via = F.element_at(F.array(*[F.lit(m) for m in metrics], F.lit("rest")), F.col("_i") + 1)
    return rows.join(chosen, id_col).withColumn("via", via).drop("_i")
