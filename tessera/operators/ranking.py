"""Windows, ranks, bins and samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.perf import positive_finite
from tessera.operators.sweep import carried, swept
from tessera.sources.shared import save


def harmonic_curve(df: DataFrame, x: str, ratio: str, by: list[str]) -> DataFrame:
    """Running harmonic mean of ratio over the rows with x at most this x, positive finite rows only; a row per x.

    Rows combine by x first; the distinct x of a group are swept part by part.
    """
    good = df.where(positive_finite(F.col(x)) & positive_finite(F.col(ratio)))
    per = good.groupBy(*by, x).agg(F.count(F.lit(1)).alias("_n"), F.sum(1 / F.col(ratio)).alias("_s"))
    rows = carried(swept(per, by, [x]), {"n": ("sum", F.col("_n")), "_sum": ("sum", F.col("_s"))})
    return rows.select(*by, x, "n", (F.col("n") / F.col("_sum")).alias("hm"))


#: Marks of up to so many groups, a kilobyte each, are broadcast; more groups are joined by a shuffle.
BROADCAST_GROUPS = 10_000


def exact_quantiles(df: DataFrame, x: str, quantiles: dict[str, float], by: Sequence[str] = (), parts: int = 128) -> DataFrame:
    """(by..., one double column per name of `quantiles`): exact quantiles of x, interpolated between neighbours.

    Equal values combine first. Approximate quantiles cut a group's distinct values into about `parts` ranges, whose
    counts tell which ranges hold the wanted ranks; only those are sorted, so no task holds all values of a group.
    Nulls of x do not count; a group without values has no row.
    """
    key = F.struct(F.lit(0).alias("_one"), *by).alias("_k")
    values = df.select(key, F.col(x).cast("double").alias("_v")).where("_v is not null").groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_n"))
    cuts = F.percentile_approx("_v", [i / parts for i in range(1, parts)], 10 * parts)
    values = save(values, "values")
    marks = save(values.groupBy("_k").agg(F.sum("_n").alias("_total"), cuts.alias("_marks")), "marks")
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_GROUPS else marks  # few groups would be as many tasks
    ranged = values.join(marks, "_k").withColumn("_range", F.size(F.filter("_marks", lambda m: m < F.col("_v")))).drop("_marks")
    sums = ranged.groupBy("_k", "_range").agg(F.sum("_n").alias("_in"), F.max("_total").alias("_total"))
    upto = Window.partitionBy("_k").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_end", F.sum("_in").over(upto)).withColumn("_start", F.col("_end") - F.col("_in"))
    place = {name: (F.col("_total") - 1) * F.lit(float(q)) for name, q in quantiles.items()}
    holds = lambda rank: (F.col("_start") <= rank) & (rank < F.col("_end"))
    some = reduce(or_, [holds(end(p)) for p in place.values() for end in (F.floor, F.ceil)])
    near = ranged.join(sums.where(some).select("_k", "_range", F.col("_start").alias("_base")), ["_k", "_range"])
    within = Window.partitionBy("_k", "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_end", F.col("_base") + F.sum("_n").over(within)).withColumn("_start", F.col("_end") - F.col("_n"))
    at = lambda rank: F.max(F.when(holds(rank), F.col("_v")))
    ends = [at(end(p)).alias(f"_{side}_{name}") for name, p in place.items() for side, end in (("lo", F.floor), ("hi", F.ceil))]
    found = near.groupBy("_k").agg(F.max("_total").alias("_total"), *ends)

    def between(name: str) -> Column:
        lo, hi, p = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), place[name]
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (p - F.floor(p))).alias(name)

    return found.select(*[F.col(f"_k.{c}").alias(c) for c in by], *map(between, quantiles))


def log_grid(df: DataFrame, x: str, low: float, high: float, points: int) -> DataFrame:
    """`points` thresholds at equal distances of the logarithm between two quantiles of x: (i, threshold)."""
    ends = exact_quantiles(df.where(positive_finite(F.col(x))), x, {"lo": low, "hi": high})
    i = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    step = F.pow(F.col("hi") / F.col("lo"), F.col("i") / (points - 1))
    return ends.select("lo", "hi", i.alias("i")).select("i", (F.col("lo") * step).alias("threshold"))


def quantile_bins(df: DataFrame, x: str, bins: int) -> DataFrame:
    """df with `bin`: right-closed bins between the distinct quantiles of x, the lowest edge inside."""
    names = [f"q{i}" for i in range(bins + 1)]
    edges = exact_quantiles(df, x, {n: i / bins for i, n in enumerate(names)}).select(F.array_distinct(F.array(*names)).alias("_edges"))
    below = F.size(F.filter("_edges", lambda e: e < F.col(x)))
    return df.join(F.broadcast(edges), how="left").withColumn("bin", F.greatest(below - 1, F.lit(0))).drop("_edges")  # one row


def zero_filled_counts(df: DataFrame, bin_column: str, bins: int, by: list[str]) -> DataFrame:
    """Counts per group and bin 0..bins-1, empty bins included."""
    counts = df.where(F.col(bin_column).isNotNull()).groupBy(*by, bin_column).agg(F.count(F.lit(1)).alias("n"))
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    every = groups.withColumn(bin_column, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(counts, [*by, bin_column], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def last_value_first_place(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key as a dict keeps it: the last row's values in the first row's place (column `place`)."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"), F.min(order).alias("place"))
    return best.select(*keys, "_r.*", "place")


def unique_prefix(df: DataFrame, name: str, by: list[str]) -> DataFrame:
    """Rows whose name up to the first "[" occurs once in its group, under that prefix."""
    prefix = F.substring_index(name, "[", 1)
    once = df.withColumn("_p", prefix).groupBy(*by, "_p").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*df.columns)).alias("_r"))
    return once.where("_n = 1").select("_r.*", F.col("_p").alias("prefix"))


def merge_intervals(df: DataFrame, by: list[str], begin: str = "begin", end: str = "end") -> DataFrame:
    """Half-open intervals merged where they overlap or touch. A sweep by begin: an interval behind all ends so far begins
    an island; islands are numbered by a second pass over the same order."""
    rows = swept(df.where(F.col(end) > F.col(begin)).select(*by, begin, end), by, [begin, end])
    rows = carried(rows, {"_upto": ("max", F.col(end))}, behind=True)
    new = (F.col("_upto").isNull() | (F.col(begin) > F.col("_upto"))).cast("long")
    rows = carried(rows, {"_island": ("sum", new)})
    return rows.groupBy("_k", "_island").agg(*[F.first(c).alias(c) for c in by], F.min(begin).alias(begin), F.max(end).alias(end)).drop("_k", "_island")


def running_numbers(df: DataFrame, order: Column, chunk: Column, by: list[str]) -> DataFrame:
    """df with `rank`, 1-based in `order` within each group, worked out by chunks (a coarse function of the order).

    Two small windows in place of one over a whole group, so that a hot group is spread over tasks.
    """
    marked = df.withColumn("_chunk", chunk)
    sizes = marked.groupBy(*by, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*by, "_chunk", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy(*by, "_chunk").orderBy(order))
    return marked.withColumn("_r", within).join(bases, [*by, "_chunk"]).withColumn("rank", F.col("_r") + F.col("_base")).drop("_r", "_base", "_chunk")


def contiguous_chunks(df: DataFrame, order: Column, coarse: Column, n: int) -> DataFrame:
    """df with `chunk` 0..n-1, contiguous in order and nearly equal, the first ones one longer.

    coarse is a coarse monotone function of the order (see running_numbers); no window holds all rows.
    """
    total = df.count()
    size, longer = divmod(total, n)
    at = F.col("rank") - 1
    first = F.floor(at / (size + 1))
    chunk = first if not size else F.when(at < longer * (size + 1), first).otherwise(longer + F.floor((at - longer * (size + 1)) / size))
    return running_numbers(df, order, coarse, []).withColumn("chunk", chunk.cast("int")).drop("rank")


def stride_chunks(df: DataFrame, order: Column, coarse: Column, n: int) -> DataFrame:
    """df with `chunk`, dealt round-robin in order."""
    return running_numbers(df, order, coarse, []).withColumn("chunk", ((F.col("rank") - 1) % n).cast("int")).drop("rank")


def stratified_sample(df: DataFrame, strata: list[str], size: int, seed: int, id_col: str) -> DataFrame:
    """`size` distinct rows, weighted by the inverse size of their stratum, without replacement.

    Efraimidis and Spirakis: the smallest -ln(u) / weight win; u comes from a hash of seed and id, so reruns agree.
    """
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return df.join(sizes, strata).withColumn("_key", -F.ln(u) * F.col("_n")).orderBy("_key", id_col).limit(size).drop("_key", "_n")


def mutually_equal(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames hold the same rows, repeats included."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
