"""Joins: last-wins lookups, as-of joins, overlaps of lines, suffixes and ranges, reconciliation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.sweep import carried, swept


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the largest `order` for each key, by one grouped maximum."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("row"))
    return best.select(*keys, "row.*")


def lookup_left(left: DataFrame, right: DataFrame, keys: list[str], order: str) -> DataFrame:
    """left with the columns of the last matching row of right; rows without a match stay."""
    return left.join(last_wins(right, keys, order), keys, "left")


def asof(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    value: str,
    by: list[str],
    strict: bool = True,
    found: str = "value",
    bucket: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Each left row with `value` of the latest right row of its group before left_time (strictly, or at it too).

    Union and one window: both sides are sorted together once, whatever their sizes, and no pair is made. Of right
    rows at one time the largest value counts. Null times match nothing. A coarse monotone function of time as
    `bucket` cuts hot groups: a bucket is a window of its own, and what earlier buckets end with is carried over by a
    window over one row per bucket.
    """
    columns = left.columns
    cell = bucket(F.col("_t")) if bucket else F.lit(0)
    here = left.select(*by, F.col(left_time).alias("_t"), F.lit(0 if strict else 1).alias("_side"), F.struct(*columns).alias("_row"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    empty = F.lit(None).cast(here.schema["_row"].dataType)
    there = (
        right.where(F.col(right_time).isNotNull())
        .groupBy(*by, F.col(right_time).alias("_t"))
        .agg(F.max(value).alias("_v"))
        .select(*by, "_t", F.lit(1 if strict else 0).alias("_side"), empty.alias("_row"), "_v")
    )
    window = Window.partitionBy(*by, "_cell").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = here.unionByName(there).withColumn("_cell", cell).withColumn("_found", F.last("_v", ignorenulls=True).over(window))
    if bucket:
        ends = there.withColumn("_cell", cell).groupBy(*by, "_cell").agg(F.max_by("_v", "_t").alias("_end"))
        cells = both.select(*by, "_cell").distinct().join(ends, [*by, "_cell"], "left")
        earlier = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        carried = cells.select(*by, "_cell", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
        both = both.join(carried, [*by, "_cell"], "left").withColumn("_found", F.coalesce("_found", "_carried"))
    return both.where("_row is not null").select("_row.*", F.when(F.col("_t").isNotNull(), F.col("_found")).alias(found))


def asof_release(
    left: DataFrame,
    releases: DataFrame,
    left_time: str,
    time: str,
    version: str,
    by: list[str],
    pick: str = "date",
    fallback: str = "null",
    bucket: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """left with found_version: the version of a release strictly before left_time.

    pick "date": the release with the largest date; "version": the largest version as text among those before ("1.9"
    beats "1.10"). fallback "oldest": the version of the oldest release where none is before; else null. bucket as in
    asof(); the running maximum of "version" goes over the releases alone.
    """
    known = releases.where(F.col(time).isNotNull()).select(*by, time, version)
    for key in by:
        known = known.where(F.col(key).isNotNull())
    if pick == "version":
        upto = Window.partitionBy(*by).orderBy(time).rangeBetween(Window.unboundedPreceding, 0)
        known = known.withColumn(version, F.max(version).over(upto))
    rows = asof(left, known, left_time, time, version, by, found="found_version", bucket=bucket)
    if fallback == "oldest":
        oldest = known.groupBy(*by).agg(F.min_by(version, F.struct(time, version)).alias("_oldest"))
        rows = rows.join(oldest, by, "left").withColumn("found_version", F.coalesce("found_version", "_oldest")).drop("_oldest")
    return rows


def line_overlap(diff_lines: DataFrame, covered: DataFrame) -> DataFrame:
    """Covering tests: tests that run a modified line. diff_lines (instance_id, file, line); covered (instance_id, test, file, line).

    Leading dots and slashes of paths are stripped as characters, so ".github/x" is "github/x" on both sides.
    """
    clean = lambda c: F.regexp_replace(c, r"^[./]+", "")
    a = diff_lines.select("instance_id", clean("file").alias("file"), "line").distinct()
    b = covered.select("instance_id", "test", clean("file").alias("file"), "line")
    return b.join(a, ["instance_id", "file", "line"], "left_semi").select("instance_id", "test").distinct()


def suffix_matches(absolute: DataFrame, relative: DataFrame) -> DataFrame:
    """(path, rel) where path is rel or ends with "/" + rel; of several the first rel in text order.

    An equi-join on every suffix of the path (as many as it has parts) in place of comparing all pairs.
    """
    parts = F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))
    return (
        absolute.select("path", F.explode(suffixes).alias("rel"))
        .join(relative.select("rel").distinct(), "rel", "left_semi")
        .groupBy("path")
        .agg(F.min("rel").alias("rel"))
    )


def covering_ranges(outer: DataFrame, inner: DataFrame, by: list[str]) -> DataFrame:
    """Distinct ranges of inner (by..., begin, end) that one range of outer holds whole; ends are exclusive, empty outer ranges hold nothing.

    A sweep by begin: a range is held if, of the outer ranges that begin no later, the largest end is no smaller. Every
    range is one row, however long it is.
    """
    a = outer.where("end > begin").select(*by, "begin", "end", F.lit(0).alias("_inner"))
    b = inner.select(*by, "begin", "end", F.lit(1).alias("_inner"))
    rows = swept(a.unionByName(b), by, ["begin", "_inner"])
    rows = carried(rows, {"_reach": ("max", F.when(F.col("_inner") == 0, F.col("end")))})
    return rows.where("_inner = 1 and _reach >= end").select(*by, "begin", "end").distinct()


def update_non_null(left: DataFrame, right: DataFrame, keys: list[str], order: str) -> DataFrame:
    """left with the non-null values of the first matching right row (by order) in place of its own."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    first = right.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c).alias(f"_{c}") for c in shared]), order).alias("_new")).select(*keys, "_new.*")
    rows = left.join(first, keys, "left")
    return rows.select(*[F.coalesce(f"_{c}", c).alias(c) if c in shared else F.col(c) for c in left.columns])


def full_delta(a: DataFrame, b: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """b - a of each value over the keys of either side, missing ones zero."""
    x = a.select(*keys, *[F.col(v).alias(f"_a_{v}") for v in values])
    y = b.select(*keys, *[F.col(v).alias(f"_b_{v}") for v in values])
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return x.join(y, keys, "full").select(*keys, *[(zero(f"_b_{v}") - zero(f"_a_{v}")).alias(f"delta_{v}") for v in values])


def require_known(ids: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """ids, or an error that names some which `known` lacks."""
    missing = [r[0] for r in ids.select(key).join(known.select(key), key, "left_anti").limit(5).collect()]
    if missing:
        raise ValueError(f"unknown {key}: {missing}")
    return ids


def reconcile(instances: DataFrame, predictions: DataFrame, completed: DataFrame) -> DataFrame:
    """Instances to run: those with a prediction whose patch is not blank, not completed yet."""
    wanted = predictions.where(F.length(F.regexp_replace(F.coalesce("model_patch", F.lit("")), r"\s", "")) > 0)
    return instances.join(wanted.select("instance_id"), "instance_id", "left_semi").join(completed.select("instance_id"), "instance_id", "left_anti")


def share_work(rows: DataFrame, keys: list[str], compute, keep_keyless: bool = True) -> DataFrame:
    """rows with what compute(distinct keys) finds, worked out once a key; keys that it does not return are dropped.

    Rows with a null key pass through, the new columns null.
    """
    has = F.lit(True)
    for k in keys:
        has = has & F.col(k).isNotNull()
    found = compute(rows.where(has).select(*keys).distinct())
    out = rows.where(has).join(found, keys)
    return out.unionByName(rows.where(~has), allowMissingColumns=True) if keep_keyless else out


def comments_before(items: DataFrame, comments: DataFrame, key: str, cutoff: str, time: str, text: str, place: str | None = None) -> DataFrame:
    """Texts of the comments of each item before its cutoff, in the order of `place` (time and text if none is given),
    stopping at the first that is not before. Where that is, is a grouped minimum; comments without a time are left out."""
    order = F.struct(place) if place else F.struct(time, text)
    rows = comments.join(items.select(key, cutoff), key).where(F.col(time).isNotNull() & F.col(cutoff).isNotNull()).withColumn("_o", order)
    late = F.col(time) >= F.col(cutoff)
    ends = rows.where(late).groupBy(key).agg(F.min("_o").alias("_end"))
    kept = rows.where(~late).join(ends, key, "left").where("_end is null or _o < _end")
    texts = kept.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_o", F.col(text).alias("_t")))).alias("_c"))
    return items.join(texts, key, "left").withColumn("hints", F.array_join(F.transform("_c", lambda c: c["_t"]), "\n")).drop("_c")
