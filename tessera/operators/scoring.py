"""Scores of a prediction run against a gold run: per instance, and as one breakdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.diffs import modified_lines
from tessera.functions.perf import harmonic_mean, speedup_ratio
from tessera.functions.text import is_blank

JSON_LIST = "array<string>"


def test_list(column: Column) -> Column:
    """A list that came as a JSON text; what cannot be read is empty."""
    return F.coalesce(F.from_json(column, JSON_LIST), F.expr("cast(array() as array<string>)"))


def evaluate(instances: DataFrame, gold: DataFrame, pred: DataFrame, statuses: DataFrame) -> DataFrame:
    """One report row per instance.

    instances (instance_id, patch, pass_to_pass array); gold (instance_id, before_mean, after_mean); pred the same and
    patch_text; statuses (instance_id, test, status), its instances being those with correctness output.

    A missing run counts as ratio 1. Without tests to pass an instance is correct by default and unverifiable; without
    correctness output it is wrong and its ratio 1; else the share of distinct tests whose status contains PASS, over
    the length of the list, repeats included. A complete share with figures is VERIFIED whatever other flags there are.
    """
    runs = gold.select("instance_id", F.col("before_mean").alias("gb"), F.col("after_mean").alias("ga"))
    wanted = pred.select("instance_id", F.col("before_mean").alias("pb"), F.col("after_mean").alias("pa"), "patch_text")
    passed = (
        instances.select("instance_id", F.explode("pass_to_pass").alias("test"))
        .join(statuses.select("instance_id", "test", "status"), ["instance_id", "test"])
        .where(F.col("status").contains("PASS"))
        .groupBy("instance_id")
        .agg(F.countDistinct("test").alias("passed"))
    )
    ran = statuses.select("instance_id").distinct().withColumn("ran", F.lit(True))
    rows = instances.join(runs, "instance_id", "left").join(wanted, "instance_id", "left").join(passed, "instance_id", "left").join(ran, "instance_id", "left")
    has_perf = F.col("pb").isNotNull()
    raw, gold_ratio = speedup_ratio(F.col("pb"), F.col("pa")), speedup_ratio(F.col("gb"), F.col("ga"))
    size = F.size("pass_to_pass")
    no_tests, no_output = size == 0, F.col("ran").isNull()
    pct = F.when(no_tests, 1.0).when(no_output, 0.0).otherwise(F.coalesce("passed", F.lit(0)) / F.greatest(size, F.lit(1)))
    ratio = F.when(no_tests, raw).when(no_output | (F.col("pct") != 1), 1.0).otherwise(raw)
    corrupt = is_blank(F.col("patch_text")) | F.lower("patch_text").contains("error:")
    flags = F.array(
        F.when(~has_perf, F.when(F.col("patch_text").isNotNull() & corrupt, "CORRUPT_PATCH").otherwise("NO_PERF_DATA")),
        F.when(gold_ratio < 1, "GOLD_SLOWDOWN"),
        F.when(no_tests, "UNVERIFIABLE_CORRECTNESS").when(no_output, "NO_CORRECTNESS_DATA"),
    )
    joined = F.array_join(F.filter(flags, lambda f: f.isNotNull()), "|")
    quality = F.when(~no_tests & ~no_output & (((F.col("pct") == 1) & has_perf) | (joined == "")), "VERIFIED").otherwise(joined)
    rows = rows.withColumn("pct", pct)
    return rows.select(
        "instance_id",
        raw.alias("raw_pred_speedup_ratio"),
        ratio.alias("pred_speedup_ratio"),
        gold_ratio.alias("gold_speedup_ratio"),
        F.when(gold_ratio != 0, ratio / gold_ratio).otherwise(0.0).alias("human_speedup_ratio"),
        (F.col("pct") == 1).cast("double").alias("correctness"),
        F.col("pct").alias("correctness_pct"),
        F.coalesce("gb", F.lit(0.0)).alias("pre_edit_runtime"),
        modified_lines(F.col("patch")).alias("patch_length"),
        has_perf.alias("has_pred_perf"),
        quality.alias("data_quality"),
    )


def breakdown(report: DataFrame, *by: str) -> DataFrame:
    """Score and proportions over report rows, for each group of `by` (one row over all without).

    Rows without figures of the prediction are left out of the score and the four categories, and told as a proportion
    of their own, so that the five sum to one. Zero rows give zeros. The floor of the harmonic mean is 0.001.
    """
    has = F.col("has_pred_perf")
    n, used = F.count(F.lit(1)), F.count_if(has)
    right, fast, human = F.col("correctness") == 1, F.col("raw_pred_speedup_ratio") >= 1, F.col("human_speedup_ratio") >= 1
    share = lambda condition: F.round(F.coalesce(F.try_divide(F.count_if(condition), n), F.lit(0.0)), 4)
    clean = F.nanvl("human_speedup_ratio", F.lit(None).cast("double"))
    score = F.coalesce(F.try_divide(used, F.sum(F.when(has & clean.isNotNull(), 1 / F.greatest(clean, F.lit(0.001))))), F.lit(0.0))
    quality = lambda word: F.coalesce(F.col("data_quality").contains(word), F.lit(False))
    doubtful = quality("UNVERIFIABLE") | quality("PERF_ONLY") | quality("NO_PERF") | quality("CORRUPT")
    out = report.groupBy(*by).agg(
        n.alias("total_instances"),
        used.alias("effective_n"),
        (n - used).alias("instances_excluded"),
        F.round(score, 4).alias("overall_score"),
        share(has & (F.col("correctness") < 1)).alias("proportion_incorrect"),
        share(has & right & ~fast).alias("proportion_correct_but_no_speedup"),
        share(has & right & fast & ~human).alias("proportion_correct_with_speedup_but_human_no_speedup"),
        share(has & right & fast & human).alias("proportion_human_speedup_or_better"),
        share(~has).alias("proportion_excluded"),
        F.count_if(right & ~doubtful).alias("correctness_verified_count"),
        F.count_if(quality("UNVERIFIABLE")).alias("correctness_unverifiable_count"),
        F.count_if(F.col("gold_speedup_ratio") < 1).alias("gold_slowdowns"),
    )
    caveats = F.array(
        F.when(F.col("instances_excluded") > 0, F.concat(F.col("instances_excluded").cast("string"), F.lit(" without figures, left out of the score"))),
        F.when(F.col("correctness_unverifiable_count") > 0, F.concat(F.col("correctness_unverifiable_count").cast("string"), F.lit(" without tests to pass, correct by default"))),
        F.when(F.col("gold_slowdowns") > 0, F.concat(F.col("gold_slowdowns").cast("string"), F.lit(" where the expert's change is a slowdown"))),
    )
    return out.withColumn("caveats", F.filter(caveats, lambda c: c.isNotNull()))


def older_breakdown(report: DataFrame, *by: str) -> DataFrame:
    """The older proportions: no row is left out, and the last category does not ask for correctness."""
    n = F.count(F.lit(1))
    right = F.col("correctness") == 1
    fast, human = F.col("pred_speedup_ratio") > 1, F.col("human_speedup_ratio") >= 1
    share = lambda condition: F.round(F.try_divide(F.count_if(condition), n), 4)
    return report.groupBy(*by).agg(
        share(~right).alias("incorrect"),
        share(right & ~fast).alias("no_speedup"),
        share(right & fast & ~human).alias("below_human"),
        share(human).alias("human_or_better"),
        F.round(harmonic_mean(F.col("human_speedup_ratio")), 4).alias("score"),
    )


def grade(instances: DataFrame, statuses: DataFrame) -> DataFrame:
    """Test lists of each instance split into successes and failures, with shares and a resolution.

    instances (instance_id, language, fail_to_pass array, pass_to_pass array); statuses (instance_id, test, status).
    PASSED and XFAIL succeed, FAILED, ERROR and missing ones fail, SKIPPED is neither. An empty list has share 1.
    Without any test Python counts as FULL, the other languages as NO.
    """
    long = instances.select("instance_id", F.explode("fail_to_pass").alias("test"), F.lit("f2p").alias("kind")).unionByName(
        instances.select("instance_id", F.explode("pass_to_pass").alias("test"), F.lit("p2p").alias("kind"))
    )
    good, bad = F.col("status").isin("PASSED", "XFAIL"), F.col("status").isNull() | F.col("status").isin("FAILED", "ERROR")
    lists = (
        long.join(statuses.select("instance_id", "test", "status"), ["instance_id", "test"], "left")
        .groupBy("instance_id")
        .agg(
            *[
                F.sort_array(F.collect_list(F.when((F.col("kind") == kind) & ok, F.col("test")))).alias(f"{kind}_{name}")
                for kind in ("f2p", "p2p")
                for name, ok in (("success", good), ("failure", bad))
            ]
        )
    )
    none = F.expr("cast(array() as array<string>)")
    rows = instances.select("instance_id", "language", "fail_to_pass", "pass_to_pass").join(lists, "instance_id", "left")
    for kind in ("f2p", "p2p"):
        for name in ("success", "failure"):
            rows = rows.withColumn(f"{kind}_{name}", F.coalesce(f"{kind}_{name}", none))
        total = F.size(f"{kind}_success") + F.size(f"{kind}_failure")
        rows = rows.withColumn(kind, F.when(total == 0, 1.0).otherwise(F.try_divide(F.size(f"{kind}_success"), total)))
    empty = (F.size("fail_to_pass") == 0) & (F.size("pass_to_pass") == 0)
    status = (
        F.when(empty & (F.col("language") != "python"), "NO")
        .when((F.col("f2p") == 1) & (F.col("p2p") == 1), "FULL")
        .when((F.col("f2p") > 0) & (F.col("f2p") < 1) & (F.col("p2p") == 1), "PARTIAL")
        .otherwise("NO")
    )
    return rows.select("instance_id", "f2p_success", "f2p_failure", "p2p_success", "p2p_failure", "f2p", "p2p", status.alias("resolution"))


def cross_classify(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tests of (instance_id, test, status) before and after an edit: P2P, P2F, F2P or F2F; missing counts as failed."""
    passed = lambda c: F.coalesce(F.col(c).isin("PASSED", "XFAIL"), F.lit(False))
    both = before.select("instance_id", "test", F.col("status").alias("was")).join(
        after.select("instance_id", "test", F.col("status").alias("now")), ["instance_id", "test"], "full"
    )
    kind = F.concat(F.when(passed("was"), "P").otherwise("F"), F.lit("2"), F.when(passed("now"), "P").otherwise("F"))
    return both.select("instance_id", "test", kind.alias("kind"))


def validation_result(statuses: DataFrame) -> DataFrame:
    """Per instance the numbers of passed and failed tests; resolved with no failure and a pass at least."""
    good = F.count_if(F.col("status").isin("PASSED", "XFAIL"))
    bad = F.count_if(F.col("status").isin("FAILED", "ERROR"))
    return statuses.groupBy("instance_id").agg(good.alias("passed"), bad.alias("failed"), ((bad == 0) & (good > 0)).alias("resolved"))


def benchmark_stats(rows: DataFrame, name: str = "name", aggregate: str = "aggregate_name", value: str = "value", position: str = "position") -> DataFrame:
    """Mean and sample deviation of each benchmark: its own aggregate rows where it has them, else its runs (one run: 0)."""
    pick = lambda kind: F.min_by(value, F.when(F.col(aggregate) == kind, F.col(position)))
    raw = F.when(F.col(aggregate).isNull(), F.col(value))
    given = lambda kind: F.when(F.count_if(F.col(aggregate) == kind) > 0, pick(kind))
    return rows.groupBy(name).agg(
        F.coalesce(given("mean"), F.avg(raw)).alias("mean"),
        F.coalesce(given("stddev"), F.stddev_samp(raw), F.lit(0.0)).alias("sd"),
    )
