"""Flaky tests: unanimity over runs, or the share of the commonest status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outcomes(runs: DataFrame) -> DataFrame:
    """Per test of an instance: number of runs of the instance, runs with the test, distinct statuses.

    runs (instance_id, run, test, status), one status for each; a run without any test is no run.
    """
    per_instance = runs.groupBy("instance_id").agg(F.countDistinct("run").alias("n_runs"))
    per_test = runs.groupBy("instance_id", "test").agg(F.count(F.lit(1)).alias("seen"), F.size(F.collect_set("status")).cast("long").alias("kinds"))
    return per_test.join(per_instance, "instance_id")


def unanimous(runs: DataFrame) -> DataFrame:
    """Adds stable: one status in all of the instance's runs, missing in none."""
    return outcomes(runs).withColumn("stable", (F.col("kinds") == 1) & (F.col("seen") == F.col("n_runs")))


def deflake(instances: DataFrame, runs: DataFrame, min_runs: int = 3) -> DataFrame:
    """instances (instance_id, covering_tests) without flaky tests; adds `status`.

    "kept as is" without covering tests or with fewer than min_runs runs; "filtered" without its flaky tests; an
    instance that is left without tests goes. A covering test that no run has is not flaky and stays.
    """
    marks = unanimous(runs)
    flaky = marks.where("not stable").groupBy("instance_id").agg(F.collect_set("test").alias("flaky"))
    counted = marks.groupBy("instance_id").agg(F.max("n_runs").alias("n_runs"))
    rows = instances.join(counted, "instance_id", "left").join(flaky, "instance_id", "left")
    as_is = (F.size("covering_tests") <= 0) | F.col("covering_tests").isNull() | (F.coalesce("n_runs", F.lit(0)) < min_runs)
    left = F.array_except("covering_tests", F.coalesce("flaky", F.expr("cast(array() as array<string>)")))
    return (
        rows.withColumn("status", F.when(as_is, "kept as is").otherwise("filtered"))
        .withColumn("covering_tests", F.when(as_is, F.col("covering_tests")).otherwise(left))
        .where("status = 'kept as is' or size(covering_tests) > 0")
        .select("instance_id", "covering_tests", "status")
    )


def modal(runs: DataFrame, n_runs: int, min_consistency: float = 1.0) -> DataFrame:
    """Per test the commonest status over all n_runs runs (missing ones count as MISSING) and whether it is stable.

    Stable if the status is not MISSING and has min_consistency of the runs; of equal counts the one seen first wins.
    """
    counted = runs.groupBy("instance_id", "test", "status").agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("first"))
    seen = counted.groupBy("instance_id", "test").agg(F.sum("n").alias("seen"))
    absent = seen.where(F.col("seen") < n_runs).select(
        "instance_id", "test", F.lit("MISSING").alias("status"), (F.lit(n_runs) - F.col("seen")).alias("n"), F.lit(n_runs).alias("first")
    )
    best = counted.unionByName(absent).groupBy("instance_id", "test").agg(F.max(F.struct("n", (-F.col("first")).alias("early"), "status")).alias("b"))
    return best.select(
        "instance_id",
        "test",
        F.col("b.status").alias("status"),
        F.col("b.n").alias("n"),
        ((F.col("b.status") != "MISSING") & (F.col("b.n") / n_runs >= min_consistency)).alias("stable"),
    )
