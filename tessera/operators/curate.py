"""Building and checking the dataset: projections, filters with reasons, validation, coverage, profiles of sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.diffs import all_code_free, any_test_file, edits, is_non_code_only, modified_files, touches_tests
from tessera.functions.text import instance_id, is_blank, mentions_performance, performance_pull
from tessera.operators.sweep import carried, plain, swept


def build_instances(pulls: DataFrame, language: str = "python") -> DataFrame:
    """Task instances of pulls (repo, number, title, body, base_sha, merged_at, patch, test_patch, issue_text).

    Python keeps merged pulls with a patch ('' and null have none) and takes the issues as the problem; the other
    languages keep those with repository, base commit and number, and take title and body.
    """
    merged = F.col("merged_at").isNotNull()
    if language == "python":
        keep, problem = merged & (F.coalesce("patch", F.lit("")) != ""), F.coalesce("issue_text", F.lit(""))
    else:
        keep = (F.coalesce("repo", F.lit("")) != "") & (F.coalesce("base_sha", F.lit("")) != "") & F.col("number").isNotNull()
        problem = F.concat(F.coalesce("title", F.lit("")), F.lit("\n\n"), F.coalesce("body", F.lit("")))
    return pulls.where(keep).select(
        "repo",
        F.col("number").alias("pull_number"),
        instance_id(F.col("repo"), F.col("number")).alias("instance_id"),
        F.col("base_sha").alias("base_commit"),
        "patch",
        "test_patch",
        problem.alias("problem_statement"),
        F.lit(language).alias("language"),
    )


def stage_filter(instances: DataFrame) -> DataFrame:
    """Adds passed and reason: the first rule that rejects, in this order.

    instances (instance_id, patch, title, body, labels array, problem_statement, found: whether the pull was found).
    """
    files = F.transform(edits(F.col("patch")), lambda e: F.struct(e["source"].alias("source"), e["dest"].alias("dest")))
    instances = instances.withColumn("_files", files)  # parsed once, contents left behind
    reason = (
        F.when(any_test_file(F.col("_files")), "modifies_tests")
        .when(all_code_free(F.col("_files")), "non_code_only")
        .when(~(F.col("found") & performance_pull(F.col("title"), F.col("body"), F.col("labels"))) & ~mentions_performance(F.col("problem_statement")), "not_performance")
    )
    return instances.withColumn("reason", F.coalesce(reason, F.lit("passed"))).withColumn("passed", F.col("reason") == "passed").drop("_files")


REASONS = ["passed", "modifies_tests", "non_code_only", "not_performance"]


def reason_counts(filtered: DataFrame, reasons: list[str] = REASONS) -> DataFrame:
    """Counts by reason, zero for those that do not occur."""
    every = filtered.sparkSession.createDataFrame([(r,) for r in reasons], "reason string")
    counts = filtered.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return every.join(counts, "reason", "left").select("reason", F.coalesce("n", F.lit(0)).alias("n"))


def validation(df: DataFrame, required: list[str], id_col: str, repo_col: str, sha_col: str, patch_col: str, workload_col: str) -> DataFrame:
    """Adds errors, an array of what is wrong with each record."""
    empty = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")).when(is_blank(F.col(c).cast("string")), F.lit(f"empty {c}")) for c in required]
    there = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    form = [
        F.when(there(id_col) & ~F.col(id_col).rlike(r"^\w[\w.-]*-\d+$"), F.lit("bad id")),
        F.when(there(repo_col) & ~F.col(repo_col).rlike(r"^[\w.-]+/[\w.-]+$"), F.lit("bad repo")),
        F.when(there(sha_col) & ~F.lower(sha_col).rlike(r"^[0-9a-f]{40}$"), F.lit("bad commit")),
        F.when(there(patch_col) & ~F.lower(patch_col).contains("diff"), F.lit("no diff")),
        F.when(there(workload_col) & ~F.col(workload_col).contains("def ") & ~F.col(workload_col).contains("import "), F.lit("no code")),
    ]
    return df.withColumn("errors", F.filter(F.array(*empty, *form), lambda e: e.isNotNull()))


def duplicate_errors(df: DataFrame, key: str) -> DataFrame:
    """Ids that occur n > 1 times, with their n - 1 errors."""
    return df.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("errors")).where("errors > 0")


def buildable(df: DataFrame, needed: list[str]) -> DataFrame:
    """Adds build_reason: the first needed field that is blank, or null if the spec can be built."""
    reason = F.coalesce(*[F.when(is_blank(F.col(c).cast("string")), F.lit(f"no {c}")) for c in needed])
    return df.withColumn("build_reason", reason)


def fill_missing(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Columns that are absent get their default; a null in a column that is there stays null."""
    return df.withColumns({c: d for c, d in defaults.items() if c not in df.columns})


def repo_filter(repos: DataFrame, min_pulls: int, min_density: float) -> DataFrame:
    """Adds reason: the first rule a repository (merged_prs, installable, has_tests, perf_prs) fails."""
    density = F.coalesce(F.try_divide(F.col("perf_prs"), F.col("merged_prs")), F.lit(0.0))
    return repos.withColumn("density", density).withColumn(
        "reason",
        F.when(F.col("merged_prs") < min_pulls, "few_pulls")
        .when(~F.col("installable"), "not_installable")
        .when(~F.col("has_tests"), "no_tests")
        .when(F.col("density") < min_density, "low_density")
        .otherwise("kept"),
    )


def star_bands(stars: Column, base: int) -> Column:
    """0-based band at base times 1, 2, 4, 8, 20, 50 and 150; null below."""
    edges = [base * f for f in (1, 2, 4, 8, 20, 50, 150)]
    return F.when(stars >= edges[0], sum((F.when(stars >= e, 1).otherwise(0) for e in edges), F.lit(-1)))


def incremental_pulls(pulls: DataFrame, seen: DataFrame, cutoff: str, limit: int) -> DataFrame:
    """The latest `limit` pulls that are new, created on or after the cutoff."""
    fresh = pulls.where(F.col("created_at") >= cutoff).join(seen.select("number"), "number", "left_anti")
    return fresh.orderBy(F.col("created_at").desc(), F.col("number").desc()).limit(limit)


def file_agreement(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Adds precision, recall, f1 and jaccard of two arrays of files (0 where there is nothing to divide by)."""
    hit = F.size(F.array_intersect(gold, pred))
    a, b = F.size(F.array_distinct(gold)), F.size(F.array_distinct(pred))
    either = F.size(F.array_union(gold, pred))
    ratio = lambda x, y: F.coalesce(F.try_divide(x, y), F.lit(0.0))
    return df.withColumns({"hit": hit, "either": either, "precision": ratio(hit, b), "recall": ratio(hit, a), "f1": ratio(2 * hit, a + b), "jaccard": ratio(hit, either)})


def agreement_summary(df: DataFrame, evaluated: str) -> DataFrame:
    """Macro means over all rows, those not evaluated counting zero; the hit rate over evaluated ones; micro jaccard."""
    n, used = F.count(F.lit(1)), F.count_if(F.col(evaluated))
    macro = lambda c: F.sum(F.when(F.col(evaluated), F.col(c)).otherwise(0.0)) / n
    hits = F.count_if(F.col(evaluated) & (F.col("hit") > 0))
    micro = F.try_divide(F.sum(F.when(F.col(evaluated), F.col("hit"))), F.sum(F.when(F.col(evaluated), F.col("either"))))
    return df.agg(*[macro(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1", "jaccard")], F.try_divide(hits, used).alias("hit_rate"), micro.alias("micro_jaccard"))


def extension_counts(df: DataFrame, patch: str) -> DataFrame:
    files = df.select(F.explode(modified_files(F.col(patch))).alias("file"))
    return files.groupBy(F.lower(F.regexp_extract("file", r"\.([^./]+)$", 1)).alias("extension")).agg(F.count(F.lit(1)).alias("n"))


def keyword_counts(df: DataFrame, keywords: list[str], fields: list[str]) -> DataFrame:
    """Rows that contain each keyword in any field, case apart; zero counts included. One pass, one aggregate a keyword."""
    text = F.lower(F.concat_ws("\n", *fields))
    sums = df.select(text.alias("t")).agg(*[F.count_if(F.col("t").contains(k.lower())).alias(f"k{i}") for i, k in enumerate(keywords)])
    pairs = F.array(*[F.struct(F.lit(k).alias("keyword"), F.col(f"k{i}").alias("n")) for i, k in enumerate(keywords)])
    return sums.select(F.explode(pairs).alias("p")).select("p.*")


def running_cost(df: DataFrame, order: list[str], cost: str, cap: float, by: list[str]) -> DataFrame:
    """Adds spent (with this row) and allowed: rows up to and with the first that passes the cap. A sweep in order."""
    rows = carried(swept(df, by, order), {"spent": ("sum", F.col(cost))})
    return plain(rows).withColumn("allowed", F.col("spent") - F.col(cost) <= cap)


def run_report(instances: DataFrame, predictions: DataFrame, reports: DataFrame) -> DataFrame:
    """Counts by outcome: submitted, empty patch, completed, resolved, unresolved, error, and not submitted."""
    rows = instances.select("instance_id").join(predictions.select("instance_id", "model_patch"), "instance_id", "left").join(reports.select("instance_id", "resolved"), "instance_id", "left")
    status = (
        F.when(F.col("model_patch").isNull(), "incomplete")
        .when(F.col("model_patch") == "", "empty_patch")
        .when(F.col("resolved").isNull(), "error")
        .when(F.col("resolved"), "resolved")
        .otherwise("unresolved")
    )
    return rows.groupBy(status.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
