"""Filters of pulls as a table: a repository's rules are rows, so a rule is added without a change of code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import NEGATIVE_TITLES
from tessera.operators.specs import REPO_RULES

#: A rule: of one repository, or of all that have none of their own (null). accept false: a hit turns the pull down.
RULE = "repo string, field string, operator string, words array<string>, accept boolean"
FIELDS = ("title", "body", "labels")
OPERATORS = ("contains", "equals", "starts", "matches")


def known_rules(spark: SparkSession) -> DataFrame:
    """The rules of the repositories with conventions of their own, as rows."""
    rows = []
    for repo, (labels, titles) in REPO_RULES.items():
        rows += [(repo, "title", "contains", NEGATIVE_TITLES, False), (repo, "labels", "contains", labels, True), (repo, "title", "contains", titles, True)]
    return spark.createDataFrame(rows, RULE)


def _says(value: Column, rule: Column) -> Column:
    """Whether a text meets one of a rule's words, case apart (patterns as they are)."""
    low = F.lower(value)

    def one(word: Column) -> Column:
        w = F.lower(word)
        return (
            F.when(rule["operator"] == "contains", F.contains(low, w))
            .when(rule["operator"] == "equals", low == w)
            .when(rule["operator"] == "starts", F.startswith(low, w))
            .otherwise(F.regexp_like(value, word))
        )

    return F.exists(rule["words"], one)


def apply_rules(pulls: DataFrame, rules: DataFrame, repo: str = "repo", otherwise: Column | None = None) -> DataFrame:
    """pulls (repo, title, body, labels array) with `passes` and `by`: the number of the repository's rules that decided.

    A pull passes if a rule with accept is met and none without it. Repositories are compared in lower case, by their
    names or by what stands behind the slash, the whole name first; those without rules take the rules of null, and where
    there are none of those `otherwise` (false). Null fields and words meet nothing. Unknown fields and operators raise.
    Rules are settings, some per repository: each repository's are gathered into one row, and that table is joined.
    """
    known = F.col("field").isin(*FIELDS) & F.col("operator").isin(*OPERATORS)
    sound = F.when(known, F.struct("field", "operator", F.filter("words", lambda w: w.isNotNull()).alias("words"), F.coalesce("accept", F.lit(True)).alias("accept"))).otherwise(
        F.raise_error(F.concat(F.lit("no rule on "), F.coalesce("field", F.lit("null")), F.lit(" by "), F.coalesce("operator", F.lit("null"))))
    )
    of = rules.groupBy(F.lower("repo").alias("_repo")).agg(F.sort_array(F.collect_list(sound)).alias("_rules"))
    own = of.where("_repo is not null")
    general = of.where("_repo is null").select(F.col("_rules").alias("_general"))
    full = F.lower(F.col(repo))
    rows = pulls.withColumn("_full", full).withColumn("_short", F.substring_index("_full", "/", -1))
    rows = rows.join(own.select(F.col("_repo").alias("_full"), F.col("_rules").alias("_a")), "_full", "left")
    rows = rows.join(own.select(F.col("_repo").alias("_short"), F.col("_rules").alias("_b")), "_short", "left")
    rows = rows.join(F.broadcast(general), how="left")  # one row
    rows = rows.withColumn("_rules", F.coalesce("_a", "_b", "_general"))

    def met(rule: Column) -> Column:
        on_labels = F.exists(F.coalesce("labels", F.array().cast("array<string>")), lambda label: _says(label, rule))
        text = F.when(rule["field"] == "title", F.col("title")).otherwise(F.col("body"))
        return F.coalesce(F.when(rule["field"] == "labels", on_labels).otherwise(_says(text, rule)), F.lit(False))

    hits = F.filter("_rules", met)
    passes = F.exists("_hits", lambda r: r["accept"]) & F.forall("_hits", lambda r: r["accept"])
    rows = rows.withColumn("_hits", hits)
    fallback = F.coalesce(otherwise, F.lit(False)) if otherwise is not None else F.lit(False)
    rows = rows.withColumn("passes", F.when(F.col("_rules").isNull(), fallback).otherwise(passes)).withColumn("by", F.coalesce(F.size("_hits"), F.lit(0)))
    return rows.withColumn("by", F.greatest("by", F.lit(0))).select(*pulls.columns, "passes", "by")


def first_of_union(parts: list[DataFrame], key: str, order: list[str], n: int) -> DataFrame:
    """The first n rows of parts one behind the other, each part by `order`; of rows with one key that of the first part
    counts. The n rows are picked by one bounded sort, of which each task keeps n."""
    rows = parts[0].withColumn("_part", F.lit(0))
    for i, part in enumerate(parts[1:], 1):
        rows = rows.unionByName(part.withColumn("_part", F.lit(i)), allowMissingColumns=True)
    rest = [c for c in rows.columns if c not in (key, "_part", *order)]
    once = rows.groupBy(key).agg(F.min(F.struct("_part", *[c for c in order if c != key], *rest)).alias("_r"))
    columns = [c for c in rows.columns if c != "_part"]
    picked = once.select(key, "_r.*").orderBy("_part", *order, key).limit(n)
    return picked.select(*columns)
