"""Writers of the pipeline's files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.option("ignoreNullFields", "false").json(path)


def write_report(report: DataFrame, summary: DataFrame, path: str) -> None:
    """CSV rows and a JSON summary side by side."""
    report.write.option("header", True).csv(f"{path}/report.csv")
    summary.write.option("ignoreNullFields", "false").json(f"{path}/summary.json")


def append_new(df: DataFrame, path: str, key: str, schema: str) -> DataFrame:
    """Appends the rows whose key the target does not hold yet, and returns them: safe to run again."""
    spark = df.sparkSession
    try:
        done = spark.read.schema(schema).json(path).select(key)
        fresh = df.join(done, key, "left_anti")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        fresh = df
    fresh.write.mode("append").option("ignoreNullFields", "false").json(path)
    return fresh


def write_both(df: DataFrame, condition, path: str) -> None:
    """All rows under `<path>.all` and those that meet the condition under `path`."""
    write_jsonl(df, f"{path}.all")
    write_jsonl(df.sparkSession.read.schema(df.schema).json(f"{path}.all").where(condition), path)


def dead_letters(df: DataFrame, reason, path: str) -> DataFrame:
    """Appends rows with a reason to a quarantine and returns the others."""
    marked = df.withColumn("reason", reason)
    marked.where("reason is not null").write.mode("append").json(path)
    return marked.where("reason is null").drop("reason")


def repo_lines(repos: DataFrame, style: str = "simple") -> DataFrame:
    """Lines (value) of a repository list: simple (by name) or ranked (by estimated pulls, with the figures as a comment)."""
    if style == "simple":
        return repos.orderBy("repo").select(F.col("repo").alias("value"))
    text = F.format_string("%s  # stars=%d est_perf_prs=%d", "repo", "stars", "est_perf_prs")
    return repos.orderBy(F.col("est_perf_prs").desc(), "repo").select(text.alias("value"))


def upsert(rows: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows and new ones, the latest of each key."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.unionByName(new).groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return best.select(*keys, "_r.*")


def split_by(df: DataFrame, column: str, path: str) -> None:
    """A directory for each value."""
    df.repartition(column).write.partitionBy(column).json(path)


def concat_checked(parts: list[DataFrame]) -> DataFrame:
    """The union of parts; raises if its count is not the sum of theirs."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    counts = sum(p.count() for p in parts)
    if out.count() != counts:
        raise ValueError("rows were lost")
    return out


def read_shards(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).json(paths)
