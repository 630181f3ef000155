"""Readers of the pipeline's files, all by declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.perf import perf_by_label


def jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines) of a JSON-lines file; blank lines are neither."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    parsed = lines.select("value", F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.where("r._bad is null").select("r.*").drop("_bad"), parsed.where("r._bad is not null").select(F.col("value").alias("line"))


def jsonl_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Fails on the first bad line."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON array over many lines; fails if it is broken."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def instances(spark: SparkSession, path: str, schema: str, ids: list[str] | None = None) -> DataFrame:
    """Task instances of a parquet, JSON-lines or JSON-array path; ids that are not there raise."""
    if path.rstrip("/").endswith(".parquet"):
        df = spark.read.schema(schema).parquet(path)
    elif path.endswith((".jsonl", ".jsonl.all")):
        df = jsonl_strict(spark, path, schema)
    else:
        df = json_array(spark, path, schema)
    if ids is None:
        return df
    wanted = spark.createDataFrame([(i,) for i in ids], "instance_id string")
    absent = [r[0] for r in wanted.join(df, "instance_id", "left_anti").limit(5).collect()]
    if absent:
        raise ValueError(f"no such instances: {absent}")
    return df.join(F.broadcast(wanted), "instance_id", "left_semi")  # as long as the caller's list


def repos_json(spark: SparkSession, path: str) -> DataFrame:
    """(repo): a JSON array of names or of objects with full_name, or {"repos": [...]} of either."""
    text = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    inner = F.coalesce(F.try_variant_get("v", "$.repos", "variant"), F.col("v"))
    names = text.select(F.explode(F.try_variant_get(inner, "$", "array<variant>")).alias("e"))
    name = F.coalesce(F.try_variant_get("e", "$.full_name", "string"), F.try_variant_get("e", "$.repo", "string"), F.try_variant_get("e", "$", "string"))
    return names.select(name.alias("repo")).where(F.col("repo").contains("/"))


def repo_line(line: Column) -> Column:
    """The repository of a line of a list: what stands before a #, if it has a slash; else null."""
    name = F.trim(F.substring_index(line, "#", 1))
    return F.when(name.contains("/"), F.substring_index(name, " ", 1))


def repos_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(repo_line(F.col("value")).alias("repo")).where("repo is not null")


def report_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def files_by_directory(spark: SparkSession, pattern: str) -> DataFrame:
    """(instance_id, text): whole files, each named by its directory."""
    return spark.read.text(pattern, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("instance_id"), F.col("value").alias("text")
    )


def perf_summaries(spark: SparkSession, pattern: str) -> DataFrame:
    return files_by_directory(spark, pattern).select("instance_id", perf_by_label(F.col("text")).alias("perf")).select("instance_id", "perf.*")


ISTANBUL = "map<string,struct<path:string,statementMap:map<string,struct<start:struct<line:int>>>,s:map<string,int>>>"
GCOVR = "struct<files:array<struct<file:string,lines:array<struct<line_number:int,count:long>>>>>"


def istanbul_lines(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, file, line): first lines of statements that ran, of an istanbul or v8 coverage JSON."""
    files = df.select(*keys, F.explode(F.from_json(text, ISTANBUL)).alias("name", "f"))
    ran = F.map_keys(F.map_filter("f.s", lambda k, n: n > 0))
    return (
        files.select(*keys, F.coalesce("f.path", "name").alias("file"), "f", F.explode(ran).alias("i"))
        .select(*keys, "file", F.element_at("f.statementMap", F.col("i"))["start"]["line"].alias("line"))
        .where("line is not null")
        .distinct()
    )


def gcovr_lines(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, file, line) with a count above zero, of a gcovr JSON."""
    files = df.select(*keys, F.explode(F.from_json(text, GCOVR)["files"]).alias("f"))
    lines = files.select(*keys, F.col("f.file").alias("file"), F.explode("f.lines").alias("l"))
    return lines.where("l.count > 0").select(*keys, "file", F.col("l.line_number").alias("line")).distinct()


def kv_get(rows: DataFrame, namespace: str, now: float, max_age: float | None = None) -> DataFrame:
    """(key, value variant): entries of a namespace that are not too old; broken values are null."""
    fresh = rows.where(F.col("namespace") == namespace)
    if max_age is not None:
        fresh = fresh.where(now - F.col("fetched_at") <= max_age)
    return fresh.select("key", F.try_parse_json("value").alias("value"))


def profile_stats(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, file, line, func, ncalls, tottime, cumtime, callers) of profiler dumps: one file a row, read in tasks."""
    import marshal

    import pandas as pd

    def read(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                for (file, line, func), (_, n, tot, cum, callers) in marshal.loads(bytes(content)).items():  # noqa: S302
                    above = [{"caller": f"{a}:{b}:{c}", "calls": v[1], "tot_time": v[2], "cum_time": v[3]} for (a, b, c), v in callers.items()]
                    rows.append((path, file, line, func, n, tot, cum, above))
            yield pd.DataFrame(rows, columns=["path", "file", "line", "func", "ncalls", "tottime", "cumtime", "callers"])

    schema = (
        "path string, file string, line int, func string, ncalls long, tottime double, cumtime double, "
        "callers array<struct<caller:string,calls:long,tot_time:double,cum_time:double>>"
    )
    return spark.read.format("binaryFile").load(pattern).select("path", "content").mapInPandas(read, schema)


def coverage_databases(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, context, file, line) of coverage databases: each is a SQLite file, opened in the task that has its bytes."""
    import sqlite3

    import pandas as pd

    def read(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                con = sqlite3.connect(":memory:")
                con.deserialize(bytes(content))
                query = "select c.context, f.path, b.numbits from line_bits b join file f on f.id = b.file_id join context c on c.id = b.context_id"
                for context, file, bits in con.execute(query):
                    rows += [(path, context, file, 8 * i + k) for i, byte in enumerate(bits) for k in range(8) if byte >> k & 1]
                con.close()
            yield pd.DataFrame(rows, columns=["path", "context", "file", "line"])

    found = spark.read.format("binaryFile").load(pattern).select("path", "content")
    return found.mapInPandas(read, "path string, context string, file string, line long")
