"""Datasets with splits and revisions: Parquet files, and manifests that say which of them a revision holds.

A folder has data/ (files, never changed), index/ (of each file the ids and hashes of its rows) and revisions/ (of each
revision the files of its splits). A revision is whole once its manifest is there; what a failed commit leaves behind is
in no manifest. Readers see one revision, whatever is committed meanwhile.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "split string, file string, rows bigint, revision bigint"
INDEX = "id string, hash bigint, file string, commit string"


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """(split, file, rows, revision) of all revisions; files as paths below root."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/revisions")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], MANIFEST)


def _revision(spark: SparkSession, root: str, revision: int | None) -> int:
    """The asked revision or the latest one; 0 if there is none."""
    found = manifests(spark, root)
    if revision is None:
        return found.agg(F.max("revision")).first()[0] or 0
    if found.where(F.col("revision") == revision).isEmpty():
        raise ValueError(f"no revision {revision} in {root}")
    return revision


def commit(df: DataFrame, root: str, split: str, id_col: str = "instance_id", mode: str = "replace") -> int:
    """Writes df as `split` in a new revision, in place of that split's rows or ("append") behind them, and returns its
    number. Other splits stay as they are in the latest revision.

    Ids are read as text; null ids, and ids that stand twice in the split, raise and leave no revision. Of two writers
    that commit at once one fails, as its number is taken.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"replace or append, not {mode}")
    spark, name = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{root}/data/{name}")
    # files are known by their names below data/, so that a folder can be moved
    file = F.concat(F.lit(f"{name}/"), F.element_at(F.split(F.input_file_name(), "/"), -1))
    rows = spark.read.schema(df.schema).parquet(f"{root}/data/{name}")
    rows = rows.select(F.col(id_col).cast("string").alias("id"), F.xxhash64(*df.columns).alias("hash"), file.alias("file"))
    rows.write.parquet(f"{root}/index/commit={name}")
    index = spark.read.schema(INDEX).parquet(f"{root}/index").where(F.col("commit") == name)
    latest = _revision(spark, root, None)
    before = manifests(spark, root).where(F.col("revision") == latest)
    kept = before if mode == "append" else before.where(F.col("split") != split)
    own = kept.where(F.col("split") == split)
    ids = index.select("id").unionByName(_index(spark, root, own).select("id"))
    twice = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").limit(5).collect()
    if twice:
        raise ValueError(f"ids that are null or stand twice in {split}: {[r.id for r in twice]}")
    new = index.groupBy("file").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(split).alias("split"), "file", "rows")
    if own.isEmpty() and new.isEmpty():  # an empty split is still one
        new = spark.createDataFrame([(split, None, 0)], "split string, file string, rows bigint")
    new = new.unionByName(kept.select("split", "file", "rows"))
    new.coalesce(1).write.mode("error").parquet(f"{root}/revisions/revision={latest + 1}")
    return latest + 1


def _index(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """(id, hash, file) of the rows of some files."""
    try:
        index = spark.read.schema(INDEX).parquet(f"{root}/index")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        index = spark.createDataFrame([], INDEX)
    return index.join(files.select("file"), "file", "left_semi").select("id", "hash", "file")


def load(spark: SparkSession, root: str, schema: str, split: str, ids: DataFrame | list[str] | None = None, revision: int | None = None, id_col: str = "instance_id") -> DataFrame:
    """The rows of a split, as of a revision (the latest if none is given).

    ids: only these rows; some that are not there raise. Only files that hold one of them are opened. An unknown revision
    or split raises.
    """
    held = manifests(spark, root).where((F.col("revision") == _revision(spark, root, revision)) & (F.col("split") == split))
    if held.isEmpty():
        raise ValueError(f"no split {split} in {root}" + (f" at revision {revision}" if revision else ""))
    files = held.where("file is not null")
    if ids is not None:
        wanted = ids.select(F.col(ids.columns[0]).cast("string").alias("id")) if isinstance(ids, DataFrame) else spark.createDataFrame([(i,) for i in ids], "id string")
        index = _index(spark, root, files)
        absent = [r.id for r in wanted.join(index, "id", "left_anti").limit(5).collect()]
        if absent:
            raise ValueError(f"no such instances: {absent}")
        files = index.join(wanted, "id", "left_semi").select("file").distinct()
    paths = [f"{root}/data/{r.file}" for r in files.select("file").collect()]  # names of files, as any reader lists them
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return rows if ids is None else rows.join(wanted.select("id"), F.col(id_col).cast("string") == F.col("id"), "left_semi")


def changes(spark: SparkSession, root: str, split: str, old: int, new: int) -> DataFrame:
    """(id, change): rows that were added, removed or changed between two revisions of a split, from their indexes alone.
    Files that both revisions hold are not compared."""
    both = manifests(spark, root).where((F.col("split") == split) & F.col("file").isNotNull())
    at = {k: both.where(F.col("revision") == _revision(spark, root, k)).select("file") for k in (old, new)}
    a = _index(spark, root, at[old].join(at[new], "file", "left_anti")).select("id", F.col("hash").alias("_a"))
    b = _index(spark, root, at[new].join(at[old], "file", "left_anti")).select("id", F.col("hash").alias("_b"))
    kind = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    return a.join(b, "id", "full").select("id", kind.alias("change")).where("change is not null")
