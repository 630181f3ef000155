"""What the operators of this subpackage share: tables in the shared folder, connected components, word rules."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: bytes.translate table that lower-cases A-Z and nothing else.
LOWER_AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where it is unset a temporary folder is set, but only in local mode, where all tasks run on this machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def save(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write df as Parquet to the shared folder (in folders by the columns `by`) and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def text_slices(batch: pa.RecordBatch, column: int, room: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `room` bytes of a binary column, or of one row: what a task holds does not grow with its texts' number."""
    block = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)) // room
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if lo < hi:
            yield batch.slice(lo, hi - lo)


def hash_sample(df: DataFrame, keys: list[str], size: int, total: int) -> DataFrame:
    """`size` rows of a frame of `total` (all if it has no more): those with the smallest hashes of their keys.

    Rows beyond a hash that twice as many rows pass are filtered first, so that tasks do not each send `size` rows.
    """
    h = F.xxhash64(*keys)
    if total > 2 * size:
        df = df.where(F.pmod(h, F.lit(1 << 40)) < int((1 << 40) * 2 * size / total))
    return df.orderBy(F.pmod(h, F.lit(1 << 40)), *keys).limit(size)


def ranked(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """rows with `pos`, 0-based by `order` (nulls first) within each group, and `n`, the rows of the group.

    One range sort numbers rows by task, and the counts of each (group, task) give the bases, so that a hot group is
    spread over tasks; the only windows are over a group's tasks. Ties are cut anywhere. rows are read twice (bounds,
    then sort): let them be a table. Columns of `group` hold no nulls.
    """
    by = [*group, *order, "_tie"]
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    rows = save(rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie").withColumn("_at", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    per = Window.partitionBy(*group)
    parts = rows.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_in"))
    parts = parts.withColumn("n", F.sum("_in").over(per)).withColumn("_base", F.sum("_in").over(per.orderBy("_part")) - F.col("_in"))
    parts = save(parts.drop("_in"), f"{name}-parts")
    return rows.join(parts, [*group, "_part"]).withColumn("pos", F.col("_base") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_base")


def release(spark: SparkSession) -> None:
    """Let the context cleaner delete the shuffle files of finished steps, which stay while the driver's JVM keeps their plans."""
    gc.collect()
    spark._jvm.System.gc()


def drop_saved(df: DataFrame) -> None:
    """Delete a table of save() that nothing reads any more."""
    path = getattr(df, "_saved_at", None)
    if path:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def spanning(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest index that it reaches through the links (u, v)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def star_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of (u, v) links between longs: rows (node, component), component the smallest node.

    Alternates large-star and small-star steps (Kiveris et al., 2014): every step is a grouped minimum and an
    equi-join, so a huge component is spread over tasks (hot keys are split by the adaptive skew join), and the
    number of rounds grows with the logarithm of the component's size. Only two numbers a round reach the driver.
    Nodes without a link have no row. Null ends are ignored.
    """
    links = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = save(links, "links")
    mark = _fingerprint(links)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # grouped minima are written out, so that both sides of a hot node's join are plain shuffles, which can be split
        least = save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = save(large, "large")
        low = save(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = save(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        for old in (links, least, large, low):
            drop_saved(old)
        links, before, mark = after, mark, _fingerprint(after)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
