"""Exact dedup by an extendible-hash index in the shared folder, DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import drop_saved, save


def _slot(depth: int, h: str = "h") -> Column:
    """The leading `depth` bits of a 64-bit hash: its place in a directory of 2**depth slots."""
    return F.shiftrightunsigned(h, 64 - depth).cast("long") if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, bucket_rows: int, max_depth: int = 40) -> tuple[int, DataFrame]:
    """Global depth and directory (slot, local_depth, bucket) of an extendible hash over keys `h`.

    The directory doubles (one more leading bit) while a bucket is overfull; a slot's bucket is the shallowest
    prefix that holds at most bucket_rows keys, named by its first slot. It has about rows / bucket_rows slots and
    stays a DataFrame. Keys of one hash cannot be split: max_depth ends the doubling.
    """
    depth = max(0, math.ceil(math.log2(max(1, keys.count() / bucket_rows))))
    while True:
        slots = keys.groupBy(_slot(depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        if depth >= max_depth or (slots.agg(F.max("n")).first()[0] or 0) <= bucket_rows:
            break
        depth += 1
    levels = F.explode(F.sequence(F.lit(0), F.lit(depth)))
    prefixes = slots.select("slot", "n", levels.alias("d")).withColumn("prefix", F.expr(f"shiftright(slot, {depth} - d)"))
    full = prefixes.groupBy("d", "prefix").agg(F.sum("n").alias("total"))
    local = (
        prefixes.join(full, ["d", "prefix"])
        .groupBy("slot")
        .agg(F.coalesce(F.min(F.when(F.col("total") <= bucket_rows, F.col("d"))), F.lit(depth)).alias("local_depth"))
    )
    first = F.expr(f"shiftleft(shiftright(slot, {depth} - local_depth), {depth} - local_depth)")
    return depth, local.withColumn("bucket", first)


def route(rows: DataFrame, depth: int, slots: DataFrame) -> DataFrame:
    """rows with the bucket (and its local depth) that the directory names for the leading bits of their hash `h`.

    A slot without a directory entry leaves a null bucket, which no chain has.
    """
    return rows.withColumn("slot", _slot(depth)).join(slots, "slot", "left").drop("slot")


def write_index(keys: DataFrame, texts: DataFrame, depth: int, slots: DataFrame, broadcast_keys: int = 500_000) -> DataFrame:
    """The index in the shared folder: bucket, local_depth, h, link, links, keep_id, n, text.

    keys are (h, keep_id, n), one row a hash; texts are (id, text, h), one row a document. Keys go to their bucket by
    the directory. A key of one document is a chain of one link and needs no text. The texts of other keys combine
    before the shuffle into one row each. An owner task takes a range of (bucket, hash), sorts it, walks each chain,
    compares the bytes of a text with those of the one before, numbers the links and writes its file. The file keeps
    a text only where it must be told from others of its hash.
    """
    routed = save(route(keys, depth, slots), "routed")
    hot = routed.where("n > 1").select("bucket", "local_depth", "h")
    hot = F.broadcast(hot) if hot.count() <= broadcast_keys else hot
    several = (
        texts.join(hot, "h")
        .groupBy("bucket", "local_depth", "h", "text")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    columns = ["bucket", "local_depth", "h", "keep_id", "n"]
    alone = routed.where("n = 1").select(*columns, F.lit(None).cast("string").alias("text"))
    owned = several.select(*columns, "text").unionByName(alone).repartitionByRange("bucket", "h")
    chain = Window.partitionBy("bucket", "h")
    walk = chain.orderBy("text")
    differs = ~F.col("text").eqNullSafe(F.lag("text").over(walk)) & (F.row_number().over(walk) > 1)
    owned = owned.withColumn("differs", differs.cast("long")).withColumn("link", F.sum("differs").over(walk))
    owned = owned.withColumn("links", F.max("link").over(chain) + 1)
    kept = F.when(F.col("links") > 1, F.col("text")).alias("text")
    index = save(owned.select("bucket", "local_depth", "h", "link", "links", "keep_id", "n", kept), "index")
    drop_saved(routed)
    return index


def look_up(
    entries: DataFrame, texts: DataFrame, depth: int, slots: DataFrame, index: DataFrame, broadcast_keys: int = 500_000
) -> DataFrame:
    """entries (with `h`) with keep_id and n of their link, found by directory, bucket, hash and, in a chain of several
    links, the bytes of the text. An entry that its bucket does not hold is an error.

    texts are (id, text, h) and the entries' other columns; of these, those of hashes with several links are compared.
    Up to broadcast_keys such hashes are broadcast, so that other texts are not shuffled.
    """
    columns = [c for c in entries.columns if c != "h"]
    heads = index.where("link = 0").select("bucket", "h", "links", "keep_id", "n")
    found = route(entries, depth, slots).join(heads, ["bucket", "h"], "left").where("links is null or links = 1")
    lost = F.when(F.col("links").isNull(), F.raise_error(F.lit("an entry is not in the bucket that the directory names")))
    plain = found.select(*columns, lost.otherwise(F.col("keep_id")).alias("keep_id"), "n")
    chains = index.where("links > 1").select("bucket", "h", "text", "keep_id", "n")
    several = save(chains.select("h").distinct(), "several")
    several = F.broadcast(several) if several.count() <= broadcast_keys else several
    forked = route(texts.join(several, "h", "left_semi"), depth, slots)
    return plain.unionByName(forked.join(chains, ["bucket", "h", "text"]).select(*columns, "keep_id", "n"))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = 512,
    broadcast_keys: int = 500_000,
    hash_of: Column | None = None,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, text_hash (xxhash64 of the text as it came). Of equal texts the largest id stays.

    1. One scan writes an entry (id, 64-bit hash, SHA-256) per document to the shared folder. hash_of, over the column
       `text`, replaces the hash.
    2. Entries of one hash combine before the shuffle into one key, so that a text with a third of all rows is one key.
    3. The directory doubles until no bucket holds more than bucket_rows keys.
    4. Keys are routed to buckets by the directory; the texts of every key that stands for several documents are read
       again. Owner tasks take ranges of buckets, chain the texts of each hash, compare bytes and write the index
       (write_index). Up to broadcast_keys such hashes (24 bytes each) are broadcast; beyond that they are joined by a
       shuffle.
    5. Each entry is routed by the directory and takes its link from its bucket (look_up); where different texts share
       a hash, the document's text is compared with the links of the chain. The SHA-256 decides nothing.

    A null text counts as empty. A null id is the smallest; a group of null ids has a null keep_id and each of its
    rows is kept. Rows repeated with the same id and text are each marked kept if that id stays. Other columns of
    the input are not read. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    came = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text_col).alias("text_hash"))
    came = came.withColumn("h", F.xxhash64("text") if hash_of is None else hash_of.cast("long"))
    came = came.withColumn("sha", F.unhex(F.sha2("text", 256)))
    entries = save(came.drop("text"), "entries")
    keys = save(entries.groupBy("h").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n")), "keys")
    depth, slots = directory(keys, bucket_rows)
    slots = save(slots, "directory")
    index = write_index(keys, came, depth, slots, broadcast_keys)
    drop_saved(keys)
    return look_up(entries, came, depth, slots, index, broadcast_keys).select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "text_hash",
    )
