"""Prefix trie of conversations: which turns conversations share from their start, and what sharing them saves.

A conversation's prefixes have chained digests: each is the SHA-256 of the one before and of its turn. Conversations with
one digest at one depth share a node. Nodes that the same conversations pass are a run; each run is exploded to all runs
above it for the sums of subtrees.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ranked, save

#: Turns of a conversation that one task chains, and nodes of a run (or numbers of ends) that one window or list holds.
CHUNK = 1024


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, turns, digest, bytes): the turns of each conversation, numbered from 0 by turn (null first).

    digest: SHA-256 of role and text (null: empty), the role's length in front. Turns with one number are ordered by role
    and then by digest. Rows without a conversation are left out. Texts are hashed first and not sorted or shuffled.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes")
    )
    placed = ranked(save(rows, "trie-turns"), ["conv"], ["turn", "role", "digest"], "trie-ordered")
    return save(placed.select("conv", "pos", F.col("n").alias("turns"), "digest", "bytes"), "trie-numbered")


def _chain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, chunk, depth, digest, bytes) sorted by the first three: the digest becomes the chain's within its chunk,
    `up` the one before. One state at a time."""
    last, state = None, b""
    for batch in batches:
        conv, chunk, depth, digest, size = (batch.column(i) for i in range(5))
        chained, before = [], []
        for key, d in zip(zip(conv.to_pylist(), chunk.to_pylist(), strict=True), digest.to_pylist(), strict=True):
            if key != last:
                last, state = key, b""
            before.append(state)
            state = sha256(state + d).digest()
            chained.append(state)
        yield pa.RecordBatch.from_arrays([conv, chunk, depth, pa.array(chained, pa.binary()), pa.array(before, pa.binary()), size], names=["conv", "chunk", "depth", "digest", "up", "bytes"])


def _carry_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, chunk, digest of the whole chunk) sorted: the chain of the chunks before each."""
    last, state = None, b""
    for batch in batches:
        conv, chunk, digest = (batch.column(i) for i in range(3))
        carried = []
        for key, d in zip(conv.to_pylist(), digest.to_pylist(), strict=True):
            if key != last:
                last, state = key, b""
            state = sha256(state + d).digest()
            carried.append(state)
        yield pa.RecordBatch.from_arrays([conv, chunk, pa.array(carried, pa.binary())], names=["conv", "chunk", "carry"])


def prefixes(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv, depth, digest, up, bytes) for turns (conv, depth from 1, digest, bytes): the digest of each prefix, and that
    of the prefix one turn shorter (empty for none).

    A long conversation is chained in chunks of turns that different tasks hold: the chunks' last digests are chained in
    turn, and a digest within a later chunk is the hash of the chain before it and of the one inside. Chunks begin at the
    same depths everywhere, so equal prefixes, and only those, have equal digests.
    """
    dealt = turns.select("conv", F.floor((F.col("depth") - 1) / chunk).cast("long").alias("chunk"), "depth", "digest", "bytes")
    dealt = dealt.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "depth")
    rows = save(dealt.mapInArrow(_chain_batches, "conv long, chunk long, depth long, digest binary, up binary, bytes long"), "trie-chains")
    finals = rows.where(F.col("depth") % chunk == 0).select("conv", (F.col("chunk") + 1).alias("chunk"), "digest")
    finals = finals.repartition("conv").sortWithinPartitions("conv", "chunk")
    carries = save(finals.mapInArrow(_carry_batches, "conv long, chunk long, carry binary"), "trie-carries")
    joined = lambda d: F.unhex(F.sha2(F.concat("carry", d), 256))
    later = rows.where("chunk > 0").join(carries, ["conv", "chunk"])
    # the prefix before a chunk's first turn is the last one of the chunk before
    whole = rows.where((F.col("depth") % chunk == 0) & (F.col("chunk") > 0)).join(carries, ["conv", "chunk"]).select("conv", (F.col("chunk") + 1).alias("chunk"), joined("digest").alias("last"))
    first = rows.where((F.col("depth") % chunk == 0) & (F.col("chunk") == 0)).select("conv", (F.col("chunk") + 1).alias("chunk"), F.col("digest").alias("last"))
    later = later.join(whole.unionByName(first), ["conv", "chunk"])
    up = F.when((F.col("depth") - 1) % chunk == 0, F.col("last")).otherwise(joined("up"))
    later = later.select("conv", "depth", joined("digest").alias("digest"), up.alias("up"), "bytes")
    return rows.where("chunk = 0").select("conv", "depth", "digest", "up", "bytes").unionByName(later)


def _suffix_sums(nodes: DataFrame, run: list[str], chunk: int) -> DataFrame:
    """nodes with `below`: the sum of `value` over the nodes of the run at this depth and deeper, by chunks of depths."""
    rows = nodes.withColumn("_c", F.floor(F.col("depth") / chunk))
    totals = rows.groupBy(*run, "_c").agg(F.sum("value").alias("_v"))
    per = Window.partitionBy(*run).orderBy(F.col("_c").desc())
    totals = totals.select(*run, "_c", (F.sum("_v").over(per) - F.col("_v")).alias("_after"))
    within = F.sum("value").over(Window.partitionBy(*run, "_c").orderBy(F.col("depth").desc()))
    return rows.withColumn("_w", within).join(totals, [*run, "_c"]).withColumn("below", F.col("_w") + F.col("_after")).drop("_c", "_w", "_after")


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, chunk, text) sorted: the SHA-256 of each node's texts, joined by commas. Only the hash is held."""
    last, state = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], names=["digest", "ends_sha256"])

    for batch in batches:
        for node, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if node != last:
                if state:
                    yield out()
                last, state = node, sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if state:
        yield out()


def end_hashes(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(digest, ends_sha256) for rows (digest, conv), each once: SHA-256 of the conversations' numbers in order, by commas.

    Numbers are gathered in stretches of `chunk` consecutive ones. A node within one stretch is hashed where it is; the
    texts of the others pass one by one through the hash, which nothing can split.
    """
    numbers = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    texts = save(ends.groupBy("digest", F.floor(F.col("conv") / chunk).alias("chunk")).agg(numbers.alias("text")), "trie-ends")
    many = save(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "trie-many")
    one = texts.join(many, "digest", "left_anti").select("digest", F.sha2(F.col("text").cast("binary"), 256).alias("ends_sha256"))
    dealt = texts.join(many, "digest", "left_semi").select("digest", "chunk", "text").repartition("digest").sortWithinPartitions("digest", "chunk")
    return one.unionByName(dealt.mapInArrow(_hash_batches, "digest binary, ends_sha256 string"))


def prefix_trie(turns: DataFrame, conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each node: digest, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_bytes, ends_sha256.

    turns: (conv, depth from 1 without gaps, digest, bytes); conversations: (conv, depth: its number of turns), each once,
    those without turns too. A node is a distinct sequence of first turns; its members are the conversations that begin
    with it, conv_id the smallest of them, parent_conv_id its parent's (null for the root). n_leaves counts the childless
    nodes of its subtree (itself included), saved_bytes sums (n_convs - 1) * bytes over it; ends_sha256 is end_hashes() of
    the members that end at the node. Without conversations there is no root and no row.

    A run is a path of nodes with the same members: all but the first have as many as their parent. Every run but for
    the root ends in a branch or a conversation's end, so runs exploded to the runs above them are at most twice the
    turns, however deep a conversation is; only these pairs are summed, with partial sums before their shuffle.
    """
    paths = save(prefixes(turns, chunk), "trie-prefixes")
    nodes = paths.groupBy("digest").agg(F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes"), F.max("up").alias("up"))
    root = conversations.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).where("n > 0")
    root = root.select(F.lit(b"").alias("digest"), "conv", F.lit(0).cast("long").alias("depth"), "n", F.lit(0).cast("long").alias("bytes"), F.lit(None).cast("binary").alias("up"))
    nodes = save(nodes.select(*root.columns).unionByName(root), "trie-nodes")
    # written out, so that the children of a hot node can be split
    above = nodes.select(F.col("digest").alias("up"), F.col("conv").alias("parent"), F.col("n").alias("above"))
    known = save(nodes.join(above, "up", "left"), "trie-known")
    children = known.where("up is not null").groupBy(F.col("up").alias("digest")).agg(F.count(F.lit(1)).alias("children"))
    known = known.join(children, "digest", "left").withColumn("children", F.coalesce("children", F.lit(0).cast("long")))
    value = (F.col("n") - 1) * F.col("bytes")
    known = known.select("digest", "conv", "depth", "n", "bytes", "parent", "children", (F.col("up").isNull() | (F.col("n") < F.col("above"))).alias("head"), value.alias("value"))
    known = save(known, "trie-linked")
    # a run is known by its smallest member and its size: runs with one smallest member lie on one path
    runs = known.groupBy("conv", "n").agg(F.min("depth").alias("depth"), F.sum("value").alias("value"), F.count_if(F.col("children") == 0).alias("leaves"))
    runs = save(runs, "trie-runs")
    heads = known.where("head").select("digest", F.col("conv").alias("top"), F.col("n").alias("size"))
    ways = paths.select("conv", "depth", "digest").unionByName(conversations.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("digest")))
    ways = save(ways, "trie-ways").join(save(heads, "trie-heads"), "digest").select("conv", F.col("depth").alias("at"), "top", "size")
    pairs = save(ways, "trie-on-ways").join(runs, "conv").where("at < depth")
    below = pairs.groupBy(F.col("top").alias("conv"), F.col("size").alias("n")).agg(F.sum("value").alias("more_value"), F.sum("leaves").alias("more_leaves"))
    sums = runs.select("conv", "n", "leaves").join(below, ["conv", "n"], "left")
    zero = F.lit(0).cast("long")
    sums = save(sums.select("conv", "n", (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"), F.coalesce("more_value", zero).alias("more")), "trie-sums")
    shared = _suffix_sums(known.where("n > 1"), ["conv", "n"], chunk)
    alone = known.where("n = 1").withColumn("below", zero)
    ends = end_hashes(paths.join(conversations, ["conv", "depth"], "left_semi").select("digest", "conv").unionByName(conversations.where("depth = 0").select(F.lit(b"").alias("digest"), "conv")), chunk)
    out = shared.unionByName(alone).join(sums, ["conv", "n"]).join(ends, "digest", "left")
    return out.select(
        F.hex("digest").alias("digest"),
        F.col("conv").alias("conv_id"),
        "depth",
        # within a run the parent has the same smallest member
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        "n_leaves",
        (F.col("below") + F.col("more")).alias("saved_bytes"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def forked(numbered: DataFrame, source: Column, taken: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from another one: (turns, conversations) for prefix_trie().

    numbered: of ordered_turns(). Of a conversation, `source` and `taken` (at most `most`) are functions of conv: it begins
    with the first `taken` turns of the source (all if there are fewer, none if it is absent), then has its own turns
    behind its first `taken`.
    """
    sizes = numbered.groupBy("conv").agg(F.max("turns").alias("turns")).withColumn("source", source).withColumn("taken", taken)
    sizes = save(sizes, "trie-sizes")
    have = sizes.select(F.col("conv").alias("source"), F.col("turns").alias("there"))
    begun = F.least("taken", F.coalesce("there", F.lit(0)))
    rest = F.greatest(F.col("turns") - F.col("taken"), F.lit(0))
    sizes = save(sizes.join(have, "source", "left").select("conv", "source", "taken", begun.alias("begun"), (begun + rest).cast("long").alias("depth")), "trie-rebuilt")
    firsts = numbered.where(F.col("pos") < most).select(F.col("conv").alias("source"), "pos", "digest", "bytes")
    given = sizes.where("begun > 0").select("conv", "source", "begun").join(firsts, "source").where("pos < begun")
    given = given.select("conv", (F.col("pos") + 1).alias("depth"), "digest", "bytes")
    own = numbered.join(sizes.select("conv", "taken", "begun"), "conv").where("pos >= taken")
    own = own.select("conv", (F.col("begun") + F.col("pos") - F.col("taken") + 1).alias("depth"), "digest", "bytes")
    return given.unionByName(own), sizes.select("conv", "depth")
