"""Merkle dataset manifest: a hash tree per partition of a table and one over their roots, with a proof for every row.

Trees are built by what combineByKey does, driven by events. A digest that arrives opens or fills the partial parent at
its place; a parent whose children are all there (how many follows from the size of the tree) is hashed, and arrives in
turn at its own parent. A task does so with whatever part of a table it holds and passes on what stays open: the digests
in unfinished parents, or finished blocks of some levels. That frontier is reshuffled by the block above it. On the way
back each finished parent leaves links to its children, which lead from any node up to its block and give its proof.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import ranked, save

#: Leaves of a block at most: what one step of a walk holds.
BLOCK = 1024


def hashed(parts: list[str]) -> str:
    """The digest of digests: SHA-256 of their hex texts, one behind the other."""
    return sha256("".join(parts).encode()).hexdigest()


def row_digest(*columns: Column) -> Column:
    """SHA-256 (hex) over values as `-` for null, else the bytes of the text, a colon, the text; integers as decimals."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


@cache
def widths(n: int, fan_out: int) -> tuple[int, ...]:
    """Nodes on each level of a tree of n leaves, up to the one root."""
    found = [n]
    while found[-1] > 1:
        found.append(-(-found[-1] // fan_out))
    return tuple(found)


class Runs:
    """The partial parents of one tree that a task has seen so far; add() and merge() in any order.

    Nodes are (level, place). Parents are finished up to level `top` and not beyond.
    """

    def __init__(self, n: int, fan_out: int, top: int, linked: bool = False):
        self.widths, self.fan_out, self.top = widths(n, fan_out), fan_out, min(top, len(widths(n, fan_out)) - 1)
        self.open: dict[tuple[int, int], dict[int, str]] = {}
        self.done: list[tuple[int, int, str]] = []
        #: Of each child its place in the run and the digests of the others, if asked for.
        self.links: dict[tuple[int, int], tuple[int, list[str]]] | None = {} if linked else None

    def add(self, level: int, place: int, digest: str) -> None:
        k = self.fan_out
        while level < self.top:
            parent, at = divmod(place, k)
            arity = min(k, self.widths[level] - parent * k)
            if arity > 1:
                run = self.open.setdefault((level, parent), {})
                run[at] = digest
                if len(run) < arity:
                    return
                del self.open[level, parent]
                children = [run[i] for i in range(arity)]
            else:
                children = [digest]
            if self.links is not None:
                for i in range(arity):
                    self.links[level, parent * k + i] = (i, children[:i] + children[i + 1 :])
            level, place, digest = level + 1, parent, hashed(children)
        self.done.append((level, place, digest))

    def frontier(self) -> list[tuple[int, int, str]]:
        """What this task cannot take further: finished blocks, and the children of parents that lack others."""
        rest = [(level, parent * self.fan_out + i, d) for (level, parent), run in self.open.items() for i, d in run.items()]
        return self.done + rest

    def proof(self, level: int, place: int) -> list[tuple[int, list[str]]]:
        """The links from a node up to the top of its block."""
        found = []
        while (level, place) in self.links:
            found.append(self.links[level, place])
            level, place = level + 1, place // self.fan_out
        return found


NODE = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("digest", pa.string())])
NODE_TYPES = "tree string, n long, level int, place long, digest string"
STEPS = "array<struct<place: int, siblings: array<string>>>"


def _rows(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    return zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns], strict=True)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), NODE, strict=True)], schema=NODE)


def _combine(fan_out: int, top: int, whole: bool):
    """Rows (tree, n, level, place, digest, block) to the frontier below level `top`. whole: each block's rows come
    together, so that nothing may stay open."""

    def close(runs: Runs, key: tuple) -> list[tuple]:
        if whole and runs.open:
            raise ValueError(f"nodes are missing or repeated below {min(runs.open)} in the tree {key[0]!r}")
        return [(key[0], runs.widths[0], *node) for node in runs.frontier()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, last, out = None, None, []
        for batch in batches:
            for tree, n, level, place, digest, block in _rows(batch, *NODE.names, "block"):
                if (tree, block) != last:  # a tree that comes back only makes one more partial parent
                    if runs:
                        out += close(runs, last)
                    runs, last = Runs(n, fan_out, top), (tree, block)
                runs.add(level, place, digest)
            if runs:
                out += [(last[0], runs.widths[0], *node) for node in runs.done]
                runs.done = []
            if out:
                yield _table(out)
                out = []
        if runs and (out := close(runs, last)):
            yield _table(out)

    return run


def _descend(fan_out: int, top: int, carried: pa.Schema):
    """Of each (tree, block) a row with the way from its top to the root, then the block's nodes: to those nodes with
    their whole ways. Steps are built column by column."""

    def close(runs: Runs, way: tuple, nodes: list[tuple]) -> pa.RecordBatch:
        crown, above = way
        places, counts, siblings = [], [], []
        upper_places, upper_counts = [s["place"] for s in above], [len(s["siblings"]) for s in above]
        upper_siblings = [d for s in above for d in s["siblings"]]
        ends = [0]
        for _, _, level, place, *_ in nodes:
            for at, others in runs.proof(level, place):
                places.append(at)
                counts.append(len(others))
                siblings += others
            places += upper_places
            counts += upper_counts
            siblings += upper_siblings
            ends.append(len(places))
        total, bounds = 0, [0]
        for c in counts:
            bounds.append(total := total + c)
        others = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(siblings, pa.string()))
        steps = pa.StructArray.from_arrays([pa.array(places, pa.int32()), others], ["place", "siblings"])
        proofs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)
        columns = [pa.array(c, f.type) for c, f in zip(zip(*nodes, strict=True), carried, strict=True)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([crown] * len(nodes), pa.list_(pa.string())), proofs], names=[*carried.names, "crown", "proof"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, last, way, nodes = None, None, None, []
        for batch in batches:
            names = (*carried.names, "block", "crown", "proof")
            for *node, block, crown, proof in _rows(batch, *names):
                if (node[0], block) != last:
                    if nodes:
                        yield close(runs, way, nodes)
                    runs, last, way, nodes = None, (node[0], block), None, []
                if crown is not None:
                    way = crown, proof
                    continue
                if way is None:
                    raise ValueError(f"no way from block {block} of the tree {node[0]!r}")
                runs = runs or Runs(node[1], fan_out, top, linked=True)
                runs.add(node[2], node[3], node[4])
                nodes.append(tuple(node))
        if nodes:
            yield close(runs, way, nodes)

    return run


def _levels(fan_out: int) -> int:
    """The levels of a block: as many as keep its leaves within BLOCK, at least one."""
    up = 1
    while fan_out ** (up + 1) <= BLOCK:
        up += 1
    return up


def _block(fan_out: int, top: int) -> Column:
    """The number of a node's block: its ancestor's place on level `top`."""
    return F.expr(f"place div cast(pow({fan_out}, {top} - level) as bigint)")


def climb(leaves: DataFrame, fan_out: int = 2, name: str = "merkle") -> list[DataFrame]:
    """Tables of nodes: leaves (tree, n, level 0, place, digest, ...), then for each round the tops of blocks.

    A node is its tree's root if n <= fan_out ** level; it stands in the table of the round that reached it. The rounds
    are the logarithm of the largest tree's leaves to the base BLOCK; that size is all that reaches the driver.
    """
    up, most = _levels(fan_out), leaves.agg(F.max("n")).first()[0] or 0
    rounds, top = [leaves], 0
    while fan_out**top < most:
        below = rounds[-1].where((F.col("level") == top) & (F.col("n") > fan_out**top)).select(*NODE.names)
        top += up
        # first whatever part of a tree a task holds, then what that leaves open, dealt by block
        partial = below.withColumn("block", F.lit(0).cast("long")).mapInArrow(_combine(fan_out, top, False), NODE_TYPES)
        dealt = partial.withColumn("block", _block(fan_out, top)).repartition("tree", "block").sortWithinPartitions("tree", "block")
        rounds.append(save(dealt.mapInArrow(_combine(fan_out, top, True), NODE_TYPES), f"{name}-tops"))
    return rounds


def roots(rounds: list[DataFrame], fan_out: int = 2) -> DataFrame:
    """(tree, digest) of every tree."""
    found = [r.where(F.col("n") <= F.pow(F.lit(float(fan_out)), "level")).select("tree", "digest") for r in rounds]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def proofs(rounds: list[DataFrame], starts: DataFrame, fan_out: int = 2) -> DataFrame:
    """The leaves with `crown` and `proof`: the siblings of each step from leaf to root, and behind it, in order.

    starts: (tree, crown array<string>, proof) of each tree's root. A round is dealt once, by block; each block gets the
    way from its top once and not once a leaf.
    """
    up = _levels(fan_out)
    ways = None
    for step in range(len(rounds) - 1, -1, -1):
        nodes, level = rounds[step], up * step
        at_root = nodes.where(F.col("n") <= F.pow(F.lit(float(fan_out)), "level")).join(starts, "tree")
        if step == len(rounds) - 1:
            ways = at_root
            continue
        tops, top = rounds[step + 1], level + up
        held = ways.withColumn("block", _block(fan_out, top)).select("tree", "block", "crown", "proof")
        members = nodes.where((F.col("level") == level) & (F.col("n") > fan_out**level))
        carried = members.columns
        dealt = members.withColumn("block", _block(fan_out, top)).unionByName(held, allowMissingColumns=True)
        dealt = dealt.repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("crown").isNull())
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in members.schema)
        schema = to_arrow_schema(members.schema)
        below = dealt.mapInArrow(_descend(fan_out, top, schema), f"{types}, crown array<string>, proof {STEPS}")
        below = below if step == 0 else save(below.select("tree", "n", "level", "place", "digest", "crown", "proof"), "merkle-ways")
        ways = below.unionByName(at_root.select(*below.columns))
    return ways


def _leaves(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows (tree, digest, ...) as nodes of level 0, placed by `order`, ties by digest."""
    rest = [c for c in rows.columns if c not in ("tree", "digest")]
    placed = ranked(rows, ["tree"], [*order, "digest"], name)
    return placed.select("tree", "n", F.lit(0).alias("level"), F.col("pos").alias("place"), "digest", *rest)


def merkle_manifest(docs: DataFrame, columns: list[str], by: str = "lang", id_col: str = "doc_id", fan_out: int = 2, claimed: Column | None = None) -> DataFrame:
    """(id, leaf, claimed, subroot, root, proof) of every row.

    leaf: row_digest() of `columns`. Per value of `by` the leaves ascend by id_col and every fan_out consecutive nodes
    become the digest of their digests (the last run may be shorter, even one) until one remains, the subroot; subroots,
    by that value (null first, then bytewise), give the root in the same way. proof: for each step from the leaf via the
    subroot to the root its place in the run and the siblings there; verified() folds it. claimed: a digest that goes
    along, for instance of another copy of the row.

    Leaves with equal ids (null is the smallest) are ordered by digest, so equal rows may stand in for each other. A lone
    leaf is its subroot, a lone subroot the root. An empty table gives an empty manifest. Other columns are not read.
    """
    if fan_out < 2:
        raise ValueError("a run has two children at least")
    key = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("-"))  # null first
    rows = docs.select(key.alias("tree"), F.col(id_col).alias("id"), row_digest(*[F.col(c) for c in columns]).alias("digest"), (claimed if claimed is not None else F.lit(None).cast("string")).alias("claimed"))
    leaves = _leaves(save(rows, "merkle-leaves"), ["id"], "merkle-placed")
    rounds = climb(leaves, fan_out)
    subroots = save(roots(rounds, fan_out).select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest"), "merkle-subroots")
    upper = climb(_leaves(subroots, ["key"], "merkle-upper"), fan_out)
    top = roots(upper, fan_out).select("tree", F.array("digest").alias("crown"), F.array().cast(STEPS).alias("proof"))
    starts = proofs(upper, top, fan_out).select(F.col("key").alias("tree"), F.array("digest", F.col("crown")[0]).alias("crown"), "proof")
    found = proofs(rounds, save(starts, "merkle-starts"), fan_out)
    return found.select("id", F.col("digest").alias("leaf"), "claimed", F.col("crown")[0].alias("subroot"), F.col("crown")[1].alias("root"), "proof")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    other = lambda s, start, n: F.array_join(F.slice(s["siblings"], start, n), "")

    def step(digest: Column, s: Column) -> Column:
        before = other(s, F.lit(1), s["place"])
        behind = other(s, s["place"] + 1, F.size(s["siblings"]))
        return F.sha2(F.concat(before, digest, behind).cast("binary"), 256)

    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """The digest of a proof's siblings."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda s: s["siblings"])), "").cast("binary"), 256)
