"""SimHash near-dedup: by few bits with a covering locality-sensitive hash, by similarity with tables of wider fingerprints.

simhash_dedup: every distinct 64-bit fingerprint is masked by the 15 words of a covering code of radius 3: bit i belongs to mask v
if the inner product over GF(2) of v and a fixed nonzero 4-bit label of i is one. Up to three differing bits span at
most three of four dimensions, so some v is orthogonal to all their labels: its mask hides every differing bit and the
pair shares that table's key. Recall is therefore 1, and candidates are checked on all 64 bits.

near_dedup: fingerprints of 256 bits meet in 48 tables of eight bits (`wide_links`), links are checked on the texts.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER_AZ, save, spanning, star_components, text_slices

#: Shingles hashed at once; bounds memory for very long texts.
_CHUNK = 1 << 16
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_COLUMN = np.arange(8, dtype=np.int64) * 256


def shingle_hashes(text: bytes | None, shingle: int = 3, seed: int = 42):
    """XXH64 values of the word shingles of UTF-8 text, in chunks; a text shorter than a shingle is one shingle."""
    words = (text or b"").translate(LOWER_AZ).split()
    if not words:
        return
    size = min(shingle, len(words))
    total, digest = len(words) - size + 1, xxhash.xxh64_intdigest
    for at in range(0, total, _CHUNK):
        n = min(_CHUNK, total - at)
        runs = zip(*(words[at + k : at + k + n] for k in range(size)), strict=True)
        yield np.fromiter((digest(b" ".join(r), seed) for r in runs), "<u8", n)


def _majority(chunks) -> int:
    """The 64 bits that are one in over half of the values; zero if there are none."""
    total, ones = 0, np.zeros((8, 8), np.int64)
    for hashes in chunks:
        total += len(hashes)
        for at in range(0, len(hashes), _CHUNK):
            part = hashes[at : at + _CHUNK]
            seen = np.bincount((part.view(np.uint8).reshape(-1, 8) + _COLUMN).ravel(), minlength=2048)
            ones += seen.reshape(8, 256) @ _BITS
    bits = (2 * ones.reshape(64) > total).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of UTF-8 text: a bit is one if it is set in over half of the XXH64 values."""
    return _majority(shingle_hashes(text, shingle, seed))


def covering_masks(radius: int = 3) -> list[int]:
    """The 2**(radius+1) - 1 signed 64-bit masks of a covering code."""
    labels = [i % (2 ** (radius + 1) - 1) + 1 for i in range(64)]
    masks = []
    for v in range(1, 2 ** (radius + 1)):
        mask = sum(1 << i for i, label in enumerate(labels) if bin(v & label).count("1") % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _fingerprint_batches(shingle: int):
    def run(batches):
        for batch in batches:
            prints = [fingerprint(t, shingle) for t in batch.column(2).to_pylist()]
            fp = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], fp], names=["id", "h", "fp"])

    return run


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links (u, v) with the smallest node that it reaches, itself left out."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def _cell_links(keys: list[np.ndarray], fp: np.ndarray, radius: int, room: int = 1 << 20):
    """Spanning links among rows that agree in all keys; rows come sorted by them."""
    change = np.ones(len(fp), bool)
    if len(fp) > 1:
        change[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    cell = np.cumsum(change)
    us, vs, held = [], [], 0
    left = np.arange(len(fp))
    for step in range(1, len(fp)):
        left = left[left < len(fp) - step]
        left = left[cell[left] == cell[left + step]]
        if not len(left):
            break
        near = left[np.bitwise_count((fp[left] ^ fp[left + step]).view(np.uint64)) <= radius]
        us.append(fp[near])
        vs.append(fp[near + step])
        held += len(near)
        if held > room:
            u, v = _forest(np.concatenate(us), np.concatenate(vs))
            us, vs, held = [u], [v], 0
            room = max(room, 2 * len(u))
    return _forest(np.concatenate(us), np.concatenate(vs)) if us and sum(map(len, us)) else (fp[:0], fp[:0])


def _link_batches(radius: int):
    """Over rows (t, key, cell, fp) sorted by the first three: links inside each cell, cells kept whole."""

    def run(batches):
        held: list[np.ndarray] | None = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)] if held else cols
            n = len(cols[0])
            if not n:
                continue
            same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
            cut = n - int(same.sum())
            held = [c[cut:] for c in cols]
            u, v = _cell_links([c[:cut] for c in cols[:3]], cols[3][:cut], radius)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        if held is not None:
            u, v = _cell_links(held[:3], held[3], radius)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def near_links(prints: DataFrame, radius: int = 3, block: int = 2048) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints `fp` at radius or fewer differing bits.

    Exact: a table's bucket of more than `block` fingerprints is cut into blocks, and every pair of its blocks is
    compared in a cell of its own, so no task holds more than two blocks of a bucket and nothing is capped. A cell
    gives a spanning forest of its links, not all pairs.
    """
    tables = F.array(
        *[
            F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
            for i, m in enumerate(covering_masks(radius))
        ]
    )
    keyed = prints.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    # written out, so that a hot bucket's join can be split
    sizes = save(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    cells = (
        keyed.join(sizes, ["t", "key"])
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .select("t", "key", "fp", "own", "blocks", other.alias("other"))
        .select("t", "key", (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).cast("long").alias("cell"), "fp")
    )
    dealt = cells.repartition("t", "key", "cell").sortWithinPartitions("t", "key", "cell")
    return dealt.mapInArrow(_link_batches(radius), "u long, v long")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (smallest id reachable by links), text_hash
    (xxhash64 of the text) and kept, true for one document of each component: the smallest (id, text_hash).

    Words are lower-cased A-Z runs without ASCII white space. A text without words (null, empty, blank) has
    fingerprint zero and is linked like any other; shorter than a shingle, the whole word sequence is the shingle.
    Repeated rows give repeated rows, kept or not alike. A null id takes no part in the smallest id; a component of null ids only has a
    null component. Other columns of the input are not read. An empty table gives an empty result.

    Cost: one pass over the texts, then only distinct fingerprints (exact copies collapse by a grouped minimum with
    map-side combining) meet in 15 tables; no text is shuffled.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).cast("binary").alias("text")
    )
    prints = save(rows.mapInArrow(_fingerprint_batches(shingle), "id long, h long, fp long"), "simhash")
    # null ids come last
    nodes = prints.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("rep"))
    stars = star_components(near_links(nodes.select("fp"), radius))
    rooted = nodes.join(stars, F.col("fp") == F.col("node"), "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("root")
    )
    lowest = save(rooted.groupBy("root").agg(F.min("rep").alias("first")), "lowest")
    labels = rooted.join(lowest, "root").select("fp", "first")
    return prints.join(labels, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        F.col("h").alias("text_hash"),
        (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h"))).alias("kept"),
    )


def _shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    chunks = [np.unique(c) for c in shingle_hashes(text, shingle)]
    return np.unique(np.concatenate(chunks)) if chunks else np.zeros(0, "<u8")


def _node(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes()) if len(shingles) else 0


#: 64-bit words of the fingerprint by which near_dedup searches.
_WIDE = ["fp", "fp1", "fp2", "fp3"]
#: The masks of its tables on each word: the eight bytes, then every eighth bit from the first four on.
_WIDE_MASKS = [255 << 8 * i for i in range(8)] + [0x0101010101010101 << i for i in range(4)]


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th 64 bits of each shingle; the first are its hash, others are drawn from it (SplitMix64)."""
    if not k:
        return hashes
    x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_fingerprint(shingles: np.ndarray) -> list[int]:
    """SimHash of a set of shingle hashes in four words of 64 bits."""
    return [_majority([_mixed(shingles, k)]) for k in range(len(_WIDE))]


def _wide_batches(shingle: int):
    """Rows (id, h, text) to (id, h, node, size, words of the fingerprint): node is a hash of the set of shingles."""

    def describe(text: bytes | None):
        found = _shingle_set(text, shingle)
        return _node(found), len(found), *wide_fingerprint(found)

    def run(batches):
        for whole in batches:
            for batch in text_slices(whole, 2):
                cols = zip(*map(describe, batch.column(2).to_pylist()), strict=True)
                longs = (pa.array(np.array(c, np.uint64).view(np.int64)) for c in cols)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *longs], names=["id", "h", "node", "size", *_WIDE])

    return run


def _near_prints(prints: np.ndarray, reach: int, small: int = 1024, tile: int = 128) -> np.ndarray:
    """For each column of `prints` (words x n) the smallest column that it reaches by links of `reach` or fewer bits.

    Exact: every pair is compared, `tile` columns with `small` others at a time, but for those that are connected already.
    The work grows with the square of n, the memory with n.
    """
    n = prints.shape[1]
    low = np.arange(n)
    rest = low
    while len(rest) > 1:
        before, a, b = low, rest[:tile], rest
        if (low[a] == low[a[0]]).all():
            b = rest[low[rest] != low[a[0]]]
        for lo in range(0, len(b), small):
            c = b[lo : lo + small]
            # no pair has more bits in some of the words than in all; all but the last leave few unlike pairs open
            bits = np.bitwise_count(prints[0][a][:, None] ^ prints[0][c])
            for word in prints[1:-1]:
                bits += np.bitwise_count(word[a][:, None] ^ word[c])
            i, j = np.divmod(np.flatnonzero(bits <= reach), len(c))
            i, j = a[i], c[j]
            open_ = low[i] != low[j]
            i, j = i[open_], j[open_]
            linked = np.bitwise_count(prints[:, i] ^ prints[:, j]).sum(axis=0, dtype=np.int64) <= reach
            if linked.any():
                roots, at = np.unique(low[np.stack([i[linked], j[linked]])], return_inverse=True)
                at = at.reshape(2, -1)
                joined = np.arange(n)
                joined[roots] = roots[spanning(at[0], at[1], len(roots))]
                low = joined[low]
        rest = rest[tile:]
        if low is not before:
            rest = rest[np.argsort(low[rest], kind="stable")]
    return low


def _wide_link_batches(reach: int):
    """Over rows (cell, words) sorted by cell: spanning links between the first words of each cell's fingerprints."""

    def links(rows: np.ndarray) -> pa.RecordBatch:
        low = _near_prints(rows[1:].view(np.uint64), reach)
        own = low != np.arange(len(low))
        return pa.RecordBatch.from_arrays([pa.array(rows[1][own]), pa.array(rows[1][low[own]])], names=["u", "v"])

    def run(batches):
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            cuts = (np.flatnonzero(np.diff(rows[0])) + 1).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, rows.shape[1]]):
                if lo == hi:
                    continue
                if held and held[-1][0, 0] != rows[0, lo]:
                    yield links(np.concatenate(held, axis=1))
                    held = []
                held.append(rows[:, lo:hi])
        if held:
            yield links(np.concatenate(held, axis=1))

    return run


def wide_links(prints: DataFrame, reach: int = 72, block: int = 1 << 16) -> DataFrame:
    """Links (u, v) between the first words `fp` of distinct fingerprints (columns _WIDE) that connect those at `reach` or
    fewer differing bits which share a table.

    48 tables each take eight bits of the fingerprint. At a similarity of 0.8 a bit agrees with 0.8485, eight bits with 0.27,
    so a pair shares no table once in three million times (sets of four and five shingles, the worst case: 0.8125, once in
    25,000); 39 of 256 bits differ, 48 for those, while unrelated ones differ in 128 (deviation 8). A bucket of more than
    `block` fingerprints is dealt in cells of two blocks, which grow with the root of their number; a cell gives a forest.
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in _WIDE_MASKS]
    tables = [F.struct(F.lit(t).alias("t"), F.col(w).bitwiseAND(F.lit(m).cast("long")).alias("key")) for t, (w, m) in enumerate(product(_WIDE, masks))]
    keyed = prints.select(*_WIDE, F.explode(F.array(*tables)).alias("k")).select(*_WIDE, "k.t", "k.key")
    # at most 256 keys a table
    sizes = save(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    blocks = F.ceil(F.sqrt(F.col("n") / block)).cast("int")
    cells = (
        keyed.join(F.broadcast(sizes.select("t", "key", blocks.alias("blocks"))), ["t", "key"])
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(F.xxhash64("t", "key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), *_WIDE)
    )
    dealt = cells.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(_wide_link_batches(reach), "u long, v long")


def _set_batches(shingle: int, room: int = 1 << 19):
    """Rows (node, text) to (node, set of shingle hashes); a batch holds one set or about `room` hashes."""

    def out(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "set"])

    def run(batches):
        for batch in batches:
            nodes, sets, held = [], [], 0
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                nodes.append(node)
                sets.append(_shingle_set(text.as_py(), shingle).view(np.int64))
                held += len(sets[-1])
                if held >= room:
                    yield out(nodes, sets)
                    nodes, sets, held = [], [], 0
            if nodes:
                yield out(nodes, sets)

    return run


def _tile_pairs(a: np.ndarray, b: np.ndarray, root: np.ndarray, size: np.ndarray, fp: np.ndarray, sets: pa.ListArray, reach: int, similarity: float, width: int = 4096):
    """The links (i, j) between nodes i of a and j of b with different roots: exact Jaccard similarities of pairs within
    `reach` bits, as products of 0/1 matrices over the shingles that several of the nodes have."""
    near = root[a][:, None] != root[b][None, :]
    near &= np.bitwise_count((fp[a][:, None] ^ fp[b][None, :]).view(np.uint64)) <= reach
    near &= np.minimum(size[a][:, None], size[b][None, :]) >= similarity * np.maximum(size[a][:, None], size[b][None, :])
    a, b, near = a[near.any(axis=1)], b[near.any(axis=0)], near[np.ix_(near.any(axis=1), near.any(axis=0))]
    if not len(a):
        return a, b
    both = np.unique(np.concatenate([a, b]))
    held = sets.take(pa.array(both))
    owner = np.repeat(np.arange(len(both)), np.diff(held.offsets.to_numpy()))
    _, column, times = np.unique(held.flatten().to_numpy(), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    left, right = np.searchsorted(both, a), np.searchsorted(both, b)
    common = np.zeros((len(a), len(b)), np.float32)  # counts below 2**24 are exact
    for lo in range(0, int(shared.sum()), width):
        start, end = np.searchsorted(column, (lo, lo + width))
        has = np.zeros((len(both), width), np.float32)
        has[owner[start:end], column[start:end] - lo] = 1
        common += has[left] @ has[right].T
    joint = common.astype(np.float64)
    i, j = np.nonzero(near & (joint / (size[a][:, None] + size[b][None, :] - joint) >= similarity))
    return a[i], b[j]


def _cell_pairs(side: np.ndarray, root: np.ndarray, size: np.ndarray, fp: np.ndarray, sets: pa.ListArray, reach: int, similarity: float, tile: int = 512):
    """Of one cell, for each node the smallest node that it reaches by links: of nodes of side 0 with those of side 1, and
    of those of side 2 with one another. Tile by tile; links go at once into a forest."""
    n = len(side)
    cut = lambda k: [x for lo in range(0, n, tile) if len(x := np.flatnonzero(side == k)[lo : lo + tile])]
    own = cut(2)
    pairs = [(a, b) for a in cut(0) for b in cut(1)] + [(a, b) for k, a in enumerate(own) for b in own[k:]]
    low = np.arange(n)
    for a, b in pairs:
        i, j = _tile_pairs(a, b, root, size, fp, sets, reach, similarity)
        if len(i):
            low = spanning(np.concatenate([i, np.arange(n)]), np.concatenate([j, low]), n)
    return low


def _cell_links_batches(reach: int, similarity: float):
    """Over rows (key, cell, side, node, root, size, fp, set) sorted by the first two: spanning links (u, v) of each cell."""

    def links(table: pa.Table) -> pa.RecordBatch:
        side, node, root, size, fp = (table[c].to_numpy() for c in ("side", "node", "root", "size", "fp"))
        low = _cell_pairs(side, root, size, fp, table["set"].combine_chunks(), reach, similarity)
        linked = np.flatnonzero(low != np.arange(len(low)))
        return pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[low[linked]])], names=["u", "v"])

    def run(batches):
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            key, cell = table["key"].to_numpy(), table["cell"].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True):
                if held and last != (key[lo], cell[lo]):
                    yield links(pa.concat_tables(held))
                    held = []
                held.append(table.slice(lo, hi - lo))
                last = key[lo], cell[lo]
        if held:
            yield links(pa.concat_tables(held))

    return run


#: Up to so many (node, hash) pairs, 16 bytes each, are broadcast; more are joined by a shuffle of the texts.
BROADCAST_HASHES = 1_000_000


def _sets(nodes: DataFrame, rows: DataFrame, shingle: int) -> DataFrame:
    """(node, set) for rows (node, any_h): the texts are read again."""
    wanted = save(nodes.select("node", F.col("any_h").alias("h")), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_HASHES else wanted
    texts = rows.select("h", "text").join(wanted, "h").select("node", "text")
    sets = texts.mapInArrow(_set_batches(shingle), "node long, set array<long>")
    return save(sets.dropDuplicates(["node"]), "sets")


def _similar(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (u, v) whose sets of shingles have the Jaccard similarity or more."""
    ends = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    sets = _sets(nodes.join(ends, "node"), rows, shingle)
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("set").alias("a")), "u")
    both = both.join(sets.select(F.col("node").alias("v"), F.col("set").alias("b")), "v")
    common = F.size(F.array_intersect("a", "b"))
    return both.where(common / (F.size("a") + F.size("b") - common) >= similarity).select("u", "v")


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    similarity: float = 0.8,
    reach: int = 28,
    block: int = 512,
    room: int = 2_000_000,
) -> DataFrame:
    """Rows as simhash_dedup gives them, with links between texts whose sets of word shingles have a Jaccard similarity
    of `similarity` or more. Every link is checked on the sets; a component is what such links connect.

    SimHash finds the candidates: fingerprints of 256 bits, of which 39 differ at 0.8, meet in tables of eight bits and
    are linked at 72 or fewer (`wide_links`; what that misses is said there). What such links connect is a group, and the
    Jaccard similarity of every pair of a group's texts is checked where `reach` or fewer of the first 64 bits differ, but for
    pairs that are connected already. First each text meets the smallest and the largest of its group, which connects most of
    a large group with few pairs. What is left of a group is compared in cells of two blocks
    that give spanning links, never pairs: the texts outside the group's largest root with one another and with those of
    that root, which need no comparing among themselves. Blocks grow with the root of their number (from `block` texts
    on), so that the sets dealt to cells grow with the power 1.5 of a group and not with its square, up to `room` shingles a
    block, which bounds a task's memory; a group beyond room * room / block shingles is dealt in more blocks of that size.

    Texts with equal sets (those without words too) are one node. Null ids, repeated rows and other columns are treated
    as by simhash_dedup.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).cast("binary").alias("text")
    )
    words = ", ".join(f"{w} long" for w in _WIDE)
    found = save(rows.mapInArrow(_wide_batches(shingle), f"id long, h long, node long, size long, {words}"), "prints")
    nodes = found.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("rep"), F.min("h").alias("any_h"), *[F.min(c).alias(c) for c in ("size", *_WIDE)])
    nodes = save(nodes, "nodes")
    stars = star_components(wide_links(nodes.where("size > 0").select(*_WIDE).distinct()))
    keyed = nodes.where("size > 0").join(stars.withColumnRenamed("node", "fp"), "fp", "left").select("node", "size", "fp", F.coalesce("component", "fp").alias("key"))
    end = F.struct("node", "size", "fp")
    # written out, so that a hot group's join can be split
    groups = keyed.groupBy("key").agg(F.min(end).alias("lo"), F.max(end).alias("hi")).where("lo.node <> hi.node")
    groups = save(groups, "groups")
    keyed = save(keyed.join(groups.select("key"), "key", "left_semi"), "keyed")
    met = keyed.join(groups, "key").select("node", "size", "fp", F.explode(F.array("lo", "hi")).alias("o")).where("node <> o.node")
    met = met.where(F.least("size", "o.size") >= similarity * F.greatest("size", "o.size"))
    met = met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("o.fp"))) <= reach)
    met = save(met.select(F.least("node", "o.node").alias("u"), F.greatest("node", "o.node").alias("v")).distinct(), "met")
    links = save(_similar(met, nodes, rows, shingle, similarity), "near-links")
    stars = save(star_components(links), "stars")
    rooted = keyed.join(stars, "node", "left").select("key", "node", "size", "fp", F.coalesce("component", "node").alias("root"))
    rooted = save(rooted, "rooted")
    per_root = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    main = F.max(F.struct("n", "shingles", "root")).alias("main")
    open_keys = per_root.groupBy("key").agg(F.sum("n").alias("n"), F.sum("shingles").alias("shingles"), F.count(F.lit(1)).alias("roots"), main)
    blocks = lambda n, shingles: F.greatest(F.ceil(F.sqrt(n / block)), F.ceil(shingles / room), F.lit(1)).cast("int")
    rest = blocks(F.col("n") - F.col("main.n"), F.col("shingles") - F.col("main.shingles"))
    open_keys = open_keys.where("n > 2 and roots > 1").select("key", F.col("main.root").alias("main"), rest.alias("a"), blocks(F.col("main.n"), F.col("main.shingles")).alias("p"))
    left = save(rooted.join(save(open_keys, "open"), "key"), "left")
    sets = _sets(nodes.join(left.select("node").distinct(), "node"), rows, shingle)
    left = left.withColumn("active", F.col("root") != F.col("main"))
    left = left.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("active"), F.col("a")).otherwise(F.col("p"))).cast("int"))
    left = left.withColumn("other", F.explode(F.expr("sequence(0, if(active, a + p, a) - 1)")))
    # cells of two active blocks come first, then those of an active one with one of the largest root
    cell = F.expr("if(not active, a * a + other * p + own, if(other < a, least(own, other) * a + greatest(own, other), a * a + own * p + other - a))")
    side = F.expr("if(not active, 1, if(other >= a, 0, if(own = other, 2, if(own < other, 0, 1))))")
    cells = left.withColumn("cell", cell.cast("long")).withColumn("side", side).join(sets, "node").select("key", "cell", "side", "node", "root", "size", "fp", "set")
    dealt = cells.repartition("key", "cell").sortWithinPartitions("key", "cell")
    links = links.unionByName(save(dealt.mapInArrow(_cell_links_batches(reach, similarity), "u long, v long"), "cell-links"))
    stars = star_components(links)
    rooted = nodes.join(stars, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("root"))
    lowest = save(rooted.groupBy("root").agg(F.min("rep").alias("first")), "lowest")
    labels = rooted.join(lowest, "root").select("node", "first")
    return found.join(labels, "node").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        F.col("h").alias("text_hash"),
        (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h"))).alias("kept"),
    )
