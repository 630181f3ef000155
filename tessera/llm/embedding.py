"""Embedding near-dedup by int8 tile products with rigorous error bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import save, spanning, star_components


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows as int8 codes, scales and error norms: unit = scale * code + error, |error| = err."""
    scale = np.maximum(np.abs(unit).max(axis=1), 1e-300) / 127.0
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    err = np.linalg.norm(unit - scale[:, None] * code, axis=1)
    return code, scale, err * (1 + 1e-9) + 1e-12


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow of the squares
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _bounds(code: tuple, other: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Quantised cosines of two tiles and how far the true ones may be from them.

    |u.v - s_u s_v q_u.q_v| <= e_u (1 + e_v) + e_v (1 + e_u) + e_u e_v.
    """
    (q, s, e), (p, t, f) = code, other
    # integer-valued floats: exact in single precision up to 2**24 / 127**2 = 1040 dimensions
    kind = np.float32 if q.shape[1] <= 1000 else np.float64
    approx = (q.astype(kind) @ p.astype(kind).T).astype(np.float64)
    approx *= s[:, None]
    approx *= t[None, :]
    return approx, e[:, None] * (1 + f)[None, :] + f[None, :] * (1 + 2 * e)[:, None] + 1e-12


def _tiles(own: np.ndarray, one: bool, tile: int):
    """Pairs of index arrays (and whether they are one tile) that cover the pairs of a cell of one or two blocks."""
    blocks = [np.flatnonzero(own == b) for b in np.unique(own)]
    cut = [[b[k : k + tile] for k in range(0, len(b), tile)] for b in blocks]
    if one:
        yield from ((x, y, i == j) for i, x in enumerate(cut[0]) for j, y in enumerate(cut[0]) if i <= j)
    elif len(cut) == 2:
        yield from ((x, y, False) for x in cut[0] for y in cut[1])


class _Links:
    """Links of a cell: for each class the vectors linked, and spanning links."""

    def __init__(self, n: np.ndarray):
        self.n, self.links = n, np.zeros(len(n), np.int64)
        self.u = self.v = np.zeros(0, np.int64)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        size = len(self.n)
        self.links += (np.bincount(i, self.n[j], size) + np.bincount(j, self.n[i], size)).astype(np.int64)
        root = spanning(np.r_[i, self.u], np.r_[j, self.v], size)
        self.u = np.flatnonzero(root != np.arange(size))
        self.v = root[self.u]

    def rows(self, cid: np.ndarray, own: np.ndarray, open_: np.ndarray, a: int, b: int) -> pa.RecordBatch:
        """(u, v, links, own, a, b): counts, spanning links, and the classes of the cell that pairs are still open for."""
        got = np.flatnonzero(self.links)
        parts = (len(got), len(self.u), len(open_))
        which = np.repeat([0, 1, 2], parts)
        at = np.r_[got, self.u, open_].astype(np.int64)
        v = np.r_[np.zeros(len(got), np.int64), cid[self.v], np.zeros(len(open_), np.int64)]
        links = np.where(which == 0, self.links[at], 0)
        full = lambda x: pa.array(np.full(len(at), x, np.int32), mask=which != 2)
        arrays = [pa.array(cid[at]), pa.array(v, mask=which != 1), pa.array(links), pa.array(own[at].astype(np.int32), mask=which != 2), full(a), full(b)]
        return pa.RecordBatch.from_arrays(arrays, names=["u", "v", "links", "own", "a", "b"])


def _code_rows(cell: pa.Table, threshold: float, tile: int):
    """A cell of int8 codes: links that are sure, and the classes with pairs that may link or not."""
    cid, own, n = (cell[c].to_numpy() for c in ("cid", "own", "n"))
    q = np.frombuffer(b"".join(cell["code"].to_pylist()), np.int8).reshape(len(cid), -1)
    code = q, cell["scale"].to_numpy(), cell["err"].to_numpy()
    a, b = cell["a"][0].as_py(), cell["b"][0].as_py()
    found, open_ = _Links(n), np.zeros(len(cid), bool)
    for x, y, same in _tiles(own, a == b, tile):
        approx, bound = _bounds([c[x] for c in code], [c[y] for c in code])
        if same:
            approx[np.tril_indices(len(x))] = -9
        i, j = np.nonzero(approx >= threshold - bound)
        sure = approx[i, j] - bound[i, j] >= threshold
        found.add(x[i[sure]], y[j[sure]])
        open_[x[i[~sure]]] = open_[y[j[~sure]]] = True
    yield found.rows(cid, own, np.flatnonzero(open_), a, b)


def _exact_rows(cell: pa.Table, threshold: float, tile: int):
    """The open pairs of a cell, with vectors in double precision."""
    cid, own, n = (cell[c].to_numpy() for c in ("cid", "own", "n"))
    unit = _unit(cell["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(cid), -1))
    code = quantise(unit)
    a, b = cell["a"][0].as_py(), cell["b"][0].as_py()
    found = _Links(n)
    for x, y, same in _tiles(own, a == b, tile):
        approx, bound = _bounds([c[x] for c in code], [c[y] for c in code])
        if same:
            approx[np.tril_indices(len(x))] = -9
        i, j = np.nonzero((approx >= threshold - bound) & (approx - bound < threshold))
        for at in range(0, len(i), 100_000):
            k, m = x[i[at : at + 100_000]], y[j[at : at + 100_000]]
            linked = np.einsum("ij,ij->i", unit[k], unit[m]) >= threshold
            found.add(k[linked], m[linked])
    yield found.rows(cid, own, np.zeros(0, np.int64), a, b)


def _code_batches(batches):
    """Rows (cid, vector) to (cid, code, scale, err)."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 1000):
            batch = whole.slice(lo, 1000)
            vectors = batch.column(1)
            sizes, flat = np.diff(vectors.offsets.to_numpy()), vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            begin, codes = np.cumsum(sizes) - sizes, np.empty(len(sizes), object)
            scale, err = np.empty(len(sizes)), np.empty(len(sizes))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                q, scale[at], err[at] = quantise(_unit(flat[begin[at, None] + np.arange(size)]))
                codes[at] = [row.tobytes() for row in q]
            arrays = [batch.column(0), pa.array(codes.tolist(), pa.binary()), pa.array(scale), pa.array(err)]
            yield pa.RecordBatch.from_arrays(arrays, names=["cid", "code", "scale", "err"])


def _cell_batches(work, threshold: float, tile: int):
    """Over rows sorted by (group, dim, a, b): whole cells, one at a time, through `work`."""

    def key(table: pa.Table, i: int) -> tuple:
        return tuple(table[c][i].as_py() for c in ("grp", "dim", "a", "b"))

    def run(batches):
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            cols = [np.asarray(table[c].to_numpy(zero_copy_only=False)) for c in ("grp", "dim", "a", "b")]
            change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1 if len(cols[0]) > 1 else []
            for lo, hi in zip([0, *change], [*change, table.num_rows], strict=True):
                k = key(table, int(lo))
                if held and k != last:
                    yield from work(pa.concat_tables(held), threshold, tile)
                    held = []
                held.append(table.slice(int(lo), int(hi - lo)))
                last = k
        if held:
            yield from work(pa.concat_tables(held), threshold, tile)

    return run


def embedding_dedup(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    group_col: str = "label",
    threshold: float = 0.93,
    block: int = 1024,
    tile: int = 2048,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept; vectors link if their groups are equal and cosine >= threshold.

    Equal vectors of a group collapse to one class by a grouped count first. A group of n classes is dealt into blocks
    of sqrt(n * block) (block at least, 65,536 at most), and each pair of its blocks is one cell of work: a task holds
    the int8 codes of two blocks, and a cell gives link counts and spanning links, never its pairs. Codes are dealt
    once for every block of their group, so their copies grow with the root of n up to 4 million classes. Classes with
    pairs that the codes cannot decide meet again in their cell in double precision, and only they. The result is
    exact; the work is the pairs of classes of a group, so it grows with the square of the largest group.

    Null or zero vectors, those with null or non-finite components, and rows with a null group link with nothing and
    are kept as their own component. Vectors of different lengths do not link. Repeated rows are vectors of their
    own, linked with each other. A null id takes no part in the smallest id. Other columns of the input are not read.
    An empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(group_col).alias("grp_value"), F.col(vec_col).cast("array<double>").alias("vector"))
    fine = F.expr("grp_value is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vector, x -> x <> 0)")
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    classes = rows.where("fine").groupBy("grp_value", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = classes.select(F.monotonically_increasing_id().alias("cid"), "grp_value", F.size("vector").alias("dim"), "vector", "rep", "n")
    classes = save(classes, "classes")
    rows_a_block = F.least(F.lit(65_536), F.greatest(F.lit(block), F.sqrt(F.count(F.lit(1)) * block)))
    sizes = classes.groupBy("grp_value", "dim").agg(F.ceil(F.count(F.lit(1)) / rows_a_block).cast("int").alias("blocks"))
    codes = save(classes.select("cid", "vector").mapInArrow(_code_batches, "cid long, code binary, scale double, err double"), "codes")
    dealt = (
        classes.select("cid", "grp_value", "dim", "n")
        .join(codes, "cid")
        .join(sizes, ["grp_value", "dim"])
        .withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(F.col("grp_value").alias("grp"), "dim", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "cid", "n", "code", "scale", "err")
    )
    cell = ["grp", "dim", "a", "b"]
    schema = "u long, v long, links long, own int, a int, b int"
    dealt = dealt.repartition(*cell).sortWithinPartitions(*cell)
    sure = save(dealt.mapInArrow(_cell_batches(_code_rows, threshold, tile), schema), "links")
    open_ = (
        sure.where("a is not null")
        .select(F.col("u").alias("cid"), "own", "a", "b")
        .join(classes, "cid")
        .select(F.col("grp_value").alias("grp"), "dim", "a", "b", "own", "cid", "n", "vector")
    )
    open_ = open_.repartition(*cell).sortWithinPartitions(*cell)
    exact = save(open_.mapInArrow(_cell_batches(_exact_rows, threshold, tile), schema), "links")
    found = sure.where("a is null").unionByName(exact)
    counts = found.where("v is null").groupBy(F.col("u").alias("cid")).agg(F.sum("links").alias("links"))
    stars = star_components(found.where("v is not null").select("u", "v"))
    rooted = (
        classes.select("cid", "rep", "n", "grp_value", "vector")
        .join(counts, "cid", "left")
        .join(stars.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("root", F.coalesce("component", "cid"))
    )
    lowest = save(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "lowest")
    labels = rooted.join(lowest, "root").select(
        "grp_value", "vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    linked = rows.where("fine").join(labels, ["grp_value", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where("not fine").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
