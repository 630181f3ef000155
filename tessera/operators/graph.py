"""Call graphs: reachable parts, depths, ancestors; edges and flame layouts; greedy selection.

Searches go by equi-joins over all graphs at a time and write each round to the shared folder, which cuts the lineage.
Functions that have one caller and one callee are passed in one step, however many stand in a row.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.shared import save


def _chains(edges: DataFrame, ends: DataFrame, graph: str) -> DataFrame:
    """(graph, node, start, steps): for each node inside a chain the node that the chain comes from, and how far.

    Inside are nodes with one caller and one callee that are none of `ends`. Pointers to callers double each round, so a
    chain takes as many rounds as the logarithm of its length. Rings that nothing enters never reach a start; they are
    left out.
    """
    one = lambda end, other: edges.groupBy(graph, F.col(end).alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min(other).alias(other)).where("n = 1").drop("n")
    inside = one("callee", "caller").join(one("caller", "callee").select(graph, "node"), [graph, "node"]).join(ends.select(graph, "node"), [graph, "node"], "left_anti")
    inside = save(inside.select(graph, "node", F.col("caller").alias("start")), "inside")
    ends_of = inside.select(graph, F.col("node").alias("start"), F.lit(True).alias("more"))
    state = inside.join(ends_of, [graph, "start"], "left").select(graph, "node", "start", F.lit(1).alias("steps"), F.coalesce("more", F.lit(False)).alias("more"))
    state = save(state, "chains")
    done = state.where("not more")
    while True:
        # only what has not reached its start goes on; a chain settles some nodes each round, a ring none
        open_ = state.where("more")
        mid = done.unionByName(open_).select(graph, F.col("node").alias("start"), F.col("start").alias("_next"), F.col("steps").alias("_more"), F.col("more").alias("_open"))
        jumped = open_.join(mid, [graph, "start"])
        state = save(jumped.select(graph, "node", F.col("_next").alias("start"), (F.col("steps") + F.col("_more")).alias("steps"), F.col("_open").alias("more")), "chains")
        settled = state.where("not more")
        if settled.isEmpty():
            return done.drop("more")
        done = done.unionByName(settled)


def min_depths(edges: DataFrame, roots: DataFrame, graph: str = "graph") -> DataFrame:
    """(graph, node, depth): least number of calls from a root. edges (graph, caller, callee); roots (graph, node).

    Chains of single calls are edges with a length; a round takes all of them one edge on from what it has found or
    shortened, until nothing is. So the rounds are the calls between branches, and a chain of any length counts as one.
    """
    edges = save(edges.where("caller <> callee").select(graph, "caller", "callee").distinct(), "edges")
    roots = roots.select(graph, "node").distinct()
    chains = save(_chains(edges, roots, graph), "chains")
    # an edge out of a chain begins where the chain does; edges into chains need not be walked
    out = edges.join(chains.select(graph, F.col("node").alias("caller"), "start", "steps"), [graph, "caller"], "left")
    hops = out.select(graph, F.coalesce("start", "caller").alias("node"), "callee", (F.coalesce("steps", F.lit(0)) + 1).alias("length"))
    hops = save(hops.join(chains.select(graph, F.col("node").alias("callee")), [graph, "callee"], "left_anti"), "hops")
    frontier = found = every = save(roots.withColumn("depth", F.lit(0)), "depths")
    for level in count(1):
        step = frontier.join(hops, [graph, "node"]).groupBy(graph, F.col("callee").alias("node")).agg(F.min(F.col("depth") + F.col("length")).alias("depth"))
        known = found.select(graph, "node", F.col("depth").alias("_known"))
        frontier = save(step.join(known, [graph, "node"], "left").where("_known is null or depth < _known").drop("_known"), "depths")
        if frontier.isEmpty():
            break
        every = every.unionByName(frontier)
        found = every.groupBy(graph, "node").agg(F.min("depth").alias("depth"))
        if level % 10 == 0:
            every = found = save(found, "depths")
    inside = chains.join(found.select(graph, F.col("node").alias("start"), "depth"), [graph, "start"])
    return found.unionByName(inside.select(graph, "node", (F.col("depth") + F.col("steps")).alias("depth")))


def reachable(edges: DataFrame, roots: DataFrame, graph: str = "graph") -> DataFrame:
    return min_depths(edges, roots, graph).select(graph, "node")


def ancestors(edges: DataFrame, nodes: DataFrame, graph: str = "graph") -> DataFrame:
    """(graph, node): everything that calls one of the nodes, directly or not; the nodes themselves only if on a cycle."""
    back = edges.select(graph, F.col("callee").alias("caller"), F.col("caller").alias("callee"))
    first = nodes.join(back.withColumnRenamed("caller", "node"), [graph, "node"]).select(graph, F.col("callee").alias("node"))
    return reachable(back, first, graph)


def invert(callers: DataFrame) -> DataFrame:
    """Rows (func, callers: array of (caller, calls, tot_time, cum_time)) as edges (caller, callee, ...)."""
    return callers.select(F.col("func").alias("callee"), F.explode("callers").alias("c")).select("c.caller", "callee", "c.calls", "c.tot_time", "c.cum_time")


def weighted_depth(functions: DataFrame, depths: DataFrame, graph: str, weight: str) -> DataFrame:
    """Per graph the weighted mean depth over reachable functions and the share of weight that is reachable."""
    rows = functions.join(depths, [graph, "node"], "left")
    near = F.sum(F.when(F.col("depth").isNotNull(), F.col(weight)))
    return rows.groupBy(graph).agg(
        F.try_divide(F.sum(F.col(weight) * F.col("depth")), near).alias("avg_depth"),
        F.coalesce(F.try_divide(near, F.sum(weight)), F.lit(0.0)).alias("reachable_share"),
    )


def captured_gain(gold: DataFrame, pred: DataFrame, graph: str) -> DataFrame:
    """Share of the gold run's gain in functions that the prediction edits, in files that it edits only, and elsewhere.

    gold (graph, file, func, gain); pred (graph, file, func), the functions edited.
    """
    same = pred.select(graph, "file", "func").distinct().withColumn("_f", F.lit(1))
    files = pred.select(graph, "file").distinct().withColumn("_file", F.lit(1))
    rows = gold.join(same, [graph, "file", "func"], "left").join(files, [graph, "file"], "left")
    total = F.sum("gain")
    share = lambda condition: F.coalesce(F.try_divide(F.sum(F.when(condition, F.col("gain"))), total), F.lit(0.0))
    return rows.groupBy(graph).agg(
        share(F.col("_f").isNotNull()).alias("captured"),
        share(F.col("_f").isNull() & F.col("_file").isNotNull()).alias("in_file_loss"),
        share(F.col("_file").isNull()).alias("wrong_file_loss"),
    )


def flame_layout(edges: DataFrame, graph: str = "graph", root: str = "root") -> DataFrame:
    """Boxes (graph, node, depth, left, width): children share their parent's width by weight, in node order.

    edges (graph, parent, node, weight) form a tree under `root`; a node with several parents, or a root that has one,
    raises. One level is laid out at a time, to whatever depth; widths are products along the path, so a level is one
    join. What is not under the root has no box.
    """
    several = edges.groupBy(graph, "node").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | (F.col("node") == root)).first()
    if several:
        raise ValueError(f"the edges are no tree: {several['node']!r} has a parent too many")
    per = Window.partitionBy(graph, "parent")
    order = per.orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    share = edges.withColumn("part", F.col("weight") / F.sum("weight").over(per)).withColumn("before", F.coalesce(F.sum("weight").over(order), F.lit(0.0)) / F.sum("weight").over(per))
    share = save(share.select(graph, "parent", "node", "part", "before"), "shares")
    level = edges.select(graph).distinct().select(graph, F.lit(root).alias("node"), F.lit(0).alias("depth"), F.lit(0.0).alias("left"), F.lit(1.0).alias("width"))
    out = level
    for depth in count(1):
        above = level.select(graph, F.col("node").alias("parent"), F.col("left").alias("_l"), F.col("width").alias("_w"))
        placed = share.join(above, [graph, "parent"])
        level = save(placed.select(graph, "node", F.lit(depth).alias("depth"), (F.col("_l") + F.col("_w") * F.col("before")).alias("left"), (F.col("_w") * F.col("part")).alias("width")), "boxes")
        if level.isEmpty():
            return out
        out = out.unionByName(level)
        if depth % 20 == 0:
            out = save(out, "boxes")


def greedy_selection(nodes: DataFrame, graph: str, cap: float) -> DataFrame:
    """(graph, node): the choice of functions made from the deepest on, skipping callers of chosen ones, until their mass
    reaches `cap` of the graph's.

    nodes (graph, node, depth, mass, ancestors array, and share if there is one), a node once a graph. The order is by
    depth, share and mass, the largest first, then by node; nulls count as 0. The node that reaches the cap is still
    chosen, so a graph with nodes has one at least. Ancestors that are no nodes are ignored.

    The sequential rule in rounds for all graphs at a time: a node before which no undecided node can bar it is chosen, and
    bars its ancestors behind it. Only nodes with an ancestor that is a node, and these, take part in rounds; what is
    shuffled to find them is a hash and a row number for each ancestor. One range sort deals the chosen to tasks, which add
    up their parts; totals of the parts give the rest. No graph meets in one task.
    """
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    share = zero("share") if "share" in nodes.columns else F.lit(0.0)
    key = lambda c: F.xxhash64(graph, F.col(c).cast("string"))
    order = ["_d", "_s", "_m", "node"]
    ranked = nodes.select(graph, "node", zero("mass").alias("mass"), (-zero("depth")).alias("_d"), (-share).alias("_s"), (-zero("mass")).alias("_m"), "ancestors")
    ranked = save(ranked.withColumn("_at", F.monotonically_increasing_id()), "candidates")
    named = ranked.where(F.col(graph).isNotNull() & F.col("node").isNotNull())
    above = named.select(F.col("_at").alias("_from"), graph, F.explode("ancestors").alias("barred")).where("barred is not null")
    pairs = above.select("_from", key("barred").alias("_key")).join(named.select(F.col("_at").alias("_to"), key("node").alias("_key")), "_key")
    pairs = save(pairs.select("_from", "_to").distinct(), "pairs")
    ids = save(pairs.select(F.col("_from").alias("_at")).union(pairs.select("_to")).distinct(), "ids")
    bound = save(named.join(_bounded(ids), "_at", "left_semi"), "bound")
    # names as well, since hashes may collide
    end = lambda name: bound.select(F.col("_at").alias(name), F.struct(graph, "node", "ancestors", F.struct(*order).alias("rank")).alias(f"{name}_end"))
    bars = pairs.join(end("_from"), "_from").join(end("_to"), "_to").where(F.col(f"_from_end.{graph}") == F.col(f"_to_end.{graph}"))
    bars = save(bars.where("array_contains(_from_end.ancestors, _to_end.node) and _from_end.rank < _to_end.rank").select("_from", "_to"), "bars")
    left, refused = bound.select("_at"), None
    while True:
        free = save(left.join(bars.select(F.col("_to").alias("_at")), "_at", "left_anti"), "chosen")
        if free.isEmpty():
            break
        barred = save(bars.join(free.select(F.col("_at").alias("_from")), "_from", "left_semi").select(F.col("_to").alias("_at")).distinct(), "barred")
        refused = barred if refused is None else refused.unionByName(barred)
        left = save(left.join(free.unionByName(barred), "_at", "left_anti"), "undecided")
        bars = bars.join(left.select(F.col("_at").alias("_from")), "_from", "left_semi").join(left.select(F.col("_at").alias("_to")), "_to", "left_semi")
        bars = save(bars, "bars")
    chosen = named if refused is None else named.join(_bounded(save(refused, "refused")), "_at", "left_anti")
    dealt = chosen.select(graph, *order, "mass").repartitionByRange(graph, *order).sortWithinPartitions(graph, *order)
    dealt = dealt.select(graph, "node", "mass", F.xxhash64(graph).alias("_g"))
    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema}
    rows = save(dealt.mapInArrow(_running_batches, f"`{graph}` {kinds[graph]}, node {kinds['node']}, _part int, _row int, _mass double, _most double"), "running")
    parts = rows.groupBy(graph, "_part").agg(F.max_by("_mass", "_row").alias("_sum"), F.max("_mass").alias("_top"))
    before = Window.partitionBy(graph).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0.0))).withColumn("_full", F.max(F.col("_base") + F.col("_top")).over(before))
    caps = ranked.groupBy(graph).agg((F.sum("mass") * cap - 1e-12).alias("_cap"))
    parts = save(parts.join(caps, graph).where("_full is null or _full < _cap").select(graph, "_part", "_base", "_cap"), "parts")
    return rows.join(_bounded(parts), [graph, "_part"]).where("_most is null or _base + _most < _cap").select(graph, "node")


#: Up to so many rows of a few numbers are broadcast.
BROADCAST_ROWS = 2_000_000


def _bounded(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _running_batches(batches):
    """Over sorted rows (graph, node, mass, _g) of a task: the running mass of each graph, and its largest value before the row."""
    part, row, last, total, most = TaskContext.get().partitionId(), 0, None, 0.0, None
    for batch in batches:
        n, g, mass = batch.num_rows, batch.column(3).to_numpy(), batch.column(2).to_numpy().copy()
        upto, first = np.empty(n), np.zeros(n, bool)
        cuts = (np.flatnonzero(np.diff(g)) + 1).tolist()
        for lo, hi in zip([0, *cuts], [*cuts, n]):
            if lo == hi:
                continue
            new = g[lo] != last
            if not new:
                mass[lo] += total
            running = np.cumsum(mass[lo:hi])
            highest = np.maximum.accumulate(running if new else np.maximum(running, most))
            first[lo], upto[lo], upto[lo + 1 : hi] = new, 0.0 if new else most, highest[:-1]
            mass[lo:hi] = running
            last, total, most = g[lo], running[-1], highest[-1]
        at = pa.array(np.arange(row, row + n), pa.int32())
        row += n
        arrays = [*batch.columns[:2], pa.array(np.full(n, part), pa.int32()), at, pa.array(mass), pa.array(upto, mask=first)]
        yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:2], "_part", "_row", "_mass", "_most"])
