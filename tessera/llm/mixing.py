"""Mixing sources to target weights by a low-discrepancy schedule, DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, save

#: 2**31 over the golden ratio, odd: k * GOLDEN mod 2**31 is a Weyl sequence of lowest discrepancy. Its next 31 bits
#: shift every stretch of PERIOD points, so that the sequence goes on beyond them.
GOLDEN, SHIFT, PERIOD = 1327217885, 1607638789, 1 << 31
#: Slots numbered together; a count per stretch and source replaces a global ranking.
STRETCH = 8192


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """(s, source, source_size, weight, target) from rows (source, size).

    Sources in code-point order, null last, take the weights in turn. Targets share the total of all sizes by weight
    and stop at cap times the source's size: with sources sorted by cap * size / weight, the level of the water is
    the largest of (rest of the total) / (rest of the weights). One row per source goes through single-task windows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("s", F.row_number().over(order) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("s") % len(weights) + 1))
        .withColumn("most", F.col("source_size") * cap)
    )
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "s")
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(
        F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    level = left / F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    return (
        per.withColumn("level", level)
        .withColumn("target", F.least(F.col("most").cast("double"), F.max("level").over(everything) * F.col("weight")))
        .select("s", "source", "source_size", "weight", "target")
    )


def _running(over: Window, column: str) -> Column:
    return F.coalesce(F.sum(column).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def point(slot: str) -> str:
    """SQL of the point of a slot, in [0, 1)."""
    return f"(({slot} % {PERIOD} * {GOLDEN} + {slot} div {PERIOD} * {SHIFT}) % {PERIOD}) / {float(PERIOD)}D"


def slots(quotas: DataFrame, block: int) -> DataFrame:
    """The schedule: (slot, s, rank, y, block, part, pass_slots) for rows (s, source_size, quota).

    Slot k takes the point frac(k * golden ratio) through the cumulative slot counts of the sources; y is where in its
    source's interval the point lies. Ranked in slot order, a source's slots walk its blocks, pass after pass, until
    its quota of words is used: the last slot may take part (`part` words) of its block. A source that the points give
    fewer slots than it needs gets the rest behind the schedule, with the points of those slots. pass_slots: slots of
    the schedule that one pass over the source spans.
    """
    spark = quotas.sparkSession
    need = quotas.where("quota > 0").selectExpr(
        "s",
        "quota",
        "source_size",
        f"cast(ceil(source_size / {block}) as long) as blocks",
        "quota div source_size as passes",
        "quota % source_size as rest",
    )
    need = need.selectExpr("*", f"cast(ceil(rest / {block}) as long) as m").selectExpr("*", "passes * blocks + m as n")
    ordered = Window.orderBy("s")
    need = save(need.withColumn("low", _running(ordered, "n")), "quotas")
    total, sources = need.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, cells = total or 0, 4 * sources + 64
    whole = max(total, 1)
    ranges = need.selectExpr("s", f"low / {whole} as p", f"(low + n) / {whole} as q").selectExpr(
        "*", f"explode(sequence(cast(floor(p * {cells}) as int), cast(floor(q * {cells}) as int))) as cell"
    )
    points = spark.range(total).selectExpr("id as slot", f"{point('id')} as x").withColumn("cell", F.floor(F.col("x") * cells).cast("int"))
    placed = (
        points.join(ranges, "cell")
        .where("x >= p and x < q")
        .selectExpr("slot", "s", "(x - p) / (q - p) as y", f"slot div {STRETCH} as stretch")
    )
    counts = placed.groupBy("s", "stretch").agg(F.count(F.lit(1)).alias("c"))
    before = counts.select("s", "stretch", _running(Window.partitionBy("s").orderBy("stretch"), "c").alias("before"))
    within = F.row_number().over(Window.partitionBy("s", "stretch").orderBy("slot")) - 1
    ranked = placed.withColumn("r", within).join(before, ["s", "stretch"]).select("slot", "s", "y", (F.col("r") + F.col("before")).alias("rank"))
    got = counts.groupBy("s").agg(F.sum("c").alias("got"))
    short = (
        need.join(got, "s", "left")
        .selectExpr("s", "n", "coalesce(got, 0) as got")
        .where("got < n")
        .withColumn("at", _running(ordered, "n"))
        .selectExpr("s", "at", "explode(sequence(got, n - 1)) as rank")
        .selectExpr(f"{total} + at + rank as slot", "s", "rank")
        .selectExpr("slot", "s", f"{point('slot')} as y", "rank")
    )
    return (
        ranked.unionByName(short)
        .join(need, "s")
        .where("rank < n")
        .selectExpr(
            "slot",
            "s",
            "rank",
            "y",
            "rank % blocks as block",
            f"if(m > 0 and rank = n - 1, rest - (m - 1) * {block}, null) as part",
            f"blocks * {total}D / n as pass_slots",
        )
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    cap: int = 3,
    block: int = 1024,
    seed: str = "mix",
    chunk_rows: int = 2_000,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Mix whole documents to target weights: id, size, source_size, target, taken, first_slot, pass_slots (and the columns to carry).

    A source's documents are shuffled by MD5 of seed and id and laid end to end in a circle, which begins with the
    document that the point of the source's first slot hits; equal blocks of `block` words (the last one shorter) are
    what the slots of the schedule take, so the points say which documents get one more turn than others. `taken` counts a document's words in all slots that
    take its blocks; a source's sum is its target to the nearest word, and no document exceeds cap times its size.
    first_slot is the first slot that takes a word of the document (null: none does), pass_slots how many slots lie
    about between two turns of its source's blocks: the mix in order is that of first_slot + turn * pass_slots.

    A null text has size 0 and is never taken; a null id sorts first; a null source is a source, the last one. Empty
    tables give an empty result. Repeated rows are laid side by side and share what is taken. The same rows give the
    same mix in any partitioning. A hot source is positioned in chunks of its shuffled order (a window per chunk and
    running sums of chunk totals), so that no task holds a source.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    kept = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    at = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    sized = save(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), at.alias("at"), *kept), "sized")
    extra = [f"carry_{i}" for i in range(len(carry))]
    chunks = max(1, math.ceil(sized.count() / chunk_rows))
    sources = save(source_targets(sized, weights, cap), "sources")
    quotas = sources.selectExpr("s", "source_size", "cast(floor(target + 0.5) as long) as quota")
    schedule = save(slots(quotas, block), "slots")
    whole = F.col("part").isNull()
    takes = (
        schedule.groupBy("s", "block")
        .agg(
            F.count_if(whole).alias("full"),
            F.coalesce(F.max("part"), F.lit(0)).alias("part"),
            F.min(F.when(whole, F.col("slot"))).alias("full_slot"),
            F.min(F.when(~whole, F.col("slot"))).alias("part_slot"),
            F.max("pass_slots").alias("pass_slots"),
        )
    )
    chunk = F.expr(f"cast(conv(substr(at, 1, 8), 16, 10) as long) * {chunks} div 4294967296")
    laid = (
        sized.join(sources, sized["source"].eqNullSafe(sources["source"]))
        .select("s", "source_size", "target", "id", "size", "at", chunk.alias("chunk"), *extra)
    )
    totals = laid.groupBy("s", "chunk").agg(F.sum("size").alias("words"))
    offsets = totals.select("s", "chunk", _running(Window.partitionBy("s").orderBy("chunk"), "words").alias("base"))
    order = Window.partitionBy("s", "chunk").orderBy("at", "id", "size", *extra)
    placed = (
        laid.withColumn("start", _running(order, "size"))
        .withColumn("row", F.row_number().over(order))
        .join(offsets, ["s", "chunk"])
        .withColumn("start", F.col("start") + F.col("base"))
    )
    hit = schedule.where("rank = 0").select("s", "y")
    turned = (
        placed.where("size > 0")
        .join(hit, "s")
        .where("start <= y * source_size")
        .groupBy("s")
        .agg(F.max("start").alias("turn"))
    )
    placed = placed.join(turned, "s", "left").withColumn("start", F.expr("if(size > 0 and turn is not null, pmod(start - turn, source_size), start)"))
    blocks = F.when(
        F.col("size") > 0, F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")
    )
    pieces = (
        placed.withColumn("block", F.explode_outer(blocks))
        .withColumn("lo", F.greatest(F.col("start") - F.col("block") * block, F.lit(0)))
        .withColumn("hi", F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block)))
    )
    words = F.col("full") * (F.col("hi") - F.col("lo")) + F.greatest(F.least("part", "hi") - F.col("lo"), F.lit(0))
    return (
        pieces.join(takes, ["s", "block"], "left")
        .groupBy("s", "chunk", "row", "id", "size", "source_size", "target", *extra)
        .agg(
            F.coalesce(F.sum(words), F.lit(0)).alias("taken"),
            F.min(F.least("full_slot", F.when(F.col("part") > F.col("lo"), F.col("part_slot")))).alias("first_slot"),
            F.max("pass_slots").alias("pass_slots"),
        )
        .select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "first_slot", "pass_slots", *[F.col(e).alias(c) for e, c in zip(extra, carry, strict=True)])
    )
