"""Running values over sorted rows, by the tasks that sorted them.

A window over a whole group puts a hot group into one task. Here one range sort deals (group, order) to tasks, so a large
group spans many; each task's part gives one total, the totals of the parts before a part are its carry, and only the
rows of one part meet in a window. It works for whatever can be added up part by part: sums, counts, largest values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.shared import save


def swept(df: DataFrame, by: list[str], order: list[Column | str]) -> DataFrame:
    """df, written in order, with `_k` (the group as a struct, so that nulls are a group), `_part` and `_at`.

    Ties of `order` may be cut between tasks; give an order without ties where results depend on it.
    """
    key = F.struct(F.lit(0).alias("_one"), *by).alias("_k")
    tie = F.monotonically_increasing_id()
    rows = df.withColumn("_tie", tie).repartitionByRange(*by, *order, "_tie").sortWithinPartitions(*by, *order, "_tie").drop("_tie")
    rows = save(rows.withColumn("_at", F.monotonically_increasing_id()), "swept")
    return rows.select("*", key, F.shiftright("_at", 33).alias("_part"))


def carried(rows: DataFrame, values: dict[str, tuple[str, Column]], behind: bool = False) -> DataFrame:
    """rows of swept() with running values: {name: ("sum" or "max", column)}, up to and with each row; behind: without it.

    A sum before the first row is zero, a maximum null; nulls are left out.
    """
    fold = {"sum": F.sum, "max": F.max}
    made = rows.select("*", *[c.alias(f"_v_{n}") for n, (_, c) in values.items()])
    totals = made.groupBy("_k", "_part").agg(*[fold[kind](f"_v_{n}").alias(f"_c_{n}") for n, (kind, _) in values.items()])
    before = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select("_k", "_part", *[fold[kind](f"_c_{n}").over(before).alias(f"_c_{n}") for n, (kind, _) in values.items()])
    upto = Window.partitionBy("_k", "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1 if behind else 0)
    within = made.select("*", *[fold[kind](f"_v_{n}").over(upto).alias(f"_w_{n}") for n, (kind, _) in values.items()])

    def joined(n: str, kind: str) -> Column:
        if kind == "max":
            return F.greatest(f"_w_{n}", f"_c_{n}").alias(n)
        zero = F.lit(0)
        return (F.coalesce(f"_w_{n}", zero) + F.coalesce(f"_c_{n}", zero)).alias(n)

    return within.join(carries, ["_k", "_part"]).select(*rows.columns, *[joined(n, kind) for n, (kind, _) in values.items()])


def plain(rows: DataFrame) -> DataFrame:
    """Without the columns of the sweep."""
    return rows.drop("_k", "_part", "_at")
