"""Every query of the registry against its SQL on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__
from tessera.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else f"{v:.6g}" if v else "0"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return v.isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    sql = ORACLE_SQL[name]
    assert sorted(duck.sql(sql).columns) == columns
    want = sorted(tuple(map(plain, r)) for r in duck.sql("select {} from ({})".format(", ".join(f'"{c}"' for c in columns), sql)).fetchall())
    assert got == want


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_queries_without_sql_have_rows(spark):
    for name in set(QUERIES) - set(ORACLE_SQL):
        assert QUERIES[name](spark, SF).count() > 0, name


def test_depths_end_with_the_graph_only(spark, tmp_path):
    from tessera.operators import graph

    spark.sparkContext.setCheckpointDir(str(tmp_path))
    edges = spark.createDataFrame([("g", i, i + 1) for i in range(205)] + [("g", 205, 0)], "graph string, caller long, callee long")
    roots = spark.createDataFrame([("g", 0)], "graph string, node long")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = {r.node: r.depth for r in graph.min_depths(edges.coalesce(1).cache(), roots.coalesce(1)).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == {i: i for i in range(206)}


def test_greedy_selection_respects_ancestors_and_cap(spark):
    from tessera.operators.graph import greedy_selection

    rows = [("g", "a", 0, 10.0, []), ("g", "b", 1, 5.0, ["a"]), ("g", "c", 2, 3.0, ["a", "b"]), ("g", "d", 1, 4.0, ["a"])]
    nodes = spark.createDataFrame(rows, "graph string, node string, depth int, mass double, ancestors array<string>")
    assert sorted(r.node for r in greedy_selection(nodes, "graph", 1.0).collect()) == ["c", "d"]
    assert [r.node for r in greedy_selection(nodes, "graph", 0.1).collect()] == ["c"]


def test_exact_quantiles_equal_sorted_values(spark):
    import numpy as np

    from tessera.operators.ranking import exact_quantiles, quantile_bins

    rng = np.random.default_rng(3)
    groups = {"hot": rng.normal(0, 100, 3000), "ties": rng.integers(0, 4, 500).astype(float), "one": np.array([2.5]), None: rng.random(11)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("hot", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    wanted = {"low": 0.0, "a": 0.05, "mid": 0.5, "b": 0.95, "high": 1.0}
    got = {r.g: [r[n] for n in wanted] for r in exact_quantiles(df, "x", wanted, ["g"], parts=8).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx(list(np.quantile(vs, list(wanted.values()))))
    whole = exact_quantiles(df, "x", wanted, parts=8).collect()
    assert list(whole[0]) == pytest.approx(list(np.quantile(np.concatenate(list(groups.values())), list(wanted.values()))))
    assert exact_quantiles(df.limit(0), "x", wanted).isEmpty() and quantile_bins(df.limit(0), "x", 3).isEmpty()


def test_sample_is_without_repeats_and_covers_strata(spark):
    from tessera.operators.ranking import stratified_sample

    df = spark.range(1000).selectExpr("id", "if(id < 950, 'big', 'small') as s")
    rows = stratified_sample(df, ["s"], 60, 3, "id").collect()
    assert len({r.id for r in rows}) == 60 and sum(r.s == "small" for r in rows) >= 15
    assert rows == stratified_sample(df.repartition(3), ["s"], 60, 3, "id").collect()
