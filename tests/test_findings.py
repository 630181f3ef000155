"""Queries on tables that once gave wrong or costly results."""

import duckdb

import __spark_entry__  # noqa: F401  (registers the queries)
from tessera.plans.registry import ORACLE_SQL, QUERIES


def same_as_sql(spark, folder, name, tables):
    """Whether a query gives what its SQL does over tables written to a folder."""
    con = duckdb.connect()
    for t, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    df = QUERIES[name](spark, str(folder))
    got = sorted(map(repr, map(tuple, df.collect())))
    columns = ", ".join(f'"{c}"' for c in df.columns)
    return got == sorted(map(repr, con.sql(f"select {columns} from ({ORACLE_SQL[name]})").fetchall()))


def test_typed_validation_of_odd_texts(spark, tmp_path):
    """Toolchain words in a text, texts that are absent, empty or blank, and no id."""
    texts = ["run cmake", "gbench(x)", "ggbench g++ ctest", "CMakeLists import", "gtest catch2", None, "", " \n", "bench(", "plain"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (-9, "cmake")]
    assert same_as_sql(spark, tmp_path, "o28_typed_validation", {"documents": spark.createDataFrame(rows, "doc_id long, text string")})


def test_tasks_that_number_lines_grow_with_the_table(spark, monkeypatch):
    from tessera.plans import registry

    folder = "/root/testdata/sf0.001"
    whole = registry.numbered_lines(spark, folder)
    monkeypatch.setattr(registry, "LINES_A_TASK", 100)
    dealt = registry.numbered_lines(spark, folder)
    assert dealt.rdd.getNumPartitions() == whole.count() // 100 + 1
    assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()


def test_log_function_makes_no_frame_of_each_log(spark):
    from tessera.operators import logs

    logs.register_log_function(spark, {"words": lambda log: [tuple(w.split("=")) for w in log.split()]}, "parse_words", default="words")
    rows = spark.createDataFrame([(1, "a=PASSED b=FAILED a=FAILED"), (2, None)], "id long, log string")
    found = spark.sql("SELECT r.id, t.test, t.status FROM {rows} r, LATERAL parse_words(r.log, null) t", rows=rows)
    assert sorted(map(tuple, found.collect())) == [(1, "a", "FAILED"), (1, "b", "FAILED")]
    assert "ArrowEvalPythonUDTF" not in found._jdf.queryExecution().executedPlan().toString()


def test_quantiles_of_few_groups_are_no_shuffled_join(spark):
    from tessera.operators.ranking import exact_quantiles

    df = spark.createDataFrame([(g, float(v)) for g in "ab" for v in range(50)], "g string, x double")
    found = exact_quantiles(df, "x", {"mid": 0.5}, ["g"], parts=4)
    assert "strategy=broadcast" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [("a", 24.5), ("b", 24.5)]


def test_rings_of_single_calls_do_not_go_on(spark, monkeypatch):
    from tessera.operators import graph

    rounds = []
    saved = graph.save
    monkeypatch.setattr(graph, "save", lambda df, name: rounds.append(name) or saved(df, name))
    ring = [("g", i, (i + 1) % 64) for i in range(64)]
    edges = spark.createDataFrame([*ring, ("g", 100, 101), ("g", 101, 102)], "graph string, caller long, callee long")
    roots = spark.createDataFrame([("g", 100)], "graph string, node long")
    assert sorted(map(tuple, graph.min_depths(edges, roots).collect())) == [("g", 100, 0), ("g", 101, 1), ("g", 102, 2)]
    assert rounds.count("chains") < 5
