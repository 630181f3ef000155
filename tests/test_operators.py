"""Operators on small tables, against plain versions and by what their plans show."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph, joins, logs, ranking, rules, sampling, specs, sweep
from tessera.sources import datasets


def scans(df):
    """How often a plan reads its table, by the marks of its leaves."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [")


# ---- parsers ----


@pytest.fixture
def log_table(spark, tmp_path):
    rows = [
        (1, "Django/django", "t1 (x) ... ok\n  t2 (x) ... some output\n\nok\r\nt3 ... FAIL\nERROR: t4 (y)"),
        (2, "numpy/numpy", "PASSED a[1]\nPASSED a[2]\nFAILED b[1] - x"),
        (3, None, "PASSED a[1]\nFAILED a[1]\nPASSED"),
        (4, "sympy/sympy", "test_x ok [OK]\ntest_y F [FAIL]\n____ sympy/z.py:test_y ____\n__ sympy/z.py:test_q __"),
        (5, "sympy/sympy", "ran by pytest\n  sympy/a.py::t PASSED 3%\ntest_x ok"),
        (6, "mwaskom/seaborn", "FAILED one\ntwo PASSED 4%\nPASSED three"),
        (7, "numpy/numpy", None),
        (8, "numpy/numpy", ""),
    ]
    spark.createDataFrame(rows, "k int, repo string, log string").write.parquet(str(tmp_path / "logs"))
    return spark.read.parquet(str(tmp_path / "logs"))


def test_logs_of_many_parsers_are_read_once(spark, log_table):
    parsed = logs.parse_logs(log_table, ["k"], "log", "repo")
    assert scans(parsed) == 1
    found = {}
    for r in parsed.collect():
        found.setdefault(r.k, {})[r.test] = r.status
    assert found == {
        1: {"t1 (x)": "PASSED", "t2 (x)": "PASSED", "t3": "FAILED", "t4": "ERROR"},
        2: {"b": "FAILED"},
        3: {"a[1]": "FAILED"},
        4: {"test_x": "PASSED", "test_y": "FAILED", "sympy/z.py:test_y": "FAILED", "sympy/z.py:test_q": "FAILED"},
        5: {"sympy/a.py::t": "PASSED"},
        6: {"one": "FAILED", "two": "PASSED", "three": "PASSED"},
    }


def test_a_parser_that_is_any_function_reads_its_own_logs(spark, log_table):
    def sizes(frame, keys, text):
        return frame.select(*keys, F.lit("size").alias("test"), F.length(text).cast("string").alias("status"))

    logs.register_parser("Django/DJANGO", sizes)
    try:
        parsed = logs.parse_logs(log_table, ["k"], "log", "repo")
        assert scans(parsed) == 2 and [(r.test, r.status) for r in parsed.where("k = 1").collect()] == [("size", str(len(log_table.where("k = 1").first().log)))]
    finally:
        logs.register_parser("Django/DJANGO", logs.django_log)


def test_log_function_from_sql(spark):
    frame = spark.createDataFrame([(1, "a=1\na=0\nb=1", "X"), (2, "a=1", "none"), (3, None, "x"), (4, "c=?\n=1", "x"), (5, "z", None)], "k int, log string, parser string")
    logs.register_log_function(spark, {"x": logs.pattern_reader(r"^(?P<test>\w*)=(?P<status>.)$", {"1": "PASSED", "0": "FAILED"})}, "parse_eq")
    ask = "SELECT l.k, t.* FROM {f} l, LATERAL parse_eq(l.log, l.parser) t"
    assert sorted(map(tuple, spark.sql(ask, f=frame).collect())) == [(1, "a", "FAILED"), (1, "b", "PASSED")]
    # again, while the session runs: another format, and a default for all others
    logs.register_log_function(spark, {"x": lambda log: [(log[:1], "ERROR")]}, "parse_eq", default="X")
    assert {(r.k, r.test) for r in spark.sql(ask, f=frame).collect()} == {(1, "a"), (2, "a"), (4, "c"), (5, "z")}
    with pytest.raises(Exception, match="two strings"):
        spark.sql("SELECT * FROM parse_eq(1, 'x')").collect()
    with pytest.raises(ValueError, match="no groups"):
        logs.pattern_reader("(?P<test>x)", {})
    assert spark.sql(ask, f=frame.where("false")).count() == 0


# ---- call graphs ----


def plain_depths(edges, roots):
    import collections

    out = {}
    for g in {g for g, _ in roots}:
        todo = collections.deque((n, 0) for h, n in roots if h == g)
        while todo:
            n, d = todo.popleft()
            if (g, n) not in out:
                out[g, n] = d
                todo.extend((c, d + 1) for h, a, c in edges if h == g and a == n)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_depths_and_ancestors_of_cyclic_graphs(spark, seed):
    import random

    rng = random.Random(seed)
    edges = [(g, rng.randrange(30), rng.randrange(30)) for g in "ab" for _ in range(25 * seed)]
    edges += [("a", 100 + i, 101 + i) for i in range(20)] + [("a", 120, 3), ("a", 5, 100), ("b", 7, 200), ("b", 200, 201), ("b", 201, 200), ("b", 300, 301), ("b", 301, 300)]
    roots = [("a", 5), ("a", 110), ("b", 7), ("b", 7), ("c", 1)]
    frame = spark.createDataFrame(edges, "graph string, caller long, callee long")
    start = spark.createDataFrame(roots, "graph string, node long")
    got = {(r.graph, r.node): r.depth for r in graph.min_depths(frame, start).collect()}
    assert got == plain_depths(edges, roots)
    above = {(r.graph, r.node) for r in graph.ancestors(frame, start).collect()}
    back = [(g, c, a) for g, a, c in edges]
    assert above == set(plain_depths(back, [(g, c) for g, r in roots for h, a, c in back if (h, a) == (g, r)]))


def test_a_chain_of_100000_calls_takes_few_rounds(spark, monkeypatch):
    made = []
    real = graph.save
    monkeypatch.setattr(graph, "save", lambda df, name, *by: made.append(name) or real(df, name, *by))
    n = 100_000
    edges = spark.range(n).select(F.lit("g").alias("graph"), F.col("id").alias("caller"), (F.col("id") + 1).alias("callee"))
    found = graph.min_depths(edges, spark.createDataFrame([("g", 0)], "graph string, node long"))
    assert found.where("depth <> node").count() == 0 and found.count() == n + 1 and len(made) < 60


def test_flame_layout_of_a_deep_tree_and_of_none(spark):
    deep = 205
    edges = [("g", "root" if i == 0 else f"n{i - 1}", f"n{i}", 2.0) for i in range(deep)] + [("g", "n0", "z", 6.0), ("g", "lost", "alone", 1.0)]
    types = "graph string, parent string, node string, weight double"
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = {r.node: r for r in graph.flame_layout(spark.createDataFrame(edges, types).coalesce(1)).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(got) == deep + 2 and got[f"n{deep - 1}"].depth == deep and got[f"n{deep - 1}"].width == 0.25 and (got["z"].left, got["z"].width) == (0.25, 0.75)
    for bad in ([("g", "root", "a", 1.0), ("g", "a", "b", 1.0), ("g", "b", "a", 1.0)], [("g", "root", "a", 1.0), ("g", "a", "root", 1.0)]):
        with pytest.raises(ValueError, match="no tree"):
            graph.flame_layout(spark.createDataFrame(bad, types))


def plain_selection(nodes, cap):
    chosen, banned, mass = [], set(), 0.0
    for n, d, m, s, above in sorted(nodes, key=lambda x: (-(x[1] or 0), -(x[3] or 0), -(x[2] or 0), x[0])):
        if n in banned:
            continue
        chosen.append(n)
        mass += m or 0
        banned.update(above)
        if mass >= cap * sum(x[2] or 0 for x in nodes) - 1e-12:
            break
    return chosen


def test_greedy_selection_equals_the_rule_row_by_row(spark):
    import random

    rng = random.Random(8)
    graphs = {}
    for g in range(12):
        n = rng.randint(1, 40)
        graphs[g] = [(i, rng.choice([None, 0, 1, 2, 3]), rng.choice([-1.0, 0.0, 1.0, 2.5, None]), rng.choice([0.1, 0.2, None]), [rng.randrange(n + 2) for _ in range(rng.randint(0, 3))]) for i in range(n)]
    graphs[20] = [(0, 0, -1.0, 0.0, []), (1, 1, -2.0, 0.0, [])]  # no mass to speak of: the first alone
    rows = [(g, *x) for g, nodes in graphs.items() for x in nodes]
    frame = spark.createDataFrame(rows, "graph int, node int, depth int, mass double, share double, ancestors array<int>")
    for cap in (0.0, 0.5, 1.0):
        got = {}
        for r in graph.greedy_selection(frame, "graph", cap).collect():
            got.setdefault(r.graph, set()).add(r.node)
        assert got == {g: set(plain_selection(nodes, cap)) for g, nodes in graphs.items()}
    assert graph.greedy_selection(frame.where("false"), "graph", 0.5).count() == 0


def test_greedy_selection_rounds_hold_only_nodes_with_ancestors(spark, monkeypatch):
    """Of 1,000 nodes two are bound to one another; the rounds once wrote all of them."""
    written = []
    keep = graph.save
    monkeypatch.setattr(graph, "save", lambda df, name, *by: written.append((name, keep(df, name, *by))) or written[-1][1])
    rows = [(i % 3, f"n{i}", i % 5, 1.0, ["gone", "n3"] if i == 9 else None) for i in range(1000)] + [(None, "n3", 0, 1.0, ["n9"]), (0, None, 0, 1.0, [None])]
    frame = spark.createDataFrame(rows, "graph int, node string, depth int, mass double, ancestors array<string>")
    got = {(r.graph, r.node) for r in graph.greedy_selection(frame, "graph", 1.0).collect()}
    assert got == {(i % 3, f"n{i}") for i in range(1000)} - {(0, "n3")}
    assert max(df.count() for name, df in written if name in ("pairs", "bound", "chosen", "undecided")) <= 2


# ---- sweeps ----


@pytest.fixture
def small_parts(spark):
    """So small parts that a group spans several of them."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_a_group_with_most_rows_is_swept_in_parts(spark, small_parts):
    df = spark.range(2000).select(F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, None).otherwise("cold").alias("g"), (F.col("id") * 7 % 2000).alias("t"), (F.col("id") % 5).alias("v"))
    rows = sweep.swept(df, ["g"], ["t"])
    sizes = [r["count"] for r in rows.groupBy("_k", "_part").count().collect()]
    assert max(sizes) < 600 and len(sizes) >= 7
    got = sweep.plain(sweep.carried(sweep.carried(rows, {"s": ("sum", F.col("v"))}), {"m": ("max", F.col("s") % 17)}, behind=True)).collect()
    for g in ("hot", "cold", None):
        total, most = 0, None
        for r in sorted((r for r in got if r.g == g), key=lambda r: r.t):
            total += r.v
            assert (r.s, r.m) == (total, most)
            most = max(total % 17, most if most is not None else -1)
    assert sweep.carried(sweep.swept(df.where("false"), ["g"], ["t"]), {"s": ("sum", F.col("v"))}).count() == 0


def test_ranges_are_held_and_merged_in_a_sweep(spark, small_parts):
    import random

    rng = random.Random(3)
    make = lambda n, width: [(rng.choice(["hot", "hot", "hot", "x", None]), b, b + rng.randint(-1, width)) for b in (rng.randrange(400) for _ in range(n))]
    outer, inner = make(150, 20) + [("x", 0, 10**9)], make(300, 6)
    types = "g string, begin long, end long"
    got = joins.covering_ranges(spark.createDataFrame(outer, types), spark.createDataFrame(inner, types), ["g"]).collect()
    assert {tuple(r) for r in got} == {i for i in inner if any(o[0] == i[0] and o[1] < o[2] and o[1] <= i[1] and o[2] >= i[2] for o in outer)} and len(got) == len({tuple(r) for r in got})
    merged = sorted(((r.g, r.begin, r.end) for r in ranking.merge_intervals(spark.createDataFrame(outer, types), ["g"]).collect()), key=str)
    plain = []
    for g in ("hot", "x", None):
        for b, e in sorted((b, e) for h, b, e in outer if h == g and e > b):
            if plain and plain[-1][0] == g and b <= plain[-1][2]:
                plain[-1] = (g, plain[-1][1], max(e, plain[-1][2]))
            else:
                plain.append((g, b, e))
    assert merged == sorted(plain, key=str)


def test_comments_stop_at_the_first_late_one_by_place(spark):
    items = spark.createDataFrame([(1, 10), (2, 10), (3, None), (4, 5)], "k int, cutoff int")
    comments = spark.createDataFrame([(1, 1, 3, "a"), (1, 2, 12, "late"), (1, 3, 4, "after"), (2, 1, None, "when?"), (2, 2, 9, "b"), (3, 1, 1, "c")], "k int, place int, t int, text string")
    by_place = {r.k: r.hints for r in joins.comments_before(items, comments, "k", "cutoff", "t", "text", "place").collect()}
    assert by_place == {1: "a", 2: "b", 3: None, 4: None}
    assert {r.k: r.hints for r in joins.comments_before(items, comments, "k", "cutoff", "t", "text").collect()}[1] == "a\nafter"


# ---- samples ----


def plain_sample(rows, keys, size, bins, seed):
    """The steps of the sample over plain lists; keys: {(tag, id): u}."""
    import numpy as np

    metrics = ["a", "b", "c"]
    size = min(size, len(rows))
    edges = {m: sampling.log_edges_of(min((r[m] for r in rows.values() if r[m] > 0), default=None), max((r[m] for r in rows.values() if r[m] > 0), default=None), bins)[1:-1] for m in metrics}
    place = {i: {m: 0 if r[m] <= 0 else sum(r[m] >= e for e in edges[m]) for m in metrics} for i, r in rows.items()}
    rng, part, chosen = np.random.default_rng(seed), size // 3, {}
    sizes = {m: [sum(p[m] == b for p in place.values()) for b in range(bins)] for m in metrics}
    for m, share in zip(metrics, [part, part, size - 2 * part], strict=True):
        dealt = rng.multinomial(share, np.array(sizes[m]) / sum(sizes[m]))
        own, pool, lacking = [], [], 0
        for b in range(bins):
            members = sorted((i for i in rows if place[i][m] == b), key=lambda i: (keys[m, i], i))
            if dealt[b]:
                own += members[: dealt[b]]
                pool += members[dealt[b] :]
                lacking += max(0, dealt[b] - len(members))
        own += sorted(pool, key=lambda i: (keys[f"more {m}", i], i))[:lacking]
        for i in own:
            chosen.setdefault(i, m)
    weight = {i: np.prod([float(sizes[m][place[i][m]]) for m in metrics]) for i in rows}
    rest = sorted((i for i in rows if i not in chosen), key=lambda i: -np.log(keys["rest", i]) * weight[i])
    return chosen | {i: "rest" for i in rest[: size - len(chosen)]}


@pytest.mark.parametrize("size", [1, 40, 150, 10_000])
def test_quota_sample_equals_its_steps(spark, size):
    import random

    rng = random.Random(size)
    rows = {i: {"a": rng.choice([0.0, -1.0, 1.0, 2.0]) * rng.random(), "b": rng.expovariate(1) ** 3, "c": float(rng.choice([5, 5, 5, 500]))} for i in range(200)}
    data = [(i, r["a"], r["b"], r["c"], "x") for i, r in rows.items()] + [(None, 1.0, 1.0, 1.0, "x"), (900, None, 1.0, 1.0, "x"), (901, float("nan"), 1.0, 1.0, "x"), (902, float("inf"), 1.0, 1.0, "x"), (0, *rows[0].values(), "again")]
    frame = spark.createDataFrame(data, "id long, a double, b double, c double, via string")
    tags = [t for m in "abc" for t in (m, f"more {m}")] + ["rest"]
    ids = spark.createDataFrame([(i,) for i in rows], "id long")
    keys = {(t, r.id): r.u for t in tags for r in ids.select("id", sampling.uniform(9, t, "id").alias("u")).collect()}
    got = sampling.quota_sample(frame, "id", ["a", "b", "c"], size, bins=6, seed=9).collect()
    assert len(got) == min(size, 200) and {r.id: r.via for r in got} == plain_sample(rows, keys, size, 6, 9)


def test_sample_of_nothing(spark):
    frame = spark.createDataFrame([], "id long, a double, b double, c double")
    assert sampling.quota_sample(frame, "id", ["a", "b", "c"], 5).collect() == []


# ---- rules and datasets as tables ----

PULLS = [
    (1, "astropy/astropy", "Speed up the eff of x", "b", ["docs"]), (2, "Astropy", "typo", None, ["Performance!"]), (3, "x/astropy", "a", "perf in the body", None), (4, "o/dask", "avoid copies", "", []),
    (5, "o/other", "perf", "", ["performance"]), (6, None, "perf", "", []), (7, "o/xarray", None, None, [None, "topic-performance"]), (8, "o/numpy", "Fix typo: efficiency", "", []),
]


def test_rules_are_rows(spark):
    types = "n int, repo string, title string, body string, labels array<string>"
    pulls = spark.createDataFrame(PULLS, types)
    known = rules.known_rules(spark)
    got = {r.n: (r.passes, r.by) for r in rules.apply_rules(pulls, known).collect()}
    short = F.lower(F.substring_index("repo", "/", -1))
    want = {r.n: r.w for r in pulls.where("n <> 5 and n <> 6").select("n", specs.repo_pull(short, F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")), F.coalesce("labels", F.array().cast("array<string>"))).alias("w")).collect()}
    assert {n: got[n][0] for n in want} == want and got[1][0] and got[5] == got[6] == (False, 0)
    # a row more, no code: of one repository, and of all without their own
    more = spark.createDataFrame([("O/OTHER", "labels", "equals", ["PERFORMANCE", None], None), ("o/other", "title", "matches", ["^q"], False), (None, "body", "contains", [""], True)], rules.RULE)
    again = {r.n: r.passes for r in rules.apply_rules(pulls, known.unionByName(more)).collect()}
    assert again == {n: p for n, (p, _) in got.items()} | {5: True, 6: True}
    assert {r.n: r.passes for r in rules.apply_rules(pulls, known.where("false"), otherwise=F.col("n") == 3).collect()} == {n: n == 3 for n, *_ in PULLS}
    with pytest.raises(Exception, match="no rule on title by guess"):
        rules.apply_rules(pulls, spark.createDataFrame([(None, "title", "guess", ["x"], True)], rules.RULE)).collect()


def test_first_of_union(spark):
    make = lambda *rows: spark.createDataFrame(rows, "k string, o int, v string")
    got = rules.first_of_union([make(("b", 2, "1"), ("a", 1, "1")), make(("a", 0, "2"), ("c", 0, "2"), ("d", 1, "2"), (None, 2, "2"))], "k", ["o"], 4).collect()
    assert [tuple(r) for r in got] == [("a", 1, "1"), ("b", 2, "1"), ("c", 0, "2"), ("d", 1, "2")]


def test_dataset_revisions(spark, tmp_path):
    root, types = str(tmp_path / "set"), "instance_id string, v int"
    make = lambda *rows: spark.createDataFrame(rows, types).repartitionByRange(2, "instance_id")
    read = lambda split="test", **kw: sorted(map(tuple, datasets.load(spark, root, types, split, **kw).collect()))
    with pytest.raises(ValueError, match="no split"):
        read()
    assert datasets.commit(make(("a", 1), ("b", 2), ("c", 3), ("d", 4)), root, "test") == 1
    assert datasets.commit(make(("x", 9)), root, "dev") == 2
    assert datasets.commit(make(("e", 5)), root, "test", mode="append") == 3
    assert datasets.commit(make(("a", 1), ("b", 7)), root, "test") == 4
    assert datasets.commit(make(), root, "dev") == 5
    assert read(revision=1) == read(revision=2) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)] and read(revision=3)[-1] == ("e", 5)
    assert read() == [("a", 1), ("b", 7)] and read("dev") == [] and read("dev", revision=4) == [("x", 9)]
    some = datasets.load(spark, root, types, "test", ids=["a"], revision=1)
    assert [tuple(r) for r in some.collect()] == [("a", 1)] and len(some.inputFiles()) == 1  # of two files
    for ask, what in (({"ids": ["a", "gone"]}, "gone"), ({"revision": 9}, "no revision 9"), ({"split": "none"}, "no split none"), ({"split": "dev", "revision": 1}, "no split dev")):
        with pytest.raises(ValueError, match=what):
            read(**ask)
    assert sorted(map(tuple, datasets.changes(spark, root, "test", 1, 4).collect())) == [("b", "changed"), ("c", "removed"), ("d", "removed")]
    assert [tuple(r) for r in datasets.changes(spark, root, "test", 1, 3).collect()] == [("e", "added")]
    for bad in ([("a", 1), ("a", 2)], [(None, 1)]):
        with pytest.raises(ValueError, match="null or stand twice"):
            datasets.commit(make(*bad), root, "test")
    with pytest.raises(ValueError, match="stand twice"):
        datasets.commit(make(("b", 2)), root, "test", mode="append")
    assert read() == [("a", 1), ("b", 7)]  # failed commits left no revision


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "set")
    frame = spark.createDataFrame([("a",)], "instance_id string")
    datasets.commit(frame, root, "test")
    real = datasets._revision
    monkeypatch.setattr(datasets, "_revision", lambda s, r, k: 0 if k is None else real(s, r, k))  # it has not seen the other's commit
    with pytest.raises(Exception, match="(?i)already exists"):
        datasets.commit(frame, root, "test")
