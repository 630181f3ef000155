"""Column functions and operators on small cases whose results are plain to see."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import bins, diffs, hunks, perf, text
from tessera.operators import curate, flaky, joins, logs, ranking, scoring
from tessera.sources import readers, writers


def value(spark, column, **columns):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()]) if columns else spark.range(1)
    return row.select(column.alias("v")).first().v


SUMMARY = "Before Mean: 0.3223\nBefore SD: 0.0029\nAfter Mean: 6.35e-2\nAfter SD: 0.0004\nImprovement: 507.56%"


@pytest.mark.parametrize(
    ("said", "label", "position"),
    [
        (SUMMARY, (0.3223, 0.0029, 0.0635, 0.0004), (0.3223, 0.0029, 0.0635, 0.0004)),
        ("Before Mean: 2 (SD: 1)\nAfter Mean: 1 (SD: 0.5)", (2, 1, 1, 0.5), (0, 0, 0, 0)),
        ("Before Mean: 1\nBefore SD: 2\nAfter Mean: 3", None, (0, 0, 0, 0)),
        ("", None, (0, 0, 0, 0)),
    ],
)
def test_perf_summaries(spark, said, label, position):
    got = value(spark, perf.perf_by_label(F.lit(said)))
    assert (tuple(got) if got else None) == label
    assert tuple(value(spark, perf.perf_by_position(F.lit(said)))) == position


def test_strict_summary_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, perf.perf_by_position(F.lit("a: x\nb: 1\nc: 1\nd: 1"), strict=True))


def test_significance_edges(spark):
    case = lambda b, a, s: value(spark, perf.is_significant(F.lit(b), F.lit(a), F.lit(s)))
    assert [case(2.0, 1.0, 0.4), case(2.0, 1.0, 0.5), case(2.0, 1.0, 0.0), case(1.0, 1.0, 0.0), case(1.0, 2.0, 0.0)] == [True, False, True, False, False]


def test_means(spark):
    df = spark.createDataFrame([(0.5,), (2.0,), (float("nan"),), (0.0,)], "x double")
    assert df.agg(perf.harmonic_mean(F.col("x"))).first()[0] == pytest.approx(4 / (2 + 0.5 + 1000))
    assert df.agg(perf.harmonic_mean(F.col("x"), None)).first()[0] == 0
    assert df.agg(perf.harmonic_mean_positive(F.col("x"))).first()[0] == pytest.approx(0.8)
    assert df.agg(perf.geometric_mean(F.col("x"))).first()[0] == pytest.approx(1.0)
    assert df.where("false").agg(perf.harmonic_mean(F.col("x"))).first()[0] == 0
    hm, gm, am = spark.range(1, 50).select(F.col("id").cast("double").alias("x")).agg(perf.harmonic_mean(F.col("x")), perf.geometric_mean(F.col("x")), F.avg("x")).first()
    assert hm <= gm <= am


def test_units_and_prices(spark):
    assert value(spark, perf.to_seconds(F.lit(2.0), F.lit("us"))) == 2e-6
    with pytest.raises(Exception, match="unknown time unit"):
        value(spark, perf.to_seconds(F.lit(2.0), F.lit("h")))
    with pytest.raises(Exception, match="more cached"):
        value(spark, perf.token_cost(F.lit(1), F.lit(2), F.lit(0), F.lit(1.0), F.lit(1.0), F.lit(1.0)))


EDGES = [1.0, 2.0, 4.0]


@pytest.mark.parametrize(
    ("closed", "keep", "want"),
    [("left", False, [None, 0, 0, 1, None]), ("left", True, [None, 0, 0, 1, 1]), ("right", False, [None, None, 0, 0, 1]), ("right", True, [None, 0, 0, 0, 1])],
)
def test_bins_at_edges(spark, closed, keep, want):
    df = spark.createDataFrame([(x,) for x in (0.5, 1.0, 1.5, 2.0, 4.0)], "x double")
    got = [r[0] for r in df.select(bins.bin_index(F.col("x"), EDGES, closed, keep)).collect()]
    assert got == [None if w is None else (1 if closed == "left" and x == 2.0 else w) for w, x in zip(want, (0.5, 1.0, 1.5, 2.0, 4.0), strict=True)]
    assert bins.log_edges(1, 100, 2)[1] == pytest.approx(10)


def test_keywords(spark):
    said = lambda t, **kw: value(spark, text.mentions_performance(F.lit(t), **kw))
    assert said("FastAPI and breakfast") is False and said("a fast loop") is True
    assert said("high CPU usage") is False  # upper case never meets lower-cased text
    assert said("<!-- cache -->") is False and said("<!-- PERF -->", verbatim=True) is True
    assert said("lazy loading") is False and said("lazy loading", extended=True) is True
    pull = lambda title, body, labels: value(spark, text.performance_pull(F.lit(title), F.lit(body), F.array(*map(F.lit, labels))))
    assert pull("Bump x", "faster", ["performance"]) is False and pull("x", None, ["Speed-up"]) is True and pull(None, None, []) is False


def test_issue_references_keep_the_last_number_of_a_word(spark):
    got = value(spark, text.resolved_issues(F.lit("Fixes #1 fixes #2 Fixes #3 see #4 <!-- closes #5 -->")))
    assert got == ["3", "2"]


def test_code_blocks(spark):
    said = "x\n```py\na = 1\n```\n```suggestion\nno\n```\n```\nb\n```"
    assert value(spark, text.first_code_block(F.lit(said))) == "a = 1"
    assert value(spark, text.code_blocks(F.lit(said))) == ["a = 1\n", "b\n"]
    assert value(spark, text.first_code_block(F.lit("none"))) is None


@pytest.mark.parametrize(("raw", "want"), [("120101", "12.1"), ("1.2.3", "1.2"), ("v3", "3"), ("(x)", None), (" 10.2 (lts)", "10.2")])
def test_packed_versions(spark, raw, want):
    assert value(spark, text.packed_version(F.lit(raw))) == want


def test_versions(spark):
    assert value(spark, text.find_version(F.lit('"""__version__ = "9.9" """\nVERSION = (1, 10, 2)'))) == "1,10,2"
    assert value(spark, text.major_minor(F.lit("1,10,2"))) == "1,10".replace(",", "")
    assert value(spark, text.find_version(F.lit("none"))) is None
    assert value(spark, text.full_version(F.lit(" v1.2.3-rc1 "))) == "1.2.3-rc1" and value(spark, text.full_version(F.lit("v"))) is None
    assert [value(spark, text.min_python(F.lit(s))) for s in (">=3.8,<4", "==3.9.*", "~=3")] == ["3.8", "3.9", "3.10"]


DIFF = """diff --git a/src/a b.py b/src/a b.py
--- a/src/a b.py
+++ b/src/a b.py
@@ -3,3 +3,4 @@ def f():
 kept
-old
+new
+more
 end
diff --git a/old.py b/tests/test_new.py
similarity index 100%
rename from old.py
rename to tests/test_new.py
diff --git a/x.png b/x.png
Binary files a/x.png and b/x.png differ"""


def test_diffs(spark):
    got = value(spark, diffs.edits(F.lit(DIFF)))
    assert [(e.source, e.dest, e.content == "") for e in got] == [("src/a b.py", "src/a b.py", False), ("old.py", "tests/test_new.py", False), ("x.png", "x.png", True)]
    assert value(spark, diffs.touches_tests(F.lit(DIFF))) is True and value(spark, diffs.modified_lines(F.lit(DIFF))) == 3
    assert value(spark, diffs.edits(F.lit(" \n"))) == [] and value(spark, diffs.is_non_code_only(F.lit(""))) is True
    assert tuple(value(spark, diffs.change_shape(F.lit(DIFF)))) == (3, 3, 1)
    parts = value(spark, diffs.split_patch(F.lit(DIFF)))
    assert "test_new" in parts.test_patch and "test_new" not in parts.patch


def test_hunk_lines_have_numbers(spark):
    rows = hunks.hunk_lines(spark.createDataFrame([(1, DIFF)], "k int, p string"), ["k"], "p").collect()
    assert sorted((r.mark, r.text, r.old_line, r.new_line) for r in rows if r.mark != " ") == [("+", "more", None, 5), ("+", "new", None, 4), ("-", "old", 4, None)]
    assert sorted((r.old_line, r.new_line) for r in rows if r.mark == " ") == [(3, 3), (5, 6)]


@pytest.mark.parametrize(
    ("lines", "want"),
    [
        (['+"""', "+doc", '+"""'], False), (["+# note", "+", "-# old"], False), (["+x = 1"], True), (['+"""one line"""'], False), (['+"""', "+doc", '+"""', "+x = 1"], True),
        (["+'''a", "+b", "+c'''", "-  # no"], False),
    ],
)
def test_meaningful_changes(spark, lines, want):
    patch = "diff --git a/a.py b/a.py\n--- a/a.py\n+++ b/a.py\n@@ -1 +1 @@\n" + "\n".join(lines)
    assert value(spark, hunks.meaningful_change(F.lit(patch))) is want
    assert value(spark, hunks.meaningful_change(F.lit(patch.replace(".py", ".c")))) is True


def test_minimal_patch(spark):
    """Context at both ends of a hunk goes but for one line behind it; context between changes stays."""
    got = value(spark, hunks.minimal_patch(F.lit("diff --git a/a b/a\n--- a/a\n+++ b/a\n@@ -1,6 +1,6 @@ f\n one\n-two  \n+2\n three\n-four\n+4\n five\n six\n@@ -20,2 +20,3 @@\n x\n+y\n z\n")))
    assert got == "--- a/a\n+++ b/a\n@@ -2,4 +2,4 @@\n-two\n+2\n three\n-four\n+4\n five\n@@ -21,1 +21,2 @@\n+y\n z\n"


@pytest.mark.parametrize(
    ("path", "kinds"),
    [
        ("tests/a.py", "test"), ("src/latest/a.py", ""), ("benchmarks/test_a.py", "bench"), ("docs/a.py", "doc"), ("README.MD", "doc"), (".github/workflows/x.yml", "ci"),
        ("requirements-dev.txt", "doc deps"), ("requirements_parser.py", ""), ("sub/a.yml", ""), ("a.yml", "config"), ("poetry.lock", "deps lock"), ("src/Dockerfile", "config"),
    ],
)
def test_file_kinds(spark, path, kinds):
    p = F.lit(path)
    rules = {"test": diffs.is_test_file, "bench": diffs.is_benchmark_file, "doc": diffs.is_doc_file, "ci": diffs.is_ci_file, "deps": diffs.is_deps_file, "config": diffs.is_config_file, "lock": diffs.is_lock_file}
    assert {k for k, rule in rules.items() if value(spark, rule(p))} == set(kinds.split())


def parse(spark, parser, said):
    return {r.test: r.status for r in parser(spark.createDataFrame([(1, said)], "k int, log string"), ["k"], "log").collect()}


def test_log_formats(spark):
    assert parse(spark, logs.pytest_log, "PASSED a::b[x[1] y] 3%\nFAILED c - boom\nERROR\nXFAIL d\nnoise") == {"a::b[x[1] y]": "PASSED", "c": "FAILED", "d": "XFAIL"}
    assert parse(spark, logs.numpy_log, "PASSED a[1]\nPASSED a[2]\nFAILED b[1]") == {"b": "FAILED"}
    assert parse(spark, logs.django_log, "t1 (x) ... ok\nt2 (x) ... some output\nok\nt3 ... FAIL\nERROR: t4 (y)\nt5 ... skipped 'z'") == {"t1 (x)": "PASSED", "t2 (x)": "PASSED", "t3": "FAILED", "t4": "ERROR", "t5": "SKIPPED"}
    assert parse(spark, logs.gtest_log, "[ RUN      ] A.b\n[       OK ] A.b (1 ms)\n[ RUN      ] A.c\n[  FAILED  ] A.d") == {"A.b": "PASSED", "A.c": "ERROR", "A.d": "FAILED"}
    for broken in ("", "{", "<testsuite>", "not a log"):
        for parser in (logs.pytest_log, logs.gtest_json, logs.vitest_json, logs.junit_xml, logs.catch2_xml, logs.ctest_log):
            assert parse(spark, parser, broken) == {}
    assert parse(spark, logs.junit_xml, '<testsuite name="s"><testcase name="a" classname="c"/><testcase name="b"><error/></testcase></testsuite>') == {"c.a": "PASSED", "s.b": "ERROR"}


def test_parser_registry(spark):
    logs.register_parser("Own/Repo", logs.ctest_log)
    frame = spark.createDataFrame([(1, "own/REPO", "Test #1: a .... Passed"), (2, "x/y", "PASSED b"), (3, None, "PASSED c")], "k int, repo string, log string")
    assert {(r.k, r.test) for r in logs.parse_logs(frame, ["k"], "log", "repo").collect()} == {(1, "a"), (2, "b"), (3, "c")}
    del logs.PARSERS["own/repo"]


def test_asof_is_strict_at_equal_times(spark):
    left = spark.createDataFrame([("a", 5), ("a", 6), ("b", 5), ("a", None)], "g string, t int")
    right = spark.createDataFrame([("a", 5, "x"), ("a", 2, "w"), ("a", None, "z")], "g string, t int, v string")
    got = {(r.g, r.t): r.value for r in joins.asof(left, right, "t", "t", "v", ["g"]).collect()}
    assert got == {("a", 5): "w", ("a", 6): "x", ("b", 5): None, ("a", None): None}
    got = {(r.g, r.t): r.value for r in joins.asof(left, right, "t", "t", "v", ["g"], strict=False).collect()}
    assert got[("a", 5)] == "x"


def test_release_picks(spark):
    tasks = spark.createDataFrame([("r", "2020-05-01"), ("r", "2019-01-01"), ("none", "2020-01-01")], "g string, d string")
    releases = spark.createDataFrame([("r", "2020-01-01", "1.9"), ("r", "2020-03-01", "1.10"), ("r", "2020-05-01", "2.0")], "g string, t string, v string")
    pick = lambda **kw: {(r.g, r.d): r.found_version for r in joins.asof_release(tasks, releases, "d", "t", "v", ["g"], **kw).collect()}
    assert pick()[("r", "2020-05-01")] == "1.10" and pick(pick="version")[("r", "2020-05-01")] == "1.9"
    assert pick()[("r", "2019-01-01")] is None and pick(fallback="oldest")[("r", "2019-01-01")] == "1.9" and pick()[("none", "2020-01-01")] is None


def test_require_known(spark):
    with pytest.raises(ValueError, match="unknown id"):
        joins.require_known(spark.range(3), spark.range(2), "id")


def test_deflake_keeps_instances_with_few_runs(spark):
    runs = spark.createDataFrame([("a", i, "t", "PASSED") for i in range(3)] + [("a", 0, "u", "PASSED"), ("b", 0, "t", "FAILED")], "instance_id string, run int, test string, status string")
    instances = spark.createDataFrame([("a", ["t", "u"]), ("b", ["t"]), ("c", []), ("d", None)], "instance_id string, covering_tests array<string>")
    got = {r.instance_id: (r.covering_tests, r.status) for r in flaky.deflake(instances, runs).collect()}
    assert got == {"a": (["t"], "filtered"), "b": (["t"], "kept as is"), "c": ([], "kept as is"), "d": (None, "kept as is")}


def test_breakdown_of_nothing_and_proportions(spark):
    schema = "has_pred_perf boolean, correctness double, raw_pred_speedup_ratio double, human_speedup_ratio double, gold_speedup_ratio double, data_quality string"
    empty = scoring.breakdown(spark.createDataFrame([], schema)).first()
    assert empty.total_instances == 0 and empty.overall_score == 0 and empty.caveats == []
    rows = [(True, 1.0, 2.0, 1.5, 1.2, "VERIFIED"), (True, 0.0, 1.0, 0.0, 0.9, None), (False, 1.0, 1.0, 1.0, 1.0, "NO_PERF_DATA"), (True, 1.0, 0.5, 0.4, 1.0, "VERIFIED")]
    r = scoring.breakdown(spark.createDataFrame(rows, schema)).first()
    assert sum(v for k, v in r.asDict().items() if k.startswith("proportion")) == pytest.approx(1, abs=1e-3) and len(r.caveats) == 2


def test_intervals_and_ranks(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 3, 5), ("a", 7, 8), ("a", 2, 2), ("b", 1, 9), ("b", 2, 3)], "g string, begin int, end int")
    assert sorted(tuple(r) for r in ranking.merge_intervals(df, ["g"]).select("g", "begin", "end").collect()) == [("a", 1, 5), ("a", 7, 8), ("b", 1, 9)]
    nums = ranking.running_numbers(spark.range(50).withColumn("g", F.lit(1)), F.col("id"), F.floor(F.col("id") / 7), ["g"]).collect()
    assert all(r["rank"] == r.id + 1 for r in nums)


def test_missing_columns_get_defaults_but_nulls_stay(spark):
    df = curate.fill_missing(spark.createDataFrame([(None,)], "a string"), {"a": F.lit("x"), "b": F.lit("y")})
    assert tuple(df.first()) == (None, "y")


def test_readers_and_writers(spark, tmp_path):
    path = f"file://{tmp_path}/x.jsonl"
    spark.createDataFrame([('{"instance_id": "a", "version": "1.10"}',), ("",), ("{bad",)], "value string").write.text(path)
    good, bad = readers.jsonl(spark, path, "instance_id string, version string")
    assert [tuple(r) for r in good.collect()] == [("a", "1.10")] and [r.line for r in bad.collect()] == ["{bad"]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        readers.jsonl_strict(spark, path, "instance_id string, version string").collect()
    ok = f"file://{tmp_path}/ok.jsonl"
    writers.write_jsonl(spark.createDataFrame([("a", None)], "instance_id string, version string"), ok)
    assert readers.instances(spark, ok, "instance_id string, version string", ["a"]).count() == 1
    with pytest.raises(ValueError, match="no such instances"):
        readers.instances(spark, ok, "instance_id string, version string", ["b"])
    with pytest.raises(ValueError, match="rows were lost"):
        writers.concat_checked([spark.range(2).sample(False, 0.0000001, 1), _Liar(spark.range(2))])


class _Liar:
    """A frame that counts a row too many."""

    def __init__(self, df):
        self.df = df

    def __getattr__(self, name):
        return getattr(self.df, name)

    def count(self):
        return self.df.count() + 1


def test_profiles(spark, tmp_path):
    import cProfile

    cProfile.runctx("sum(range(10))", {}, {}, str(tmp_path / "a.prof"))
    rows = readers.profile_stats(spark, f"file://{tmp_path}/*.prof").collect()
    assert any("sum" in r.func for r in rows) and all(math.isfinite(r.cumtime) for r in rows)


def test_coverage_databases(spark, tmp_path):
    import sqlite3

    con = sqlite3.connect(tmp_path / "x.coverage")
    con.executescript("create table file(id, path); create table context(id, context); create table line_bits(file_id, context_id, numbits)")
    con.execute("insert into file values (1, '/a.py')")
    con.execute("insert into context values (1, 't')")
    con.execute("insert into line_bits values (1, 1, ?)", (bytes([0b10, 0b1]),))
    con.commit()
    con.close()
    rows = readers.coverage_databases(spark, f"file://{tmp_path}/*.coverage").collect()
    assert sorted((r.context, r.file, r.line) for r in rows) == [("t", "/a.py", 1), ("t", "/a.py", 8)]


def test_lines_of_interest_surround_removals(spark):
    patch = "diff --git a/a b/a\n--- a/a\n+++ b/a\n@@ -1,4 +1,3 @@\n one\n-two\n three\n+four\n end"
    rows = hunks.lines_of_interest(spark.createDataFrame([(1, patch)], "k int, p string"), ["k"], "p").collect()
    assert sorted(r.line for r in rows) == [1, 2, 3]
