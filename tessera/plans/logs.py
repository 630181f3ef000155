"""Log parsers: one log per order, a line or element per lineitem, in each format; the SQL states what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import logs
from tessera.plans.registry import NUMBERED, numbered_lines, query, table

# the order's log as rows: test and status of every line; later lines of one test win
ROWS = f"""{NUMBERED},
    rows AS (SELECT l_orderkey, pos, 'tests/t' || (l_partkey % 3) || '.py::case[' || (l_suppkey % 4) || ']' AS test,
        CASE WHEN l_returnflag = 'R' THEN 'FAILED' WHEN l_returnflag = 'A' THEN 'PASSED' ELSE 'SKIPPED' END AS status FROM numbered),
    last AS (SELECT l_orderkey, test, arg_max(status, pos) AS status FROM rows GROUP BY 1, 2)
"""


def _rows(spark, d):
    status = F.when(F.col("l_returnflag") == "R", "FAILED").when(F.col("l_returnflag") == "A", "PASSED").otherwise("SKIPPED")
    test = F.concat(F.lit("tests/t"), (F.col("l_partkey") % 3).cast("string"), F.lit(".py::case["), (F.col("l_suppkey") % 4).cast("string"), F.lit("]"))
    return numbered_lines(spark, d).select("l_orderkey", "pos", test.alias("test"), status.alias("status"))


def _log(rows, line, start="", end="", sep="\n"):
    """One text per order: its lines in order."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))), lambda x: x["line"])
    return rows.groupBy("l_orderkey").agg(F.concat(F.lit(start), F.array_join(parts, sep), F.lit(end)).alias("log"))


_c = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.col(p) if p in ("test", "status") else F.lit(p) for p in parts])
LAST = f"WITH {ROWS} SELECT l_orderkey, test, status FROM last"


@query("l01_l07_pytest", LAST)
def l01(spark, d):
    log = _log(_rows(spark, d), _c("status", " ", "test", F.when(F.col("status") == "FAILED", " - assert [1] == 2").otherwise(" 3%")), "=== start ===\n")
    return logs.parse_logs(log.withColumn("repo", F.concat(F.lit("Some/R"), (F.col("l_orderkey") % 3).cast("string"))), ["l_orderkey"], "log", "repo")


@query("l02_pytest_options", f"WITH {ROWS} SELECT l_orderkey, replace(test, '[', '[/') AS test, status FROM last")
def l02(spark, d):
    return logs.pytest_options_log(_log(_rows(spark, d), _c("status", " ", F.replace("test", F.lit("["), F.lit("[/tmp/x/")), " more")), ["l_orderkey"], "log")


@query("l03_django", f"WITH {ROWS} SELECT l_orderkey, test, status FROM last")
def l03(spark, d):
    word = F.when(F.col("status") == "FAILED", "FAIL").when(F.col("status") == "PASSED", "ok").otherwise("skipped 'why'")
    return logs.django_log(_log(_rows(spark, d), _c("  ", "test", " ... ", word)), ["l_orderkey"], "log")


@query("l04_pytest_later", f"WITH {ROWS} SELECT l_orderkey, test, status FROM last")
def l04(spark, d):
    line = F.when(F.col("pos") % 2 == 0, _c("\x1b[32m", "status", "\x1b[0m ", "test")).otherwise(_c("test", " ", "status"))
    return logs.pytest_later_log(_log(_rows(spark, d), line), ["l_orderkey"], "log")


@query("l05_seaborn_matplotlib_pydantic", f"WITH {ROWS} SELECT 'matplotlib' AS format, l_orderkey, test, status FROM last UNION ALL SELECT 'pydantic', l_orderkey, test, status FROM last UNION ALL SELECT 'seaborn', l_orderkey, test, arg_max(status, pos) FROM rows WHERE status <> 'SKIPPED' GROUP BY 2, 3")
def l05(spark, d):
    rows = _rows(spark, d)
    plain = _log(rows, _c("status", " ", "test"))
    coloured = _log(rows, _c("[31m", "status", F.when(F.col("status") == "FAILED", " [ 5%]").otherwise(""), " ", "test"))
    parts = [("matplotlib", logs.matplotlib_log(plain, ["l_orderkey"], "log")), ("pydantic", logs.pydantic_log(coloured, ["l_orderkey"], "log")), ("seaborn", logs.seaborn_log(plain, ["l_orderkey"], "log"))]
    frames = [df.select(F.lit(n).alias("format"), "l_orderkey", "test", "status") for n, df in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("l05_sympy", f"WITH {ROWS}, r AS (SELECT l_orderkey, pos, 'test_' || (l_partkey % 3) AS test, CASE l_returnflag WHEN 'R' THEN 'FAILED' WHEN 'A' THEN 'PASSED' ELSE 'ERROR' END AS status FROM numbered) SELECT l_orderkey, test, arg_max(status, pos) AS status FROM r GROUP BY 1, 2")
def l05s(spark, d):
    end = F.when(F.col("l_returnflag") == "R", " F").when(F.col("l_returnflag") == "A", " ok [OK]").otherwise(" E")
    rows = numbered_lines(spark, d).select("l_orderkey", "pos", F.concat(F.lit("test_"), (F.col("l_partkey") % 3).cast("string"), end).alias("line"))
    return logs.sympy_log(_log(rows, F.col("line")), ["l_orderkey"], "log")


@query("l06_w11_numpy", f"WITH {ROWS} SELECT l_orderkey, string_split(test, '[')[1] AS test, min(status) AS status FROM last GROUP BY 1, 2 HAVING count(*) = 1")
def l06(spark, d):
    return logs.numpy_log(_log(_rows(spark, d), _c("status", " ", "test")), ["l_orderkey"], "log")


@query("l08_x29_vitest_json", f"WITH {ROWS} SELECT l_orderkey, test, status FROM last")
def l08(spark, d):
    case = F.struct(F.col("test").alias("fullName"), F.when(F.col("status") == "SKIPPED", "todo").otherwise(F.lower("status")).alias("status"))
    log = _log(_rows(spark, d), F.to_json(case), '{"testResults": [{"assertionResults": [', "]}]}", ", ")
    return logs.vitest_json(log, ["l_orderkey"], "log")


@query("l08_l10_s12_junit_xml", f"WITH {ROWS} SELECT l_orderkey, 'suite.' || test AS test, status FROM last")
def l08x(spark, d):
    inner = F.when(F.col("status") == "FAILED", '><failure message="x">no</failure></testcase>').when(F.col("status") == "PASSED", "/>").otherwise("><skipped/></testcase>")
    log = _log(_rows(spark, d), _c('<testcase name="', "test", '" time="1"', inner), '<?xml version="1.0"?><testsuites><testsuite tests="3" name="suite">', "</testsuite></testsuites>")
    return logs.junit_xml(log, ["l_orderkey"], "log")


@query("l09_gtest", f"WITH {ROWS} SELECT l_orderkey, 'S.' || replace(test, '/', '_') AS test, status FROM last")
def l09(spark, d):
    verb = F.when(F.col("status") == "FAILED", "  FAILED  ").when(F.col("status") == "PASSED", "       OK ").otherwise("  SKIPPED ")
    name = _c("S.", F.replace("test", F.lit("/"), F.lit("_")))
    return logs.gtest_log(_log(_rows(spark, d), _c("[ RUN      ] ", name, "\n[", verb, "] ", name, " (3 ms)")), ["l_orderkey"], "log")


@query("l09_gtest_json", f"WITH {ROWS} SELECT l_orderkey, 'S.' || test AS test, status FROM last")
def l09j(spark, d):
    failed = F.array(F.struct(F.lit("no").alias("failure")))
    case = F.struct(F.col("test").alias("name"), F.lit("S").alias("classname"), F.when(F.col("status") == "SKIPPED", "NOTRUN").otherwise("RUN").alias("status"), F.lit("COMPLETED").alias("result"), F.when(F.col("status") == "FAILED", failed).alias("failures"))
    return logs.gtest_json(_log(_rows(spark, d), F.to_json(case), '{"testsuites": [{"name": "Q", "testsuite": [', "]}]}", ", "), ["l_orderkey"], "log")


@query("l10_ctest", f"WITH {ROWS} SELECT l_orderkey, test, status FROM last")
def l10(spark, d):
    word = F.when(F.col("status") == "FAILED", "***Timeout").when(F.col("status") == "PASSED", "   Passed").otherwise("   Not Run")
    return logs.ctest_log(_log(_rows(spark, d), _c("  Test  #1: ", "test", " .......", word, "   0.04 sec")), ["l_orderkey"], "log")


@query("l11_catch2_xml", f"WITH {ROWS} SELECT l_orderkey, test, status FROM last")
def l11(spark, d):
    inner = F.when(F.col("status") == "FAILED", '<OverallResult success="false"/>').when(F.col("status") == "PASSED", '<OverallResult success="true"/>').otherwise('<Skip/><OverallResult success="true"/>')
    return logs.catch2_xml(_log(_rows(spark, d), _c('<TestCase name="', "test", '" line="3">', inner, "</TestCase>"), "<Catch2TestRun>", "</Catch2TestRun>"), ["l_orderkey"], "log")


GBENCH = "struct<benchmarks:array<struct<name:string,run_type:string,aggregate_name:string,real_time:double,time_unit:string>>>"


@query("l12_x28_benchmark_json", "SELECT l_suppkey, l_partkey AS name, round(l_quantity / 1000, 9) AS seconds FROM lineitem WHERE l_linenumber <> 2")
def l12(spark, d):
    from tessera.functions.perf import to_seconds

    kind = F.when(F.col("l_linenumber") == 2, "aggregate").otherwise("iteration")
    case = F.struct(F.col("l_partkey").cast("string").alias("name"), kind.alias("run_type"), F.col("l_quantity").alias("real_time"), F.lit("ms").alias("time_unit"))
    log = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.to_json(F.struct(F.collect_list(case).alias("benchmarks"))).alias("log"))
    rows = log.select("l_suppkey", F.explode(F.from_json("log", GBENCH)["benchmarks"]).alias("b")).where("b.run_type <> 'aggregate'")
    return rows.select("l_suppkey", F.col("b.name").cast("long").alias("name"), F.round(to_seconds(F.col("b.real_time"), F.col("b.time_unit")), 9).alias("seconds"))


@query("l13_eval_section", "SELECT doc_id, CASE WHEN doc_id % 5 > 0 AND doc_id % 7 > 0 THEN chr(10) || text END AS section FROM documents")
def l13(spark, d):
    k = F.col("doc_id")
    log = F.concat(F.lit(">>>>> Applied\nold\n"), F.when(k % 7 == 0, "").otherwise(">>>>> Tests\n>>>>> Tests"), F.lit("\n"), F.col("text"), F.when(k % 5 == 0, "\n>>>>> Timed Out").otherwise(""))
    return table(spark, d, "documents").select("doc_id", logs.eval_section(log, ">>>>> Tests", [">>>>> Timed Out"]).alias("section"))


@query("l14_status_loader", f"WITH {ROWS} SELECT l_orderkey, test, status FROM last")
def l14(spark, d):
    rows = _rows(spark, d)
    last = rows.groupBy("l_orderkey", "test").agg(F.max_by("status", "pos").alias("status"))
    as_map = last.where("l_orderkey % 2 = 0").groupBy("l_orderkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("test", "status")))).alias("log"))
    lines = _log(rows.where("l_orderkey % 2 = 1"), _c("status", " ", "test"))
    return logs.load_statuses(as_map.unionByName(lines), ["l_orderkey"], "log")


@query("u03_best_effort", f"WITH {ROWS} SELECT l_orderkey, test, status FROM last")
def u03(spark, d):
    best = logs.first_of([logs.vitest_json, logs.junit_xml, logs.pytest_log])
    return best(_log(_rows(spark, d), _c("status", " ", "test")), ["l_orderkey"], "log")


MIXED = f"""WITH {ROWS},
    numpy AS (SELECT l_orderkey, string_split(test, '[')[1] AS test, min(status) AS status FROM last WHERE l_orderkey % 5 = 4 GROUP BY 1, 2 HAVING count(*) = 1)
    SELECT l_orderkey, CASE l_orderkey % 5 WHEN 1 THEN replace(test, '[', '[/') ELSE test END AS test, status FROM last WHERE l_orderkey % 5 < 4 UNION ALL SELECT * FROM numpy"""


@query("u03_l07_mixed_repositories", MIXED)
def u03_mixed(spark, d):
    """Logs of five formats in one table, read once."""
    kind = F.col("l_orderkey") % 5
    word = F.when(F.col("status") == "FAILED", "FAIL").when(F.col("status") == "PASSED", "ok").otherwise("skipped 'why'")
    line = (
        F.when(kind == 1, _c("status", " ", F.replace("test", F.lit("["), F.lit("[/tmp/x/")), " more"))
        .when(kind == 2, _c("  ", "test", " ... ", word))
        .when(kind == 3, F.when(F.col("pos") % 2 == 0, _c("\x1b[32m", "status", "\x1b[0m ", "test")).otherwise(_c("test", " ", "status")))
        .otherwise(_c("status", " ", "test", F.when(F.col("status") == "FAILED", " - assert [1] == 2").otherwise(" 3%")))
    )
    repo = F.when(kind == 1, "psf/Requests").when(kind == 2, "django/django").when(kind == 3, "astropy/astropy").when(kind == 4, "numpy/numpy")
    return logs.parse_logs(_log(_rows(spark, d), line).withColumn("repo", repo), ["l_orderkey"], "log", "repo")


@query("u03_parser_function", LAST)
def u03_function(spark, d):
    """Two formats that the library does not know, registered in this session and called from SQL."""

    def arrows(log):
        for line in log.splitlines():
            name, arrow, verdict = line.partition(" => ")
            if arrow:
                yield name, {"good": "PASSED", "bad": "FAILED"}.get(verdict, "SKIPPED")

    table_lines = logs.pattern_reader(r"^\| (?P<test>\S+) *\| *(?P<status>\w+) \|$", {"Yes": "PASSED", "No": "FAILED"}, "SKIPPED")
    logs.register_log_function(spark, {"arrows": arrows, "Table": table_lines}, "parse_own_log", default="arrows")
    even = F.col("l_orderkey") % 2 == 0
    word = lambda good, bad: F.when(F.col("status") == "PASSED", good).when(F.col("status") == "FAILED", bad).otherwise("?")
    line = F.when(even, _c("| ", "test", " | ", F.when(F.col("status") == "SKIPPED", "Never").otherwise(word("yes", "NO")), " |")).otherwise(_c("test", " => ", word("good", "bad")))
    own = _log(_rows(spark, d), line, "begin\n").withColumn("parser", F.when(even, "table"))
    return spark.sql("SELECT o.l_orderkey, t.test, t.status FROM {own} o, LATERAL parse_own_log(o.log, o.parser) t", own=own)


@query("x39_drop_trailing", "SELECT l_orderkey, l_linenumber, 'a::b[x[' || l_partkey || ']y]' AS test FROM lineitem")
def x39(spark, d):
    name = F.concat(F.lit("a::b[x["), F.col("l_partkey").cast("string"), F.lit("]y] tail ]"))
    rows = table(spark, d, "lineitem").withColumn("_name", name).withColumn("_after", F.substring_index("_name", "[", 1))
    return rows.select("l_orderkey", "l_linenumber", logs.drop_trailing(F.col("_name")).alias("test"))


