"""Scores: report rows come from lineitem (a task per line), part (its gold run) and orders (its model)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import perf
from tessera.operators import flaky, scoring
from tessera.operators.curate import running_cost
from tessera.plans.registry import query, table

REPORT = """
    report AS (
        SELECT l.l_orderkey || '-' || l.l_linenumber AS instance_id, l.l_returnflag AS model, l.l_quantity AS length,
            CASE WHEN l.l_linenumber < 7 THEN 1 / ((1 - l.l_discount) * (1 + l.l_tax)) ELSE 1.0 END AS raw_pred_speedup_ratio,
            CASE WHEN l.l_linenumber < 7 AND l.l_linestatus = 'F' THEN 1 / ((1 - l.l_discount) * (1 + l.l_tax)) ELSE 1.0 END AS pred_speedup_ratio,
            1 / (0.75 + p.p_size / 100.0) AS gold_speedup_ratio,
            CASE WHEN l.l_linenumber < 7 AND l.l_linestatus = 'F' THEN 1 / ((1 - l.l_discount) * (1 + l.l_tax)) ELSE 1.0 END
                * (0.75 + p.p_size / 100.0) AS human_speedup_ratio,
            CASE WHEN l.l_linestatus = 'F' THEN 1.0 ELSE 0.0 END AS correctness,
            l.l_linenumber < 7 AS has_pred_perf,
            CASE WHEN l.l_linenumber >= 7 THEN 'NO_PERF_DATA' WHEN l.l_tax = 0 THEN 'UNVERIFIABLE_CORRECTNESS' ELSE 'VERIFIED' END AS data_quality
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
"""


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    has, right = F.col("l_linenumber") < 7, F.col("l_linestatus") == "F"
    ratio = 1 / ((1 - F.col("l_discount")) * (1 + F.col("l_tax")))
    human = 0.75 + F.col("p_size") / 100.0
    pred = F.when(has & right, ratio).otherwise(1.0)
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("instance_id"),
        F.col("l_returnflag").alias("model"),
        F.col("l_quantity").alias("length"),
        F.when(has, ratio).otherwise(1.0).alias("raw_pred_speedup_ratio"),
        pred.alias("pred_speedup_ratio"),
        (1 / human).alias("gold_speedup_ratio"),
        (pred * human).alias("human_speedup_ratio"),
        right.cast("double").alias("correctness"),
        has.alias("has_pred_perf"),
        F.when(~has, "NO_PERF_DATA").when(F.col("l_tax") == 0, "UNVERIFIABLE_CORRECTNESS").otherwise("VERIFIED").alias("data_quality"),
    )


@query(
    "a01_harmonic_floor",
    f"""WITH {REPORT} SELECT model, round(count(*) FILTER (has_pred_perf)
            / sum(1 / greatest(human_speedup_ratio, 0.001)) FILTER (has_pred_perf), 6) AS score FROM report GROUP BY model""",
)
def a01(spark, d):
    rows = report_rows(spark, d).where("has_pred_perf")
    return rows.groupBy("model").agg(F.round(perf.harmonic_mean(F.col("human_speedup_ratio")), 6).alias("score"))


@query(
    "a01b_harmonic_all",
    f"WITH {REPORT} SELECT model, round(count(*) / sum(1 / greatest(human_speedup_ratio, 0.001)), 6) AS score FROM report GROUP BY model",
)
def a01b(spark, d):
    return report_rows(spark, d).groupBy("model").agg(F.round(perf.harmonic_mean(F.col("human_speedup_ratio")), 6).alias("score"))


@query(
    "a01c_harmonic_unfloored",
    """SELECT l_returnflag AS model, l_linenumber, CASE WHEN min(l_discount) = 0 THEN 0.0
           ELSE round(count(*) / sum(1 / nullif(l_discount, 0)), 6) END AS score FROM lineitem GROUP BY ALL""",
)
def a01c(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("model"), "l_linenumber")
    return rows.agg(F.round(perf.harmonic_mean(F.col("l_discount"), None), 6).alias("score"))


@query(
    "a01d_harmonic_positive",
    """SELECT l_returnflag AS model, round(count(*) FILTER (l_discount > 0) / sum(1 / l_discount) FILTER (l_discount > 0), 6) AS score
       FROM lineitem GROUP BY 1""",
)
def a01d(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("model")).agg(F.round(perf.harmonic_mean_positive(F.col("l_discount")), 6).alias("score"))


@query(
    "a02_geometric_mean",
    "SELECT l_returnflag AS model, round(exp(avg(ln(l_discount)) FILTER (l_discount > 0)), 6) AS gm FROM lineitem GROUP BY 1",
)
def a02(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("model")).agg(F.round(perf.geometric_mean(F.col("l_discount")), 6).alias("gm"))


@query(
    "a03_a04_a05_breakdown",
    f"""WITH {REPORT},
        b AS (SELECT model, count(*) AS total_instances, count(*) FILTER (has_pred_perf) AS effective_n,
            count(*) FILTER (NOT has_pred_perf) AS instances_excluded,
            round(count(*) FILTER (has_pred_perf) / sum(1 / greatest(human_speedup_ratio, 0.001)) FILTER (has_pred_perf), 4) AS overall_score,
            round(count(*) FILTER (has_pred_perf AND correctness < 1) / count(*), 4) AS proportion_incorrect,
            round(count(*) FILTER (has_pred_perf AND correctness = 1 AND raw_pred_speedup_ratio < 1) / count(*), 4) AS proportion_correct_but_no_speedup,
            round(count(*) FILTER (has_pred_perf AND correctness = 1 AND raw_pred_speedup_ratio >= 1 AND human_speedup_ratio < 1) / count(*), 4)
                AS proportion_correct_with_speedup_but_human_no_speedup,
            round(count(*) FILTER (has_pred_perf AND correctness = 1 AND raw_pred_speedup_ratio >= 1 AND human_speedup_ratio >= 1) / count(*), 4)
                AS proportion_human_speedup_or_better,
            round(count(*) FILTER (NOT has_pred_perf) / count(*), 4) AS proportion_excluded,
            count(*) FILTER (correctness = 1 AND NOT contains(data_quality, 'UNVERIFIABLE') AND NOT contains(data_quality, 'NO_PERF')) AS correctness_verified_count,
            count(*) FILTER (contains(data_quality, 'UNVERIFIABLE')) AS correctness_unverifiable_count,
            count(*) FILTER (gold_speedup_ratio < 1) AS gold_slowdowns FROM report GROUP BY model)
        SELECT *, list_filter([CASE WHEN instances_excluded > 0 THEN instances_excluded || ' without figures, left out of the score' END,
            CASE WHEN correctness_unverifiable_count > 0 THEN correctness_unverifiable_count || ' without tests to pass, correct by default' END,
            CASE WHEN gold_slowdowns > 0 THEN gold_slowdowns || ' where the expert''s change is a slowdown' END], lambda x: x IS NOT NULL) AS caveats FROM b""",
)
def a03(spark, d):
    return scoring.breakdown(report_rows(spark, d), "model")


@query(
    "a03b_older_breakdown",
    f"""WITH {REPORT} SELECT model, round(count(*) FILTER (correctness <> 1) / count(*), 4) AS incorrect,
            round(count(*) FILTER (correctness = 1 AND pred_speedup_ratio <= 1) / count(*), 4) AS no_speedup,
            round(count(*) FILTER (correctness = 1 AND pred_speedup_ratio > 1 AND human_speedup_ratio < 1) / count(*), 4) AS below_human,
            round(count(*) FILTER (human_speedup_ratio >= 1) / count(*), 4) AS human_or_better,
            round(count(*) / sum(1 / greatest(human_speedup_ratio, 0.001)), 4) AS score FROM report GROUP BY model""",
)
def a03b(spark, d):
    return scoring.older_breakdown(report_rows(spark, d), "model")


STATUSES = """
    statuses AS (SELECT CAST(l_orderkey AS VARCHAR) AS instance_id, CAST(l_linenumber AS VARCHAR) AS test,
        CASE WHEN l_returnflag = 'R' THEN 'FAILED' WHEN l_tax = 0 THEN 'SKIPPED' WHEN l_tax > 0.07 THEN 'XPASS' ELSE 'PASSED' END AS status
        FROM lineitem)
"""


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("l_returnflag") == "R", "FAILED").when(F.col("l_tax") == 0, "SKIPPED").when(F.col("l_tax") > 0.07, "XPASS").otherwise("PASSED")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("instance_id"), F.col("l_linenumber").cast("string").alias("test"), status.alias("status"))


@query(
    "j02_j03_a06_x34_x35_evaluate",
    f"""WITH {STATUSES},
        inst AS (SELECT CAST(o_orderkey AS VARCHAR) AS instance_id, o_orderkey AS k, o_totalprice AS price,
            CASE WHEN o_orderkey % 5 = 0 THEN [] ELSE list_transform(range(1, 2 + CAST(o_orderkey % 3 AS INT)), lambda i: CAST(i AS VARCHAR)) END AS p2p FROM orders),
        passed AS (SELECT i.instance_id, count(DISTINCT s.test) AS n FROM inst i JOIN statuses s ON s.instance_id = i.instance_id AND list_contains(i.p2p, s.test)
            WHERE contains(s.status, 'PASS') GROUP BY 1),
        ran AS (SELECT DISTINCT instance_id FROM statuses),
        j AS (SELECT i.*, coalesce(p.n, 0) AS passed, r.instance_id IS NOT NULL AS ran,
                k % 7 <> 0 AS has_pred, CASE WHEN k % 7 <> 0 AND k % 11 <> 0 THEN price / (price * (0.5 + k % 4 * 0.25)) ELSE 1.0 END AS raw,
                CASE WHEN k % 3 <> 0 THEN price / (price * (0.5 + k % 5 * 0.25)) ELSE 1.0 END AS gold
            FROM inst i LEFT JOIN passed p USING (instance_id) LEFT JOIN ran r USING (instance_id)),
        e AS (SELECT *, CASE WHEN len(p2p) = 0 THEN 1.0 WHEN NOT ran THEN 0.0 ELSE passed / len(p2p) END AS pct FROM j),
        f AS (SELECT *, CASE WHEN len(p2p) = 0 THEN raw WHEN NOT ran OR pct <> 1 THEN 1.0 ELSE raw END AS adj,
                array_to_string(list_filter([CASE WHEN NOT has_pred THEN CASE WHEN k % 2 = 0 THEN 'CORRUPT_PATCH' ELSE 'NO_PERF_DATA' END END,
                    CASE WHEN gold < 1 THEN 'GOLD_SLOWDOWN' END,
                    CASE WHEN len(p2p) = 0 THEN 'UNVERIFIABLE_CORRECTNESS' WHEN NOT ran THEN 'NO_CORRECTNESS_DATA' END], lambda x: x IS NOT NULL), '|') AS flags FROM e)
        SELECT instance_id, raw AS raw_pred_speedup_ratio, adj AS pred_speedup_ratio, gold AS gold_speedup_ratio, adj / gold AS human_speedup_ratio,
            CASE WHEN pct = 1 THEN 1.0 ELSE 0.0 END AS correctness, pct AS correctness_pct, CASE WHEN k % 3 <> 0 THEN price ELSE 0.0 END AS pre_edit_runtime,
            2 AS patch_length, has_pred AS has_pred_perf,
            CASE WHEN len(p2p) > 0 AND ran AND ((pct = 1 AND has_pred) OR flags = '') THEN 'VERIFIED' ELSE flags END AS data_quality FROM f""",
)
def evaluate(spark, d):
    orders = table(spark, d, "orders")
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    key = k.cast("string").alias("instance_id")
    tests = F.transform(F.sequence(F.lit(1), (1 + k % 3).cast("int")), lambda i: i.cast("string"))
    none = F.expr("cast(array() as array<string>)")
    patch = F.lit("diff --git a/x b/x\n--- a/x\n+++ b/x\n@@ -1 +1 @@\n-a\n+b")
    instances = orders.select(key, patch.alias("patch"), F.when(k % 5 == 0, none).otherwise(tests).alias("pass_to_pass"))
    gold = orders.where(k % 3 != 0).select(key, price.alias("before_mean"), (price * (0.5 + k % 5 * 0.25)).alias("after_mean"))
    ran = k % 7 != 0
    pred = orders.select(
        key,
        F.when(ran, price).alias("before_mean"),
        F.when(k % 11 == 0, 0.0).when(ran, price * (0.5 + k % 4 * 0.25)).alias("after_mean"),
        F.when(k % 2 == 0, "error: patch failed").otherwise("diff").alias("patch_text"),
    )
    return scoring.evaluate(instances, gold, pred, statuses(spark, d))


@query(
    "a07_a08_a09_grade",
    f"""WITH {STATUSES},
        inst AS (SELECT CAST(o_orderkey AS VARCHAR) AS instance_id, CASE WHEN o_orderkey % 2 = 0 THEN 'python' ELSE 'cpp' END AS language,
            CASE WHEN o_orderkey % 4 = 0 THEN [] ELSE ['1', '2'] END AS f2p, CASE WHEN o_orderkey % 8 < 2 THEN [] ELSE ['3', '4'] END AS p2p FROM orders),
        long AS (SELECT instance_id, unnest(f2p) AS test, 'f2p' AS kind FROM inst UNION ALL SELECT instance_id, unnest(p2p), 'p2p' FROM inst),
        m AS (SELECT l.*, coalesce(s.status IN ('PASSED', 'XFAIL'), false) AS good, coalesce(s.status IN ('FAILED', 'ERROR'), true) AS bad
            FROM long l LEFT JOIN statuses s USING (instance_id, test)),
        g AS (SELECT i.*, coalesce(list_sort(list(test) FILTER (kind = 'f2p' AND good)), []) AS f2p_success, coalesce(list_sort(list(test) FILTER (kind = 'f2p' AND bad)), []) AS f2p_failure,
            coalesce(list_sort(list(test) FILTER (kind = 'p2p' AND good)), []) AS p2p_success, coalesce(list_sort(list(test) FILTER (kind = 'p2p' AND bad)), []) AS p2p_failure
            FROM inst i LEFT JOIN m USING (instance_id) GROUP BY ALL),
        r AS (SELECT *, CASE WHEN len(f2p_success) + len(f2p_failure) = 0 THEN 1.0 ELSE len(f2p_success) / (len(f2p_success) + len(f2p_failure)) END AS a,
            CASE WHEN len(p2p_success) + len(p2p_failure) = 0 THEN 1.0 ELSE len(p2p_success) / (len(p2p_success) + len(p2p_failure)) END AS b FROM g)
        SELECT instance_id, f2p_success, f2p_failure, p2p_success, p2p_failure, a AS f2p, b AS p2p,
            CASE WHEN len(f2p) = 0 AND len(p2p) = 0 AND language <> 'python' THEN 'NO' WHEN a = 1 AND b = 1 THEN 'FULL'
                WHEN a > 0 AND a < 1 AND b = 1 THEN 'PARTIAL' ELSE 'NO' END AS resolution FROM r""",
)
def grade(spark, d):
    k = F.col("o_orderkey")
    none, some = F.expr("cast(array() as array<string>)"), lambda *x: F.array(*map(F.lit, x))
    instances = table(spark, d, "orders").select(
        k.cast("string").alias("instance_id"),
        F.when(k % 2 == 0, "python").otherwise("cpp").alias("language"),
        F.when(k % 4 == 0, none).otherwise(some("1", "2")).alias("fail_to_pass"),
        F.when(k % 8 < 2, none).otherwise(some("3", "4")).alias("pass_to_pass"),
    )
    return scoring.grade(instances, statuses(spark, d))


@query(
    "a10_cross_classify",
    f"""WITH {STATUSES}, a AS (SELECT * FROM statuses WHERE CAST(instance_id AS BIGINT) % 3 > 0), b AS (SELECT CAST(CAST(instance_id AS BIGINT) + 1 AS VARCHAR) AS instance_id, test, status FROM statuses)
        SELECT coalesce(a.instance_id, b.instance_id) AS instance_id, coalesce(a.test, b.test) AS test,
            CASE WHEN a.status = 'PASSED' THEN 'P' ELSE 'F' END || '2' || CASE WHEN b.status = 'PASSED' THEN 'P' ELSE 'F' END AS kind
        FROM a FULL JOIN b ON a.instance_id = b.instance_id AND a.test = b.test""",
)
def a10(spark, d):
    s = statuses(spark, d)
    later = s.withColumn("instance_id", (F.col("instance_id").cast("long") + 1).cast("string"))
    return scoring.cross_classify(s.where(F.col("instance_id").cast("long") % 3 > 0), later)


@query(
    "a29_validation_result",
    f"""WITH {STATUSES} SELECT instance_id, count(*) FILTER (status = 'PASSED') AS passed, count(*) FILTER (status = 'FAILED') AS failed,
            count(*) FILTER (status = 'FAILED') = 0 AND count(*) FILTER (status = 'PASSED') > 0 AS resolved FROM statuses GROUP BY 1""",
)
def a29(spark, d):
    return scoring.validation_result(statuses(spark, d))


RUNS = """
    runs AS (SELECT CAST(user_id AS VARCHAR) AS instance_id, CAST(event_id % 3 AS INT) AS run, event_type AS test,
        CASE WHEN arg_max(value, event_id) > 20 THEN 'PASSED' ELSE 'FAILED' END AS status FROM events GROUP BY 1, 2, 3)
"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = [F.col("user_id").cast("string").alias("instance_id"), (F.col("event_id") % 3).cast("int").alias("run"), F.col("event_type").alias("test")]
    return table(spark, sf_dir, "events").groupBy(*by).agg(F.when(F.max_by("value", "event_id") > 20, "PASSED").otherwise("FAILED").alias("status"))


@query(
    "a11_flaky",
    f"""WITH {RUNS}, n AS (SELECT instance_id, count(DISTINCT run) AS n_runs FROM runs GROUP BY 1)
        SELECT r.instance_id, r.test, count(DISTINCT r.run) AS seen, count(DISTINCT r.status) AS kinds, n.n_runs,
            count(DISTINCT r.status) = 1 AND count(DISTINCT r.run) = n.n_runs AS stable FROM runs r JOIN n USING (instance_id) GROUP BY r.instance_id, r.test, n.n_runs""",
)
def a11(spark, d):
    return flaky.unanimous(runs(spark, d))


@query(
    "a11b_deflake",
    f"""WITH {RUNS}, n AS (SELECT instance_id, count(DISTINCT run) AS n_runs FROM runs GROUP BY 1),
        f AS (SELECT instance_id, list(test) AS flaky FROM (SELECT r.instance_id, r.test FROM runs r JOIN n USING (instance_id) GROUP BY r.instance_id, r.test, n.n_runs
            HAVING NOT (count(DISTINCT r.status) = 1 AND count(DISTINCT r.run) = n.n_runs)) GROUP BY 1),
        i AS (SELECT CAST(c_custkey AS VARCHAR) AS instance_id, CASE WHEN c_custkey % 9 = 0 THEN [] ELSE ['click', 'purchase', 'absent'] END AS covering_tests FROM customer),
        j AS (SELECT i.*, len(covering_tests) = 0 OR coalesce(n.n_runs, 0) < 3 AS as_is, coalesce(f.flaky, []) AS flaky FROM i LEFT JOIN n USING (instance_id) LEFT JOIN f USING (instance_id)),
        k AS (SELECT instance_id, CASE WHEN as_is THEN covering_tests ELSE list_filter(covering_tests, lambda t: NOT list_contains(flaky, t)) END AS covering_tests,
            CASE WHEN as_is THEN 'kept as is' ELSE 'filtered' END AS status FROM j)
        SELECT * FROM k WHERE status = 'kept as is' OR len(covering_tests) > 0""",
)
def a11b(spark, d):
    some = F.array(F.lit("click"), F.lit("purchase"), F.lit("absent"))
    tests = F.when(F.col("c_custkey") % 9 == 0, F.expr("cast(array() as array<string>)")).otherwise(some)
    return flaky.deflake(table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("instance_id"), tests.alias("covering_tests")), runs(spark, d))


@query(
    "a11c_modal_share",
    f"""WITH {RUNS}, c AS (SELECT instance_id, test, status, count(*) AS n, min(run) AS first FROM runs GROUP BY 1, 2, 3),
        s AS (SELECT instance_id, test, sum(n) AS seen FROM c GROUP BY 1, 2),
        u AS (SELECT * FROM c UNION ALL SELECT instance_id, test, 'MISSING', CAST(3 - seen AS BIGINT), 3 FROM s WHERE seen < 3),
        r AS (SELECT *, row_number() OVER (PARTITION BY instance_id, test ORDER BY n DESC, first, status DESC) AS k FROM u)
        SELECT instance_id, test, status, n, status <> 'MISSING' AND n / 3 >= 0.6 AS stable FROM r WHERE k = 1""",
)
def a11c(spark, d):
    return flaky.modal(runs(spark, d), 3, 0.6)


@query(
    "f17_significance",
    """SELECT p_partkey, CASE WHEN after >= before THEN false WHEN sd = 0 THEN before - after > 0 ELSE before - after > 2 * sd END AS significant
       FROM (SELECT p_partkey, p_retailprice AS before, p_retailprice * (0.8 + p_size / 100.0) AS after, CAST(p_size % 6 AS DOUBLE) * 20 AS sd FROM part)""",
)
def f17(spark, d):
    before = F.col("p_retailprice")
    return table(spark, d, "part").select("p_partkey", perf.is_significant(before, before * (0.8 + F.col("p_size") / 100.0), (F.col("p_size") % 6) * 20.0).alias("significant"))


@query("f18_older_significance", "SELECT p_partkey FROM part WHERE NOT (p_retailprice * (0.8 + p_size / 100.0) > p_retailprice - 2 * (p_size % 6) * 20)")
def f18(spark, d):
    bad = F.expr("p_retailprice * (0.8D + p_size / 100.0D) > p_retailprice - 2 * (p_size % 6) * 20")
    return table(spark, d, "part").where(~bad).select("p_partkey")


@query("f19_positive_finite", "SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE l_tax > 0 AND isfinite(l_tax)")
def f19(spark, d):
    return table(spark, d, "lineitem").where(perf.positive_finite(F.col("l_tax"))).select("l_orderkey", "l_linenumber", "l_tax")


@query(
    "f24_t01_top_patches",
    f"""WITH {REPORT} SELECT instance_id, round(human_speedup_ratio, 9) AS human_speedup_ratio FROM report WHERE human_speedup_ratio >= 1 AND correctness = 1
        ORDER BY round(human_speedup_ratio, 9) DESC, instance_id LIMIT 40""",
)
def f24(spark, d):
    rows = report_rows(spark, d).where("human_speedup_ratio >= 1 and correctness = 1").select("instance_id", F.round("human_speedup_ratio", 9).alias("human_speedup_ratio"))
    return rows.orderBy(F.col("human_speedup_ratio").desc(), "instance_id").limit(40)  # the report's top 40


@query(
    "x14_x15_perf_summaries",
    """SELECT p_partkey, p_retailprice AS before_mean, CAST(p_size AS DOUBLE) AS before_sd, p_retailprice / 2 AS after_mean, 0.5 AS after_sd,
          CASE WHEN p_retailprice <> 0 THEN (p_retailprice - p_retailprice / 2) / p_retailprice * 100 ELSE 0.0 END AS improvement,
          CASE WHEN p_partkey % 3 = 0 THEN 0.0 ELSE p_retailprice END AS by_position FROM part""",
)
def x14(spark, d):
    s = lambda c: F.col(c).cast("string")
    half = (F.col("p_retailprice") / 2).cast("string")
    apart = F.concat(F.lit("Before Mean: "), s("p_retailprice"), F.lit("\nBefore SD: "), s("p_size"), F.lit("\nAfter Mean: "), half, F.lit("\nAfter SD: 0.5\nImprovement: 1%"))
    inline = F.concat(F.lit("Before Mean: "), s("p_retailprice"), F.lit(" (SD: "), s("p_size"), F.lit(")\nAfter Mean: "), half, F.lit(" (SD: 0.5)"))
    text = F.when(F.col("p_partkey") % 3 == 0, inline).otherwise(apart)
    rows = table(spark, d, "part").select("p_partkey", perf.perf_by_label(text).alias("p"), perf.perf_by_position(text).alias("q"))
    return rows.select("p_partkey", "p.*", perf.improvement_pct(F.col("p.before_mean"), F.col("p.after_mean")).alias("improvement"), F.col("q.before_mean").alias("by_position"))


@query(
    "x27_a22_benchmark_stats",
    """SELECT l_suppkey AS name, round(CASE WHEN count(*) FILTER (l_linenumber = 1) > 0 THEN arg_min(v, pos) FILTER (l_linenumber = 1) ELSE avg(v) END, 9) AS mean,
          round(coalesce(CASE WHEN count(*) FILTER (l_linenumber = 2) > 0 THEN arg_min(v, pos) FILTER (l_linenumber = 2) END,
              stddev_samp(v) FILTER (l_linenumber > 2), 0), 9) AS sd
       FROM (SELECT l_suppkey, l_linenumber, l_orderkey * 10 + l_linenumber AS pos, l_quantity * CASE WHEN l_linestatus = 'F' THEN 1e-3 ELSE 1e-6 END AS v FROM lineitem) GROUP BY 1""",
)
def x27(spark, d):
    unit = F.when(F.col("l_linestatus") == "F", "ms").otherwise("us")
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("name"),
        F.when(F.col("l_linenumber") == 1, "mean").when(F.col("l_linenumber") == 2, "stddev").alias("aggregate_name"),
        perf.to_seconds(F.col("l_quantity"), unit).alias("value"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"),
    )
    return scoring.benchmark_stats(rows).select("name", F.round("mean", 9).alias("mean"), F.round("sd", 9).alias("sd"))


@query(
    "x30_x31_token_cost",
    """SELECT s.s_suppkey, coalesce(n.n_name, 'unknown') AS model, CAST(CAST(s_suppkey * 700 AS DECIMAL(20,6)) * 3.0 / 1000000
          + CAST(s_suppkey * 300 AS DECIMAL(20,6)) * 0.3 / 1000000 + CAST(s_suppkey * 50 AS DECIMAL(20,6)) * 15.0 / 1000000 AS DOUBLE) AS cost
       FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey""",
)
def x30(spark, d):
    alias = table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    k = F.col("s_suppkey")
    cost = perf.token_cost(k * 1000, k * 300, k * 50, F.lit(3.0), F.lit(0.3), F.lit(15.0))
    return table(spark, d, "supplier").join(alias, "s_nationkey", "left").select("s_suppkey", F.coalesce("n_name", F.lit("unknown")).alias("model"), cost.cast("double").alias("cost"))


@query(
    "a28_running_cost",
    """SELECT o_orderkey, round(sum(o_totalprice) OVER w, 2) AS spent, sum(o_totalprice) OVER w - o_totalprice <= 500000 AS allowed FROM orders
       WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""",
)
def a28(spark, d):
    rows = running_cost(table(spark, d, "orders"), ["o_orderdate", "o_orderkey"], "o_totalprice", 500000, ["o_custkey"])
    return rows.select("o_orderkey", F.round("spent", 2).alias("spent"), "allowed")


@query("a27_density", "SELECT c_nationkey, round(count(*) FILTER (c_acctbal < 0) / count(*), 6) AS density, CAST(trunc(count(*) * 0.37) AS INT) AS estimate FROM customer GROUP BY 1")
def a27(spark, d):
    n = F.count(F.lit(1))
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.round(F.coalesce(F.try_divide(F.count_if(F.col("c_acctbal") < 0), n), F.lit(0.0)), 6).alias("density"), (n * 0.37).cast("int").alias("estimate"))
