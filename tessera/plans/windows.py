"""Aggregates, windows, ranks, bins and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import bins
from tessera.operators import curate, ranking, sampling
from tessera.plans.registry import query, table


@query("a12_grouped_median", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median FROM lineitem GROUP BY 1")
def a12(spark, d):
    found = ranking.exact_quantiles(table(spark, d, "lineitem"), "l_extendedprice", {"median": 0.5}, ["l_returnflag"])
    return found.withColumn("median", F.round("median", 4))


@query("a13_value_counts", "SELECT source, count(*) AS n FROM documents GROUP BY 1")
def a13(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("a14_min_mean_max", "SELECT l_shipdate > TIMESTAMP '1998-01-01' AS late, min(l_tax) FILTER (l_tax > 0) AS lo, round(avg(l_tax) FILTER (l_tax > 0), 9) AS mean, max(l_tax) AS hi FROM lineitem GROUP BY 1")
def a14(spark, d):
    x = F.nanvl(F.when(F.col("l_tax") > 0, F.col("l_tax")).otherwise(float("nan")), F.lit(None).cast("double"))
    late = (F.col("l_shipdate") > F.lit("1998-01-01").cast("timestamp_ntz")).alias("late")
    return table(spark, d, "lineitem").groupBy(late).agg(F.min(x).alias("lo"), F.round(F.avg(x), 9).alias("mean"), F.max(x).alias("hi"))


@query(
    "a15_describe",
    """SELECT count(n_chars) AS n, round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS sd, min(n_chars) AS lo, round(quantile_cont(n_chars, 0.25), 4) AS q1,
          round(quantile_cont(n_chars, 0.5), 4) AS q2, round(quantile_cont(n_chars, 0.75), 4) AS q3, max(n_chars) AS hi FROM documents""",
)
def a15(spark, d):
    x, docs = F.col("n_chars"), table(spark, d, "documents")
    plain = docs.agg(F.count(x).alias("n"), F.round(F.avg(x), 6).alias("mean"), F.round(F.stddev_samp(x), 6).alias("sd"), F.min(x).alias("lo"), F.max(x).alias("hi"))
    found = ranking.exact_quantiles(docs, "n_chars", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    both = plain.join(F.broadcast(found), how="left")  # one row each
    return both.select("n", "mean", "sd", "lo", *[F.round(q, 4).alias(q) for q in found.columns], "hi")


@query("a16_p08_token_sums", "SELECT l_orderkey, CAST(sum(l_linenumber) AS BIGINT) AS prompt, CAST(sum(l_quantity) AS BIGINT) AS completion, count(*) AS calls FROM lineitem GROUP BY 1")
def a16(spark, d):
    use = F.struct(F.col("l_linenumber").cast("long").alias("p"), F.col("l_quantity").cast("long").alias("c"))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(use).alias("usages"))
    total = lambda f: F.aggregate("usages", F.lit(0).cast("long"), lambda s, u: s + u[f])
    return rows.select("l_orderkey", total("p").alias("prompt"), total("c").alias("completion"), F.size("usages").cast("long").alias("calls"))


@query("a18_stats", "SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS kept, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS share FROM orders")
def a18(spark, d):
    kept = F.count_if(F.col("o_orderstatus") == "F")
    return table(spark, d, "orders").agg(F.count(F.lit(1)).alias("total"), kept.alias("kept"), F.round(kept / F.count(F.lit(1)), 6).alias("share"))


@query(
    "a23_run_report",
    """WITH i AS (SELECT c_custkey FROM customer), p AS (SELECT o_custkey AS c_custkey, CASE WHEN max(o_orderkey) % 4 = 0 THEN '' ELSE 'x' END AS patch FROM orders GROUP BY 1),
        r AS (SELECT o_custkey AS c_custkey, max(o_orderkey) % 3 = 0 AS resolved FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
        SELECT CASE WHEN patch IS NULL THEN 'incomplete' WHEN patch = '' THEN 'empty_patch' WHEN resolved IS NULL THEN 'error' WHEN resolved THEN 'resolved' ELSE 'unresolved' END AS outcome,
            count(*) AS n FROM i LEFT JOIN p USING (c_custkey) LEFT JOIN r USING (c_custkey) GROUP BY 1""",
)
def a23(spark, d):
    orders = table(spark, d, "orders")
    predictions = orders.groupBy(F.col("o_custkey").alias("instance_id")).agg(F.when(F.max("o_orderkey") % 4 == 0, "").otherwise("x").alias("model_patch"))
    reports = orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("instance_id")).agg((F.max("o_orderkey") % 3 == 0).alias("resolved"))
    return curate.run_report(table(spark, d, "customer").select(F.col("c_custkey").alias("instance_id")), predictions, reports)


@query("a24_group_rows", "SELECT c_nationkey, c_mktsegment, list_sort(list(c_custkey)) AS ids FROM customer GROUP BY 1, 2")
def a24(spark, d):
    return table(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.sort_array(F.collect_list("c_custkey")).alias("ids"))


WORDS = ["the", "is", "queue", "Haa", "and the", "zebra"]


@query("a26_keyword_counts", " UNION ALL ".join(f"SELECT '{w}' AS keyword, count(*) FILTER (contains(lower(text || chr(10) || source), lower('{w}'))) AS n FROM documents" for w in WORDS))
def a26(spark, d):
    return curate.keyword_counts(table(spark, d, "documents"), WORDS, ["text", "source"])


CURVE = """
    t AS (SELECT l_returnflag AS model, l_quantity AS x, count(*) AS n, sum(1 / l_discount) AS s FROM lineitem WHERE l_discount > 0 AND l_quantity > 0 GROUP BY 1, 2),
    c AS (SELECT model, x, CAST(sum(n) OVER w AS BIGINT) AS n, sum(n) OVER w / sum(s) OVER w AS hm FROM t WINDOW w AS (PARTITION BY model ORDER BY x))
"""


@query("w01_harmonic_curve", f"WITH {CURVE} SELECT model, x, n, round(hm, 6) AS hm FROM c")
def w01(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("model"), F.col("l_quantity").alias("x"), "l_discount")
    return ranking.harmonic_curve(lines, "x", "l_discount", ["model"]).withColumn("hm", F.round("hm", 6))


@query(
    "w01_w02_curve_on_grid",
    f"""WITH {CURVE}, e AS (SELECT quantile_cont(l_quantity, 0.05) AS lo, quantile_cont(l_quantity, 0.95) AS hi FROM lineitem WHERE l_quantity > 0),
        g AS (SELECT i, lo * pow(hi / lo, i / 9) AS threshold FROM e, range(10) r(i))
        SELECT g.i, m.model, round(g.threshold, 6) AS threshold, round(c.hm, 6) AS hm
        FROM (SELECT i, threshold, threshold + 1e-9 AS t FROM g) g CROSS JOIN (SELECT DISTINCT model FROM c) m ASOF LEFT JOIN c ON m.model = c.model AND g.t >= c.x""",
)
def w02(spark, d):
    from tessera.operators.joins import asof

    lines = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("model"), F.col("l_quantity").alias("x"), "l_discount")
    curve = ranking.harmonic_curve(lines, "x", "l_discount", ["model"])
    models = F.array_distinct(F.array(*[F.lit(m) for m in "ANR"]))
    grid = ranking.log_grid(lines, "x", 0.05, 0.95, 10).select("i", "threshold", (F.col("threshold") + 1e-9).alias("t"), F.explode(models).alias("model"))
    out = asof(grid, curve, "t", "x", "hm", ["model"], strict=False, found="hm")
    return out.select("i", "model", F.round("threshold", 6).alias("threshold"), F.round("hm", 6).alias("hm"))


EDGES = [1.0, 5.0, 10.0, 20.0, 35.0, 50.0]
_LEFT = " ".join(f"WHEN l_quantity >= {a} AND l_quantity < {b} THEN {i}" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:], strict=False)))
_RIGHT = " ".join(f"WHEN l_quantity > {a} AND l_quantity <= {b} THEN {i}" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:], strict=False)))


@query("w03_bins_left", f"WITH b AS (SELECT CASE {_LEFT} END AS bin FROM lineitem) SELECT bin, count(*) AS n FROM b WHERE bin IS NOT NULL GROUP BY 1 HAVING count(*) >= 3")
def w03(spark, d):
    b = bins.bin_index(F.col("l_quantity"), EDGES, "left")
    return table(spark, d, "lineitem").groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n")).where("bin is not null and n >= 3")


@query("w04_bins_right", f"WITH b AS (SELECT CASE WHEN l_quantity = 1 THEN 0 {_RIGHT} END AS bin, l_tax FROM lineitem) SELECT bin, count(*) AS n, round(quantile_cont(l_tax, 0.5), 6) AS median FROM b WHERE bin IS NOT NULL GROUP BY 1")
def w04(spark, d):
    b = bins.bin_index(F.col("l_quantity"), EDGES, "right", keep_ends=True)
    rows = table(spark, d, "lineitem").select(b.alias("bin"), "l_tax").where("bin is not null")
    medians = ranking.exact_quantiles(rows, "l_tax", {"median": 0.5}, ["bin"]).withColumn("median", F.round("median", 6))
    return rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).join(medians, "bin", "left")


@query(
    "w05_quantile_bins",
    """WITH e AS (SELECT list_sort(list_distinct(quantile_cont(l_quantity, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges FROM lineitem)
        SELECT greatest(len(list_filter(edges, lambda x: x < l_quantity)) - 1, 0) AS bin, count(*) AS n FROM lineitem, e GROUP BY 1""",
)
def w05(spark, d):
    return ranking.quantile_bins(table(spark, d, "lineitem"), "l_quantity", 5).groupBy(F.col("bin").cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("w06_inner_bins", "SELECT CASE WHEN c_acctbal <= 0 THEN 0 ELSE (c_acctbal >= 100)::INT + (c_acctbal >= 1000)::INT + (c_acctbal >= 5000)::INT END AS bin, count(*) AS n FROM customer GROUP BY 1")
def w06(spark, d):
    return table(spark, d, "customer").groupBy(bins.inner_bin(F.col("c_acctbal"), [100, 1000, 5000]).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "w07_zero_filled_histogram",
    """SELECT s.c_mktsegment, CAST(b.bin AS INT) AS bin, count(c.c_custkey) AS n FROM (SELECT DISTINCT c_mktsegment FROM customer) s CROSS JOIN range(12) b(bin)
       LEFT JOIN customer c ON c.c_mktsegment = s.c_mktsegment AND CAST(floor(c.c_acctbal / 1000) AS INT) = b.bin GROUP BY 1, 2""",
)
def w07(spark, d):
    rows = table(spark, d, "customer").withColumn("bin", F.floor(F.col("c_acctbal") / 1000).cast("int"))
    return ranking.zero_filled_counts(rows.where("bin between 0 and 11"), "bin", 12, ["c_mktsegment"])


@query("w08_first_wins", "SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1")
def w08(spark, d):
    return ranking.first_wins(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"])


@query("w09_last_value_first_place", "SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus, max(o_orderkey) AS o_orderkey, min(o_orderkey) AS place FROM orders GROUP BY 1")
def w09(spark, d):
    return ranking.last_value_first_place(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], "o_orderkey")


@query("w11_unique_prefix", "SELECT o_custkey, min(o_orderkey) AS o_orderkey, 't' || (o_custkey % 50) || o_orderstatus AS prefix FROM orders GROUP BY o_custkey, o_orderstatus HAVING count(*) = 1")
def w11(spark, d):
    name = F.concat(F.lit("t"), (F.col("o_custkey") % 50).cast("string"), F.col("o_orderstatus"), F.lit("["), F.col("o_orderkey").cast("string"), F.lit("]"))
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", name.alias("test"))
    return ranking.unique_prefix(rows, "test", ["o_custkey"]).select("o_custkey", "o_orderkey", "prefix")


@query(
    "w13_interval_merge",
    """WITH r AS (SELECT o_custkey AS g, o_orderkey % 2000 AS b, o_orderkey % 2000 + 1 + o_orderkey % 90 AS e FROM orders),
        m AS (SELECT *, max(e) OVER (PARTITION BY g ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM r),
        i AS (SELECT *, sum(CASE WHEN upto IS NULL OR b > upto THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS k FROM m)
        SELECT g, min(b) AS begin, max(e) AS end FROM i GROUP BY g, k""",
)
def w13(spark, d):
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("g"), (k % 2000).alias("begin"), (k % 2000 + 1 + k % 90).alias("end"))
    return ranking.merge_intervals(rows, ["g"])


@query("w14_contiguous_chunks", "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INT) AS chunk FROM orders")
def w14(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey")
    return ranking.contiguous_chunks(rows, F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 5000), 7)


@query("w15_stride_chunks", "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % 7 AS INT) AS chunk FROM orders")
def w15(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey")
    return ranking.stride_chunks(rows, F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 5000), 7)


@query("w16_running_numbers", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rank FROM orders")
def w16(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return ranking.running_numbers(rows, F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 5000), ["o_orderstatus"]).select("o_orderkey", "rank")


@query("t02_top_reversed", "SELECT * FROM (SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 10) ORDER BY s_acctbal, s_suppkey DESC")
def t02(spark, d):
    top = table(spark, d, "supplier").select("s_suppkey", "s_acctbal").orderBy(F.col("s_acctbal").desc(), "s_suppkey").limit(10)  # the report's ten
    return top.orderBy("s_acctbal", F.col("s_suppkey").desc())


@query("t03_t04_ranked", "SELECT s_suppkey, row_number() OVER (ORDER BY coalesce(nullif(floor(s_acctbal / 1000), 0), 0), s_nationkey % 5 = 0, s_suppkey) AS place FROM supplier")
def t03(spark, d):
    first = F.coalesce(F.nullif(F.floor(F.col("s_acctbal") / 1000), F.lit(0)), F.lit(0))
    second = F.coalesce(F.when(F.col("s_nationkey") % 5 != 0, 0), F.lit(1))  # nulls last
    ranked = ranking.running_numbers(table(spark, d, "supplier"), F.struct(first, second, "s_suppkey"), first, [])
    return ranked.select("s_suppkey", F.col("rank").alias("place"))


@query("t07_t08_stratified_sample")
def t07(spark, d):
    return ranking.stratified_sample(table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_orderstatus", "o_orderpriority"], 200, 7, "o_orderkey")


@query("t07_quota_sample")
def t07_quotas(spark, d):
    """600 orders, spread as all are by lines, price and time to ship, and rare combinations of them."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("double").alias("lines"), F.sum("l_extendedprice").alias("price"), F.max(F.col("l_quantity") / (F.col("l_tax") + 0.01)).alias("load"))
    return sampling.quota_sample(lines, "l_orderkey", ["lines", "price", "load"], 600, bins=12, seed=7)


@query("t09_capped_list", "SELECT o_custkey, list_slice(list_sort(list(o_orderkey)), 1, 10) AS some FROM orders GROUP BY 1")
def t09(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.slice(F.sort_array(F.collect_list("o_orderkey")), 1, 10).alias("some"))
