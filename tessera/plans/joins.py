"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import joins, ranking
from tessera.operators.curate import agreement_summary, file_agreement, incremental_pulls
from tessera.plans.registry import query, table
from tessera.sources.writers import concat_checked, upsert


@query(
    "j01_last_wins_lookup",
    """SELECT c.c_custkey, o.o_orderkey AS last_order, o.o_totalprice FROM customer c LEFT JOIN
          (SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey""",
)
def j01(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderkey").alias("last_order"), "o_totalprice")
    return joins.lookup_left(table(spark, d, "customer").select("c_custkey"), orders, ["c_custkey"], "o_orderkey").select("c_custkey", "last_order", "o_totalprice")


@query("j04_inner_with_coverage", "SELECT o_orderkey, list_sort(list(l_linenumber)) AS lines FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def j04(spark, d):
    covered = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list("l_linenumber")).alias("lines"))
    return table(spark, d, "orders").select("o_orderkey").join(covered, "o_orderkey")


@query(
    "j05_workload_join",
    """SELECT c.c_custkey, w.workload FROM customer c LEFT JOIN (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS workload FROM orders
          WHERE o_orderstatus <> 'P' GROUP BY 1) w ON c.c_custkey = w.o_custkey""",
)
def j05(spark, d):
    load = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority"))
    given = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", load.alias("workload")).where("workload <> ''")
    return joins.lookup_left(table(spark, d, "customer").select("c_custkey"), given, ["c_custkey"], "o_orderkey").select("c_custkey", "workload")


CLICKS = """
    c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
    r AS (SELECT user_id, ts, max(event_id) AS v FROM events WHERE event_type = 'signup' GROUP BY 1, 2)
"""


@query("j06_asof_strict", f"WITH {CLICKS} SELECT c.event_id, r.v AS value FROM c ASOF LEFT JOIN r ON c.user_id = r.user_id AND c.ts > r.ts")
def j06(spark, d):
    events = table(spark, d, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    return joins.asof(clicks, events.where("event_type = 'signup'"), "ts", "ts", "event_id", ["user_id"]).select("event_id", "value")


@query("j06_asof_inclusive", f"WITH {CLICKS} SELECT c.event_id, r.v AS value FROM c ASOF LEFT JOIN r ON c.user_id = r.user_id AND c.ts >= r.ts")
def j06i(spark, d):
    events = table(spark, d, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    return joins.asof(clicks, events.where("event_type = 'signup'"), "ts", "ts", "event_id", ["user_id"], strict=False).select("event_id", "value")


@query("j06_asof_hot_groups", "WITH c AS (SELECT event_id, ts FROM events WHERE event_type = 'click'), r AS (SELECT ts, max(event_id) AS v FROM events WHERE event_type = 'signup' GROUP BY 1) SELECT c.event_id, r.v AS value FROM c ASOF LEFT JOIN r ON c.ts > r.ts")
def j06h(spark, d):
    """One group only, cut into days."""
    events = table(spark, d, "events").withColumn("g", F.lit(1))
    clicks = events.where("event_type = 'click'").select("event_id", "g", "ts")
    found = joins.asof(clicks, events.where("event_type = 'signup'"), "ts", "ts", "event_id", ["g"], bucket=lambda t: F.date_trunc("day", t))
    return found.select("event_id", "value")


RELEASES = """
    monthly AS (SELECT date_trunc('month', o_orderdate) AS m, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
    rel AS (SELECT strftime(m, '%Y') || '.' || CAST(month(m) AS VARCHAR) AS v, first, last FROM monthly)
"""


def _releases(spark, d):
    month = F.date_trunc("month", "o_orderdate")
    version = F.concat_ws(".", F.year("m").cast("string"), F.month("m").cast("string"))
    rows = table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(month.alias("m")).agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return rows.select(F.lit(1).alias("g"), version.alias("v"), "first", "last")


def _month(t):
    return F.date_trunc("month", t)


def _tasks(spark, d):
    return table(spark, d, "lineitem").select(F.lit(1).alias("g"), "l_orderkey", "l_linenumber", "l_shipdate")


@query(
    "j06a_asof_min_oldest",
    f"""WITH {RELEASES} SELECT l_orderkey, l_linenumber, coalesce(rel.v, (SELECT arg_min(v, first) FROM rel)) AS version
        FROM lineitem ASOF LEFT JOIN rel ON l_shipdate > rel.first""",
)
def j06a(spark, d):
    found = joins.asof_release(_tasks(spark, d), _releases(spark, d), "l_shipdate", "first", "v", ["g"], fallback="oldest", bucket=_month)
    return found.select("l_orderkey", "l_linenumber", F.col("found_version").alias("version"))


@query(
    "j06b_asof_max_text",
    f"""WITH {RELEASES}, days AS (SELECT DISTINCT l_shipdate AS day FROM lineitem),
        best AS (SELECT day, max(v) AS version FROM days LEFT JOIN rel ON rel.last < day GROUP BY 1)
        SELECT l_orderkey, l_linenumber, version FROM lineitem JOIN best ON day = l_shipdate""",
)
def j06b(spark, d):
    found = joins.asof_release(_tasks(spark, d), _releases(spark, d), "l_shipdate", "last", "v", ["g"], pick="version", bucket=_month)
    return found.select("l_orderkey", "l_linenumber", F.col("found_version").alias("version"))


@query("j06c_asof_null", f"WITH {RELEASES} SELECT l_orderkey, l_linenumber, rel.v AS version FROM lineitem ASOF LEFT JOIN rel ON l_shipdate > rel.first")
def j06c(spark, d):
    found = joins.asof_release(_tasks(spark, d), _releases(spark, d), "l_shipdate", "first", "v", ["g"], bucket=_month)
    return found.select("l_orderkey", "l_linenumber", F.col("found_version").alias("version"))


@query(
    "j06d_asof_oldest",
    f"""WITH {RELEASES} SELECT l_orderkey, l_linenumber, coalesce(rel.v, (SELECT arg_min(v, last) FROM rel)) AS version
        FROM lineitem ASOF LEFT JOIN rel ON l_shipdate > rel.last""",
)
def j06d(spark, d):
    found = joins.asof_release(_tasks(spark, d), _releases(spark, d), "l_shipdate", "last", "v", ["g"], fallback="oldest", bucket=_month)
    return found.select("l_orderkey", "l_linenumber", F.col("found_version").alias("version"))


@query("j06e_asof_max_null", f"WITH {RELEASES} SELECT l_orderkey, l_linenumber, rel.v AS version FROM lineitem ASOF LEFT JOIN rel ON l_shipdate > rel.last")
def j06e(spark, d):
    found = joins.asof_release(_tasks(spark, d), _releases(spark, d), "l_shipdate", "last", "v", ["g"], bucket=_month)
    return found.select("l_orderkey", "l_linenumber", F.col("found_version").alias("version"))


@query(
    "j07_line_overlap",
    """WITH m AS (SELECT DISTINCT o_custkey AS instance_id, o_orderdate AS file, o_orderkey % 5 AS line FROM orders),
        c AS (SELECT o_custkey AS instance_id, l_suppkey AS test, o_orderdate AS file, l_linenumber AS line FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
        SELECT DISTINCT c.instance_id, c.test FROM c JOIN m ON c.instance_id = m.instance_id AND c.file = m.file AND c.line = m.line""",
)
def j07(spark, d):
    orders = table(spark, d, "orders")
    file = lambda p: F.concat(F.lit(p), F.col("o_orderdate").cast("string"))
    lines = orders.select(F.col("o_custkey").alias("instance_id"), file("./").alias("file"), (F.col("o_orderkey") % 5).cast("int").alias("line"))
    covered = orders.join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    covered = covered.select(F.col("o_custkey").alias("instance_id"), F.col("l_suppkey").alias("test"), file("").alias("file"), F.col("l_linenumber").alias("line"))
    return joins.line_overlap(lines, covered)


@query(
    "j08_suffix_match",
    """WITH a AS (SELECT DISTINCT regexp_replace(url, '^https?://', '') AS path FROM pages), r AS (SELECT DISTINCT regexp_extract(url, '/([^/]+)$', 1) AS rel FROM pages WHERE page_id % 3 = 0)
        SELECT path, min(rel) AS rel FROM a JOIN r ON path = rel OR ends_with(path, '/' || rel) WHERE rel <> '' GROUP BY 1""",
)
def j08(spark, d):
    pages = table(spark, d, "pages")
    absolute = pages.select(F.regexp_replace("url", "^https?://", "").alias("path")).distinct()
    relative = pages.where("page_id % 3 = 0").select(F.regexp_extract("url", r"/([^/]+)$", 1).alias("rel")).where("rel <> ''")
    return joins.suffix_matches(absolute, relative)


RANGES = """
    o AS (SELECT o_custkey, o_orderkey % 1000 AS b, o_orderkey % 1000 + 40 AS e FROM orders),
    i AS (SELECT o_custkey, o_orderkey % 977 AS b, o_orderkey % 977 + 10 AS e FROM orders)
"""


@query("j09_range_containment", f"WITH {RANGES} SELECT DISTINCT i.o_custkey, i.b AS begin, i.e AS end FROM i JOIN o ON i.o_custkey = o.o_custkey AND o.b <= i.b AND o.e >= i.e")
def j09(spark, d):
    rows = table(spark, d, "orders")
    part = lambda m, n: rows.select("o_custkey", (F.col("o_orderkey") % m).alias("begin"), (F.col("o_orderkey") % m + n).alias("end"))
    return joins.covering_ranges(part(1000, 40), part(977, 10), ["o_custkey"])


@query("j10_j11_semi", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def j10(spark, d):
    some = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(some, "o_custkey", "left_semi").select("o_orderkey")


@query("j12_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def j12(spark, d):
    done = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(done, "c_custkey", "left_anti").select("c_custkey")


@query(
    "j13_f25_reconcile",
    """SELECT c_custkey AS instance_id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'P')
          AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')""",
)
def j13(spark, d):
    orders = table(spark, d, "orders")
    patch = F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_orderstatus"))
    predictions = orders.select(F.col("o_custkey").alias("instance_id"), patch.alias("model_patch"))
    instances = table(spark, d, "customer").select(F.col("c_custkey").alias("instance_id"))
    return joins.reconcile(instances, predictions, orders.where("o_orderpriority like '1%'").select(F.col("o_custkey").alias("instance_id")))


@query(
    "j14_w08_update",
    """SELECT c_custkey, coalesce(n.seg, c_mktsegment) AS c_mktsegment, coalesce(n.bal, c_acctbal) AS c_acctbal FROM customer LEFT JOIN
          (SELECT o_custkey, arg_min(seg, o_orderkey) AS seg, arg_min(bal, o_orderkey) AS bal FROM
              (SELECT o_custkey, o_orderkey, o_orderpriority AS seg, o_totalprice AS bal FROM orders WHERE o_orderkey % 2 = 0) GROUP BY 1) n ON c_custkey = o_custkey""",
)
def j14(spark, d):
    new = table(spark, d, "orders").where("o_orderkey % 2 = 0")
    new = new.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderpriority").alias("c_mktsegment"), F.col("o_totalprice").alias("c_acctbal"))
    return joins.update_non_null(table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), new, ["c_custkey"], "o_orderkey")


SIDES = """
    a AS (SELECT l_suppkey AS k, round(sum(l_quantity), 2) AS v FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
    b AS (SELECT l_suppkey AS k, round(sum(l_quantity), 2) AS v FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 3 > 0 GROUP BY 1)
"""


@query("j16_full_delta", f"WITH {SIDES} SELECT coalesce(a.k, b.k) AS k, round(coalesce(b.v, 0) - coalesce(a.v, 0), 2) AS delta_v FROM a FULL JOIN b ON a.k = b.k")
def j16(spark, d):
    lines = table(spark, d, "lineitem")
    side = lambda c: lines.where(c).groupBy(F.col("l_suppkey").alias("k")).agg(F.round(F.sum("l_quantity"), 2).alias("v"))
    out = joins.full_delta(side("l_returnflag = 'A'"), side("l_returnflag = 'R' and l_suppkey % 3 > 0"), ["k"], ["v"])
    return out.withColumn("delta_v", F.round("delta_v", 2))


@query("j15_j17_both_sides", f"WITH {SIDES} SELECT k, a.v AS gold, b.v AS pred FROM a JOIN b USING (k)")
def j17(spark, d):
    lines = table(spark, d, "lineitem")
    side = lambda c, n: lines.where(c).groupBy(F.col("l_suppkey").alias("k")).agg(F.round(F.sum("l_quantity"), 2).alias(n))
    return side("l_returnflag = 'A'", "gold").join(side("l_returnflag = 'R' and l_suppkey % 3 > 0", "pred"), "k")


@query(
    "j18_shared_work",
    """SELECT o.o_orderkey, n.spec FROM orders o JOIN (SELECT o_custkey, 'v' || (o_custkey % 7) AS spec FROM (SELECT DISTINCT o_custkey FROM orders)
          WHERE o_custkey % 5 <> 0) n ON o.o_custkey = n.o_custkey WHERE o.o_orderkey % 10 > 0
       UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 10 = 0""",
)
def j18(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 > 0, F.col("o_custkey")).alias("key"))
    found = lambda keys: keys.where("key % 5 <> 0").withColumn("spec", F.concat(F.lit("v"), (F.col("key") % 7).cast("string")))
    return joins.share_work(rows, ["key"], found).select("o_orderkey", "spec")


@query(
    "j19_comments_before",
    """WITH i AS (SELECT conv_id, max(turn) - 1 AS cutoff FROM conversations GROUP BY 1)
        SELECT i.conv_id, i.cutoff, coalesce((SELECT string_agg(c.role, chr(10) ORDER BY c.turn) FROM conversations c WHERE c.conv_id = i.conv_id AND c.turn < i.cutoff), '') AS hints FROM i""",
)
def j19(spark, d):
    turns = table(spark, d, "conversations")
    items = turns.groupBy("conv_id").agg((F.max("turn") - 1).alias("cutoff"))
    out = joins.comments_before(items, turns.select("conv_id", "turn", "role"), "conv_id", "cutoff", "turn", "role")
    return out.withColumn("hints", F.coalesce("hints", F.lit("")))


@query("j20_length_lookup", "SELECT o_orderkey, coalesce(n, 0.0) AS length FROM orders LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n FROM lineitem WHERE l_tax > 0.04 GROUP BY 1) ON o_orderkey = l_orderkey")
def j20(spark, d):
    lengths = table(spark, d, "lineitem").where("l_tax > 0.04").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return table(spark, d, "orders").join(lengths, "o_orderkey", "left").select("o_orderkey", F.coalesce("n", F.lit(0.0)).alias("length"))


@query(
    "a19_file_agreement",
    """WITH g AS (SELECT o_custkey AS k, list_distinct(list(o_orderkey % 7)) AS gold FROM orders GROUP BY 1), p AS (SELECT o_custkey AS k, list_distinct(list(o_orderkey % 5)) AS pred FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
        j AS (SELECT k, gold, coalesce(pred, []) AS pred, pred IS NOT NULL AS evaluated FROM g LEFT JOIN p USING (k)),
        m AS (SELECT evaluated, len(list_intersect(gold, pred)) AS hit, len(list_distinct(gold || pred)) AS e, len(gold) AS a, len(pred) AS b FROM j)
        SELECT round(sum(CASE WHEN evaluated AND b > 0 THEN hit / b ELSE 0 END) / count(*), 9) AS macro_precision, round(sum(CASE WHEN evaluated THEN hit / a ELSE 0 END) / count(*), 9) AS macro_recall,
            round(sum(CASE WHEN evaluated THEN 2 * hit / (a + b) ELSE 0 END) / count(*), 9) AS macro_f1, round(sum(CASE WHEN evaluated THEN hit / e ELSE 0 END) / count(*), 9) AS macro_jaccard,
            round(count(*) FILTER (evaluated AND hit > 0) / count(*) FILTER (evaluated), 9) AS hit_rate, round(sum(hit) FILTER (evaluated) / sum(e) FILTER (evaluated), 9) AS micro_jaccard FROM m""",
)
def a19(spark, d):
    orders = table(spark, d, "orders")
    files = lambda df, m, n: df.groupBy("o_custkey").agg(F.collect_set(F.col("o_orderkey") % m).alias(n))
    rows = files(orders, 7, "gold").join(files(orders.where("o_orderstatus = 'F'"), 5, "pred"), "o_custkey", "left")
    rows = rows.withColumn("evaluated", F.col("pred").isNotNull()).withColumn("pred", F.coalesce("pred", F.expr("cast(array() as array<bigint>)")))
    out = agreement_summary(file_agreement(rows, "gold", "pred"), "evaluated")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query("k07_upsert", "SELECT o_custkey AS key, max(o_orderkey) AS fetched_at, arg_max(o_orderstatus, o_orderkey) AS value FROM orders GROUP BY 1")
def k07(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("fetched_at"), F.col("o_orderstatus").alias("value"))
    return upsert(rows.where("fetched_at % 2 = 0"), rows.where("fetched_at % 2 = 1"), ["key"], "fetched_at")


@query("s18_r04_cache_get", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type = 'click' AND value <= 50")
def s18(spark, d):
    from tessera.sources.readers import kv_get

    rows = table(spark, d, "events").select(F.col("event_type").alias("namespace"), F.col("event_id").alias("key"), F.col("props").alias("value"), (-F.col("value")).alias("fetched_at"))
    return kv_get(rows, "click", 0.0, 50.0).select(F.col("key").alias("event_id"), F.try_variant_get("value", "$.k", "long").alias("k"))


@query("k11_u01_union_checked", "SELECT s_name AS name, 'supplier' AS kind FROM supplier UNION ALL SELECT c_name, 'customer' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def k11(spark, d):
    suppliers = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    done = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    fresh = table(spark, d, "customer").join(done, "c_custkey", "left_anti")
    return concat_checked([suppliers, fresh.select(F.col("c_name").alias("name"), F.lit("customer").alias("kind"))])


@query("u02_w10_ordered_distinct", "SELECT source, min(doc_id) AS place FROM documents GROUP BY 1")
def u02(spark, d):
    docs = table(spark, d, "documents").select("source", "doc_id")
    return docs.groupBy("source").agg(F.min("doc_id").alias("place"))


@query("u03_first_parser_wins", "SELECT o_custkey AS test, CASE WHEN count(*) FILTER (o_orderstatus = 'F') > 0 THEN 'F' ELSE 'O' END AS status FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def u03(spark, d):
    rank = F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)
    return table(spark, d, "orders").where("o_orderstatus <> 'P'").groupBy(F.col("o_custkey").alias("test")).agg(F.min_by("o_orderstatus", rank).alias("status"))


@query(
    "u05_u06_set_algebra",
    """WITH s AS (SELECT o_custkey, list_sort(list_distinct(list(o_orderkey % 7))) AS a, list_sort(list_distinct(list(o_orderkey % 5))) AS b FROM orders GROUP BY 1)
        SELECT o_custkey, list_sort(list_intersect(a, b)) AS both, list_filter(a, lambda x: NOT list_contains(b, x)) AS only FROM s""",
)
def u05(spark, d):
    s = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set(F.col("o_orderkey") % 7).alias("a"), F.collect_set(F.col("o_orderkey") % 5).alias("b"))
    return s.select("o_custkey", F.sort_array(F.array_intersect("a", "b")).alias("both"), F.sort_array(F.array_except("a", "b")).alias("only"))


@query("u07_set_equality", "SELECT true AS same_ids, false AS same_rows")
def u07(spark, d):
    ids = table(spark, d, "orders").select("o_orderkey")
    rows = table(spark, d, "orders").select("o_custkey")
    same = ranking.mutually_equal(ids, ids.distinct()), ranking.mutually_equal(rows, rows.distinct())
    return spark.createDataFrame([same], "same_ids boolean, same_rows boolean")


@query(
    "t05_incremental_limit",
    """SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
       ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 25""",
)
def t05(spark, d):
    pulls = table(spark, d, "orders").select(F.col("o_orderkey").alias("number"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"))
    seen = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("number"))
    return incremental_pulls(pulls, seen, "1998-01-01", 25).select(F.col("number").alias("o_orderkey"))
