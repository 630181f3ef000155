"""Sources, sinks, graphs and streams."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.operators import graph
from tessera.plans.registry import numbered_lines, query, table
from tessera.sources import datasets, readers, writers
from tessera.sources.shared import new_path, shared_dir
from tessera.streaming import jobs, stateful


def shared(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which is the checkpoint folder too."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return new_path(spark, name)


@query("s01_s02_k01_jsonl_round_trip", "SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
def s01(spark, d):
    path = shared(spark, "jsonl")
    rows = table(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    writers.write_jsonl(rows, path)
    spark.createDataFrame([("",), ("{broken",)], "value string").write.mode("append").text(path)
    good, _ = readers.jsonl(spark, path, "c_custkey bigint, c_name string, c_mktsegment string")
    return good


@query("s01_k05_bad_lines", """SELECT '{"name":"' || c_name AS line FROM customer WHERE c_custkey % 4 = 1 UNION ALL SELECT c_name FROM customer WHERE c_custkey % 4 = 2 UNION ALL SELECT '{broken'""")
def s01b(spark, d):
    """Every other line is cut off or no JSON; blank ones are not bad."""
    path = shared(spark, "bad")
    k = F.col("c_custkey") % 4
    line = F.when(k == 0, F.to_json(F.struct(F.col("c_name").alias("name")))).when(k == 1, F.concat(F.lit('{"name":"'), F.col("c_name"))).when(k == 2, F.col("c_name")).otherwise("  ")
    table(spark, d, "customer").select(line.alias("value")).union(spark.createDataFrame([("",), ("{broken",)], "value string")).write.text(path)
    return readers.jsonl(spark, path, "name string")[1]


@query(
    "s04_k09_revisions",
    """WITH one AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 7 > 0), two AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'new' ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 6 > 0)
        SELECT 'at 1' AS part, CAST(k AS VARCHAR) AS id, v FROM one UNION ALL SELECT 'at 3', CAST(k AS VARCHAR), v FROM two UNION ALL SELECT 'dev', CAST(c_custkey AS VARCHAR), 'dev' FROM customer WHERE c_custkey % 7 = 0
        UNION ALL SELECT 'some', CAST(k AS VARCHAR), v FROM one WHERE k % 10 = 1
        UNION ALL SELECT 'change', CAST(coalesce(one.k, two.k) AS VARCHAR), CASE WHEN one.k IS NULL THEN 'added' WHEN two.k IS NULL THEN 'removed' ELSE 'changed' END FROM one FULL JOIN two ON one.k = two.k WHERE one.v IS DISTINCT FROM two.v""",
)
def s04(spark, d):
    """Three commits to two splits; two revisions, another split, some ids of the first revision, and what changed."""
    root, k = shared(spark, "dataset"), F.col("c_custkey")
    rows = table(spark, d, "customer")
    made = lambda some, v: rows.where(some).select(k.cast("string").alias("instance_id"), v.alias("v"))
    first = datasets.commit(made(k % 7 > 0, F.col("c_mktsegment")), root, "test")
    datasets.commit(made(k % 7 == 0, F.lit("dev")), root, "dev")
    datasets.commit(made((k % 6 > 0) & (k % 2 == 0), F.when(k % 5 == 0, "new").otherwise(F.col("c_mktsegment"))), root, "test")
    last = datasets.commit(made((k % 6 > 0) & (k % 2 == 1), F.when(k % 5 == 0, "new").otherwise(F.col("c_mktsegment"))), root, "test", mode="append")
    read = lambda part, split, **kw: datasets.load(spark, root, "instance_id string, v string", split, **kw).select(F.lit(part).alias("part"), F.col("instance_id").alias("id"), "v")
    some = rows.where((k % 7 > 0) & (k % 10 == 1)).select(k)
    parts = [read("at 1", "test", revision=first), read("at 3", "test"), read("dev", "dev", revision=last), read("some", "test", ids=some, revision=first)]
    found = datasets.changes(spark, root, "test", first, last).select(F.lit("change").alias("part"), "id", F.col("change").alias("v"))
    for part in parts:
        found = found.unionByName(part)
    return found


@query("s03_s04_s06_strict_instances", "SELECT 'acme__r-' || n_nationkey AS instance_id, n_name AS version FROM nation WHERE n_nationkey IN (3, 7)")
def s03(spark, d):
    path = shared(spark, "strict") + ".jsonl"
    rows = table(spark, d, "nation").select(F.concat(F.lit("acme__r-"), F.col("n_nationkey").cast("string")).alias("instance_id"), F.col("n_name").alias("version"))
    writers.write_jsonl(rows, path)
    return readers.instances(spark, path, "instance_id string, version string", ["acme__r-3", "acme__r-7"])


@query("s07_repos_json", "SELECT 'acme/' || n_name AS repo FROM nation UNION ALL SELECT 'beta/' || r_name FROM region UNION ALL SELECT 'gamma/' || r_name FROM region")
def s07(spark, d):
    path = shared(spark, "repos")
    names = lambda t, c, owner: table(spark, d, t).agg(F.collect_list(F.concat(F.lit(f"{owner}/"), F.col(c))).alias("a"))
    plain = names("nation", "n_name", "acme").select(F.to_json("a").alias("value"))
    objects = names("region", "r_name", "beta").select(F.to_json(F.transform("a", lambda x: F.struct(x.alias("full_name")))).alias("value"))
    wrapped = names("region", "r_name", "gamma").select(F.to_json(F.struct(F.col("a").alias("repos"))).alias("value"))
    for part in (plain, objects, wrapped):
        part.write.mode("append").text(path)
    return readers.repos_json(spark, path)


@query("s08_repos_text", "SELECT 'acme/' || n_name AS repo FROM nation WHERE n_nationkey % 2 = 0 AND NOT contains(n_name, ' ')")
def s08(spark, d):
    path = shared(spark, "list")
    line = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("acme/"), F.col("n_name"), F.lit("  # stars"))).otherwise(F.concat(F.lit("# acme/"), F.col("n_name")))
    table(spark, d, "nation").where("not contains(n_name, ' ')").select(line.alias("value")).write.text(path)
    return readers.repos_text(spark, path)


@query("s09_k02_csv_report", "SELECT s_suppkey, s_name, round(s_acctbal, 2) AS s_acctbal FROM supplier")
def s09(spark, d):
    path = shared(spark, "report")
    rows = table(spark, d, "supplier").select("s_suppkey", "s_name", F.round("s_acctbal", 2).alias("s_acctbal"))
    writers.write_report(rows, rows.agg(F.count(F.lit(1)).alias("n")), path)
    return readers.report_csv(spark, f"{path}/report.csv", "s_suppkey bigint, s_name string, s_acctbal double")


@query("s10_s11_files_by_directory", "SELECT CAST(r_regionkey AS VARCHAR) AS instance_id, CAST(r_regionkey + 1 AS DOUBLE) AS before_mean, 0.5 AS before_sd, 0.25 AS after_mean, 0.1 AS after_sd FROM region")
def s10(spark, d):
    path = shared(spark, "runs")
    text = F.concat(F.lit("Before Mean: "), (F.col("r_regionkey") + 1).cast("string"), F.lit("\nBefore SD: 0.5\nAfter Mean: 2.5e-1\nAfter SD: 0.1"))
    table(spark, d, "region").select(F.col("r_regionkey").alias("run"), text.alias("value")).repartition("run").write.partitionBy("run").text(path)
    return readers.perf_summaries(spark, f"{path}/run=*").withColumn("instance_id", F.regexp_replace("instance_id", "^run=", ""))


@query("k03_r01_append_ledger", "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey >= 10")
def k03(spark, d):
    path = shared(spark, "ledger")
    rows = table(spark, d, "nation").select("n_nationkey", "n_name")
    writers.append_new(rows.where("n_nationkey < 10"), path, "n_nationkey", "n_nationkey int, n_name string")
    return writers.append_new(rows, path, "n_nationkey", "n_nationkey int, n_name string")


@query("k04_u04_dual_sink", "SELECT n_nationkey FROM nation WHERE n_regionkey = 1")
def k04(spark, d):
    path = shared(spark, "dual")
    writers.write_both(table(spark, d, "nation").select("n_nationkey", "n_regionkey"), F.col("n_regionkey") == 1, path)
    return writers.read_shards(spark, [path], "n_nationkey int, n_regionkey int").select("n_nationkey")


@query("k08_k09_split_by", "SELECT n_nationkey, n_regionkey FROM nation")
def k08(spark, d):
    path = shared(spark, "split")
    writers.split_by(table(spark, d, "nation").select("n_nationkey", "n_regionkey"), "n_regionkey", path)
    return spark.read.schema("n_nationkey int, n_regionkey int").json(path)


@query("s16_istanbul_lines", "SELECT DISTINCT l_orderkey, '/src/f' || (l_suppkey % 5) || '.ts' AS file, CAST(l_partkey % 50 AS INT) AS line FROM lineitem WHERE l_quantity >= 10")
def s16(spark, d):
    rows = numbered_lines(spark, d).select("l_orderkey", F.concat(F.lit("/src/f"), (F.col("l_suppkey") % 5).cast("string"), F.lit(".ts")).alias("path"), F.col("pos").cast("string").alias("i"), (F.col("l_partkey") % 50).alias("line"), F.when(F.col("l_quantity") >= 10, 1).otherwise(0).alias("n"))
    start = F.struct(F.struct(F.col("line").alias("line")).alias("start"))
    files = rows.groupBy("l_orderkey", "path").agg(F.map_from_entries(F.collect_list(F.struct("i", start))).alias("statementMap"), F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("s"))
    text = files.groupBy("l_orderkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("path", F.struct("path", "statementMap", "s"))))).alias("json"))
    return readers.istanbul_lines(text, "json", ["l_orderkey"])


@query("s16b_gcovr_lines", "SELECT DISTINCT l_orderkey, 'f' || (l_suppkey % 5) || '.cpp' AS file, CAST(l_partkey % 50 AS INT) AS line FROM lineitem WHERE l_quantity >= 10")
def s16b(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", F.concat(F.lit("f"), (F.col("l_suppkey") % 5).cast("string"), F.lit(".cpp")).alias("file"), F.struct((F.col("l_partkey") % 50).alias("line_number"), F.when(F.col("l_quantity") >= 10, 4).otherwise(0).alias("count")).alias("l"))
    files = rows.groupBy("l_orderkey", "file").agg(F.collect_list("l").alias("lines"))
    text = files.groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(F.struct("file", "lines")).alias("files"))).alias("json"))
    return readers.gcovr_lines(text, "json", ["l_orderkey"])


# ten graphs over all lines; a part calls seven others, or as many as it has suppliers and lines
EDGES = """
    p AS (SELECT max(l_partkey) + 1 AS n FROM lineitem),
    e AS (SELECT DISTINCT l_suppkey % 10 AS g, l_partkey AS caller, (l_partkey * 7 + l_linenumber) % n AS callee FROM lineitem, p),
    r AS (SELECT g, min(caller) AS node FROM e GROUP BY g)
"""


def _edges(spark, d):
    shared(spark, "graph")
    rows = table(spark, d, "lineitem")
    p, n = F.col("l_partkey"), rows.agg(F.max("l_partkey") + 1).first()[0]
    return rows.select((F.col("l_suppkey") % 10).alias("graph"), p.alias("caller"), ((p * 7 + F.col("l_linenumber")) % n).alias("callee")).distinct()


def _roots(edges):
    return edges.groupBy("graph").agg(F.min("caller").alias("node"))


@query(
    "g01_g02_min_depths",
    f"""WITH RECURSIVE {EDGES}, w(g, node, depth) USING KEY (g, node) AS (
            SELECT g, node, 0 FROM r
            UNION
            SELECT w.g, e.callee, min(w.depth) + 1 FROM w JOIN e ON e.g = w.g AND e.caller = w.node LEFT JOIN recurring.w AS k ON k.g = e.g AND k.node = e.callee WHERE k.node IS NULL GROUP BY 1, 2)
        SELECT g AS graph, node, depth FROM w""",
)
def g01(spark, d):
    edges = _edges(spark, d)
    return graph.min_depths(edges, _roots(edges))


@query(
    "g03_ancestors",
    f"""WITH RECURSIVE {EDGES}, t AS (SELECT g, max(callee) AS node FROM e GROUP BY g), w(g, node) USING KEY (g, node) AS (
            SELECT e.g, e.caller FROM e JOIN t ON t.g = e.g AND e.callee = t.node
            UNION
            SELECT DISTINCT w.g, e.caller FROM w JOIN e ON e.g = w.g AND e.callee = w.node LEFT JOIN recurring.w AS k ON k.g = e.g AND k.node = e.caller WHERE k.node IS NULL)
        SELECT g AS graph, node FROM w""",
)
def g03(spark, d):
    edges = _edges(spark, d)
    return graph.ancestors(edges, edges.groupBy("graph").agg(F.max("callee").alias("node")))


@query("g04_edge_inversion", "SELECT l_suppkey AS caller, l_partkey AS callee, count(*) AS calls, round(sum(l_tax), 6) AS tot_time, round(sum(l_quantity), 6) AS cum_time FROM lineitem GROUP BY 1, 2")
def g04(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("func"), F.col("l_suppkey").alias("caller")).agg(F.count(F.lit(1)).alias("calls"), F.round(F.sum("l_tax"), 6).alias("tot_time"), F.round(F.sum("l_quantity"), 6).alias("cum_time"))
    return graph.invert(rows.groupBy("func").agg(F.collect_list(F.struct("caller", "calls", "tot_time", "cum_time")).alias("callers")))


@query(
    "g05_flame_layout",
    """WITH n AS (SELECT r_regionkey AS g, CAST(n_nationkey AS VARCHAR) AS node, CAST(n_nationkey + 1 AS DOUBLE) AS w FROM nation JOIN region ON r_regionkey = n_regionkey),
        one AS (SELECT g, node, coalesce(sum(w) OVER (PARTITION BY g ORDER BY node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(w) OVER (PARTITION BY g) AS l, w / sum(w) OVER (PARTITION BY g) AS p FROM n)
        SELECT g AS graph, 'root' AS node, 0 AS depth, 0.0 AS left, 1.0 AS width FROM region JOIN (SELECT DISTINCT g FROM n) ON g = r_regionkey
        UNION ALL SELECT g, node, 1, round(l, 9), round(p, 9) FROM one UNION ALL SELECT g, node || 'x', 2, round(l, 9), round(p, 9) FROM one""",
)
def g05(spark, d):
    shared(spark, "flame")
    rows = table(spark, d, "nation").select(F.col("n_regionkey").alias("graph"), F.col("n_nationkey").cast("string").alias("node"), (F.col("n_nationkey") + 1).cast("double").alias("weight"))
    edges = rows.withColumn("parent", F.lit("root")).unionByName(rows.select("graph", F.concat("node", F.lit("x")).alias("node"), "weight", F.col("node").alias("parent")))
    out = graph.flame_layout(edges)
    return out.select("graph", "node", "depth", F.round("left", 9).alias("left"), F.round("width", 9).alias("width"))


@query(
    "g06_unresolved_imports",
    """WITH f AS (SELECT DISTINCT 'pkg/' || source AS module FROM documents), i AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'none' ELSE source END AS name FROM documents)
        SELECT doc_id, name FROM i WHERE NOT EXISTS (SELECT 1 FROM f WHERE ends_with(f.module, '/' || i.name))""",
)
def g06(spark, d):
    from tessera.operators.joins import suffix_matches

    docs = table(spark, d, "documents")
    wanted = docs.select("doc_id", F.when(F.col("doc_id") % 4 == 0, "none").otherwise(F.col("source")).alias("name"))
    have = suffix_matches(docs.select(F.concat(F.lit("pkg/"), F.col("source")).alias("path")).distinct(), wanted.select(F.col("name").alias("rel")))
    return wanted.join(have.select(F.col("rel").alias("name")), "name", "left_anti").select("doc_id", "name")


@query(
    "a20_captured_gain",
    """WITH f AS (SELECT l_suppkey AS g, l_partkey % 5 AS file, l_partkey % 20 AS func, sum(l_quantity) AS gain FROM lineitem GROUP BY 1, 2, 3),
        p AS (SELECT DISTINCT l_suppkey AS g, l_partkey % 5 AS file, l_partkey % 20 AS func FROM lineitem WHERE l_returnflag = 'R' AND l_partkey % 5 < 3 AND l_partkey % 20 < 9),
        j AS (SELECT f.*, EXISTS (SELECT 1 FROM p WHERE p.g = f.g AND p.file = f.file AND p.func = f.func) AS a, EXISTS (SELECT 1 FROM p WHERE p.g = f.g AND p.file = f.file) AS b FROM f)
        SELECT g AS graph, round(coalesce(sum(gain) FILTER (a), 0) / sum(gain), 6) AS captured, round(coalesce(sum(gain) FILTER (NOT a AND b), 0) / sum(gain), 6) AS in_file_loss,
            round(coalesce(sum(gain) FILTER (NOT b), 0) / sum(gain), 6) AS wrong_file_loss FROM j GROUP BY 1""",
)
def a20(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("graph"), (F.col("l_partkey") % 5).alias("file"), (F.col("l_partkey") % 20).alias("func"), "l_quantity", "l_returnflag")
    gold = lines.groupBy("graph", "file", "func").agg(F.sum("l_quantity").alias("gain"))
    out = graph.captured_gain(gold, lines.where("l_returnflag = 'R' and file < 3 and func < 9"), "graph")
    return out.select("graph", *[F.round(c, 6).alias(c) for c in ("captured", "in_file_loss", "wrong_file_loss")])


@query(
    "a21_weighted_depth",
    """SELECT l_suppkey AS graph, round(sum(l_quantity * (l_linenumber - 1)) FILTER (l_linenumber < 6) / sum(l_quantity) FILTER (l_linenumber < 6), 6) AS avg_depth,
          round(coalesce(sum(l_quantity) FILTER (l_linenumber < 6), 0) / sum(l_quantity), 6) AS reachable_share FROM lineitem GROUP BY 1""",
)
def a21(spark, d):
    lines = numbered_lines(spark, d).select(F.col("l_suppkey").alias("graph"), F.concat_ws("-", "l_orderkey", "pos").alias("node"), "l_quantity", "l_linenumber")
    depths = lines.where("l_linenumber < 6").select("graph", "node", (F.col("l_linenumber") - 1).alias("depth"))
    out = graph.weighted_depth(lines, depths, "graph", "l_quantity")
    return out.select("graph", F.round("avg_depth", 6).alias("avg_depth"), F.round("reachable_share", 6).alias("reachable_share"))


@query("w12_greedy_selection")
def w12(spark, d):
    nodes = numbered_lines(spark, d).select(
        F.col("l_suppkey").alias("graph"), F.concat_ws("-", "l_orderkey", "pos").alias("node"), F.col("l_linenumber").alias("depth"), F.col("l_quantity").alias("mass"), F.col("l_tax").alias("share"),
        F.transform(F.sequence(F.lit(1), F.greatest(F.col("l_linenumber") - 1, F.lit(1))), lambda i: F.concat_ws("-", "l_orderkey", i)).alias("ancestors"),
    )
    return graph.greedy_selection(nodes, "graph", 0.8)


@query(
    "w12_deepest_orders",
    """WITH n AS (SELECT o_custkey AS g, o_orderkey AS node, o_orderkey % 8 AS depth, o_totalprice AS mass FROM orders),
        s AS (SELECT *, sum(mass) OVER w - mass AS before, 0.5 * sum(mass) OVER (PARTITION BY g) AS cap FROM n WINDOW w AS (PARTITION BY g ORDER BY depth DESC, mass DESC, node ROWS UNBOUNDED PRECEDING))
        SELECT g AS graph, node FROM s WHERE before < cap - 1e-12""",
)
def w12_flat(spark, d):
    """Without ancestors: the order and the cap alone."""
    nodes = table(spark, d, "orders").select(F.col("o_custkey").alias("graph"), F.col("o_orderkey").alias("node"), (F.col("o_orderkey") % 8).alias("depth"), F.col("o_totalprice").alias("mass"), F.array().cast("array<bigint>").alias("ancestors"))
    return graph.greedy_selection(nodes, "graph", 0.5)


def _event_stream(spark, d):
    files = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    path = shared(spark, "events")
    files.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    return jobs.json_stream(spark, path, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double")


@query("r01_r05_filter_stream", "SELECT event_id, event_type FROM events WHERE value > 50")
def r01(spark, d):
    out = shared(spark, "passed")
    rule = lambda df: df.where("value > 50").select("event_id", "event_type")
    jobs.filter_stream(_event_stream(spark, d), rule, "event_id", out, shared(spark, "state")).awaitTermination()
    return spark.read.schema("event_id bigint, event_type string").json(out)


@query("r02_stream_dedup", "SELECT user_id, event_type FROM events GROUP BY 1, 2")
def r02(spark, d):
    once = _event_stream(spark, d).dropDuplicates(["user_id", "event_type"]).select("user_id", "event_type")
    return jobs.run_to_table(once, shared(spark, "r02"), shared(spark, "state"))


@query("r06_windowed_counts", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def r06(spark, d):
    counted = jobs.windowed_counts(_event_stream(spark, d), "ts", ["event_type"], "1 day", "1000 days", "value")
    out = jobs.run_to_table(counted, shared(spark, "r06"), shared(spark, "state"), "complete")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    "r07_sessions",
    """WITH m AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
        s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM m)
        SELECT min(ts) AS start, user_id, count(*) AS n FROM s GROUP BY user_id, k""",
)
def r07(spark, d):
    found = jobs.sessions(_event_stream(spark, d), "ts", ["user_id"], "6 hours", "1000 days")
    out = jobs.run_to_table(found, shared(spark, "r07"), shared(spark, "state"), "complete")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "user_id", "n")


def _slices(spark, d, n: int = 4):
    """Events in n slices of time, each a few files written behind those of the one before: a stream that moves on."""
    rows = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    ends = rows.select(F.unix_micros("ts").alias("at")).agg(F.percentile_approx("at", [i / n for i in range(1, n)], 1000).alias("q")).first().q or []
    for low, high in zip([None, *ends], [*ends, None], strict=True):
        at = F.unix_micros("ts")
        yield rows.where((at > low if low is not None else F.lit(True)) & (at <= high if high is not None else F.lit(True)))


EVENT_TYPES = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def _moving_stream(spark, d):
    # files of some 125,000 rows, so that writing and reading a slice spreads over tasks
    path, files = shared(spark, "slices"), max(2, table(spark, d, "events").count() // 500_000)
    for part in _slices(spark, d):
        part.repartition(files).write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    return jobs.json_stream(spark, path, EVENT_TYPES, files)


#: The watermark that a stream of events ends with: milliseconds, an hour behind its last row.
WATERMARK = "(SELECT max(epoch_us(ts)) // 1000 * 1000 - 3600000000 AS now FROM events)"


@query(
    "r03_token_bucket",
    f"""WITH s AS (SELECT user_id, event_id, epoch_us(ts) AS arrived, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) AS i FROM events),
        f AS (SELECT *, max(arrived - (i - 1) * 21600000000) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + (i - 1) * 21600000000 AS filled FROM s),
        r AS (SELECT user_id, event_id, arrived, greatest(arrived, filled - 2 * 21600000000) AS released FROM f)
        SELECT user_id, event_id, arrived, released, released > arrived AS waited FROM r, {WATERMARK} WHERE released <= now""",
)
def r03_bucket(spark, d):
    """Three tokens a user, one more every six hours; all that the stream's watermark has let go."""
    limited = stateful.token_bucket(_moving_stream(spark, d), "user_id", "event_id", "ts", "1 hour", 3, 6 * 3600 * 10**6)
    with stateful.rocksdb(spark):
        out = jobs.run_to_table(limited, shared(spark, "r03"), shared(spark, "state"))
    return out.select(F.col("key").alias("user_id"), F.col("id").alias("event_id"), "arrived", "released", (F.col("released") > F.col("arrived")).alias("waited"))


@query(
    "r03_paced_table",
    """WITH RECURSIVE s AS (SELECT user_id, event_id, epoch_us(ts) AS t, 1 + event_id % 3 AS cost, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) AS i FROM events),
        b AS (
            SELECT user_id, event_id, i, t AS arrived, t AS released, t + cost * 3600000000 AS filled FROM s WHERE i = 1
            UNION ALL
            SELECT s.user_id, s.event_id, s.i, s.t, greatest(s.t, b.filled - (5 - s.cost) * 3600000000), greatest(s.t, b.filled) + s.cost * 3600000000 FROM b JOIN s ON s.user_id = b.user_id AND s.i = b.i + 1)
        SELECT user_id, event_id, arrived, released FROM b""",
)
def r03_paced(spark, d):
    """The same over a whole table by windows, rows costing one to three of five tokens; the SQL goes row by row."""
    rows = table(spark, d, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    out = stateful.paced(rows, "user_id", "event_id", "ts", 5, 3600 * 10**6, F.col("event_id") % 3 + 1)
    return out.select(F.col("key").alias("user_id"), F.col("id").alias("event_id"), "arrived", "released")


@query(
    "r04_expiring_keys",
    f"""WITH RECURSIVE s AS (SELECT user_id || '/' || event_type AS key, event_id, epoch_us(ts) AS t FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL),
        lives AS (
            SELECT key, min(t) AS t, 1 AS life FROM s GROUP BY key
            UNION ALL
            SELECT s.key, min(s.t), l.life + 1 FROM lives l JOIN s ON s.key = l.key AND s.t >= l.t + 432000000000 GROUP BY s.key, l.life)
        SELECT key, 'new' AS event, l.t AS "at", (SELECT min(event_id) FROM s WHERE s.key = l.key AND s.t = l.t) AS id, 0 AS hits FROM lives l, {WATERMARK} WHERE l.t <= now
        UNION ALL
        SELECT key, 'expired', l.t + 432000000000, NULL, (SELECT count(*) - 1 FROM s WHERE s.key = l.key AND s.t >= l.t AND s.t < l.t + 432000000000) FROM lives l, {WATERMARK} WHERE l.t + 432000000000 <= now""",
)
def r04_expiring(spark, d):
    """Keys that are known for five days, are forgotten, and come again."""
    key = F.concat_ws("/", F.col("user_id").cast("string"), "event_type")
    found = stateful.expiring_keys(_moving_stream(spark, d), F.when(F.col("user_id").isNotNull() & F.col("event_type").isNotNull(), key), "event_id", "ts", "1 hour", 5 * 24 * 3600 * 10**6)
    with stateful.rocksdb(spark):
        return jobs.run_to_table(found, shared(spark, "r04"), shared(spark, "state"))


@query("r01_r05_live_tail", "SELECT event_id, event_type, 1 AS copies FROM events WHERE value > 50")
def r01_tail(spark, d):
    """Slices arrive while the query runs; it is stopped between output and ledger of its second batch and started again."""
    path, out, state = shared(spark, "arriving"), shared(spark, "tail"), shared(spark, "state")
    sink = jobs.IdempotentSink(out, shared(spark, "ledger"), crash_at=1)
    slices = list(_slices(spark, d))
    slices[0].write.json(path)
    passed = jobs.json_stream(spark, path, EVENT_TYPES).where("value > 50").select("event_id", "event_type")
    tail = jobs.live_tail(passed, sink, state, "100 milliseconds")
    try:
        for part in slices[1:]:
            try:
                tail.processAllAvailable()
            except StreamingQueryException:
                tail = jobs.live_tail(passed, sink, state, "100 milliseconds")
            part.write.mode("append").json(path)
        tail.processAllAvailable()
    except StreamingQueryException:
        tail = jobs.live_tail(passed, sink, state, "100 milliseconds")
        tail.processAllAvailable()
    finally:
        tail.stop()
    known = sink.rows(spark, "event_id bigint, event_type string").join(sink.ledger(spark).select("batch"), "batch", "left_semi")
    return known.groupBy("event_id", "event_type").agg(F.count(F.lit(1)).cast("int").alias("copies"))


@query("r03_r04_stream_expiry", "SELECT user_id, event_type, min(ts) IS NOT NULL AS seen FROM events GROUP BY 1, 2")
def r03(spark, d):
    """The rate is the stream's files per trigger; keys expire with the event time."""
    once = jobs.dedup_with_expiry(_event_stream(spark, d), ["user_id", "event_type"], "ts", "1000 days")
    out = jobs.run_to_table(once.select("user_id", "event_type", "ts"), shared(spark, "r03"), shared(spark, "state"))
    return out.select("user_id", "event_type", F.col("ts").isNotNull().alias("seen"))
