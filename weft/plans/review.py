"""Queries over review ledgers, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import graph as G
from weft.operators import review as W
from weft.plans.graph import H, HG, _levels, h_edges
from weft.plans.relational import t

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


@query("""WITH RECURSIVE c AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN role || conv_id % 2 END AS k, turn % 5 = 4 AS s, conv_id % 3 = 0 OR turn % 2 = 1 AS a,
row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
r AS (SELECT conv_id, turn, n, a, k AS kind FROM c WHERE n = 1 UNION ALL
SELECT c.conv_id, c.turn, c.n, c.a, coalesce(c.k, CASE WHEN c.s OR (c.a = r.a AND r.kind <> 'user0') THEN r.kind END) FROM r JOIN c ON c.conv_id = r.conv_id AND c.n = r.n + 1)
SELECT conv_id, turn, kind FROM r""")
def kind_inheritance(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    c = c.select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, F.concat("role", (F.col("conv_id") % 2).cast("string"))).alias("k"), ((F.col("conv_id") % 3 == 0) | (F.col("turn") % 2 == 1)).alias("a"))
    return W.inherited_kinds(c, "conv_id", "turn", "k", F.col("turn") % 5 == 4, "a", "user0")


STAGES = ["view", "click", "purchase"]


@query(f"""WITH e AS (SELECT DISTINCT user_id FROM events WHERE user_id % 2 = 0), w AS (SELECT user_id, s AS event_type FROM e, (SELECT unnest({STAGES}) AS s)),
n AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_id % 7 = 0 GROUP BY ALL)
SELECT coalesce(w.event_type, n.event_type) AS event_type, coalesce(w.user_id, n.user_id) AS user_id, CASE WHEN w.user_id IS NULL THEN 'unexpected' WHEN n.n IS NULL THEN 'missing' ELSE 'duplicate' END AS fault
FROM w FULL JOIN n ON w.user_id = n.user_id AND w.event_type = n.event_type WHERE w.user_id IS NULL OR n.n IS NULL OR n.n > 1""")
def staged_coverage(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    return W.stage_faults(e.filter("event_id % 7 = 0").select("user_id", "event_type"), e.filter("user_id % 2 = 0").select("user_id"), STAGES, "user_id", "event_type")


@query("""WITH r AS (SELECT d.doc_id, CASE WHEN quality = 1 THEN 'accepted' ELSE 'rejected' END AS r1, CASE WHEN n_chars >= 200 THEN 'accepted' ELSE 'rejected' END AS r2,
CASE WHEN toxic = 1 THEN 'rejected' END AS board, CASE WHEN d.doc_id % 2 = 0 THEN 'passed' ELSE 'open' END AS audit, CASE WHEN d.doc_id % 3 = 0 THEN 1 END AS target, CASE WHEN d.doc_id % 5 = 0 THEN 'merge_existing' ELSE 'create_new' END AS act
FROM documents d JOIN labels l ON d.doc_id = l.doc_id), x AS (SELECT *, CASE WHEN board IS NOT NULL AND audit = 'passed' THEN board WHEN board IS NOT NULL THEN 'pending' WHEN r1 = r2 THEN r1 END AS d FROM r)
SELECT doc_id, CASE WHEN d = 'accepted' AND act = 'merge_existing' AND target IS NULL THEN 'pending' ELSE coalesce(d, 'pending') END AS decision FROM x""")
def final_decisions(spark, sf_dir):
    d = t(spark, sf_dir, "documents").join(t(spark, sf_dir, "labels"), "doc_id")
    i = F.col("doc_id")
    status = lambda ok: F.when(ok, "accepted").otherwise("rejected")
    out = W.final_decision(
        status(F.col("quality") == 1), status(F.col("n_chars") >= 200), F.when(F.col("toxic") == 1, "rejected"), F.when(i % 2 == 0, "passed").otherwise("open"),
        F.when(i % 3 == 0, 1), F.when(i % 5 == 0, "merge_existing").otherwise("create_new"),
    )
    return d.select("doc_id", out.alias("decision"))


@query("""SELECT p_partkey, CASE WHEN p_size > 45 THEN 'excluded' WHEN coalesce(n, 0) = 0 THEN 'no_match' WHEN n > 32 AND NOT e THEN 'inconclusive' ELSE 'accepted' END AS class
FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n, bool_or(l_quantity > 49) AS e FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey""")
def coverage_classes(spark, sf_dir):
    hits = t(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"), F.bool_or(F.col("l_quantity") > 49).alias("e"))
    p = t(spark, sf_dir, "part").join(hits, "p_partkey", "left")
    return p.select("p_partkey", W.coverage_class(F.col("p_size") > 45, F.col("n"), F.coalesce("e", F.lit(False)), 32).alias("class"))


@query("""WITH a AS (SELECT c_custkey AS candidate, c_nationkey AS grp, CASE WHEN c_custkey % 2 = 0 THEN 'person-' || lpad((c_custkey % 50)::VARCHAR, 6, '0') END AS target FROM customer WHERE c_acctbal > 0),
g AS (SELECT grp, row_number() OVER (ORDER BY grp) + (SELECT max(s_suppkey) FROM supplier) AS n FROM (SELECT DISTINCT grp FROM a WHERE target IS NULL))
SELECT candidate, coalesce(target, 'person-' || lpad(n::VARCHAR, 6, '0')) AS entity, CASE WHEN target IS NULL THEN 'create_new' ELSE 'merge_existing' END AS action FROM a LEFT JOIN g USING (grp)""")
def promotion(spark, sf_dir):
    from weft.operators.relational import padded_id

    c = t(spark, sf_dir, "customer").filter("c_acctbal > 0")
    a = c.select(F.col("c_custkey").alias("candidate"), F.col("c_nationkey").alias("grp"), F.when(F.col("c_custkey") % 2 == 0, padded_id("person-", F.col("c_custkey") % 50)).alias("target"))
    return W.promoted(a, t(spark, sf_dir, "supplier").select(padded_id("person-", F.col("s_suppkey")).alias("entity")), "grp", "person-")


@query("""WITH m AS (SELECT DISTINCT l_suppkey AS entity, l_orderkey AS locator, l_returnflag AS title FROM lineitem), c AS (SELECT s_suppkey AS a, s_suppkey % 50 + 1 AS b FROM supplier)
SELECT DISTINCT a AS claim, x.locator, x.title FROM c JOIN m x ON x.entity = a JOIN m y ON y.entity = b AND y.locator = x.locator AND y.title = x.title""")
def shared_locators(spark, sf_dir):
    c = t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("claim"), F.col("s_suppkey").alias("a"), (F.col("s_suppkey") % 50 + 1).alias("b"))
    m = t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("entity"), F.col("l_orderkey").alias("locator"), F.col("l_returnflag").alias("title"))
    return W.shared_locators(c, m)


@query("SELECT l_returnflag, count(DISTINCT (l_orderkey, l_suppkey)) AS n_order_supplier, count(DISTINCT (l_orderkey, l_partkey)) AS n_order_part FROM lineitem GROUP BY l_returnflag")
def distinct_pairs(spark, sf_dir):
    l = t(spark, sf_dir, "lineitem")
    return l.groupBy("l_returnflag").agg(F.countDistinct(F.struct("l_orderkey", "l_suppkey")).alias("n_order_supplier"), F.countDistinct(F.struct("l_orderkey", "l_partkey")).alias("n_order_part"))


@query(f"""WITH {H}, {HG}, {_levels(4)}, a AS (SELECT *, 2 AS length FROM l2 UNION ALL SELECT *, 3 FROM l3 UNION ALL SELECT *, 4 FROM l4) SELECT src, dst, array_to_string(ids, '>') AS ids, length FROM a WHERE src = 'N003'""")
def single_source_paths(spark, sf_dir):
    h = h_edges(spark, sf_dir)
    nodes = h.select(F.col("child").alias("dst")).union(h.select("parent")).distinct()
    p = G.canonical_paths(G.both_ways(h, "parent", "child", "edge_id"), 4, nodes.select(F.lit("N003").alias("src"), "dst"))
    return p.filter("length > 1").select("src", "dst", F.array_join("ids", ">").alias("ids"), "length")
