"""Queries over graphs, inference, mutation and consensus, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import graph as G
from weft.operators import inference as I
from weft.operators import mutation as M
from weft.operators import validation as V
from weft.plans.relational import t
from weft.sources.tables import kept, scratch

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def h_edges(spark, sf_dir):
    """(parent, child, edge_id): region over nation over supplier, a tree."""
    n, s = t(spark, sf_dir, "nation"), t(spark, sf_dir, "supplier")
    pad = lambda p, c, k: F.concat(F.lit(p), F.lpad(F.col(c).cast("string"), k, "0"))
    top = n.select(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent"), pad("N", "n_nationkey", 3).alias("child"))
    low = s.select(pad("N", "s_nationkey", 3).alias("parent"), pad("S", "s_suppkey", 6).alias("child"))
    return top.unionByName(low).withColumn("edge_id", F.concat(F.lit("asrt-"), "child"))


H = """h AS (SELECT 'R' || n_regionkey AS parent, 'N' || lpad(n_nationkey::VARCHAR, 3, '0') AS child, 'asrt-N' || lpad(n_nationkey::VARCHAR, 3, '0') AS edge_id FROM nation
UNION ALL SELECT 'N' || lpad(s_nationkey::VARCHAR, 3, '0'), 'S' || lpad(s_suppkey::VARCHAR, 6, '0'), 'asrt-S' || lpad(s_suppkey::VARCHAR, 6, '0') FROM supplier)"""


def supply_edges(spark, sf_dir):
    """(src, dst, edge_id, way): suppliers and their parts of all lines, both ways; a row for each line, so edges repeat, and none is moved for it."""
    l = t(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    a, b = F.concat(F.lit("s"), F.lpad(F.col("l_suppkey").cast("string"), 7, "0")), F.concat(F.lit("p"), F.lpad(F.col("l_partkey").cast("string"), 7, "0"))
    e = l.select(a.alias("a"), b.alias("b")).withColumn("edge_id", F.concat("a", F.lit("-"), "b"))
    return G.each_way(e, "a", "b", "edge_id")


GE = """e0 AS (SELECT DISTINCT 's' || lpad(l_suppkey::VARCHAR, 7, '0') AS a, 'p' || lpad(l_partkey::VARCHAR, 7, '0') AS b FROM lineitem),
g AS (SELECT a AS src, b AS dst, a || '-' || b AS edge_id FROM e0 UNION ALL SELECT b, a, a || '-' || b FROM e0)"""

#: Sources from which paths are asked for; pairs of all nodes grow with the square of the graph.
SOURCES = ("p0000001", "s0000001")

SIB = "sib AS (SELECT x.child AS a, y.child AS b, x.edge_id AS ea, y.edge_id AS eb FROM h x JOIN h y ON x.parent = y.parent AND x.child < y.child)"


@query(f"WITH {H}, {SIB} SELECT a, b, least(ea, eb) || ',' || greatest(ea, eb) AS premises, CASE WHEN a IN (SELECT child FROM h WHERE child LIKE '%7') OR b IN (SELECT child FROM h WHERE child LIKE '%7') THEN 'identity_conflict' ELSE 'accepted' END AS status FROM sib")
def sibling_inference(spark, sf_dir):
    h = h_edges(spark, sf_dir)
    s = I.siblings(h, h.filter("child LIKE '%7'").select(F.col("child").alias("entity")))
    return s.select("a", "b", F.array_join("premises", ",").alias("premises"), "status")


@query(f"WITH {H} SELECT x.parent AS elder, y.child AS younger, x.child AS mid, x.edge_id || ',' || y.edge_id AS premises FROM h x JOIN h y ON x.child = y.parent")
def grandparent_inference(spark, sf_dir):
    return I.grandparents(h_edges(spark, sf_dir)).withColumn("premises", F.array_join("premises", ","))


def _sibs(h):
    """Accepted siblings of parents as edges, as no others have nephews or their children cousins; those of nations count as told, others as inferred."""
    s = I.siblings(h, of=h.select(F.col("parent").alias("entity"))).filter("status = 'accepted'")
    return s.select("a", "b", F.concat_ws("~", F.lit("sib"), "a", "b").alias("edge_id"), (~F.col("a").startswith("N") | F.col("a").endswith("3")).alias("inferred"))


SIBE = SIB + ", sibe AS (SELECT a, b, 'sib~' || a || '~' || b AS edge_id, (NOT starts_with(a, 'N') OR a LIKE '%3') AS inferred FROM sib)"


def _adjudicated(c, a, b, h):
    disputed = h.filter("child LIKE '%7'").select(F.col("child").alias("entity"))
    primary = h.select(F.col("parent").alias("x"), F.col("child").alias("y"))
    return I.adjudicate(c, a, b, F.col(b).endswith("4"), disputed, primary).withColumn("premises", F.array_join("premises", ","))


def _status(a, b):
    return f"CASE WHEN {b} LIKE '%4' THEN 'covered_existing' WHEN {a} LIKE '%7' OR {b} LIKE '%7' THEN 'identity_conflict' ELSE 'needs_review' END AS status"


@query(f"""WITH {H}, {SIBE}, both_ AS (SELECT a AS elder, b AS parent, edge_id, inferred FROM sibe UNION ALL SELECT b, a, edge_id, inferred FROM sibe)
SELECT elder, child AS younger, CASE WHEN inferred THEN 72 ELSE 78 END AS certainty, s.edge_id || ',' || h.edge_id AS premises, {_status('elder', 'child')} FROM both_ s JOIN h USING (parent)""")
def uncle_aunt_inference(spark, sf_dir):
    h = h_edges(spark, sf_dir)
    return _adjudicated(I.uncles(h, _sibs(h)), "elder", "younger", h)


COUSINS = f"""WITH {H}, {SIBE}, c AS (SELECT least(x.child, y.child) AS a, greatest(x.child, y.child) AS b, inferred, x.edge_id || ',' || s.edge_id || ',' || y.edge_id AS premises
FROM sibe s JOIN h x ON x.parent = s.a JOIN h y ON y.parent = s.b)
SELECT a, b, CASE WHEN inferred THEN 68 ELSE 74 END AS certainty, premises, {_status('a', 'b')} FROM c"""


@query(COUSINS)
def cousin_inference(spark, sf_dir):
    h = h_edges(spark, sf_dir)
    return _adjudicated(I.cousins(h, _sibs(h)), "a", "b", h)


@query(f"""WITH {H}, {SIB}, i AS (SELECT a || b AS id, ea, CASE WHEN b LIKE '%5' THEN 'none' ELSE eb END AS eb FROM sib) SELECT id, 'unknown_premise' AS fault FROM i WHERE eb = 'none'""")
def structural_recheck(spark, sf_dir):
    h = h_edges(spark, sf_dir)
    s = I.siblings(h).select(F.concat("a", "b").alias("id"), F.when(F.col("b").endswith("5"), F.array(F.concat(F.lit("asrt-"), "a"), F.lit("none"))).otherwise(F.col("premises")).alias("premises"))
    return I.structure_faults(s, h)


@query(f"""WITH {GE}, p AS (SELECT x.a, y.a AS b, x.b AS mid FROM e0 x JOIN e0 y ON x.b = y.b WHERE x.a < y.a)
SELECT a, b, mid, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY mid) AS place FROM p) WHERE place <= 5""")
def shared_parts(spark, sf_dir):
    return G.shared_targets(supply_edges(spark, sf_dir).filter("src LIKE 's%'"))


@query(f"""WITH {GE}, w AS (SELECT 's' || lpad(s_suppkey::VARCHAR, 7, '0') AS a, 's' || lpad((s_suppkey + 1)::VARCHAR, 7, '0') AS b FROM supplier), p AS (SELECT w.a, w.b, x.b AS mid FROM w JOIN e0 x ON x.a = w.a JOIN e0 y ON y.a = w.b AND y.b = x.b)
SELECT a, b, mid, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY mid) AS place FROM p) WHERE place <= 5""")
def two_hop_contexts(spark, sf_dir):
    """Contexts of the stated pairs, suppliers of neighbouring keys, over all lines."""
    name = lambda c: F.concat(F.lit("s"), F.lpad(c.cast("string"), 7, "0"))
    pairs = t(spark, sf_dir, "supplier").select(name(F.col("s_suppkey")).alias("a"), name(F.col("s_suppkey") + 1).alias("b"))
    return G.two_hop_contexts(supply_edges(spark, sf_dir), pairs)


def _levels(depth: int) -> str:
    out = "l1 AS (SELECT src, dst, [src, dst] AS ids, [edge_id || ':' || src || '->' || dst] AS steps FROM g)"
    for d in range(2, depth + 1):
        seen = " UNION ALL ".join(f"SELECT src, dst FROM l{k}" for k in range(1, d))
        out += f""", x{d} AS (SELECT p.src, g.dst, list_append(p.ids, g.dst) AS ids, list_append(p.steps, g.edge_id || ':' || g.src || '->' || g.dst) AS steps FROM l{d - 1} p JOIN g ON p.dst = g.src WHERE NOT list_contains(p.ids, g.dst)),
l{d} AS (SELECT src, dst, ids, steps FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY ids, steps) AS r FROM x{d} x ANTI JOIN ({seen}) s ON x.src = s.src AND x.dst = s.dst) WHERE r = 1)"""
    return out


def paths_from(edges, sources=SOURCES):
    """Canonical paths of 2 to 4 steps from ``sources`` to every node, over all lines."""
    start = edges.sparkSession.createDataFrame([(x,) for x in sources], "node string")
    return G.paths_from(edges, start).filter("length > 1")


@query(f"""WITH {GE}, {_levels(4).replace("FROM g)", f"FROM g WHERE src IN {SOURCES})", 1)}, a AS (SELECT *, 2 AS length FROM l2 UNION ALL SELECT *, 3 FROM l3 UNION ALL SELECT *, 4 FROM l4)
SELECT src, dst, array_to_string(ids, '>') AS ids, length, 'mh-' || substr(sha256('connection||' || src || '|' || dst || '|' || array_to_string(steps, ',')), 1, 16) AS id FROM a""")
def paths_2_to_4(spark, sf_dir):
    p = paths_from(supply_edges(spark, sf_dir))
    return p.select("src", "dst", F.array_join("ids", ">").alias("ids"), "length", G.path_id("connection").alias("id"))


@query("SELECT ''::VARCHAR AS src, ''::VARCHAR AS dst, ''::VARCHAR AS fault WHERE false")
def path_invariants(spark, sf_dir):
    """Faults of the paths from SOURCES over all lines: none. ``planted_path_faults`` has paths with faults."""
    return G.path_faults(paths_from(supply_edges(spark, sf_dir)))


def order_edges(spark, sf_dir):
    """(src, dst, edge_id, way): orders and their customers, and customers in chains of three; many small components, and paths of every length to 4."""
    name = lambda p, c: F.concat(F.lit(p), F.lpad(c.cast("string"), 8, "0"))
    o, c = t(spark, sf_dir, "orders"), t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    near = c.filter(k % 3 != 0).select(k).join(c.select((k - 1).alias("c_custkey")), "c_custkey", "left_semi")
    e = o.select(name("o", F.col("o_orderkey")).alias("a"), name("c", F.col("o_custkey")).alias("b")).unionByName(near.select(name("c", k).alias("a"), name("c", k + 1).alias("b")))
    return G.each_way(e.withColumn("edge_id", F.concat_ws("-", "a", "b")), "a", "b", "edge_id")


OE = """oe AS (SELECT 'o' || lpad(o_orderkey::VARCHAR, 8, '0') AS a, 'c' || lpad(o_custkey::VARCHAR, 8, '0') AS b FROM orders
UNION ALL SELECT 'c' || lpad(x.c_custkey::VARCHAR, 8, '0'), 'c' || lpad(y.c_custkey::VARCHAR, 8, '0') FROM customer x JOIN customer y ON y.c_custkey = x.c_custkey + 1 WHERE x.c_custkey % 3 <> 0),
g AS (SELECT a AS src, b AS dst, a || '-' || b AS edge_id FROM oe UNION ALL SELECT b, a, a || '-' || b FROM oe)"""


@query(f"""WITH {OE}, {_levels(4)}, a AS (SELECT *, 2 AS length FROM l2 UNION ALL SELECT *, 3 FROM l3 UNION ALL SELECT *, 4 FROM l4) SELECT src, dst, array_to_string(ids, '>') AS ids, array_to_string(steps, ',') AS steps, length FROM a""")
def all_paths_2_to_4(spark, sf_dir):
    """Paths between all nodes of the graph, from every source, in blocks of sources."""
    p = G.all_canonical_paths(order_edges(spark, sf_dir), scratch(spark), block_rows=1_000_000)
    return p.filter("length > 1").select("src", "dst", F.array_join("ids", ">").alias("ids"), F.array_join("steps", ",").alias("steps"), "length")


@query(f"""WITH {OE}, c AS (SELECT min(c_custkey) AS c, (c_custkey + 2) // 3 AS k FROM customer GROUP BY ALL), n AS (SELECT DISTINCT src AS node FROM g),
k AS (SELECT 'c' || lpad(c_custkey::VARCHAR, 8, '0') AS node, 'c' || lpad(c::VARCHAR, 8, '0') AS root FROM customer JOIN c ON k = (c_custkey + 2) // 3)
SELECT n.node, root FROM n JOIN k USING (node) UNION ALL SELECT a, root FROM oe JOIN k ON node = b WHERE a LIKE 'o%'""")
def components_of_orders(spark, sf_dir):
    return G.components(order_edges(spark, sf_dir))


HG = "g AS (SELECT parent AS src, child AS dst, edge_id FROM h UNION ALL SELECT child, parent, edge_id FROM h)"


@query(f"""WITH {H}, {HG}, {_levels(4)}, w AS (SELECT x.parent AS src, y.child AS dst FROM h x JOIN h y ON x.child = y.parent UNION SELECT x.child, y.child FROM h x JOIN h y ON x.parent = y.parent WHERE x.child < y.child),
a AS (SELECT *, 2 AS length FROM l2 UNION ALL SELECT *, 3 FROM l3 UNION ALL SELECT *, 4 FROM l4) SELECT src, dst, array_to_string(ids, '>') AS ids, length FROM a JOIN w USING (src, dst)""")
def kinship_explanation(spark, sf_dir):
    p = G.kin_paths(h_edges(spark, sf_dir))
    return p.select("src", "dst", F.array_join("ids", ">").alias("ids"), "length")


@query(f"""WITH {H}, d AS (SELECT x.parent AS src, y.child AS dst, 2 AS delta FROM h x JOIN h y ON x.child = y.parent) SELECT * FROM d UNION ALL SELECT dst, src, -2 FROM d""")
def generation_delta(spark, sf_dir):
    return G.lineal_paths(G.both_ways(h_edges(spark, sf_dir), "parent", "child", "edge_id")).select("src", "dst", "delta")


@query(f"""WITH RECURSIVE {GE}, f AS (SELECT min(src) AS node FROM g), r AS (SELECT node FROM f UNION SELECT dst FROM r JOIN g ON node = src) SELECT node FROM r""")
def component_of_focus(spark, sf_dir):
    e = supply_edges(spark, sf_dir)
    return G.component_around(e, e.agg(F.min("src").alias("node")).filter("node IS NOT NULL"))


_PRI = "CASE l_returnflag WHEN 'R' THEN 30 WHEN 'A' THEN 20 ELSE 10 END + CASE WHEN l_quantity > 40 THEN 3 WHEN l_quantity > 20 THEN 2 ELSE 1 END"


def _trades(spark, sf_dir):
    """Supplier and part of each line as an edge."""
    flag, q = F.col("l_returnflag"), F.col("l_quantity")
    pri = F.when(flag == "R", 30).when(flag == "A", 20).otherwise(10) + F.when(q > 40, 3).when(q > 20, 2).otherwise(1)
    return t(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"),
        F.concat_ws("-", F.lit("e"), "l_orderkey", "l_linenumber").alias("edge_id"), pri.alias("pri"), flag.alias("type"), F.col("l_linestatus").alias("evidence"), q.alias("quantity"),
    )


@query(f"""WITH e AS (SELECT 's' || l_suppkey AS src, 'p' || l_partkey AS dst, 'e-' || l_orderkey || '-' || l_linenumber AS edge_id, {_PRI} AS priority FROM lineitem),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY least(src, dst), greatest(src, dst) ORDER BY priority DESC, edge_id) AS r FROM e) WHERE r = 1)
SELECT src, dst, edge_id, priority FROM f WHERE src = 's1' ORDER BY priority DESC, edge_id LIMIT 24""")
def ego_fold_topk(spark, sf_dir):
    return G.ego(G.fold_parallel(_trades(spark, sf_dir), F.col("pri")), "s1", 24).select("src", "dst", "edge_id", "priority")


@query("""WITH e AS (SELECT 's' || l_suppkey AS src, 'p' || l_partkey AS dst FROM lineitem),
n AS (SELECT dst AS n FROM e WHERE src = 's1' UNION SELECT src FROM e WHERE dst = 's1') SELECT DISTINCT src, dst FROM e WHERE src IN (SELECT n FROM n) OR dst IN (SELECT n FROM n)""")
def two_hop_neighbourhood(spark, sf_dir):
    return G.neighbourhood(_trades(spark, sf_dir).select("src", "dst").distinct(), "s1")


@query("""WITH n AS (SELECT s_suppkey, s_nationkey, s_name, s_acctbal > -990 AS ok FROM supplier),
m AS (SELECT s_nationkey, min(s_suppkey) AS target FROM n WHERE s_nationkey IN (1, 2, 3, 4, 5, 6) GROUP BY s_nationkey HAVING bool_and(ok) AND count(*) > 1),
mm AS (SELECT 's' || s_suppkey AS node, s_nationkey FROM n), mt AS (SELECT s_nationkey, min(node) AS target FROM mm WHERE s_nationkey IN (SELECT s_nationkey FROM m) GROUP BY s_nationkey),
e AS (SELECT coalesce(target, 's' || l_suppkey) AS src, 'p' || l_partkey AS dst, 'e-' || l_orderkey || '-' || l_linenumber AS edge_id FROM lineitem JOIN n ON l_suppkey = s_suppkey LEFT JOIN mt USING (s_nationkey) WHERE l_returnflag IN ('R', 'A') AND l_linestatus = 'F')
SELECT DISTINCT src, dst, edge_id FROM e JOIN mm ON src = node WHERE s_nationkey IN (1, 2, 3)""")
def faceted_graph(spark, sf_dir):
    s = t(spark, sf_dir, "supplier")
    nodes = s.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("node"), F.col("s_nationkey").cast("string").alias("grp"), F.col("s_name").alias("name"), (F.col("s_acctbal") > -990).alias("may_merge"))
    q = G.GraphQuery(types=("R", "A"), evidence=("F",), groups=("1", "2", "3"), merge=tuple("123456"), term="supplier")
    return G.visible(nodes, _trades(spark, sf_dir), q).select("src", "dst", "edge_id")


@query(f"""WITH RECURSIVE {H}, up AS (SELECT 'N005' AS node, 0 AS rank UNION ALL SELECT parent, rank - 1 FROM up JOIN h ON child = node),
dn AS (SELECT 'N005' AS node, 0 AS rank UNION ALL SELECT child, rank + 1 FROM dn JOIN h ON parent = node)
SELECT node, rank FROM up UNION SELECT node, rank FROM dn UNION SELECT child, 1 FROM h WHERE parent IN (SELECT parent FROM h WHERE child = 'N005') AND child <> 'N005'""")
def generational_rank(spark, sf_dir):
    return G.generational_ranks(h_edges(spark, sf_dir), "N005")


@query("""WITH o AS (SELECT o_custkey AS subject, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS subtype, list_sort(list(DISTINCT 'o' || o_orderkey)) AS ev FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY ALL),
n AS (SELECT o_custkey AS subject, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS subtype, list_sort(list(DISTINCT 'o' || o_orderkey)) AS ev FROM orders WHERE o_orderkey % 4 = 0 GROUP BY ALL)
SELECT coalesce(o.subject, n.subject) AS subject, CASE WHEN o.subject IS NULL THEN n.subtype ELSE o.subtype END AS subtype,
CASE WHEN o.ev IS NULL THEN 'insert' WHEN n.ev IS NULL THEN 'keep' WHEN len(list_filter(n.ev, lambda x: NOT list_contains(o.ev, x))) = 0 THEN 'skip' ELSE 'append' END AS action,
array_to_string(CASE WHEN o.ev IS NULL THEN n.ev WHEN n.ev IS NULL THEN o.ev ELSE list_concat(o.ev, list_filter(n.ev, lambda x: NOT list_contains(o.ev, x))) END, ',') AS evidence
FROM o FULL JOIN n ON o.subject = n.subject AND o.subtype IS NOT DISTINCT FROM n.subtype""")
def relation_merge_upsert(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("subject"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("subtype"))
    ev = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    old = o.filter("o_orderkey % 3 <> 0").groupBy("subject", "subtype").agg(F.array_sort(F.collect_set(ev)).alias("evidence"))
    new = o.filter("o_orderkey % 4 = 0").select("subject", "subtype", F.array(ev).alias("evidence"))
    return M.upsert(old, new, ["subject", "subtype"], "evidence").withColumn("evidence", F.array_join("evidence", ","))


@query("SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 'superseded' ELSE o_orderstatus END AS status FROM orders")
def soft_delete(spark, sf_dir):
    ids = t(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return M.soft_deleted(t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status")), ids, "o_custkey", "status", "superseded").select("o_orderkey", "status")


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'REVIEWED' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def keyed_update(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return M.updated(c, c.filter("c_custkey % 5 = 0").withColumn("c_mktsegment", F.lit("REVIEWED")), "c_custkey", ["c_mktsegment"])


@query("SELECT s_suppkey AS id FROM supplier UNION SELECT l_suppkey FROM lineitem UNION SELECT l_partkey FROM lineitem WHERE l_quantity > 49")
def insert_if_absent(spark, sf_dir):
    l = t(spark, sf_dir, "lineitem")
    rows = l.select(F.col("l_suppkey").alias("id")).unionByName(l.filter("l_quantity > 49").select(F.col("l_partkey").alias("id")))
    return M.inserted_if_absent(t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")), rows, ["id"])


@query("""WITH r AS (SELECT l_orderkey AS key, list_sort(list(l_linenumber)) AS items FROM lineitem GROUP BY l_orderkey)
SELECT key, part, array_to_string(CASE WHEN key % 2 = 0 THEN items WHEN part = 1 THEN list_filter(items, lambda x: x <= 2) ELSE list_filter(items, lambda x: x > 2) END, ',') AS items
FROM r, (SELECT unnest([1, 2]) AS part) WHERE key % 2 = 1 OR part = 1""")
def record_split(spark, sf_dir):
    r = t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.array_sort(F.collect_list("l_linenumber")).alias("items"))
    odd = r.filter("key % 2 = 1").select("key")
    parts = odd.select("key", F.lit(1).alias("part"), F.array(F.lit(1), F.lit(2)).alias("wanted")).unionByName(odd.select("key", F.lit(2).alias("part"), F.sequence(F.lit(3), F.lit(9)).alias("wanted")))
    return M.split_records(r, parts, "key", "items").withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


_REVIEWS = "(SELECT l.doc_id, CASE WHEN quality = 1 THEN 'accepted' ELSE 'rejected' END AS a, CASE WHEN n_chars >= 200 THEN 'accepted' ELSE 'rejected' END AS b, toxic, n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"


def _reviews(spark, sf_dir):
    l, d = t(spark, sf_dir, "labels"), t(spark, sf_dir, "documents")
    a = l.select("doc_id", F.when(F.col("quality") == 1, "accepted").otherwise("rejected").alias("status"), F.col("toxic").cast("string").alias("field"))
    b = d.select("doc_id", F.when(F.col("n_chars") >= 200, "accepted").otherwise("rejected").alias("status"), F.lit("0").alias("field"))
    return a, b


@query(f"SELECT doc_id, CASE WHEN a = 'accepted' AND b = 'accepted' AND toxic = 0 THEN 'accepted' WHEN a = 'rejected' AND b = 'rejected' THEN 'rejected' ELSE 'pending' END AS decision FROM {_REVIEWS}")
def consensus_two(spark, sf_dir):
    return M.consensus(*_reviews(spark, sf_dir), "doc_id", ["field"])


@query(f"""SELECT doc_id, array_to_string(list_filter([CASE WHEN NOT toxic = 0 THEN 'toxic' END, CASE WHEN NOT a = b THEN 'disagreement' END, CASE WHEN NOT n_chars < 5000 THEN 'too_long' END], lambda x: x IS NOT NULL), ',') AS issues,
CASE WHEN toxic = 0 AND a = b AND n_chars < 5000 THEN 'accepted' ELSE 'rejected' END AS decision FROM {_REVIEWS}""")
def consensus_gate(spark, sf_dir):
    a, b = _reviews(spark, sf_dir)
    both = a.join(b.select("doc_id", F.col("status").alias("other")), "doc_id").join(t(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    g = M.gated(both, {"toxic": F.col("field") == "0", "disagreement": F.col("status") == F.col("other"), "too_long": F.col("n_chars") < 5000})
    return g.select("doc_id", F.array_join("issues", ",").alias("issues"), "decision")


@query("SELECT o_orderkey, sha256(o_orderkey::VARCHAR || chr(31) || o_custkey::VARCHAR || chr(31) || o_orderstatus || chr(31) || o_orderpriority) AS signature FROM orders")
def row_signatures(spark, sf_dir):
    return t(spark, sf_dir, "orders").select("o_orderkey", M.row_signature("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("signature"))


FINGERPRINT = """h AS (SELECT sha256(k) AS h, count(*)::VARCHAR AS n FROM r GROUP BY k), p AS (SELECT substr(h, 1, 4) AS p, sha256(string_agg(h || ':' || n, chr(10) ORDER BY h)) AS d, sum(n::BIGINT) AS n FROM h GROUP BY substr(h, 1, 4)),
q AS (SELECT substr(p, 1, 2) AS p, sha256(string_agg(p || ':' || d, chr(10) ORDER BY p)) AS d, sum(n) AS n FROM p GROUP BY substr(p, 1, 2)), z AS (SELECT sum(n)::BIGINT AS n_rows, sha256(string_agg(p || ':' || d, chr(10) ORDER BY p)) AS fingerprint FROM q)"""


@query(f"WITH r AS (SELECT o_orderkey::VARCHAR || chr(31) || o_custkey::VARCHAR || chr(31) || o_orderpriority AS k FROM orders), {FINGERPRINT} SELECT * FROM z")
def table_fingerprint(spark, sf_dir):
    return M.fingerprint(t(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_orderpriority")


@query("""SELECT count(*) AS n_rows, count(*) FILTER (quality IS NULL) AS n_pending, count(*) FILTER (toxic = 1) AS n_blocked,
CASE WHEN count(*) FILTER (toxic = 1) > 0 THEN 'blocked' WHEN count(*) FILTER (quality IS NULL) > 0 THEN 'pending' ELSE 'ready' END AS status FROM documents LEFT JOIN labels USING (doc_id)""")
def release_gate(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id").join(t(spark, sf_dir, "labels"), "doc_id", "left")
    return M.release_gate(d, F.col("quality").isNull(), F.coalesce(F.col("toxic") == 1, F.lit(False)))


@query("""WITH o AS (SELECT DISTINCT ON (c_name, c_mktsegment) c_name, c_mktsegment, 'accepted' AS decision FROM customer WHERE c_custkey % 4 = 0)
SELECT c_custkey, coalesce(o.decision, 'pending') AS decision FROM customer LEFT JOIN o USING (c_name, c_mktsegment)""")
def decision_carry_over(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    old = c.filter("c_custkey % 4 = 0").select("c_name", "c_mktsegment", F.lit("accepted").alias("decision"))
    return M.carried_over(c, old, ["c_name", "c_mktsegment"], {"decision": "pending"}).select("c_custkey", "decision")


@query("""SELECT src, dst, greatest(n, 0) AS n FROM (SELECT 's' || l_suppkey AS src, 'p' || l_partkey AS dst, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1)""")
def parallel_edges(spark, sf_dir):
    return V.duplicate_keys(_trades(spark, sf_dir), "src", "dst")


@query("""SELECT node, count(*) AS degree FROM (SELECT 's' || l_suppkey AS node FROM lineitem UNION ALL SELECT 'p' || l_partkey FROM lineitem) GROUP BY node ORDER BY degree DESC, node LIMIT 10""")
def degree_top(spark, sf_dir):
    e = _trades(spark, sf_dir)
    return e.select(F.col("src").alias("node")).unionByName(e.select(F.col("dst").alias("node"))).groupBy("node").agg(F.count("*").alias("degree")).orderBy(F.desc("degree"), "node").limit(10)
