"""Queries over published records, views, ranks, paths' rules and inference, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import graph as G
from weft.operators import inference as I
from weft.operators import published as N
from weft.plans.graph import H, SIB, h_edges
from weft.plans.relational import t
from weft.plans.rules import one_of, one_of_sql, strings

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def arr(*x):
    return F.array(*[F.lit(y) for y in x]).cast("array<string>")


PASSAGES = ["STEP:MAT 1", "GEN 2", "ROM 3", "1KI 4"]


@query(f"""WITH n AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 > 0 THEN s_name ELSE '' END AS name FROM supplier),
a AS (SELECT p_partkey % (SELECT count(*) FROM supplier) AS k, p_partkey AS id, trim(p_name || ' ' || p_size) AS x FROM part),
f AS (SELECT k, min_by(x, id) AS x FROM a GROUP BY k), s AS (SELECT n.k, n.name = '' AS fallback, CASE WHEN n.name <> '' THEN n.name ELSE coalesce(f.x, 'entity-' || n.k) END AS shown FROM n LEFT JOIN f ON n.k = f.k),
u AS (SELECT a.k, x, min(id) AS seen FROM a JOIN s ON a.k = s.k WHERE x <> shown GROUP BY a.k, x), al AS (SELECT k, (list(x ORDER BY seen, x))[1:40] AS l FROM u GROUP BY k),
m AS (SELECT DISTINCT l_suppkey AS k, {one_of_sql('l_orderkey', ['MAT 1', 'GEN 2', 'ROM 3', '1KI 4'])} || ':' || l_linenumber AS passage, l_returnflag AS location, l_linestatus AS source, {one_of_sql('l_orderkey', ['MAT', 'GEN', 'ROM', '1KI'])} AS book FROM lineitem),
mm AS (SELECT k, count(*) AS n, count(*) FILTER (book IN ('MAT', 'ROM')) AS nt, count(*) FILTER (book IN ('GEN', '1KI')) AS ot, array_to_string(list_sort(list(DISTINCT book)), ',') AS books, bool_or(book = 'MAT') AS g, bool_or(book IN ('GEN', '1KI')) AS o,
array_to_string(list_sort(list(passage || '/' || location || '/' || source)), ',') AS spots FROM m GROUP BY k)
SELECT 'entity-' || s.k AS id, shown AS name, fallback, coalesce(array_to_string(l, '|'), '') AS aliases, coalesce(books, '') AS books, coalesce(spots, '') AS spots, coalesce(nt, 0) AS nt, coalesce(ot, 0) AS ot,
CASE WHEN coalesce(g, false) THEN '耶稣时期' WHEN s.k % 2 = 0 THEN '使徒时期' WHEN coalesce(o, false) THEN '旧约背景' WHEN n > 0 THEN '使徒时期' ELSE '时代待审' END AS era,
CASE WHEN s.k % 4 = 0 THEN 'o-' || s.k || '=merged' ELSE 'entity-' || s.k || '-main=independent' END AS options, CASE WHEN s.k % 2 = 0 THEN 'male' ELSE 'unknown' END AS sex
FROM s LEFT JOIN al ON s.k = al.k LEFT JOIN mm ON s.k = mm.k""")
def entity_records(spark, sf_dir):
    s, p, l = t(spark, sf_dir, "supplier"), t(spark, sf_dir, "part"), t(spark, sf_dir, "lineitem")
    node = lambda c: F.concat(F.lit("entity-"), c.cast("string"))
    k = F.col("s_suppkey")
    nodes = s.select(node(k).alias("node"), F.when(k % 3 > 0, F.col("s_name")).otherwise("").alias("name"), F.lit(None).cast("string").alias("latin"), F.when(k % 2 == 0, "male").otherwise("x").alias("sex"), F.when(k % 2 == 0, arr("nt")).otherwise(arr()).alias("testaments"), F.lit("").alias("note"))
    names = p.join(s.agg(F.count("*").alias("n")), F.lit(True)).select(F.col("p_partkey").alias("name_id"), node(F.col("p_partkey") % F.col("n")).alias("node"), F.concat_ws(" ", "p_name", "p_size").alias("text"))  # one row beside it
    mentions = l.select(F.col("l_orderkey").alias("mention_id"), node(F.col("l_suppkey")).alias("node"), F.concat(one_of(F.col("l_orderkey"), PASSAGES), F.lit(":"), F.col("l_linenumber").cast("string")).alias("passage"), F.col("l_returnflag").alias("location"), F.col("l_linestatus").alias("source"))
    options = s.filter("s_suppkey % 4 = 0").select(node(k).alias("node"), F.concat(F.lit("o-"), k.cast("string")).alias("option"), F.lit("merged").alias("status"), F.lit(None).cast("string").alias("scope"), F.lit("g").alias("grp"), node(k).alias("target"))
    e = N.entity_records(nodes, names, mentions, options).select("entity.*")
    return e.select(
        "id", "name", "fallback", strings("aliases", "|").alias("aliases"), strings("books").alias("books"), strings(F.transform("mentions", lambda m: F.concat_ws("/", m["passage"], m["location"], m["source"]))).alias("spots"),
        F.col("counts.nt").alias("nt"), F.col("counts.ot").alias("ot"), "era", strings(F.transform("options", lambda o: F.concat_ws("=", o["id"], o["status"]))).alias("options"), "sex",
    )


@query("""WITH n AS (SELECT 's' || s_suppkey AS node, CASE WHEN s_suppkey % 3 = 0 THEN 'early' ELSE 'late' END AS era FROM supplier),
e AS (SELECT 's' || l_suppkey AS src, 's' || (l_suppkey + l_linenumber) % (SELECT count(*) FROM supplier) AS dst, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS edge_id, l_returnflag AS type, CASE WHEN l_partkey % 2 = 0 THEN 'kinship:cousin' ELSE 'other' END AS raw,
CASE WHEN l_quantity > 25 THEN ['nt_text', 'modern'] ELSE ['ancient'] END AS levels, [l_linestatus, 'B' || l_linenumber] AS books, CASE WHEN l_orderkey % 2 = 0 THEN ['nt'] ELSE ['ot'] END AS ts FROM lineitem)
SELECT DISTINCT src, dst, edge_id FROM e JOIN n a ON src = a.node JOIN n b ON dst = b.node WHERE src <> dst AND (type = 'A' OR raw LIKE 'kinship:%') AND (list_contains(books, 'F') OR list_contains(books, 'B2')) AND (a.era = 'early' OR b.era = 'early')
AND list_contains(levels, 'modern') AND list_contains(ts, 'nt')""")
def facets_of_relations(spark, sf_dir):
    s, l = t(spark, sf_dir, "supplier"), t(spark, sf_dir, "lineitem")
    name = lambda c: F.concat(F.lit("s"), c.cast("string"))
    nodes = s.select(name(F.col("s_suppkey")).alias("node"), F.lit("g").alias("grp"), F.col("s_name").alias("name"), F.lit(True).alias("may_merge"), F.when(F.col("s_suppkey") % 3 == 0, "early").otherwise("late").alias("era"))
    edges = l.join(s.agg(F.count("*").alias("n")), F.lit(True)).select(  # one row beside it
        name(F.col("l_suppkey")).alias("src"), name((F.col("l_suppkey") + F.col("l_linenumber")) % F.col("n")).alias("dst"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("edge_id"), F.col("l_returnflag").alias("type"),
        F.when(F.col("l_partkey") % 2 == 0, "kinship:cousin").otherwise("other").alias("raw_type"), F.when(F.col("l_quantity") > 25, arr("nt_text", "modern")).otherwise(arr("ancient")).alias("levels"),
        F.array("l_linestatus", F.concat(F.lit("B"), F.col("l_linenumber").cast("string"))).alias("books"), F.when(F.col("l_orderkey") % 2 == 0, arr("nt")).otherwise(arr("ot")).alias("testaments"),
    )
    q = G.GraphQuery(types=("A",), family=True, books=("F", "B2"), eras=("early",), evidence=("modern",), scope="nt")
    return G.visible(nodes, edges, q).select("src", "dst", "edge_id")


@query("SELECT p_partkey FROM part WHERE contains(lower(p_name), 'red wid') OR contains(lower(p_brand), 'red wid') OR contains(lower(p_type || ' ii'), 'red wid') OR p_partkey % 50 = 0 OR contains(lower(p_name || '|' || p_brand || '|' || p_type), 'small')")
def name_search(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    # full-width letters are the same name
    names = F.array("p_name", "p_brand", F.concat("p_type", F.lit(" Ⅱ")), F.when(F.col("p_partkey") % 50 == 0, "Ｒｅｄ　Ｗｉｄｅ").otherwise(""))
    return p.filter(G.name_matches(names, " RED  wid ") | G.name_matches(names, "small")).select("p_partkey")


FAMILY = """n AS (SELECT parent AS node FROM h UNION SELECT child FROM h), up AS (SELECT 'N005' AS node, 0 AS rank UNION ALL SELECT parent, rank - 1 FROM up JOIN h ON child = node),
taken AS (SELECT node FROM up WHERE rank < 0 UNION SELECT unnest(['N006', 'N007', 'S000001'])),
dn AS (SELECT 'N005' AS node, 0 AS rank UNION ALL SELECT child, rank + 1 FROM dn JOIN h ON parent = node WHERE child NOT IN (SELECT node FROM taken))"""


@query(f"""WITH RECURSIVE {H}, {FAMILY}, r AS (SELECT 'N005' AS node, 0 AS rank, 0 AS turn UNION ALL SELECT unnest(['N007', 'S000001']), 0, 1 UNION ALL SELECT 'N006', 1, 2 UNION ALL SELECT node, rank, 3 FROM up WHERE rank < 0
UNION ALL SELECT node, rank + 1, 4 FROM dn WHERE rank > 0 UNION ALL SELECT 'N009', 7, 5 UNION ALL SELECT 'N006', 9, 5)
SELECT n.node, coalesce(x.rank, 1) AS rank FROM n LEFT JOIN (SELECT node, min_by(rank, turn) AS rank FROM r GROUP BY node) x ON n.node = x.node""")
def family_ranks(spark, sf_dir):
    h = h_edges(spark, sf_dir)
    pairs = lambda *x: spark.createDataFrame(x, "a string, b string")
    nodes = h.select(F.col("parent").alias("node")).union(h.select("child")).distinct()
    topic = spark.createDataFrame([("N009", 7), ("N006", 9)], "node string, rank int")
    return G.family_ranks(h, pairs(("N006", "N005")), pairs(("N005", "N007"), ("S000001", "N005")), nodes, "N005", topic)


@query(f"""WITH RECURSIVE {H}, e AS (SELECT parent AS src, child AS dst, CASE WHEN child LIKE '%3' THEN -1 WHEN child LIKE '%4' THEN 0 ELSE 1 END AS way FROM h), b AS (SELECT * FROM e UNION ALL SELECT dst, src, -way FROM e),
r AS (SELECT 'R1' AS node, '' AS prev, 0 AS rank UNION ALL SELECT dst, node, rank + CASE WHEN way <> 0 THEN way WHEN rank < 0 THEN 1 ELSE -1 END FROM r JOIN b ON src = node WHERE dst <> prev) SELECT node, rank::INT AS rank FROM r""")
def directional_ranks(spark, sf_dir):
    c = F.col("child")
    e = h_edges(spark, sf_dir).select(F.col("parent").alias("src"), c.alias("dst"), F.when(c.endswith("3"), "incoming").when(c.endswith("4"), "undirected").otherwise("outgoing").alias("direction"))
    return G.directional_ranks(e, "R1").select("node", "rank")


@query(f"""WITH RECURSIVE {H}, b AS (SELECT parent AS s, child AS d FROM h UNION ALL SELECT child, parent FROM h), r AS (SELECT 'R2' AS node UNION SELECT d FROM r JOIN b ON s = node) SELECT parent AS src, child AS dst FROM h WHERE parent IN (SELECT node FROM r) AND child IN (SELECT node FROM r)""")
def connected_edges(spark, sf_dir):
    return G.connected_edges(h_edges(spark, sf_dir).select(F.col("parent").alias("src"), F.col("child").alias("dst")), "R2")


@query("""WITH g AS (SELECT s_nationkey, min(s_suppkey) AS target, count(*) AS n, count(*) FILTER (s_acctbal > -900) AS m FROM supplier GROUP BY s_nationkey), x AS (SELECT s_suppkey, CASE WHEN n > 1 AND n = m THEN target ELSE s_suppkey END AS rep, s_name, s_nationkey FROM supplier JOIN g USING (s_nationkey)),
b AS (SELECT rep, array_to_string(list_sort(list(DISTINCT 'B' || s_suppkey % 7)), ',') AS books, list_sort(list(DISTINCT s_name)) AS names FROM x GROUP BY rep)
SELECT rep AS s_suppkey, s_name AS name, array_to_string(list_filter(names, lambda y: y <> s_name), ',') AS aliases, books FROM b JOIN supplier ON rep = s_suppkey""")
def merged_nodes(spark, sf_dir):
    s = t(spark, sf_dir, "supplier")
    target = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("target"))
    nodes = s.select(F.col("s_suppkey").alias("node"), F.col("s_name").alias("name"), arr().alias("aliases"), F.array(F.concat(F.lit("B"), (F.col("s_suppkey") % 7).cast("string"))).alias("books"))
    options = s.join(target, "s_nationkey").select(F.col("s_suppkey").alias("node"), F.lit("merge").alias("option"), F.col("s_nationkey").alias("grp"), "target")
    chosen = s.select(F.col("s_suppkey").alias("node"), F.when(F.col("s_acctbal") > -900, "merge").otherwise("apart").alias("option"))
    m = G.merged_nodes(nodes, G.chosen_mapping(options, chosen), ["aliases", "books"])
    return m.select(F.col("node").alias("s_suppkey"), "name", strings("aliases").alias("aliases"), strings("books").alias("books"))


@query("""WITH e AS (SELECT DISTINCT l_orderkey, l_orderkey || '-' || l_partkey AS edge_id FROM lineitem), s AS (SELECT l_orderkey || '-' || l_partkey AS edge_id, min(l_linestatus) AS status, bool_and(l_returnflag = 'A') AS inferred FROM lineitem GROUP BY ALL)
SELECT l_orderkey AS id, count(*) AS n, concat_ws(',', CASE WHEN count(*) FILTER (status = 'F') > 0 THEN 'F=' || count(*) FILTER (status = 'F') END, CASE WHEN count(*) FILTER (status = 'O') > 0 THEN 'O=' || count(*) FILTER (status = 'O') END) AS statuses,
count(*) FILTER (inferred) AS inferred, count(*) FILTER (inferred) = count(*) AS all_inferred FROM e JOIN s USING (edge_id) GROUP BY l_orderkey""")
def path_states(spark, sf_dir):
    l = t(spark, sf_dir, "lineitem").withColumn("edge_id", F.concat_ws("-", "l_orderkey", "l_partkey"))
    paths = l.groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("edge_id").alias("edge_ids"))
    edges = l.groupBy("edge_id").agg(F.min("l_linestatus").alias("status"), F.bool_and(F.col("l_returnflag") == "A").alias("inferred"))
    s = G.path_states(paths, edges)
    return s.withColumn("statuses", strings(F.transform("statuses", lambda x: F.concat_ws("=", x["status"], x["n"].cast("string")))))


@query("""SELECT 'o' || o_orderkey AS edge_id, coalesce(array_to_string(p[1:3], ','), '') AS passages FROM orders LEFT JOIN (SELECT l_orderkey, list(l_partkey::VARCHAR ORDER BY l_linenumber, l_partkey::VARCHAR) AS p FROM lineitem WHERE l_linenumber <> 2 GROUP BY l_orderkey) ON l_orderkey = o_orderkey""")
def edges_with_passages(spark, sf_dir):
    edges = t(spark, sf_dir, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("edge_id"))
    evidence = t(spark, sf_dir, "lineitem").select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("edge_id"), F.col("l_linenumber").alias("pos"), F.when(F.col("l_linenumber") == 2, " ").otherwise(F.col("l_partkey").cast("string")).alias("passage"))
    return G.with_passages(edges, evidence).select("edge_id", strings("passages").alias("passages"))


@query(f"""WITH {H}, g AS (SELECT parent AS src, child AS dst, edge_id FROM h WHERE child NOT LIKE 'N%2' UNION ALL SELECT child, parent, edge_id FROM h WHERE child NOT LIKE 'N%2'), p AS (SELECT x.src, y.dst, x.edge_id || ':' || x.src || '->' || x.dst || ',' || y.edge_id || ':' || y.src || '->' || y.dst AS steps FROM g x JOIN g y ON x.dst = y.src AND x.src <> y.dst)
SELECT src, dst, 'mh-' || substr(sha256('kinship_explanation|e' || src || '|' || src || '|' || dst || '|' || steps), 1, 16) AS id FROM p WHERE src LIKE 'R%' OR dst LIKE 'R%'""")
def explained_path_ids(spark, sf_dir):
    e = G.without_edges(G.both_ways(h_edges(spark, sf_dir), "parent", "child", "edge_id"), F.col("edge_id").rlike("^asrt-N.*2$"))
    p = G.paths_of_ends(e, F.col("node").startswith("R"))
    return p.select("src", "dst", G.path_id("kinship_explanation", F.concat(F.lit("e"), "src")).alias("id"))


@query("""WITH o AS (SELECT o_orderkey AS k FROM orders) SELECT 'a' || k AS src, CASE WHEN k % 8 = 0 THEN 'a' || k ELSE 'b' || k END AS dst, unnest(CASE k % 8 WHEN 0 THEN ['self_pair', 'ends'] WHEN 1 THEN ['length'] WHEN 2 THEN ['sizes'] WHEN 3 THEN ['ends'] WHEN 4 THEN ['repeated_step'] WHEN 5 THEN ['sizes', 'repeated_node'] ELSE [] END) AS fault FROM o""")
def planted_path_faults(spark, sf_dir):
    """Paths with a known fault each, but for a quarter of them, which have none."""
    k = F.col("o_orderkey")
    a, b, m = (F.concat(F.lit(x), k.cast("string")) for x in "abm")
    kind = k % 8
    p = t(spark, sf_dir, "orders").select(
        a.alias("src"), F.when(kind == 0, a).otherwise(b).alias("dst"), F.when(kind == 1, 5).otherwise(2).alias("length"),
        F.when(kind == 1, F.array(a, m, F.lit("x"), F.lit("y"), F.lit("z"), b)).when(kind == 2, F.array(a, b)).when(kind == 3, F.array(a, m, F.lit("x"))).when(kind == 5, F.array(a, m, m, b)).otherwise(F.array(a, m, b)).alias("ids"),
        F.when(kind == 1, arr("1", "2", "3", "4", "5")).when(kind == 4, arr("1", "1")).when(kind == 5, arr("1", "2")).otherwise(arr("1", "2")).alias("steps"),
    )
    return G.path_faults(p)


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 9 AS x FROM orders) SELECT k AS id, unnest(CASE x WHEN 0 THEN ['purpose'] WHEN 1 THEN ['direct_pair'] WHEN 2 THEN ['explains'] WHEN 3 THEN ['explained', 'uses_explained'] WHEN 4 THEN ['uses_explained', 'not_basic'] WHEN 5 THEN ['not_basic'] WHEN 6 THEN ['explained'] ELSE [] END) AS fault FROM o""")
def planted_purpose_faults(spark, sf_dir):
    k, x = F.col("o_orderkey"), F.col("o_orderkey") % 9
    told = x.isin(3, 4, 5, 6, 8)
    src, dst = F.concat(F.lit("a"), k.cast("string")), F.concat(F.lit("b"), k.cast("string"))
    o = t(spark, sf_dir, "orders")
    paths = o.select(
        k.alias("id"), F.when(x == 0, "other").when(told, "kinship_explanation").otherwise("connection").alias("purpose"), F.when(x == 2, "cousin").when(x == 3, "parent").when(x == 6, "none").when(told, "cousin").alias("explains"),
        src.alias("src"), dst.alias("dst"), F.when(x == 4, arr("sibling", "cousin")).when(x == 5, arr("sibling", "friend")).otherwise(arr("sibling", "parent")).alias("edge_ids"),
    )
    edges = spark.createDataFrame([(s, "kinship", s) for s in ("sibling", "parent", "cousin")] + [("friend", "friendship", None)], "edge_id string, type string, subtype string")
    return G.purpose_faults(paths, o.filter(x.isin(1, 8)).select(src.alias("src"), dst.alias("dst")), edges, ["parent", "sibling"], ["cousin"])


@query(f"""WITH {H}, {SIB}, s AS (SELECT * FROM sib WHERE a LIKE 'N%' AND b LIKE 'N%'), r AS (SELECT *, a LIKE '%4' OR a LIKE '%9' OR b LIKE '%4' OR b LIKE '%9' AS bad, CASE WHEN a LIKE '%3' THEN 'same' WHEN a LIKE '%6' THEN 'clash' END AS old FROM s),
f AS (SELECT *, 'rev-' || a || b AS review_id, CASE WHEN old = 'clash' THEN 'signature_conflict' WHEN bad THEN 'no_evidence' END AS fault FROM r WHERE old IS DISTINCT FROM 'same')
SELECT review_id, fault, CASE WHEN fault IS NULL THEN 'asrt-' || lpad((77 + row_number() OVER (PARTITION BY fault IS NULL ORDER BY review_id))::VARCHAR, 4, '0') END AS edge_id, CASE WHEN fault IS NULL THEN ea || ':MAT ' || ea || ',' || eb || ':MAT ' || eb END AS evidence FROM f""")
def published_inferences(spark, sf_dir):
    h = h_edges(spark, sf_dir)
    s = I.siblings(h.filter("child LIKE 'N%'")).select("a", "b", "premises")
    named = lambda d: d.select(F.lit("sibling").alias("kind"), F.lit("sibling_from_parent").alias("rule"), F.lit("undirected").alias("direction"), "a", "b", "premises")
    new = named(s).select("*", F.concat(F.lit("rev-"), "a", "b").alias("review_id"), F.lit(0.72).alias("certainty"))
    old = named(s.filter("a LIKE '%3' OR a LIKE '%6'")).withColumn("premises", F.when(F.col("a").endswith("6"), arr("x")).otherwise(F.reverse("premises")))
    old = old.select(F.lit("asrt-0077").alias("edge_id"), "*")
    evidence = h.filter("child LIKE 'N%' AND NOT child LIKE '%4' AND NOT child LIKE '%9'").select("edge_id", F.lit("s1").alias("source"), F.concat(F.lit("MAT "), "edge_id").alias("passage"))
    evidence = evidence.union(evidence.select("edge_id", F.lit("s0"), F.concat(F.lit("ROM "), "edge_id")))
    # premises that only one of the pair lacks make a row without evidence
    p = I.published(new, old, evidence)
    return p.select("review_id", "fault", "edge_id", F.when(F.col("fault").isNull(), strings(F.transform("evidence", lambda e: F.concat_ws(":", F.split(e["note"], "; ")[1], e["passage"])))).alias("evidence"))


@query("""WITH l AS (SELECT l_orderkey AS id, l_orderkey || '-' || l_linenumber AS edge_id, l_returnflag = 'A' AS inferred, CASE WHEN l_linestatus = 'F' THEN 'three_round_accepted' ELSE 'open' END AS st, CASE WHEN l_linenumber > 1 THEN 'P' || l_linenumber ELSE ' ' END AS p FROM lineitem)
SELECT id, count(DISTINCT CASE WHEN inferred THEN edge_id END) AS n_inferred, array_to_string(list_sort(list(DISTINCT p) FILTER (p <> ' ')), ',') AS passages FROM l GROUP BY id
HAVING count(DISTINCT CASE WHEN inferred THEN edge_id END) <= 1 AND bool_and(NOT inferred OR st = 'three_round_accepted') AND count(*) FILTER (p <> ' ') > 0""")
def admissible_candidates(spark, sf_dir):
    l = t(spark, sf_dir, "lineitem").withColumn("edge_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    c = l.groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("edge_id").alias("premises"))
    premises = l.select("edge_id", (F.col("l_returnflag") == "A").alias("inferred"), F.when(F.col("l_linestatus") == "F", "three_round_accepted").otherwise("open").alias("review_status"), F.when(F.col("l_linenumber") > 1, F.concat(F.lit("P"), F.col("l_linenumber").cast("string"))).otherwise(" ").alias("passage"))
    return I.admissible(c, premises).select("id", "n_inferred", strings("passages").alias("passages"))


SHAPE_FAULTS = {
    0: [], 1: ["missing_premise", "uncle_aunt_parent_12_mismatch"], 2: ["inactive_premise"], 3: ["duplicate_premise", "uncle_aunt_parent_12_mismatch"], 4: ["path_endpoint_mismatch", "uncle_aunt_parent_12_mismatch"],
    5: ["cyclic_path", "uncle_aunt_premise_shape", "uncle_aunt_parent_12_mismatch"], 6: ["unsupported_rule"], 7: [], 8: ["cousin_premise_shape", "cousin_parent_23_mismatch"], 9: ["unaccepted_inference_premise"],
}


@query("SELECT o_orderkey AS id, unnest(CASE o_orderkey % 10 " + " ".join(f"WHEN {k} THEN {v}::VARCHAR[]" for k, v in SHAPE_FAULTS.items()) + " END) AS fault FROM orders")
def planted_shape_faults(spark, sf_dir):
    """Uncles and cousins of one family with a known fault each; numbers 0 and 7 have none."""
    base = spark.createDataFrame(
        [("s", "sibling", "u", "p", "active", False, False), ("c", "parent", "p", "x", "active", False, False), ("k", "parent", "u", "y", "active", False, False), ("off", "parent", "p", "x", "closed", False, False), ("inf", "sibling", "p", "u", "active", True, False)],
        "edge_id string, kind string, x string, y string, status string, inferred boolean, accepted boolean",
    )
    k = F.col("o_orderkey") % 10
    rule = F.when(k.isin(7, 8), "cousin").when(k == 6, "other").otherwise("uncle_aunt")
    path = F.when(k.isin(7, 8), arr("y", "u", "p", "x")).when(k == 4, arr("u", "p", "z")).when(k == 5, arr("u", "p", "u", "x")).otherwise(arr("u", "p", "x"))
    premises = F.when(k == 1, arr("s", "gone")).when(k == 2, arr("s", "off")).when(k == 3, arr("s", "s")).when(k == 7, arr("s", "k", "c")).when(k == 8, arr("s", "k")).when(k == 9, arr("inf", "c")).otherwise(arr("s", "c"))
    rows = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), rule.alias("rule"), F.when(k.isin(7, 8), "y").otherwise("u").alias("a"), F.lit("x").alias("b"), path.alias("path"), premises.alias("premises"))
    return I.shape_faults(rows, base)


@query(f"""WITH {H}, {SIB}, k AS (SELECT a, b FROM sib WHERE a LIKE 'N%' AND a LIKE '%1') SELECT a, b FROM sib WHERE a LIKE 'N%' AND b LIKE 'N%' AND NOT a LIKE '%1'""")
def unknown_siblings(spark, sf_dir):
    h = h_edges(spark, sf_dir).filter("child LIKE 'N%'")
    known = I.siblings(h).filter("a LIKE '%1'").select(F.col("b").alias("a"), F.col("a").alias("b"))
    return I.siblings(h, known=known).select("a", "b")


@query("""WITH e AS (SELECT 's' || l_suppkey AS src, 'p' || l_partkey AS dst, l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS edge_id, l_returnflag AS type,
CASE WHEN l_quantity > 25 THEN ['nt_text', 'modern'] ELSE ['ancient'] END AS levels, ['B' || l_linenumber] AS books, CASE WHEN l_orderkey % 2 = 0 THEN ['nt'] ELSE ['ot'] END AS ts FROM lineitem)
SELECT 'custom' AS view, src, dst, edge_id FROM (SELECT DISTINCT * FROM e) WHERE type IN ('A', 'R') AND list_contains(books, 'B2') AND list_contains(levels, 'ancient') AND list_contains(ts, 'nt')
UNION ALL SELECT 'team', src, dst, edge_id FROM (SELECT DISTINCT src, dst, edge_id FROM e) WHERE src IN ('s1', 's2') AND dst IN ('p1', 'p2', 'p3', 'p4', 'p5')""")
def views_by_query_string(spark, sf_dir):
    """A view with its own facets and one of a topic, each sent as a link and read back."""
    from weft.operators import topics as T

    l = t(spark, sf_dir, "lineitem")
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = l.select(
        name("s", "l_suppkey").alias("src"), name("p", "l_partkey").alias("dst"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("edge_id"), F.col("l_returnflag").alias("type"),
        F.when(F.col("l_quantity") > 25, arr("nt_text", "modern")).otherwise(arr("ancient")).alias("levels"), F.array(name("B", "l_linenumber")).alias("books"), F.when(F.col("l_orderkey") % 2 == 0, arr("nt")).otherwise(arr("ot")).alias("testaments"),
    ).distinct()
    nodes = edges.select(F.col("src").alias("node")).distinct()
    topics = T.presets({"team": ["s1", "s2", "p1", "p2", "p3", "p4", "p5"]})
    custom = T.View(G.GraphQuery(types=("R", "A"), books=("B2",), evidence=("ancient",), scope="nt"), "custom")
    shown = lambda view, df: G.visible(nodes, df, T.from_query_string(T.to_query_string(view), topics).query).select("src", "dst", "edge_id")
    one = shown(custom, edges).select(F.lit("custom").alias("view"), "src", "dst", "edge_id")
    two = shown(T.View(topics["team"], "team"), edges.withColumns({"type": F.lit(T.TEAM[0]), "levels": arr("modern")}))
    return one.unionByName(two.select(F.lit("team").alias("view"), "src", "dst", "edge_id"))
