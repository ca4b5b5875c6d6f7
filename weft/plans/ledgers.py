"""Queries over changes, checks, ledgers, aggregates and orders, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import fingerprints as P
from weft.operators import matching as D
from weft.operators import mutation as M
from weft.operators import nested as N
from weft.operators import relational as R
from weft.operators import review as W
from weft.operators import validation as V
from weft.plans.graph import FINGERPRINT
from weft.plans.relational import cents, t
from weft.plans.rules import one_of, one_of_sql, strings
from weft.plans.views import arr
from weft.sources import snapshots as S_
from weft.sources import tables as S

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


@query("""WITH o AS (SELECT o_custkey AS subject, list_sort(list(DISTINCT 'o' || o_orderkey)) AS ev FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY ALL), n AS (SELECT o_custkey AS subject, list_sort(list(DISTINCT 'o' || o_orderkey)) AS ev FROM orders WHERE o_orderkey % 4 = 0 GROUP BY ALL),
i AS (SELECT subject, row_number() OVER (ORDER BY subject) + (SELECT max(o_custkey) FROM orders WHERE o_orderkey % 3 <> 0) AS n FROM n WHERE subject NOT IN (SELECT subject FROM o))
SELECT coalesce(o.subject, n.subject) AS subject, CASE WHEN o.subject IS NULL THEN 'insert' WHEN n.subject IS NULL THEN 'keep' WHEN len(list_filter(n.ev, lambda x: NOT list_contains(o.ev, x))) = 0 THEN 'skip' ELSE 'append' END AS action,
CASE WHEN i.n IS NOT NULL THEN 'asrt-' || lpad(i.n::VARCHAR, greatest(4, length(i.n::VARCHAR))::INT, '0') END AS id FROM o FULL JOIN n ON o.subject = n.subject LEFT JOIN i ON i.subject = n.subject""")
def numbered_upsert(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("subject"), F.array(F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))).alias("evidence"))
    old = o.filter("o_orderkey % 3 <> 0").groupBy("subject").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("evidence")))).alias("evidence"))
    old = old.withColumn("id", F.concat(F.lit("asrt-"), F.col("subject").cast("string")))
    plan = M.upsert(old, o.filter("o_orderkey % 4 = 0"), ["subject"], "evidence")
    return M.numbered_inserts(plan, old, ["subject"], "asrt-").select("subject", "action", "id")


@query("SELECT o_custkey AS subject, count(*) AS n, 'ambiguous' AS fault FROM orders WHERE o_orderkey % 3 = 0 GROUP BY o_custkey HAVING count(*) > 1 AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 4 = 1)")
def ambiguous_upsert(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("subject"), F.array(F.col("o_orderkey").cast("string")).alias("evidence"))
    # evidence of the target ends in x, so no row has exactly the new one
    old = o.filter("o_orderkey % 3 = 0").withColumn("evidence", F.array_append("evidence", F.lit("x")))
    return M.ambiguous_targets(old, o.filter("o_orderkey % 4 = 1"), ["subject"], "evidence")


@query("""WITH c AS (SELECT c_custkey, c_acctbal < 0 AS gone FROM customer) SELECT 'customer' AS tbl, c_custkey AS id, CASE WHEN gone THEN 'superseded' ELSE 'accepted' END AS status, CASE WHEN gone THEN 'n' || c_custkey || '; removed' ELSE 'n' || c_custkey END AS note FROM c
UNION ALL SELECT 'orders', o_orderkey, CASE WHEN gone THEN 'inactive' ELSE o_orderstatus END, CASE WHEN gone THEN 'removed' ELSE '' END FROM orders JOIN c ON o_custkey = c_custkey""")
def cascaded_delete(spark, sf_dir):
    c, o = t(spark, sf_dir, "customer"), t(spark, sf_dir, "orders")
    tables = {
        "customer": (c.select(F.col("c_custkey").alias("id"), F.lit("accepted").alias("status"), F.concat(F.lit("n"), F.col("c_custkey").cast("string")).alias("note")), "id", "status"),
        "orders": (o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("owner"), F.col("o_orderstatus").alias("status"), F.lit("").alias("note")), "owner", "status"),
    }
    out = M.cascaded(tables, c.filter("c_acctbal < 0").select("c_custkey"), "c_custkey", {"customer": "superseded", "orders": "inactive"}, "removed")
    one = lambda n: out[n].select(F.lit(n).alias("tbl"), "id", "status", "note")
    return one("customer").unionByName(one("orders"))


@query("""WITH s AS (SELECT CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE s_nationkey END AS k, min(s_name) AS v FROM supplier GROUP BY 1), c AS (SELECT CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_nationkey END AS k, min(c_name) AS v FROM customer GROUP BY 1)
SELECT k, v FROM s UNION ALL SELECT c.k, c.v FROM c WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k IS NOT DISTINCT FROM c.k)""")
def insert_null_keys_once(spark, sf_dir):
    key = lambda c: F.when(F.col(c) % 5 != 0, F.col(c))
    s = t(spark, sf_dir, "supplier").groupBy(key("s_nationkey").alias("k")).agg(F.min("s_name").alias("v"))
    rows = t(spark, sf_dir, "customer").select(key("c_nationkey").alias("k"), F.col("c_name").alias("v"))
    once = M.inserted_if_absent(s, rows, ["k"])
    return M.inserted_if_absent(once, rows, ["k"])  # a second run adds nothing


@query("""WITH r AS (SELECT l_orderkey AS key, list_sort(list(l_linenumber)) AS items FROM lineitem GROUP BY l_orderkey),
p AS (SELECT key, part, CASE WHEN part = 1 THEN list_filter(items, lambda x: x <= 2) ELSE list_filter(items, lambda x: x > 2) END AS items FROM r, (SELECT unnest([1, 2]) AS part) WHERE key % 2 = 1)
SELECT key, part, array_to_string(items, ',') AS items, CASE WHEN part = 1 THEN 'p' || key ELSE '' END AS parents FROM p WHERE len(items) > 0 UNION ALL SELECT key, 1, array_to_string(items, ','), 'p' || key FROM r WHERE key % 2 = 0""")
def split_with_relations(spark, sf_dir):
    r = t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.array_sort(F.collect_list("l_linenumber")).alias("items"))
    r = r.withColumn("parents", F.concat(F.lit("p"), F.col("key").cast("string")))
    odd = r.filter("key % 2 = 1").select("key")
    parts = odd.select("key", F.lit(1).alias("part"), F.array(F.lit(1), F.lit(2)).alias("wanted"), F.lit(True).alias("keeps")).unionByName(odd.select("key", F.lit(2).alias("part"), F.sequence(F.lit(3), F.lit(9)).alias("wanted"), F.lit(False).alias("keeps")))
    return M.split_records(r, parts, "key", "items", ["parents"]).withColumn("items", strings(F.col("items").cast("array<string>")))


@query("""WITH o AS (SELECT DISTINCT c_custkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 3 <> 0), n AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 4 = 0)
SELECT action, count(*) AS n FROM (SELECT CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN n.o_custkey IS NULL THEN 'keep' ELSE 'append' END AS action FROM o FULL JOIN n ON o.c_custkey = n.o_custkey) GROUP BY action""")
def change_plan_counts(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"))
    old = o.filter("o_orderkey % 3 <> 0").select("k").distinct().withColumn("ev", arr("old"))
    return M.applied(M.upsert(old, o.filter("o_orderkey % 4 = 0").select("k", arr("new").alias("ev")), ["k"], "ev"), "dry-run")


@query("""WITH o AS (SELECT c_mktsegment AS s, CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE c_nationkey END AS k, min(CASE WHEN c_custkey % 2 = 0 THEN 'accepted' ELSE 'rejected' END) AS d FROM customer WHERE c_custkey % 3 = 0 GROUP BY ALL)
SELECT c_custkey, coalesce(d, 'pending') AS decision FROM customer LEFT JOIN o ON s = c_mktsegment AND k IS NOT DISTINCT FROM CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE c_nationkey END""")
def carry_over_nulls(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("s"), F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey")).alias("k"))
    old = c.filter("c_custkey % 3 = 0").select("s", "k", F.when(F.col("c_custkey") % 2 == 0, "accepted").otherwise("rejected").alias("decision"))
    return M.carried_over(c, old, ["s", "k"], {"decision": "pending"}).select("c_custkey", "decision")


_A = "(SELECT c_custkey AS candidate, 'p' || c_custkey % 40 AS entity FROM customer WHERE c_acctbal > 0)"


@query(f"""SELECT 'name' AS kind, entity, 'x' AS language, name AS what FROM (SELECT DISTINCT entity, c_name AS name FROM {_A} a JOIN customer ON c_custkey = candidate WHERE c_custkey % 6 <> 0) UNION SELECT 'name', 'p0', 'x', 'held'
UNION SELECT 'mention', entity, 's' || o_orderstatus, 'o' || o_orderkey FROM {_A} a JOIN orders ON o_custkey = candidate""")
def promoted_names(spark, sf_dir):
    c, o = t(spark, sf_dir, "customer"), t(spark, sf_dir, "orders")
    accepted = c.filter("c_acctbal > 0").select(F.col("c_custkey").alias("candidate"), F.concat(F.lit("p"), (F.col("c_custkey") % 40).cast("string")).alias("entity"))
    names = c.select(F.col("c_custkey").alias("candidate"), F.lit("x").alias("language"), F.when(F.col("c_custkey") % 6 == 0, " ").otherwise(F.col("c_name")).alias("name"))
    mentions = o.select(F.col("o_custkey").alias("candidate"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("passage"), F.concat(F.lit("s"), "o_orderstatus").alias("source"))
    n, m = W.promoted_rows(accepted, names.union(names), mentions, spark.createDataFrame([("p0", "x", "held")], "entity string, language string, name string"), spark.createDataFrame([], "entity string, passage string, source string"))
    return n.select(F.lit("name").alias("kind"), "entity", "language", F.col("name").alias("what")).unionByName(m.select(F.lit("mention").alias("kind"), "entity", F.col("source").alias("language"), F.col("passage").alias("what")))


@query(f"""WITH r AS (SELECT n_nationkey::VARCHAR || chr(31) || n_name AS k FROM nation), {FINGERPRINT} SELECT 'nation' AS name, n_rows, n_rows AS want, false AS drifted FROM z UNION ALL SELECT 'region', 5, 4, true UNION ALL SELECT 'gone', NULL, 1, true""")
def snapshot_drift(spark, sf_dir):
    """Of three recorded tables one is as it was, one has another row, one is gone."""
    n, r = t(spark, sf_dir, "nation"), t(spark, sf_dir, "region")
    cols = {"nation": (n, ["n_nationkey", "n_name"]), "region": (r, ["r_regionkey", "r_name"])}
    was = M.fingerprint(n, "n_nationkey", "n_name").select(F.lit("nation").alias("name"), "n_rows", "fingerprint")
    was = was.unionByName(M.fingerprint(r.filter("r_regionkey > 0"), "r_regionkey", "r_name").select(F.lit("region").alias("name"), "n_rows", "fingerprint"))
    return M.drift(was.union(spark.createDataFrame([("gone", 1, "x")], "name string, n long, f string")), cols)


@query("SELECT true AS same")
def idempotent_rebuild(spark, sf_dir):
    """Building a table of candidates twice, ids and all, gives the same rows."""
    def build():
        l = t(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", F.array("l_partkey").alias("p"))
        return R.gathered(l, ["l_suppkey", "l_returnflag"], {"p": "parts"}, "rel-").withColumn("parts", strings(F.col("parts").cast("array<string>")))

    return M.idempotent(build, ["id", "l_suppkey", "l_returnflag", "parts"]).select("same")


@query("""WITH e AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS edge_id, l_suppkey AS s, CASE WHEN l_linenumber = 3 THEN l_suppkey ELSE l_suppkey + 1 END AS d, CASE WHEN l_linenumber = 4 THEN ' ' ELSE 'x' END AS p, l_returnflag AS f FROM lineitem)
SELECT DISTINCT edge_id, unnest(list_filter([CASE WHEN s NOT IN (SELECT s_suppkey FROM supplier) THEN 'unknown_src' END, CASE WHEN d NOT IN (SELECT s_suppkey FROM supplier) THEN 'unknown_dst' END, CASE WHEN s = d THEN 'self_loop' END, CASE WHEN p = ' ' THEN 'empty_passage' END, CASE WHEN f = 'R' THEN 'unknown_source' END], lambda x: x IS NOT NULL)) AS fault FROM e""")
def edge_faults(spark, sf_dir):
    n = F.col("l_linenumber")
    e = t(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("edge_id"), F.col("l_suppkey").cast("long").alias("src"), F.when(n == 3, F.col("l_suppkey")).otherwise(F.col("l_suppkey") + 1).cast("long").alias("dst"), F.when(n == 4, " ").otherwise("x").alias("passage"), F.col("l_returnflag").alias("source")
    )
    return V.edge_faults(e, t(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("node")), spark.createDataFrame([("A",), ("N",)], "source string")).distinct()


@query("""SELECT c_mktsegment AS kind, count(*) AS required, count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 5 = 0)) AS covered FROM customer GROUP BY c_mktsegment""")
def inventory_coverage(spark, sf_dir):
    targets = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("s"), F.lit(None).cast("string").alias("sub"), F.col("c_mktsegment").alias("kind"))
    rows = t(spark, sf_dir, "orders").filter("o_orderkey % 5 = 0").select(F.col("o_custkey").alias("s"), F.lit(None).cast("string").alias("sub"))
    return V.coverage(targets, rows, ["s", "sub"], "kind")


LICENSES, ACCESS, STATES = ["verified_public_domain", "restricted"], ["locked_public_download", "none", "member_access_verified"], ["not_started", "completed", "open"]


@query(f"""WITH r AS (SELECT o_orderkey AS k, {one_of_sql('o_orderkey', LICENSES)} = 'verified_public_domain' AS pub, {one_of_sql('o_orderkey', ACCESS)} AS acc, o_orderkey % 5 AS files, o_orderkey % 7 = 0 AS git, {one_of_sql('o_custkey', STATES)} AS st, o_orderkey % 11 <> 0 AS req FROM orders),
v AS (SELECT k, list_filter([CASE WHEN pub AND acc <> 'locked_public_download' THEN 'public_is_locked' END, CASE WHEN pub AND files = 0 THEN 'public_has_files' END, CASE WHEN NOT pub AND files > 0 THEN 'restricted_without_files' END,
CASE WHEN NOT pub AND git THEN 'restricted_not_in_git' END, CASE WHEN st <> 'not_started' AND acc = 'none' THEN 'review_after_access' END, CASE WHEN req AND st <> 'completed' THEN 'complete_for_release' END], lambda x: x IS NOT NULL) AS v FROM r)
SELECT k, array_to_string(v, ',') AS violated FROM v WHERE len(v) > 0""")
def policy_faults(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = t(spark, sf_dir, "orders").select(
        k.alias("k"), one_of(k, LICENSES).alias("license_status"), one_of(k, ACCESS).alias("access_status"), (k % 5).alias("n_files"), (k % 7 == 0).alias("full_text_in_git"), one_of(F.col("o_custkey"), STATES).alias("review_status"), (k % 11 != 0).alias("release_required")
    )
    return V.violations(rows, V.access_policy(complete=True)).select("k", strings("violated").alias("violated"))


@query("""SELECT o_orderkey AS k, unnest(CASE o_orderkey % 8 WHEN 1 THEN ['unknown'] WHEN 2 THEN ['round1_pending_has_fields', 'rounds_not_accepted'] WHEN 3 THEN ['round2_without_reviewer'] WHEN 4 THEN ['final_accepted_without_fields', 'rounds_differ'] WHEN 5 THEN ['audit_open'] WHEN 6 THEN ['rounds_differ'] ELSE [] END) AS fault FROM orders""")
def planted_ledger_faults(spark, sf_dir):
    """Review rows with a known fault each; 0 has none, 7 is decided by the board against the rounds."""
    k, x = F.col("o_orderkey"), F.col("o_orderkey") % 8

    def decision(status, target, reviewer):
        return F.struct(status.alias("status"), reviewer.alias("reviewer"), F.lit("create").alias("action") if target is None else target.alias("target"))

    yes, who, x_ = F.lit("accepted"), F.lit("r"), F.lit("x")
    rows = t(spark, sf_dir, "orders").select(
        k.alias("k"), decision(F.when(x == 2, "pending").when(x == 7, "rejected").otherwise(yes), x_, F.when(x != 2, who)).alias("round1"), decision(yes, x_, F.when(x != 3, who)).alias("round2"),
        decision(yes, F.when(x == 6, "y").when(x != 4, "x"), who).alias("final"), F.struct(F.when(x == 5, "open").otherwise("passed").alias("status"), (x == 7).alias("board")).alias("audit"),
    )
    return W.ledger_faults(rows, "k", ["target"], t(spark, sf_dir, "orders").filter(x != 1).select(k.alias("k")))


@query("""SELECT s_suppkey AS k, unnest(list_filter([CASE WHEN s_suppkey % 4 = 0 THEN 'title_drift' END, CASE WHEN s_suppkey % 5 = 0 THEN 'not_in_snapshot' END, CASE WHEN s_suppkey % 3 = 0 THEN 'line' END], lambda x: x IS NOT NULL AND NOT (x = 'title_drift' AND s_suppkey % 5 = 0))) AS fault FROM supplier""")
def locator_faults(spark, sf_dir):
    k = F.col("s_suppkey")
    s = t(spark, sf_dir, "supplier")
    ledger = s.select(k.alias("k"), F.col("s_name").alias("title"), F.lit("f").alias("source"), F.when(k % 3 == 0, 99).otherwise(2).alias("line"))
    snapshot = s.filter(k % 5 != 0).select(k.alias("k"), F.when(k % 4 == 0, "old").otherwise(F.col("s_name")).alias("title"))
    return W.locator_faults(ledger, snapshot, "k", ["title"], spark.createDataFrame([("f", 10)], "source string, n_lines int"))


@query("""SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN 'accepted' WHEN 3 THEN 'rejected' WHEN 5 THEN 'accepted' ELSE 'pending' END AS decision, array_to_string(CASE c_custkey % 6 WHEN 1 THEN ['disagreement'] WHEN 2 THEN ['target'] WHEN 4 THEN ['bible'] ELSE []::VARCHAR[] END, ',') AS issues FROM customer""")
def three_way_consensus(spark, sf_dir):
    k, x = F.col("c_custkey"), F.col("c_custkey") % 6
    c = t(spark, sf_dir, "customer")

    def judged(other: bool):
        status = F.when(x == 3, "rejected").when((x == 1) & F.lit(other), "rejected").otherwise("accepted")
        action = F.when(x == 3, None).when(x == 5, "create_new").otherwise("merge_existing")
        return c.select(k.alias("k"), status.alias("status"), action.alias("action"), F.when(x.isin(0, 1, 4), "p1").when(x == 2, "p9").alias("target"), F.when(x == 4, arr("repo")).otherwise(arr("MAT 1:1", "repo")).alias("refs"))

    rounds = judged(False).withColumn("round", F.lit(1)).unionByName(judged(True).withColumn("round", F.lit(2)))
    options = c.filter(x.isin(0, 1, 2, 4)).select(k.alias("k"), F.lit("p1").alias("target"))
    out = M.three_way(rounds, judged(False), options, "k", ["action", "target"], {"bible": lambda r: r.rlike(r"^[A-Z]{3} \d+:\d+$"), "repository": lambda r: r == "repo"})
    return out.select("k", "decision", strings("issues").alias("issues"))


@query("""WITH m AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b, round(avg(l_quantity), 2) AS c, min(l_linenumber)::DOUBLE AS d, max(l_linenumber)::DOUBLE AS e, round(avg(l_linenumber), 2) AS f FROM lineitem)
SELECT 'l_quantity' AS metric, a AS least, b AS most, c AS mean FROM m UNION ALL SELECT 'l_linenumber', d, e, f FROM m""")
def metric_summary(spark, sf_dir):
    return R.summary(t(spark, sf_dir, "lineitem"), ["l_quantity", "l_linenumber"], 2)


@query("SELECT (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)) AS suppliers, (SELECT count(*) FROM lineitem) AS lines")
def nested_sizes(spark, sf_dir):
    g = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("suppliers"), F.collect_list("l_linenumber").alias("lines"))
    return R.nested_sizes(g, ["suppliers", "lines"])


@query("SELECT l_suppkey, count(*) AS n, md5(string_agg(x, ';' ORDER BY a, b, c)) AS spots FROM (SELECT DISTINCT l_suppkey, l_returnflag AS a, l_linestatus AS b, l_linenumber AS c, l_returnflag || '/' || l_linestatus || '/' || l_linenumber AS x FROM lineitem) GROUP BY l_suppkey")
def distinct_structs(spark, sf_dir):
    d = R.distinct_structs(t(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_returnflag", "l_linestatus", "l_linenumber"], "spots")
    return d.select("l_suppkey", F.size("spots").cast("long").alias("n"), F.md5(strings(F.transform("spots", lambda s: F.concat_ws("/", s["l_returnflag"], s["l_linestatus"], s["l_linenumber"])), ";").cast("binary")).alias("spots"))


@query("""WITH g AS (SELECT l_suppkey, l_returnflag, list_sort(list(DISTINCT l_linenumber)) AS p, list_sort(list(DISTINCT l_linestatus)) AS s FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_returnflag, 'otrelc-' || lpad(row_number() OVER (ORDER BY l_suppkey, l_returnflag)::VARCHAR, 6, '0') AS id, array_to_string(list_transform(p, lambda x: 'P' || x || ' (0.72)'), ',') AS evidence, array_to_string(s, ',') AS tokens FROM g""")
def gathered_candidates(spark, sf_dir):
    l = t(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", F.array("l_linenumber").alias("p"), F.array("l_linestatus").alias("s"))
    wrap = {"evidence": strings(F.transform("passages", lambda x: F.concat(F.lit("P"), x.cast("string"), F.lit(" (0.72)"))))}
    g = R.gathered(l, ["l_suppkey", "l_returnflag"], {"p": "passages", "s": "tokens"}, "otrelc-", wrap)
    return g.select("l_suppkey", "l_returnflag", "id", "evidence", strings("tokens").alias("tokens"))


@query("""WITH o AS (SELECT s_suppkey AS member, s_nationkey AS grp, CASE s_nationkey % 4 WHEN 0 THEN min(s_suppkey) OVER (PARTITION BY s_nationkey) WHEN 1 THEN -1 WHEN 2 THEN s_suppkey END AS target, CASE WHEN s_nationkey % 5 = 0 THEN 'default' ELSE 'Common_Tradition' END AS scope FROM supplier),
g AS (SELECT grp, count(DISTINCT member) AS n, count(DISTINCT target) AS ts, min(target) AS target, bool_or(member = target) AS isin, bool_and(lower(scope) = 'common_tradition') AS ok FROM o GROUP BY grp)
SELECT grp, unnest(list_filter([CASE WHEN n < 2 THEN 'too_few' END, CASE WHEN ts > 1 THEN 'several_targets' END, CASE WHEN n > 1 AND target IS NULL THEN 'no_target' END, CASE WHEN n > 1 AND ts = 1 AND NOT isin THEN 'target_not_member' END, CASE WHEN NOT ok THEN 'scope' END], lambda x: x IS NOT NULL)) AS fault FROM g""")
def merge_group_faults(spark, sf_dir):
    s = t(spark, sf_dir, "supplier")
    least = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("least"))
    n, k = F.col("s_nationkey") % 4, F.col("s_suppkey")
    o = s.join(least, "s_nationkey").select(F.col("s_nationkey").alias("grp"), k.alias("member"), F.when(n == 0, F.col("least")).when(n == 1, F.lit(-1).cast("bigint")).when(n == 2, k).alias("target"), F.when(F.col("s_nationkey") % 5 == 0, "default").otherwise("Common_Tradition").alias("scope"))
    return R.merge_group_faults(o)


@query("""SELECT l_orderkey, array_to_string(list(s || '/' || p || '/' || n || '=' || q ORDER BY s, p, n), ',') AS evidence FROM (SELECT l_orderkey, l_returnflag AS s, l_linenumber::VARCHAR AS p, l_linestatus AS n, min(l_quantity)::INT::VARCHAR AS q FROM lineitem GROUP BY ALL) GROUP BY l_orderkey""")
def evidence_union(spark, sf_dir):
    item = F.struct(F.col("l_returnflag").alias("source"), F.col("l_linenumber").cast("string").alias("passage"), F.col("l_linestatus").alias("note"), F.col("l_quantity").alias("certainty"))
    l = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber", "l_linestatus", "l_quantity")
    rows = S.in_tasks(l, l.count(), "l_orderkey").select("l_orderkey", F.array(item).alias("e"))  # moved as columns, not as lists of one
    u = rows.groupBy("l_orderkey").agg(R.united_evidence("e", ["source", "passage", "note"]).alias("e"))
    return u.select("l_orderkey", strings(F.transform("e", lambda x: F.concat(x["source"], F.lit("/"), x["passage"], F.lit("/"), x["note"], F.lit("="), x["certainty"].cast("int").cast("string")))).alias("evidence"))


@query("""SELECT o_custkey, min(o_orderkey) AS first, min(o_orderkey) FILTER (r = 2) AS second FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) GROUP BY o_custkey""")
def nth_of_group(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    one = R.nth(o, ["o_custkey"], "o_orderkey", "o_orderkey").withColumnRenamed("o_orderkey", "first")
    return one.join(R.nth(o, ["o_custkey"], "o_orderkey", "o_orderkey", 2).withColumnRenamed("o_orderkey", "second"), "o_custkey", "left")


@query("""SELECT user_id, event_id FROM (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events) WHERE b >= value""")
def unsorted_rows(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_id").alias("pos"), "value")
    return V.unsorted(e, ["value"], ["user_id"]).select("user_id", "event_id")


@query("""SELECT p_partkey, row_number() OVER (ORDER BY lower(p_name), p_partkey)::INT AS by_name, row_number() OVER (ORDER BY (p_partkey <> 7)::INT, lower(p_name), p_partkey)::INT AS selected,
row_number() OVER (ORDER BY CASE WHEN p_size = 1 THEN 0 ELSE 1 END, p_partkey % 100, p_brand, p_partkey)::INT AS ranked FROM part WHERE p_size < 6""")
def ordered_views(spark, sf_dir):
    """Ranks of the smaller parts in three orders, each numbered without one task that sees all rows."""
    p = t(spark, sf_dir, "part").filter("p_size < 6").select("p_partkey", "p_name", "p_brand", "p_size")
    k = F.col("p_partkey")
    orders = {
        # names in capitals here and there: a language's order does not tell them apart
        "by_name": [F.collate(F.when(k % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")), "UNICODE_CI")],
        "selected": R.selected_first(k, 7, F.when(k % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")), "UNICODE_CI"),
        "ranked": R.custom_rank(F.col("p_size") == 1, (k % 100), F.col("p_brand")),
    }
    out = p.select("p_partkey")
    for name, order in orders.items():
        # sort keys as plain columns, so that rows can be dealt into ranges
        cols = {f"_o{i}": c for i, c in enumerate(order)}
        n = R.numbered(p.select("p_partkey", *[c.alias(x) for x, c in cols.items()]), [*cols, "p_partkey"])
        out = out.join(n.select("p_partkey", F.col("ordinal").cast("int").alias(name)), "p_partkey")
    return out


@query("""SELECT * FROM (SELECT o_orderkey, o_totalprice, NULL::BIGINT AS n_more FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 80) UNION ALL SELECT NULL, NULL, greatest(count(*) - 80, 0) FROM orders""")
def top_with_more(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    top, more = R.top_with_more(o, [F.desc("o_totalprice"), F.asc("o_orderkey")], 80)
    return top.select("o_orderkey", "o_totalprice", F.lit(None).cast("long").alias("n_more")).unionByName(more, allowMissingColumns=True)


@query("""SELECT c_custkey AS k, 'left_only' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT o_custkey, 'right_only' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0) AND o_custkey % 10 = 0
UNION ALL SELECT c_custkey, 'left_only' FROM customer WHERE false""")
def except_both_ways(spark, sf_dir):
    c, o = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    both = V.except_both(c, o, "k").filter("side = 'left_only'")
    return both.unionByName(V.except_both(c.filter("k % 10 <> 0"), o, "k").filter("side = 'right_only'"))


@query("SELECT (SELECT count(*) FROM (SELECT l_suppkey FROM lineitem UNION SELECT s_suppkey FROM supplier UNION SELECT p_partkey FROM part)) AS n, (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS n_lines, (SELECT count(*) FROM supplier) AS n_suppliers, (SELECT count(*) FROM part) AS n_parts")
def distinct_in_all(spark, sf_dir):
    frames = {"lines": t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k")), "suppliers": t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), "parts": t(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))}
    return V.distinct_in_all(frames, "k")


@query("""SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 4 = 0 THEN 'reject' ELSE 'keep' END AS decision FROM nation""")
def overridden_rows(spark, sf_dir):
    n = t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return V.overridden(n, n.filter("n_nationkey % 4 = 0").withColumn("decision", F.lit("reject")), "n_nationkey", ["n_name"], {"decision": "keep"})


@query("""WITH m AS (SELECT p_partkey AS mention, p_name AS label FROM part), n AS (SELECT p_name, count(*) AS c, min(p_partkey) AS k FROM part GROUP BY p_name),
x AS (SELECT mention, count(DISTINCT b.p_partkey) AS met, min(b.p_partkey) AS k FROM m JOIN part a ON a.p_partkey = mention JOIN part b ON b.p_name = label AND b.p_brand = a.p_brand AND b.p_size = a.p_size GROUP BY mention)
SELECT m.mention, CASE WHEN c = 1 THEN n.k WHEN met = 1 THEN x.k END AS resolved, CASE WHEN c = 1 THEN 'label' WHEN met = 1 THEN 'reference_overlap' ELSE 'ambiguous_label' END AS how FROM m JOIN n ON label = p_name LEFT JOIN x ON x.mention = m.mention""")
def resolution_by_reference(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    place = F.concat_ws("/", "p_brand", "p_size").alias("passage")
    m = p.select(F.col("p_partkey").alias("mention"), F.lit(None).cast("bigint").alias("ref"), F.col("p_name").alias("label"))
    r = R.resolve(m, p.select("p_partkey", "p_name"), "ref", "label", "p_partkey", "p_name", "mention", p.select(F.col("p_partkey").alias("mention"), place), p.select("p_partkey", place))
    return r.select("mention", "resolved", "how")


@query("""SELECT o_orderkey, lo, hi, x::INT AS x FROM (SELECT *, unnest(range(lo, hi + 1)) AS x FROM (SELECT o_orderkey, (o_orderkey % 7)::INT AS lo, (o_orderkey % 7 + o_custkey % 30 - 3)::INT AS hi FROM orders) WHERE hi >= lo AND hi - lo <= 20)""")
def wide_and_inverted_ranges(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    o = t(spark, sf_dir, "orders").select("o_orderkey", (k % 7).cast("int").alias("lo"), (k % 7 + c % 30 - 3).cast("int").alias("hi"))
    return R.expand_range(o, "lo", "hi", "x")


GREEK = ["αρισταρχος", "αρισταρχου", "αριστοβουλος", "αριστοβουλου", "ιωαννης", "ιωαννην", "σιμων", "σιμωνα", "αννα", "λογος"]
ENDINGS = ["ους", "εως", "ιος", "αιος", "ου", "ος", "ον", "ω", "ης", "ην", "ας", "αν", "ια", "ις", "ιν", "α", "η", "ι", "ε"]
_STEMS = {"αρισταρχος": "αρισταρχ", "αρισταρχου": "αρισταρχ", "αριστοβουλος": "αριστοβουλ", "αριστοβουλου": "αριστοβουλ", "ιωαννης": "ιωανν", "ιωαννην": "ιωανν", "σιμων": "σιμων", "σιμωνα": "σιμων", "αννα": "ανν", "λογος": "λογ"}


@query(f"""WITH w AS (SELECT p_partkey, {one_of_sql('p_partkey', GREEK)} AS a, {one_of_sql('(p_size + p_partkey)', GREEK)} AS b, {one_of_sql('p_partkey', list(_STEMS.values()))} AS x, {one_of_sql('(p_size + p_partkey)', list(_STEMS.values()))} AS y FROM part)
SELECT p_partkey, a, b, CASE WHEN a = b THEN 'equal' WHEN x = y THEN 'stem' WHEN least(length(x), length(y)) >= 4 AND (starts_with(x, y) OR starts_with(y, x)) AND abs(length(x) - length(y)) <= 2 THEN 'prefix' END AS how FROM w""")
def greek_stems(spark, sf_dir):
    a, b = one_of(F.col("p_partkey"), GREEK), one_of(F.col("p_size") + F.col("p_partkey"), GREEK)
    return t(spark, sf_dir, "part").select("p_partkey", a.alias("a"), b.alias("b"), D.stem_forms(a, b, ENDINGS).alias("how"))


@query("""WITH w AS (SELECT p_partkey, unnest(list_distinct(string_split(p_name, ' '))) AS w FROM part), n AS (SELECT split_part(p_name, ' ', 1) AS w, p_size AS id FROM part WHERE p_partkey % 7 = 0)
SELECT p_partkey, array_to_string(list_sort(list(DISTINCT id)), ',') AS ids FROM w JOIN n USING (w) GROUP BY p_partkey""")
def token_index(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    texts = p.select("p_partkey", F.split("p_name", " ").alias("w"))
    names = p.filter("p_partkey % 7 = 0").select(F.element_at(F.split("p_name", " "), 1).alias("word"), F.col("p_size").alias("id"))
    return R.token_ids(texts, "p_partkey", "w", names, "word", "id").select("p_partkey", strings(F.col("ids").cast("array<string>")).alias("ids"))


@query("SELECT l.doc_id, quality, toxic, lang, n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id")
def aligned_snapshots(spark, sf_dir):
    l, d = t(spark, sf_dir, "labels"), t(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    a = R.aligned({"candidate": d.join(l.select("doc_id"), "doc_id", "left_semi"), "board": l}, "doc_id")
    return a.select("doc_id", "board.quality", "board.toxic", "candidate.lang", "candidate.n_chars")


@query("""WITH m AS (SELECT s_suppkey AS old, s_suppkey * 10 + 1 AS new FROM supplier WHERE s_suppkey % 3 = 0), l AS (SELECT l_orderkey, list(l_suppkey ORDER BY l_linenumber, l_suppkey) AS s FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, array_to_string(list_transform(s, lambda x: CASE WHEN x % 3 = 0 THEN x * 10 + 1 ELSE x END), ',') AS flat, array_to_string(list_transform(s, lambda x: CASE WHEN x % 3 = 0 THEN x * 10 + 1 ELSE x END), ',') AS nested FROM l""")
def array_remap(spark, sf_dir):
    m = t(spark, sf_dir, "supplier").filter("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("old"), (F.col("s_suppkey") * 10 + 1).alias("new"))
    l = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))), lambda x: x["l_suppkey"]).alias("s"))
    l = l.select("l_orderkey", "s", F.struct(F.lit("x").alias("kind"), F.col("s").alias("ids")).alias("inner"))
    out = R.remap_array(R.remap_array(l, m, "l_orderkey", "s"), m, "l_orderkey", "ids", "inner")
    text = lambda c: strings(F.col(c).cast("array<string>"))
    return out.select("l_orderkey", text("s").alias("flat"), text("inner.ids").alias("nested"))


@query("""SELECT p_name AS name, sum(CASE WHEN o_orderstatus = 'F' THEN c ELSE 0 END)::BIGINT AS f, sum(c)::BIGINT AS whole FROM (SELECT p_name, o_orderstatus, round(l_extendedprice * 100)::BIGINT AS c FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey) GROUP BY p_name""")
def grouped_money(spark, sf_dir):
    l, p, o = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "part"), t(spark, sf_dir, "orders")
    rows = l.join(p, F.col("l_partkey") == F.col("p_partkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("p_name", "o_orderstatus", cents("l_extendedprice").alias("c"))
    return rows.groupBy(F.col("p_name").alias("name")).agg(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("c")).otherwise(0)).alias("f"), F.sum("c").alias("whole"))


_REMAP = "CASE WHEN {0} % 3 <> 0 THEN 'person-' || lpad({0}::VARCHAR, 6, '0') ELSE 'old-' || {0} END"


@query(f"""SELECT o_orderkey, {_REMAP.format('o_custkey')} AS subject, (SELECT string_agg({_REMAP.format('l_suppkey')} || '/' || {_REMAP.format('l_partkey')} || '/' || 'x' || l_linenumber, ' ' ORDER BY l_linenumber, 'old-' || l_suppkey, 'old-' || l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS lines,
'old-' || o_orderkey || CASE WHEN o_custkey % 2 = 0 AND o_custkey <> o_orderkey THEN ',old-' || o_custkey ELSE '' END AS former FROM orders""")
def nested_remap(spark, sf_dir):
    """Old ids in a struct, in arrays of structs and in arrays within these become new ones; those without an entry stay."""
    old = lambda c: F.concat(F.lit("old-"), F.col(c).cast("string"))
    l = t(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", old("l_suppkey").alias("person_id"), F.struct(F.array(old("l_partkey"), F.concat(F.lit("x"), F.col("l_linenumber").cast("string"))).alias("ids")).alias("deep")).alias("line"))
    lines = l.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list("line")).alias("lines"))
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(lines, "o_orderkey", "left")
    rows = o.select("o_orderkey", F.struct(old("o_custkey").alias("subject_person_id"), "lines").alias("snapshot"), N.former_ids(F.array(F.lit(" "), old("o_orderkey")), F.when(F.col("o_custkey") % 2 == 0, old("o_custkey")), "^old-").alias("legacy_ids"))
    ids = t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k")).union(t(spark, sf_dir, "lineitem").select("l_partkey")).union(t(spark, sf_dir, "orders").select("o_custkey")).distinct().filter("k % 3 <> 0")
    mapping = ids.select(F.concat(F.lit("old-"), F.col("k").cast("string")).alias("old"), R.padded_id("person-", F.col("k")).alias("new"))
    out = N.remapped(rows, mapping, "o_orderkey", ["snapshot.subject_person_id", "snapshot.lines.person_id", "snapshot.lines.deep.ids"])
    text = F.array_join(F.transform("snapshot.lines", lambda x: F.concat_ws("/", x["person_id"], x["deep"]["ids"])), " ")
    return out.select("o_orderkey", F.col("snapshot.subject_person_id").alias("subject"), text.alias("lines"), F.array_join("legacy_ids", ",").alias("former"))


@query("""SELECT o_orderkey, 'snapshot.' || path AS path, 'old-' || k AS value FROM (SELECT o_orderkey, 'subject' AS path, o_custkey AS k FROM orders UNION SELECT o_orderkey, 'lines.person_id', l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey) WHERE k % 3 = 0""")
def ids_left_behind(spark, sf_dir):
    old = lambda c: F.concat(F.lit("old-"), F.col(c).cast("string"))
    lines = t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct(old("l_suppkey").alias("person_id"))).alias("lines"))
    rows = t(spark, sf_dir, "orders").join(lines, "o_orderkey", "left").select("o_orderkey", F.struct(old("o_custkey").alias("subject"), "lines").alias("snapshot"))
    ids = t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k")).union(t(spark, sf_dir, "orders").select("o_custkey")).distinct().filter("k % 3 <> 0")
    return N.unmapped(rows, ids.select(F.concat(F.lit("old-"), F.col("k").cast("string")).alias("old"), F.lit("new").alias("new")), "o_orderkey", ["snapshot.subject", "snapshot.lines.person_id"], "^old-")


_LANES = ", ".join(f"(sum(('0x' || substr(h, {1 + 16 * k}, 16))::UBIGINT::HUGEINT) % 18446744073709551616)::VARCHAR AS h{k}" for k in range(4))
_HASHED = "SELECT o_orderstatus AS part, sha256(o_orderkey::VARCHAR || chr(31) || o_custkey::VARCHAR || chr(31) || {0}) AS h FROM orders"


@query(f"""SELECT part, count(*) AS n, {_LANES} FROM ({_HASHED.format("CASE WHEN o_orderkey % 10 = 3 THEN 'changed' ELSE o_orderpriority END")} WHERE o_orderkey % 10 <> 5) GROUP BY part""")
def fingerprints_by_changes(spark, sf_dir):
    """States of parts, brought up to date by the rows deleted, inserted and changed alone."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderstatus").alias("part"))
    cols, k = ["o_orderkey", "o_custkey", "o_orderpriority"], F.col("o_orderkey") % 10
    before = P.state(o.filter(k != 7), cols, ["part"])
    new = o.filter(k == 7).unionByName(o.filter(k == 3).withColumn("o_orderpriority", F.lit("changed")))
    out = P.changed(before, ["part"], P.state(new, cols, ["part"]), P.state(o.filter(k.isin(3, 5)), cols, ["part"]))
    return out.select("part", "n", *[F.col(f"h{j}").cast("string").alias(f"h{j}") for j in range(4)])


@query("""WITH n AS (SELECT c_nationkey AS part, count(*) AS was, count(*) FILTER (c_custkey % 50 <> 0) AS n FROM customer GROUP BY c_nationkey)
SELECT part, CASE WHEN part = 3 THEN NULL ELSE was END AS was, CASE WHEN part = 4 THEN NULL ELSE n END AS n, CASE WHEN part = 3 THEN 'new' WHEN part = 4 THEN 'missing' ELSE 'changed' END AS fault FROM n WHERE part IN (3, 4) OR was <> n""")
def drifted_parts(spark, sf_dir):
    """Of recorded parts one is gone, one is new, and those are changed that lost customers."""
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("part"))
    cols = ["c_custkey", "c_name"]
    return P.drifted(P.state(c.filter("part <> 3"), cols, ["part"]), P.state(c.filter("part <> 4 AND c_custkey % 50 <> 0"), cols, ["part"]), ["part"])


@query("""SELECT 1 AS version, (SELECT count(*) FROM supplier) AS suppliers, (SELECT count(*) FROM nation) AS nations, false AS failed, 0 AS differ
UNION ALL SELECT 1, (SELECT count(*) FROM supplier), (SELECT count(*) FROM nation), true, 0
UNION ALL SELECT 2, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 <> 0), (SELECT count(*) FROM nation) + 1, false, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 = 0) + 1""")
def versioned_apply(spark, sf_dir):
    """Two tables in one version; a change that fails between them, after which both are as before; the change, after which both are new."""
    root, rows = S.scratch(spark), []
    s, n = t(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), t(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    def state(failed: bool, differ: int) -> None:
        version = S_.manifest(spark, root)[0]
        rows.append((version, S_.read(spark, root, "supplier").count(), S_.read(spark, root, "nation").count(), failed, differ))

    S_.commit(spark, root, {"supplier": s, "nation": n})
    state(False, 0)
    fewer = lambda now: now["supplier"].filter("s_suppkey % 4 <> 0")
    more = lambda now: now["nation"].unionByName(now["nation"].agg((F.max("n_nationkey") + 1).alias("n_nationkey"), F.lit("NEW").alias("n_name")))
    failed = False
    try:
        S_.commit(spark, root, {"supplier": fewer({"supplier": s}), "nation": n.withColumn("n_name", F.raise_error(F.lit("no")).cast("string"))})
    except Exception:  # noqa: BLE001  the failure is what is asked for
        failed = True
    state(failed, 0)
    counts = S_.apply(spark, root, lambda now: {"supplier": fewer(now), "nation": more(now)})
    S_.apply(spark, root, lambda now: {"supplier": fewer(now)}, "check")
    state(False, sum(counts.values()))
    return spark.createDataFrame(rows, "version int, suppliers long, nations long, failed boolean, differ long")
