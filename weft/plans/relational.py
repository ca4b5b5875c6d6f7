"""Queries over the operators of ``weft.operators.validation`` and ``relational``, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.operators import relational as R
from weft.operators import validation as V
from weft.sources.tables import in_tasks
from weft.sources.tables import table as t

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def cents(c: str):
    """Money in whole cents, so that sums do not depend on their order."""
    return F.round(F.col(c) * 100).cast("long")


FKS = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"), ("labels", "doc_id", "documents", "doc_id"), ("documents", "doc_id", "labels", "doc_id"),
)


@query(" UNION ALL ".join(f"SELECT '{c}.{f}' AS fk, count(*) AS n_orphans, count(DISTINCT {f}) AS n_keys FROM {c} WHERE {f} IS NOT NULL AND {f} NOT IN (SELECT {k} FROM {p})" for c, f, p, k in FKS))
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for child in dict.fromkeys(c for c, *_ in FKS):
        refs = {f: (t(spark, sf_dir, p), k) for c, f, p, k in FKS if c == child}
        o = V.orphan_counts(t(spark, sf_dir, child), refs).withColumn("fk", F.concat(F.lit(f"{child}."), "fk"))
        out = o if out is None else out.unionByName(o)
    return out


PKS = (("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey"), ("supplier", "s_suppkey"), ("nation", "n_nationkey"), ("events", "event_id"), ("documents", "doc_id"), ("lineitem", "l_orderkey"), ("conversations", "conv_id"))


@query(" UNION ALL ".join(f"SELECT '{a}' AS tbl, count(*) AS n_keys, coalesce(sum(n), 0)::BIGINT AS n_rows FROM (SELECT {k}, count(*) AS n FROM {a} GROUP BY {k} HAVING count(*) > 1)" for a, k in PKS))
def pk_duplicates(spark, sf_dir):
    out = None
    for a, k in PKS:
        d = V.duplicate_keys(t(spark, sf_dir, a), k).agg(F.count("*").alias("n_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")).select(F.lit(a).alias("tbl"), "n_keys", "n_rows")
        out = d if out is None else out.unionByName(d)
    return out


@query("""SELECT l_orderkey, l_linenumber, array_to_string(list_filter([
  CASE WHEN NOT coalesce(l_quantity <= 45, false) THEN 'quantity' END, CASE WHEN NOT coalesce(l_discount <= 0.09, false) THEN 'discount' END,
  CASE WHEN NOT coalesce(l_returnflag IN ('A', 'N', 'R'), false) THEN 'flag' END, CASE WHEN NOT coalesce(regexp_matches(l_linestatus, '^[FO]$'), false) THEN 'status' END], lambda x: x IS NOT NULL), ',') AS violated
FROM lineitem WHERE NOT coalesce(l_quantity <= 45, false) OR NOT coalesce(l_discount <= 0.09, false) OR NOT coalesce(l_returnflag IN ('A', 'N', 'R'), false) OR NOT coalesce(regexp_matches(l_linestatus, '^[FO]$'), false)""")
def rule_violations(spark, sf_dir):
    rules = {"quantity": F.col("l_quantity") <= 45, "discount": F.col("l_discount") <= 0.09, "flag": F.col("l_returnflag").isin("A", "N", "R"), "status": F.col("l_linestatus").rlike("^[FO]$")}
    return V.violations(t(spark, sf_dir, "lineitem"), rules).select("l_orderkey", "l_linenumber", F.array_join("violated", ",").alias("violated"))


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL""")
def key_set_diff(spark, sf_dir):
    return V.key_set_diff(t(spark, sf_dir, "documents"), t(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT 'orders_with_lines' AS metric, (SELECT count(*) FROM orders) AS expected, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS actual, (SELECT count(*) FROM orders) = (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS ok
UNION ALL SELECT 'lines_of_orders', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey), (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def expected_counts(spark, sf_dir):
    o, l = t(spark, sf_dir, "orders"), t(spark, sf_dir, "lineitem")
    return V.count_check({
        "orders_with_lines": (o.agg(F.count("*")), l.agg(F.countDistinct("l_orderkey"))),
        "lines_of_orders": (l.agg(F.count("*")), l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).agg(F.count("*"))),
    })


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE")


@query(f"""SELECT s AS o_orderstatus, p AS o_orderpriority, count(o_orderkey) AS n FROM (SELECT unnest(['F', 'O', 'P']) AS s), (SELECT unnest({list(PRIORITIES)}) AS p)
LEFT JOIN orders ON o_orderstatus = s AND o_orderpriority = p GROUP BY s, p""")
def status_counts_zero_filled(spark, sf_dir):
    domain = spark.createDataFrame([(s, p) for s in "FOP" for p in PRIORITIES], "o_orderstatus string, o_orderpriority string")
    return R.zero_filled_counts(t(spark, sf_dir, "orders"), domain, ["o_orderstatus", "o_orderpriority"])


@query("""SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS n_high, count(*) FILTER (value IS NULL) AS n_null, count(DISTINCT user_id) AS n_users,
min(event_id) AS first_event, max(event_id) AS last_event FROM events GROUP BY event_type""")
def conditional_counts(spark, sf_dir):
    return t(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("n_high"), F.count_if(F.col("value").isNull()).alias("n_null"),
        F.countDistinct("user_id").alias("n_users"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"),
    )


@query("""SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN n_chars < 60 THEN 'short' WHEN lang NOT IN ('en', 'de', 'fr') THEN 'scope_excluded'
WHEN contains(text, '###') THEN 'placeholder' ELSE 'accepted' END AS outcome FROM documents""")
def reject_routing(spark, sf_dir):
    text = F.col("text")
    accepted, ledger = R.route(t(spark, sf_dir, "documents"), [
        (text.isNull() | (text == ""), "empty"), (F.col("n_chars") < 60, "short"), (~F.col("lang").isin("en", "de", "fr"), "scope_excluded"), (text.contains("###"), "placeholder"),
    ])
    return accepted.select("doc_id", F.lit("accepted").alias("outcome")).unionByName(ledger.select("doc_id", F.col("reason").alias("outcome")))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'open' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 200000 THEN 'expedite'
WHEN o_totalprice > 300000 THEN 'large' WHEN o_orderpriority = '5-LOW' THEN 'defer' ELSE 'normal' END AS class FROM orders""")
def priority_classify(spark, sf_dir):
    p, price = F.col("o_orderpriority"), F.col("o_totalprice")
    rules = [(F.col("o_orderstatus") == "P", "open"), (p.isin("1-URGENT", "2-HIGH") & (price > 200000), "expedite"), (price > 300000, "large"), (p == "5-LOW", "defer")]
    return t(spark, sf_dir, "orders").select("o_orderkey", R.classify(rules, "normal").alias("class"))


@query("""SELECT c_custkey, coalesce(n, 0) AS n_orders, coalesce(urgent, 0) AS n_urgent FROM customer LEFT JOIN
(SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""")
def grouped_lookup_default(spark, sf_dir):
    o = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"))
    return R.lookup(t(spark, sf_dir, "customer").select("c_custkey"), o, ["c_custkey"], {"n_orders": 0, "n_urgent": 0})


@query("""SELECT l_orderkey, min(l_quantity) AS least_quantity, string_agg(l_returnflag, '; ' ORDER BY l_linenumber, l_returnflag) AS notes,
array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS suppliers FROM lineitem GROUP BY l_orderkey""")
def keyed_merge(spark, sf_dir):
    m = R.merge_by_key(t(spark, sf_dir, "lineitem"), ["l_orderkey"], {"least_quantity": "l_quantity"}, {"notes": ("l_returnflag", "l_linenumber")}, {"suppliers": "l_suppkey"})
    return m.withColumn("suppliers", F.array_join(F.col("suppliers").cast("array<string>"), ","))


@query("""SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def argmax_by_rank(spark, sf_dir):
    return R.best(t(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderpriority"), F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("""SELECT s_nationkey, count(*) AS n, bool_and(s_acctbal > 0) AS all_positive, bool_or(s_acctbal < 0) AS any_negative, min(s_suppkey) AS target,
count(*) >= 2 AND bool_and(s_acctbal > -500) AS may_merge FROM supplier GROUP BY s_nationkey""")
def merge_group_consistency(spark, sf_dir):
    b = F.col("s_acctbal")
    return t(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(
        F.count("*").alias("n"), F.bool_and(b > 0).alias("all_positive"), F.bool_or(b < 0).alias("any_negative"), F.min("s_suppkey").alias("target"),
        ((F.count("*") >= 2) & F.bool_and(b > -500)).alias("may_merge"),
    )


@query("""SELECT array_to_string(s, ',') AS signature, count(*) AS n, min(l_orderkey) AS first FROM (SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey % 10)) AS s FROM lineitem GROUP BY l_orderkey) GROUP BY s HAVING count(*) > 1""")
def signature_twins(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 10).alias("item"))
    return R.signature_groups(rows, "l_orderkey", "item").withColumn("signature", F.array_join(F.col("signature").cast("array<string>"), ","))


_REVENUE = "(SELECT s_nationkey, s_suppkey, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT // 1000000 AS score FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"


@query(f"""WITH r AS (SELECT *, dense_rank() OVER (PARTITION BY s_nationkey ORDER BY score DESC) AS rank FROM {_REVENUE}),
n AS (SELECT *, max(CASE WHEN rank = 2 THEN score END) OVER (PARTITION BY s_nationkey) AS second FROM r)
SELECT s_nationkey, s_suppkey, score, rank::INT AS rank, CASE WHEN rank = 1 THEN coalesce(score - second, 0) ELSE 0 END AS margin_or_zero,
CASE WHEN rank = 1 THEN score - coalesce(second, 0) ELSE 0 END AS margin_or_score FROM n""")
def dense_rank_margin(spark, sf_dir):
    l, s = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "supplier")
    rev = l.groupBy("l_suppkey").agg(F.sum(cents("l_extendedprice")).alias("c")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return R.rank_margin(rev.select("s_nationkey", "s_suppkey", F.floor(F.col("c") / 1000000).cast("long").alias("score")), "s_nationkey", "score")


@query("""SELECT c_nationkey, c_custkey, rank::INT AS rank FROM (SELECT *, dense_rank() OVER (PARTITION BY c_nationkey ORDER BY floor(c_acctbal / 100) DESC) AS rank FROM customer) WHERE rank <= 3""")
def top3_rank_groups(spark, sf_dir):
    c = t(spark, sf_dir, "customer").withColumn("score", F.floor(F.col("c_acctbal") / 100))
    return R.top_rank_groups(c, "c_nationkey", "score", 3).select("c_nationkey", "c_custkey", "rank")


@query("""SELECT p_partkey, 'prt-' || lpad(row_number() OVER (ORDER BY p_brand, p_name, p_partkey)::VARCHAR, 6, '0') AS id FROM part""")
def ordinal_ids(spark, sf_dir):
    n = R.numbered(t(spark, sf_dir, "part").select("p_brand", "p_name", "p_partkey"), ["p_brand", "p_name", "p_partkey"])
    return n.select("p_partkey", R.padded_id("prt-", F.col("ordinal")).alias("id"))


@query("""WITH k AS (SELECT s_suppkey, 'sup-' || lpad((s_suppkey * 3)::VARCHAR, 6, '0') AS id FROM supplier WHERE s_suppkey % 2 = 0)
SELECT s.s_suppkey, coalesce(k.id, 'sup-' || lpad(((SELECT max(s_suppkey * 3) FROM supplier WHERE s_suppkey % 2 = 0) + row_number() OVER (PARTITION BY k.id IS NULL ORDER BY s.s_name, s.s_suppkey))::VARCHAR, 6, '0')) AS id
FROM supplier s LEFT JOIN k ON s.s_suppkey = k.s_suppkey""")
def stable_id_reuse(spark, sf_dir):
    s = t(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    known = s.filter("s_suppkey % 2 = 0").select("s_suppkey", R.padded_id("sup-", F.col("s_suppkey") * 3).alias("id"))
    return R.reuse_ids(s, known, "s_suppkey", ["s_name", "s_suppkey"], "sup-").select("s_suppkey", "id")


@query("""SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_decision(spark, sf_dir):
    return R.latest(t(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id")


@query("""SELECT conv_id, turn, (sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER w)::BIGINT AS section, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER w AS opener
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def forward_fill_sections(spark, sf_dir):
    return R.filled_forward(t(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.col("role") == "user", "turn").select("conv_id", "turn", "section", "opener")


@query("""SELECT source, count(*) AS n, array_to_string(list_sort(list(doc_id ORDER BY doc_id))[1:25], ',') AS first FROM documents WHERE contains(lower(text), 'the ') GROUP BY source""")
def capped_list_full_count(spark, sf_dir):
    hits = t(spark, sf_dir, "documents").filter(F.contains(F.lower("text"), F.lit("the "))).select("source", "doc_id")
    return R.capped_list(hits, "source", "doc_id", 25).withColumn("first", F.array_join(F.col("first").cast("array<string>"), ","))


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (event_type = 'purchase')::INT DESC, event_id) AS r FROM events WHERE event_type IN ('view', 'click', 'purchase')) WHERE r = 1""")
def priority_union(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return R.priority_union([e.filter(F.col("event_type").isin("view", "click")), e.filter("event_type = 'purchase'")], ["user_id"], [F.col("event_id")])


@query("""WITH m AS (SELECT p_partkey AS mention, CASE WHEN p_partkey % 3 = 0 THEN p_partkey END AS ref, CASE WHEN p_partkey % 7 = 0 THEN 'unknown ' || p_name ELSE p_name END AS label FROM part),
n AS (SELECT p_name, count(*) AS c, min(p_partkey) AS k FROM part GROUP BY p_name)
SELECT mention, coalesce(p.p_partkey, CASE WHEN c = 1 THEN k END) AS resolved, CASE WHEN p.p_partkey IS NOT NULL THEN 'key' WHEN c = 1 THEN 'label' WHEN c > 1 THEN 'ambiguous_label' ELSE 'missing_label' END AS how
FROM m LEFT JOIN part p ON ref = p.p_partkey LEFT JOIN n ON label = n.p_name""")
def cascaded_resolution(spark, sf_dir):
    p = t(spark, sf_dir, "part").select("p_partkey", "p_name")
    m = p.select(
        F.col("p_partkey").alias("mention"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey")).alias("ref"),
        F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("unknown "), "p_name")).otherwise(F.col("p_name")).alias("label"),
    )
    return R.resolve(m, p, "ref", "label", "p_partkey", "p_name").select("mention", "resolved", "how")


@query("""WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS subtype FROM orders),
r AS (SELECT o_custkey, subtype, count(*) AS n FROM o GROUP BY ALL) SELECT o_orderkey, o.subtype, n FROM o JOIN r ON o.o_custkey = r.o_custkey AND o.subtype IS NOT DISTINCT FROM r.subtype""")
def composite_key_nullsafe(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("subtype"))
    return R.null_safe_join(o, o.groupBy("o_custkey", "subtype").agg(F.count("*").alias("n")), ["o_custkey", "subtype"]).select("o_orderkey", "subtype", "n")


@query("""SELECT o_orderkey, l_linenumber, l_partkey FROM (SELECT o_orderkey, unnest(range(1, o_orderkey % 5 + 2)) AS line FROM orders) JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = line""")
def range_expand_join(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.lit(1).alias("lo"), (F.col("o_orderkey") % 5 + 1).cast("int").alias("hi"))
    e = R.expand_range(o, "lo", "hi", "line")
    return e.join(t(spark, sf_dir, "lineitem"), (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_linenumber") == F.col("line"))).select("o_orderkey", "l_linenumber", "l_partkey")


@query("""WITH m AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS n_passages FROM m x JOIN m y USING (l_orderkey) WHERE x.l_suppkey < y.l_suppkey GROUP BY ALL""")
def cooccurrence_pairs(spark, sf_dir):
    return R.cooccurrences(t(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


@query("""WITH p AS (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem), k AS (SELECT DISTINCT p_brand, l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey),
s AS (SELECT l_suppkey, p_brand, count(*) AS shared FROM p JOIN k USING (l_orderkey) GROUP BY ALL), a AS (SELECT l_suppkey, count(*) AS n_a FROM p GROUP BY ALL), b AS (SELECT p_brand, count(*) AS n_b FROM k GROUP BY ALL),
c AS (SELECT *, (shared * 20000 + n_a) // (n_a * 2) AS coverage, (shared * 20000 + n_b) // (n_b * 2) AS precision, (shared * 20000 + n_a + n_b - shared) // ((n_a + n_b - shared) * 2) AS jaccard FROM s JOIN a USING (l_suppkey) JOIN b USING (p_brand))
SELECT l_suppkey, p_brand, shared, coverage, precision, jaccard, coverage * 5 + precision * 3 + jaccard * 2 AS score, (dense_rank() OVER (PARTITION BY l_suppkey ORDER BY coverage * 5 + precision * 3 + jaccard * 2 DESC))::INT AS rank FROM c""")
def overlap_scores(spark, sf_dir):
    l, p = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "part")
    brands = l.select("l_orderkey", "l_partkey").join(p.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    s = R.overlap_scores(l, brands, "l_suppkey", "p_brand", "l_orderkey").drop("n_a", "n_b")
    return s.withColumn("rank", F.dense_rank().over(Window.partitionBy("l_suppkey").orderBy(F.desc("score"))))


@query("""WITH l AS (SELECT l_orderkey, 'B' || lpad(substr(p_brand, 7, 2), 2, '0') || '00' || CASE l_linenumber % 3 WHEN 0 THEN 'A' WHEN 1 THEN '' ELSE 'B' END AS code, l_linenumber FROM lineitem JOIN part ON l_partkey = p_partkey),
r AS (SELECT l_orderkey, code AS right_code, l_linenumber AS right_line FROM l WHERE l_linenumber % 2 = 0)
SELECT l_orderkey, code, right_code, l_linenumber, right_line, CASE WHEN code = right_code THEN 'exact' ELSE 'base' END AS how FROM l JOIN r USING (l_orderkey)
WHERE regexp_replace(code, '[A-Z]$', '') = regexp_replace(right_code, '[A-Z]$', '') AND (code = right_code OR NOT regexp_matches(code, '[A-Z]$') OR NOT regexp_matches(right_code, '[A-Z]$'))""")
def code_fallback_join(spark, sf_dir):
    l = t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    n = F.col("l_linenumber")
    l = l.select("l_orderkey", F.concat(F.lit("B"), F.lpad(F.substring("p_brand", 7, 2), 2, "0"), F.lit("00"), F.when(n % 3 == 0, "A").when(n % 3 == 1, "").otherwise("B")).alias("code"), "l_linenumber")
    r = l.filter("l_linenumber % 2 = 0").withColumnRenamed("l_linenumber", "right_line")
    return R.code_join(l, r, "code", "l_orderkey")


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')""")
def dual_source_agreement(spark, sf_dir):
    l, o = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "orders").select("o_orderkey")
    for c in (F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"):
        o = o.join(l.filter(c).select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    return o


@query("""SELECT o_orderkey, CASE WHEN n IS NULL THEN 'no_locator' WHEN s AND b THEN 'both' WHEN s OR b THEN 'one' ELSE 'neither' END AS class
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, bool_or(l_returnflag = 'R') AS s, bool_or(l_quantity > 40) AS b FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""")
def alignment_class(spark, sf_dir):
    e = t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("s"), F.bool_or(F.col("l_quantity") > 40).alias("b"))
    rules = [(F.col("s").isNull(), "no_locator"), (F.col("s") & F.col("b"), "both"), (F.col("s") | F.col("b"), "one")]
    return t(spark, sf_dir, "orders").select("o_orderkey").join(e, "o_orderkey", "left").select("o_orderkey", R.classify(rules, "neither").alias("class"))


@query("""WITH m AS (SELECT s_suppkey AS old, s_suppkey * 10 + 1 AS new FROM supplier WHERE s_suppkey % 3 = 0) SELECT l_orderkey, l_linenumber, coalesce(new, l_suppkey) AS l_suppkey FROM lineitem LEFT JOIN m ON l_suppkey = old""")
def id_remap(spark, sf_dir):
    m = t(spark, sf_dir, "supplier").filter("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("old"), (F.col("s_suppkey") * 10 + 1).alias("new"))
    return R.remap(t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), m, ["l_suppkey"])


@query("""WITH w AS (SELECT DISTINCT l_orderkey AS key, l_linenumber AS item FROM lineitem), p AS (SELECT key, item, 1 AS part FROM w WHERE item <= 3 UNION ALL SELECT key, item, 2 FROM w WHERE item >= 3 AND item < 6)
SELECT key, item, fault FROM (SELECT coalesce(w.key, n.key) AS key, coalesce(w.item, n.item) AS item, CASE WHEN w.key IS NULL THEN 'unknown' WHEN n.n IS NULL THEN 'missing' WHEN n.n > 1 THEN 'overlap' END AS fault
FROM w FULL JOIN (SELECT key, item, count(*) AS n FROM p GROUP BY ALL) n ON w.key = n.key AND w.item = n.item) WHERE fault IS NOT NULL""")
def partition_coverage(spark, sf_dir):
    l = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("item"))
    rows = l.count()
    w = in_tasks(l, rows, "key", "item").distinct()
    parts = w.filter("item <= 3").unionByName(w.filter("item >= 3 AND item < 6"))
    return V.partition_coverage(parts, w, "key", "item", rows * 2)
