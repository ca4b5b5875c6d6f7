"""Queries over pairs that share items, with items of many entities among them, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import inference as I
from weft.operators import overlap as O
from weft.plans.graph import SIBE, H, _sibs, h_edges
from weft.plans.relational import t

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(fn):
        QUERIES[fn.__name__] = fn
        ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


#: Scores from here on are asked for, in hundred-thousandths.
LEAST = 70_000


@query(f"""WITH d AS (SELECT DISTINCT l_orderkey % 2 AS side, l_orderkey AS e, l_suppkey AS item FROM lineitem),
s AS (SELECT side, e, list_sort(list(item)) AS s, count(*) AS n FROM d GROUP BY ALL), c AS (SELECT side, s, n, min(e) AS e, count(*) AS members FROM s GROUP BY ALL),
i AS (SELECT side, e, n, members, unnest(s) AS item FROM c),
p AS (SELECT a.e AS a, b.e AS b, a.n AS n_a, b.n AS n_b, a.members AS members_a, b.members AS members_b, count(*) AS shared FROM i a JOIN i b ON a.item = b.item AND a.side = 1 AND b.side = 0 GROUP BY ALL),
m AS (SELECT *, (shared * 20000 + n_a) // (n_a * 2) AS coverage, (shared * 20000 + n_b) // (n_b * 2) AS precision, (shared * 20000 + n_a + n_b - shared) // ((n_a + n_b - shared) * 2) AS jaccard FROM p)
SELECT a, b, n_a, n_b, shared, members_a, members_b, coverage, precision, jaccard, coverage * 5 + precision * 3 + jaccard * 2 AS score FROM m WHERE coverage * 5 + precision * 3 + jaccard * 2 >= {LEAST}""")
def overlap_scores_above(spark, sf_dir):
    """Odd orders against even ones by their suppliers: pairs of classes with their members' numbers."""
    l = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return O.scores_above(l.filter("l_orderkey % 2 = 1"), l.filter("l_orderkey % 2 = 0"), "l_orderkey", "l_orderkey", "l_suppkey", LEAST)[0]


@query("""WITH d AS (SELECT DISTINCT l_orderkey AS e, l_suppkey AS item FROM lineitem), s AS (SELECT e, list_sort(list(item)) AS s, count(*) AS n FROM d GROUP BY e),
c AS (SELECT s, n, min(e) AS e, count(*) AS members FROM s WHERE n >= 3 GROUP BY s, n), i AS (SELECT e, unnest(s) AS item FROM c),
p AS (SELECT a.e AS a, b.e AS b, count(*) AS n_passages FROM i a JOIN i b ON a.item = b.item AND a.e < b.e GROUP BY ALL HAVING count(*) >= 3)
SELECT a, b, n_passages, NULL::BIGINT AS members FROM p UNION ALL SELECT e, e, n, members FROM c WHERE members > 1""")
def cooccurrences_above(spark, sf_dir):
    """Orders that share three suppliers or more: pairs of classes, and classes of several members with what these share."""
    pairs, classes, _ = O.class_cooccurrences(t(spark, sf_dir, "lineitem"), "l_suppkey", "l_orderkey", 3)
    own = classes.select(F.col("cls").alias("a"), F.col("n").alias("n_passages"), "members").filter("members > 1")
    return pairs.withColumn("members", F.lit(None).cast("long")).unionByName(own.withColumn("b", F.col("a")))


@query("""WITH d AS (SELECT 'o' || l_orderkey AS item, l_suppkey AS e FROM lineitem UNION SELECT l_returnflag, l_suppkey FROM lineitem), n AS (SELECT item, count(*) AS n FROM d GROUP BY item),
p AS (SELECT DISTINCT a.e AS a, b.e AS b FROM d a JOIN d b ON a.item = b.item AND a.e < b.e WHERE a.item IN (SELECT item FROM n WHERE n <= 9)),
m AS (SELECT p.a, p.b, x.item FROM p JOIN d x ON x.e = p.a JOIN d y ON y.e = p.b AND y.item = x.item)
SELECT 'pair' AS kind, a::VARCHAR AS a, b::VARCHAR AS b, count(*) AS n FROM m GROUP BY ALL UNION ALL SELECT 'heavy', item, e::VARCHAR, n FROM d JOIN n USING (item) WHERE n > 9""")
def meetings_with_heavy_items(spark, sf_dir):
    """Suppliers that share orders or return flags; a flag has more than nine suppliers and stays factored."""
    l = t(spark, sf_dir, "lineitem")
    rows = l.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("item"), "l_suppkey").unionByName(l.select(F.col("l_returnflag").alias("item"), "l_suppkey"))
    met, heavy = O.counted_meetings(rows, "item", "l_suppkey", 9)
    text = lambda c, n: F.col(c).cast("string").alias(n)
    return met.select(F.lit("pair").alias("kind"), text("a", "a"), text("b", "b"), "n").unionByName(heavy.select(F.lit("heavy").alias("kind"), F.col("item").alias("a"), text("l_suppkey", "b"), "n"))


@query("""WITH e AS (SELECT 'N' || c_nationkey AS parent, 'C' || c_custkey AS child FROM customer UNION ALL SELECT 'C' || c_custkey, 'C' || (c_custkey + 1) FROM customer WHERE c_custkey % 3 = 0),
n AS (SELECT parent, count(*) AS n FROM e GROUP BY parent HAVING count(*) > 1)
SELECT 'family' AS kind, parent AS x, child AS y, n, CASE WHEN child LIKE '%7' THEN 'disputed' END AS status FROM e JOIN n USING (parent)
UNION SELECT 'pair', least(l.parent, l.child), greatest(l.parent, l.child), NULL, 'generation_conflict' FROM e l JOIN e a ON a.child = l.parent JOIN e b ON b.child = l.child AND a.parent = b.parent""")
def sibling_families(spark, sf_dir):
    """Customers of a nation as siblings, some of them parents of the next one: families, and the pairs they are wrong about."""
    c = t(spark, sf_dir, "customer")
    name = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    k = F.col("c_custkey")
    e = c.select(name("N", F.col("c_nationkey")).alias("parent"), name("C", k).alias("child")).unionByName(c.filter(k % 3 == 0).select(name("C", k).alias("parent"), name("C", k + 1).alias("child")))
    e = e.withColumn("edge_id", F.concat_ws("-", "parent", "child"))
    families, pairs = I.sibling_families(e, e.filter("child LIKE '%7'").select(F.col("child").alias("entity")))
    f = families.select(F.lit("family").alias("kind"), F.col("parent").alias("x"), F.col("child").alias("y"), "n", F.when(F.col("disputed"), "disputed").alias("status"))
    return f.unionByName(pairs.select(F.lit("pair").alias("kind"), F.col("a").alias("x"), F.col("b").alias("y"), F.lit(None).cast("long").alias("n"), "status"))


@query(f"""WITH {H}, {SIBE}, n AS (SELECT parent, count(*) AS n FROM h GROUP BY parent), both_ AS (SELECT a, b, edge_id, inferred FROM sibe UNION ALL SELECT b, a, edge_id, inferred FROM sibe)
SELECT 'cousin' AS kin, a, b, edge_id, inferred, x.n AS n_a, y.n AS n_b, x.n * y.n AS n_pairs FROM sibe JOIN n x ON x.parent = a JOIN n y ON y.parent = b
UNION ALL SELECT 'uncle', a, b, edge_id, inferred, 1, n, n FROM both_ JOIN n ON parent = b""")
def kin_families(spark, sf_dir):
    """Cousins, uncles and aunts as families, not pairs: a row for two siblings, however many children they have."""
    h = h_edges(spark, sf_dir)
    return I.kin_families(h, _sibs(h))
