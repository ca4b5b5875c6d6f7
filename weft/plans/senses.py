"""Queries over what names mean in their passages and what passages tell of two names, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import senses as E
from weft.operators import matching as D
from weft.plans.relational import t
from weft.plans.rules import strings

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(fn):
        QUERIES[fn.__name__] = fn
        ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


#: Verses by hand: (verse, passage, aliases, label, own token, endpoint, patriarch) and the kind and reason that the rules give.
VERSES = [
    (r"\v 1 \pn 摩西\pn* 说", "EXO 2:1", "摩西", "摩西", False, False, False, "person", "cuv_explicit_personal_grammar"),
    (r"\v 1 \pn 摩西\pn* 上山", "EXO 2:1", "摩西", "摩西", False, False, False, "person", "cuv_unambiguous_person_token"),
    (r"\v 1 属\pn 摩西\pn* 上山", "EXO 2:1", "摩西", "摩西", False, False, False, None, None),
    (r"\v 1 \pn 摩西\pn* 的子孙；\pn 摩西\pn* 子孙", "EXO 2:1", "摩西", "摩西", False, False, False, "person", "cuv_unambiguous_person_token"),
    (r"\v 1 摩西上山", "EXO 2:1", "摩西", "摩西", False, True, False, "person", "reviewed_direct_assertion_endpoint"),
    (r"\v 1 犹大支派", "JOS 2:1", "犹大", "犹大", False, False, False, "tribe", "polysemous_tribal_context"),
    (r"\v 1 以色列众民和犹大", "JOS 2:1", "犹大", "犹大", False, False, False, "people_group", "polysemous_collective_context"),
    (r"\v 1 犹大地", "JOS 2:1", "犹大", "犹大", False, False, False, "place", "polysemous_place_context"),
    (r"\v 1 \pn 犹大\pn* 国", "JOS 2:1", "犹大", "犹大", False, False, False, "nation", "polysemous_national_context"),
    (r"\v 1 犹大和他妻子", "JOS 2:1", "犹大", "犹大", False, False, False, "person", "ot_eponym_explicit_person_grammar"),
    (r"\v 1 犹大来了", "GEN 38:1", "犹大", "犹大", False, False, False, "person", "genesis_eponym_person_context"),
    (r"\v 1 犹大，西缅", "1CH 2:1", "犹大", "犹大", True, False, False, "person", "chronicles_genealogy_person_token"),
    (r"\v 1 犹大，西缅", "1CH 12:1", "犹大", "犹大", True, False, False, "tribe", "ot_residual_tribal_eponym"),
    (r"\v 1 摩押来了", "ISA 15:1", "摩押", "摩押", False, False, False, "people_group", "ot_residual_people_eponym"),
    (r"\v 1 没有名字", "ISA 15:1", "摩押", "摩押", False, False, False, None, None),
    (r"\v 1 雅各来了", "GEN 30:1", "雅各 以色列", "雅各", False, False, True, "person", "jacob_genesis_person_context"),
    (r"\v 1 雅各啊，以色列啊", "ISA 44:1", "雅各 以色列", "雅各", False, False, True, "people_group", "jacob_israel_poetic_collective"),
    (r"\v 1 耶书仑肥胖", "DEU 32:15", "雅各 以色列", "雅各", False, False, True, "people_group", "jacob_israel_poetic_collective"),
    (r"\v 1 雅各的神", "PSA 20:1", "雅各 以色列", "雅各", False, False, True, "person", "jacob_historical_person_reference"),
    (r"\v 1 雅各下到埃及", "JOS 24:4", "雅各 以色列", "雅各", False, False, True, "person", "jacob_narrative_person_reference"),
    (r"\v 1 雅各必如火", "OBA 1:18", "雅各 以色列", "雅各", False, False, True, "people_group", "jacob_prophetic_collective"),
    (r"\v 1 以色列犯罪", "JOS 7:11", "雅各 以色列", "雅各", False, False, True, "people_group", "israel_collective_after_genesis"),
]


def _pick(k, values, kind="string"):
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), (F.pmod(k, F.lit(len(values))) + 1).cast("int"))


def _of(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


@query(f"SELECT c_custkey, {_of([v[7] for v in VERSES])}[c_custkey % {len(VERSES)} + 1] AS kind, {_of([v[8] for v in VERSES])}[c_custkey % {len(VERSES)} + 1] AS reason FROM customer")
def mention_senses(spark, sf_dir):
    k = F.col("c_custkey")
    col = lambda i, kind="string": _pick(k, [v[i] for v in VERSES], kind)
    s = E.mention_sense(col(0), col(1), F.split(col(2), " "), col(3), col(4, "boolean"), col(5, "boolean"), col(6, "boolean"), F.lit(True))
    return t(spark, sf_dir, "customer").select(k, s["kind"].alias("kind"), s["reason"].alias("reason"))


#: Verses with a name that has no mark, and what is proposed of it: its surroundings, or nothing beside a group or place.
UNMARKED = [
    (r"看哪，\pn 约书亚\pn*，起来", "看哪，约书亚，起来"), (r"约书亚\f + \ft 注，约书亚，\f*，起来", "约书亚，起来"), (r"看，约书亚，族，", None), (r"属，约书亚，来", "属，约书亚，来"),
    (r"看约书亚来", None), (r"说：约书亚！", "说：约书亚！"), (r"城，约书亚，的", None), (r"无", None),
]


@query(f"SELECT s_suppkey, {_of([v[1] for v in UNMARKED])}[s_suppkey % {len(UNMARKED)} + 1] AS snippet FROM supplier")
def unmarked_names(spark, sf_dir):
    k = F.col("s_suppkey")
    return t(spark, sf_dir, "supplier").select(k, E.explicit_name(_pick(k, [v[0] for v in UNMARKED]), F.array(F.lit("犹大"), F.lit("约书亚")))["snippet"].alias("snippet"))


#: Sentences of two people, and who acts by each kind of relation: (text, kinship, commission, hostile).
SENTENCES = [
    ("亚当差遣大卫，", None, "ab", None), ("大卫任命亚当做事", None, "ba", None), ("亚当托付大卫的子孙", None, None, None), ("亚当膏立大卫", None, "ab", None), ("大卫是亚当的儿子", "ab", None, None),
    ("大卫杀了亚当", None, None, "ba"), ("亚当和大卫", None, None, None), ("亚当差遣大卫人，大卫指派亚当", None, "ba", None),
]


def _way(i: int) -> str:
    return f"{_of([s[i] for s in SENTENCES])}[o_orderkey % {len(SENTENCES)} + 1]"


@query(f"""WITH o AS (SELECT o_orderkey, o_custkey % 50 AS k, o_custkey % 50 % 4 = 3 AS other, {_way(1)} AS kinship, {_way(2)} AS commission, {_way(3)} AS hostile FROM orders WHERE o_orderkey % 5 <> 0 AND o_custkey % 50 <> 7),
w AS (SELECT *, unnest(['kinship', 'commission', 'hostile']) AS kind, unnest([kinship, commission, hostile]) AS way FROM o WHERE NOT other)
SELECT k, kind, CASE WHEN min(way) = 'ab' THEN 'a' || k ELSE 'b' || k END AS subject, count(*) AS n FROM w WHERE way IS NOT NULL GROUP BY k, kind HAVING count(DISTINCT way) = 1""")
def direct_relations(spark, sf_dir):
    """Of pairs of people, what their passages say: not where another person of the passage bears the same name, nor of disputed people."""
    o = t(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 50).alias("k"))
    p = o.select(F.col("k").alias("id"), F.col("o_orderkey").alias("passage"), _pick(F.col("o_orderkey"), [s[0] for s in SENTENCES]).alias("snippet"))
    end = lambda e: F.concat(F.lit(e), F.col("k").cast("string"))
    c = o.select("k").distinct().select(F.col("k").alias("id"), end("a").alias("a"), end("b").alias("b"), F.lit("亚当").alias("label_a"), F.lit("大卫").alias("label_b"), F.array(F.lit("kinship"), F.lit("commission"), F.lit("hostile")).alias("kinds"))
    labels = o.select(F.col("o_orderkey").alias("passage"), F.lit("亚当").alias("label"), end("a").alias("entity")).unionByName(o.select(F.col("o_orderkey").alias("passage"), F.lit("大卫").alias("label"), end("b").alias("entity")))
    # in some passages the label is that of two people, in some that of another one
    labels = labels.unionByName(o.filter("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("passage"), F.lit("大卫").alias("label"), F.lit("x").alias("entity")))
    labels = labels.withColumn("entity", F.when(F.expr("entity LIKE 'a%' AND int(substr(entity, 2)) % 4 = 3"), "y").otherwise(F.col("entity")))
    out = None
    for kind in D.relation_kinds():
        one = D.direct_proposals(c, p, labels, kind, o.select(F.lit("b7").alias("entity")))
        out = one if out is None else out.unionByName(one)
    return out.select(F.col("id").alias("k"), "kind", "subject", F.size("passages").cast("long").alias("n"))


@query("""WITH e AS (SELECT l_orderkey AS k, 'MAT ' || l_partkey AS passage, l_linenumber % 4 <> 0 AS read FROM lineitem), s AS (SELECT DISTINCT l_suppkey AS e, 'MAT ' || l_partkey AS passage FROM lineitem WHERE l_quantity > 10),
o AS (SELECT o_orderkey AS k, o_custkey % (SELECT max(s_suppkey) + 1 FROM supplier) AS src, (o_custkey + 1) % (SELECT max(s_suppkey) + 1 FROM supplier) AS dst FROM orders),
x AS (SELECT o.k, count(*) FILTER (read) AS n, coalesce(bool_or(read AND a.e IS NOT NULL AND b.e IS NOT NULL), false) AS two, coalesce(bool_or(read AND (a.e IS NOT NULL OR b.e IS NOT NULL)), false) AS one
  FROM o LEFT JOIN e ON e.k = o.k LEFT JOIN s a ON a.e = o.src AND a.passage = e.passage LEFT JOIN s b ON b.e = o.dst AND b.passage = e.passage GROUP BY o.k)
SELECT k, n AS n_read, CASE WHEN n = 0 THEN 'non_nt_locator' WHEN two THEN 'both_endpoints_mentioned' WHEN one THEN 'one_endpoint_mentioned' ELSE 'neither_endpoint_mentioned' END AS alignment FROM x""")
def evidence_alignment(spark, sf_dir):
    """Orders as relations between suppliers, their lines as evidence, of which some name no passage."""
    l, o = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "orders")
    of = F.col("o_custkey") % (F.col("top") + 1)
    top = t(spark, sf_dir, "supplier").agg(F.max("s_suppkey").alias("top"))
    passage = F.concat(F.lit("MAT "), F.col("l_partkey").cast("string"))
    items = l.groupBy(F.col("l_orderkey").alias("edge_id")).agg(F.collect_list(F.struct(F.when(F.col("l_linenumber") % 4 != 0, passage).otherwise("a manuscript").alias("passage"))).alias("evidence"))
    edges = o.join(F.broadcast(top)).select(F.col("o_orderkey").alias("edge_id"), of.alias("src"), ((F.col("o_custkey") + 1) % (F.col("top") + 1)).alias("dst")).join(items, "edge_id", "left")  # one row
    mentions = l.filter("l_quantity > 10").select(F.col("l_suppkey").alias("entity"), passage.alias("passage"))
    read = lambda item: F.when(item["passage"].rlike(r"^[1-3A-Z]{3} \d+"), item["passage"])
    out = D.evidence_alignment(edges, "evidence", mentions, read)
    return out.select(F.col("edge_id").alias("k"), "n_read", "alignment")
