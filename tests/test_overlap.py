import random
from itertools import combinations, product

from pyspark.sql import functions as F

from weft.operators import inference as I
from weft.operators import overlap as O


def half_up(part, whole):
    return (part * 20000 + whole) // (whole * 2)


def score(x, y):
    s = len(x & y)
    return half_up(s, len(x)) * 5 + half_up(s, len(y)) * 3 + half_up(s, len(x | y)) * 2


def sets_of(r, n, hot):
    """Random sets over a few common and many rare items; many are equal, and ``hot`` is in half of them."""
    return {i: frozenset(({hot} if r.random() < 0.5 else set()) | {r.choice([r.randint(0, 5), r.randint(0, 40)]) for _ in range(r.randint(1, 5))}) for i in range(n)}


def frame(spark, sets):
    return spark.createDataFrame([(e, str(x)) for e, s in sets.items() for x in s], "e int, item string")


def test_scores_above_against_all_pairs(spark):
    r = random.Random(5)
    a, b = sets_of(r, 150, 99), sets_of(r, 150, 99)
    for least in (90_000, 55_000, 20_000):
        pairs, ma, mb = O.scores_above(frame(spark, a), frame(spark, b), "e", "e", "item", least)
        at_a, at_b = {m.e: m.cls for m in ma.collect()}, {m.e: m.cls for m in mb.collect()}
        assert all(a[e] == a[c] for e, c in at_a.items()) and len(set(at_a.values())) == len(set(a.values()))
        got = {(p.a, p.b): (p.shared, p.score) for p in pairs.collect()}
        want = {(x, y): (len(a[x] & b[y]), score(a[x], b[y])) for x, y in product(a, b) if score(a[x], b[y]) >= least}
        assert {(x, y): got[at_a[x], at_b[y]] for x, y in want} == want and len(got) == len({(at_a[x], at_b[y]) for x, y in want})


def test_cooccurrences_above_against_all_pairs(spark):
    sets = sets_of(random.Random(6), 200, 77)
    for least in (1, 2, 3):
        pairs, members = O.cooccurrences_above(frame(spark, sets), "item", "e", least)
        at = {m.e: m.cls for m in members.collect()}
        got = {(p.a, p.b): p.n_passages for p in pairs.collect()}
        want = {(x, y): len(sets[x] & sets[y]) for x, y in combinations(sorted(sets), 2) if len(sets[x] & sets[y]) >= least}
        told = {(x, y): len(sets[x]) if at[x] == at[y] else got[min(at[x], at[y]), max(at[x], at[y])] for x, y in want}
        assert told == want and set(got) == {(min(at[x], at[y]), max(at[x], at[y])) for x, y in want if at[x] != at[y]}


def sets_over_small(r, n):
    """Sets below and above ``SMALL`` items, near copies of one another."""
    base = [frozenset(r.sample(range(60), r.choice([3, 6, 15, 16, 17, 25]))) for _ in range(n // 5)]
    return {i: frozenset(r.choice(base) - {r.randint(0, 59)} | {r.randint(0, 59)}) for i in range(n)}


def test_cooccurrences_of_sets_over_small(spark):
    sets = sets_over_small(random.Random(16), 150)
    for least in (3, 12):
        pairs, members = O.cooccurrences_above(frame(spark, sets), "item", "e", least)
        firsts = {m.cls for m in members.collect()}
        want = {(x, y): len(sets[x] & sets[y]) for x, y in combinations(sorted(firsts), 2) if len(sets[x] & sets[y]) >= least}
        assert {(p.a, p.b): p.n_passages for p in pairs.collect()} == want and len(want) > 100


def test_scores_of_sets_over_small(spark):
    r = random.Random(17)
    sets = sets_over_small(r, 200)
    a, b = {e: x for e, x in sets.items() if e % 2}, {e: x for e, x in sets.items() if e % 2 == 0}
    for least in (90_000, 45_000):
        pairs, ma, mb = O.scores_above(frame(spark, a), frame(spark, b), "e", "e", "item", least)
        ca, cb = ({m.cls for m in d.collect()} for d in (ma, mb))
        want = {(x, y): score(a[x], b[y]) for x, y in product(ca, cb) if score(a[x], b[y]) >= least}
        assert {(p.a, p.b): p.score for p in pairs.collect()} == want and want


def test_small_sets_that_share_too_little_do_not_meet(spark):
    """A thousand sets share two hot items and nothing else: with three needed, no two of them are brought together."""
    sets = frame(spark, {i: {-1, -2, *range(3 * i, 3 * i + 3)} for i in range(1000)} | {1000: {0, 1, 2, -9}}).withColumn("n", F.lit(5).cast("long"))
    small = O._in_order(sets, O._places(sets, "item"))
    pairs = O._small_pairs(small, small, lambda n, m: 3 if min(n, m) >= 3 else 0, once=True)
    assert [(p.a, p.b, p.shared) for p in pairs.collect()] == [(0, 1000, 3)]
    joined = pairs.groupBy("a").count()
    joined.collect()
    rows = []
    def walk(p):
        rows.extend(int(p.metrics().get("numOutputRows").get().value()) for _ in [0] if "Join" in p.nodeName() and p.metrics().contains("numOutputRows"))
        kids = [p.executedPlan()] if p.nodeName() == "AdaptiveSparkPlan" else [p.plan()] if p.nodeName().endswith("QueryStage") else [p.children().apply(i) for i in range(p.children().size())]
        [walk(k) for k in kids]
    walk(joined._jdf.queryExecution().executedPlan())
    assert rows and max(rows) < 20_000  # as rows of keys meet themselves; all pairs are 1,000,000


def test_passage_of_a_hundred_thousand(spark, duck):
    """All entities of both sides share one passage; what reaches the threshold is what brute force without that passage finds."""
    def side(seed):
        e = spark.range(100_000).select(F.col("id").alias("e"))
        rare = e.select("e", F.explode(F.sequence(F.lit(1), 1 + F.pmod(F.xxhash64("e", F.lit(seed)), F.lit(3)))).alias("k")).select("e", F.concat(F.lit("r"), F.pmod(F.xxhash64("e", "k", F.lit(seed)), F.lit(3000))).alias("item"))
        return e.select("e", F.lit("hot").alias("item")).unionByName(rare.filter("e % 10 <> 0")).distinct()

    left, right = side(1), side(2)
    pairs, ma, mb = O.scores_above(left, right, "e", "e", "item", 80_000)
    got = {tuple(p) for p in pairs.select("a", "b", "shared", "score").collect()}
    duck.register("l", left.toPandas()), duck.register("r", right.toPandas())
    sql = """WITH a AS (SELECT e, list_sort(list(item)) AS s FROM l GROUP BY e), b AS (SELECT e, list_sort(list(item)) AS s FROM r GROUP BY e),
    ca AS (SELECT s, len(s) AS n, min(e) AS e FROM a GROUP BY s), cb AS (SELECT s, len(s) AS n, min(e) AS e FROM b GROUP BY s),
    ia AS (SELECT e, n, unnest(s) AS item FROM ca), ib AS (SELECT e, n, unnest(s) AS item FROM cb),
    p AS (SELECT ia.e AS a, ib.e AS b, ia.n AS x, ib.n AS y, count(*) + 1 AS s FROM ia JOIN ib USING (item) WHERE item <> 'hot' GROUP BY ALL UNION ALL SELECT ca.e, cb.e, 1, 1, 1 FROM ca, cb WHERE ca.n = 1 AND cb.n = 1)
    SELECT a, b, s, (s * 20000 + x) // (x * 2) * 5 + (s * 20000 + y) // (y * 2) * 3 + (s * 20000 + x + y - s) // ((x + y - s) * 2) * 2 AS score FROM p WHERE score >= 80000"""
    assert got == {tuple(map(int, r)) for r in duck.execute(sql).fetchall()} and len(got) > 1000
    assert ma.count() == mb.count() == 100_000


def test_meetings_lose_no_pair(spark):
    sets = sets_of(random.Random(7), 80, 55)
    for heavy in (0, 8, 1000):
        met, hot = O.meetings(frame(spark, sets), "item", "e", heavy)
        got, told = {}, {}
        for m in met.collect():
            got.setdefault((m.a, m.b), set()).add(int(m.item))
        for h in hot.collect():
            told.setdefault(h.item, set()).add(h.e)
        for x, y in combinations(sorted(sets), 2):
            shared = set(map(int, sets[x] & sets[y]))
            assert got.get((x, y), {int(i) for i, of in told.items() if x in of and y in of}) == shared


def test_families_are_siblings(spark):
    r = random.Random(8)
    rows = [(f"p{r.randint(0, 5)}", f"c{i}") for i in range(40) for _ in range(r.randint(1, 2))] + [("c1", "c2"), ("c3", "c4"), ("c3", "c4")]
    parents = spark.createDataFrame([(p, c, f"{p}-{c}") for p, c in set(rows)], "parent string, child string, edge_id string")
    disputed = spark.createDataFrame([("c5",), ("c6",)], "entity string")
    families, clashes = I.sibling_families(parents, disputed)
    of, bad, apart = {}, set(), {(c.a, c.b): c.status for c in clashes.collect()}
    for f in families.collect():
        of.setdefault(f.parent, set()).add(f.child)
        bad |= {f.child} if f.disputed else set()
    got = {(x, y): apart.get((x, y)) or ("identity_conflict" if {x, y} & bad else "accepted") for c in of.values() for x, y in combinations(sorted(c), 2)}
    assert got == {(s.a, s.b): s.status for s in I.siblings(parents, disputed).collect()}
    empty = parents.limit(0)
    assert I.sibling_families(empty)[0].count() == 0 and O.meetings(empty, "parent", "child", 1)[0].count() == 0
    assert O.cooccurrences_above(empty, "parent", "child", 1)[0].count() == 0 and O.scores_above(empty, empty, "child", "child", "parent", 50_000)[0].count() == 0


def test_kin_families_stand_for_all_pairs(spark):
    r = random.Random(9)
    parents = {(f"p{r.randint(0, 5)}", f"c{r.randint(0, 25)}") for _ in range(40)} | {("p1", "p2"), ("p0", "c1"), ("p3", "c1")}
    df = spark.createDataFrame([(p, c, f"{p}-{c}") for p, c in parents], "parent string, child string, edge_id string")
    sibs = spark.createDataFrame([("p0", "p3", "e1", False), ("p1", "p2", "e2", True), ("p4", "p5", "e3", False)], "a string, b string, edge_id string, inferred boolean")
    kids = lambda p: {c for q, c in parents if q == p}
    got, cousins, uncles = I.kin_families(df, sibs).collect(), set(), set()
    for f in got:
        found = {(x, y) for x in (kids(f.a) if f.kin == "cousin" else {f.a}) for y in kids(f.b) if x != y}
        assert len(found) == f.n_pairs
        if f.kin == "cousin":
            cousins |= {(min(x, y), max(x, y)) for x, y in found}
        else:
            uncles |= found
    assert cousins == {(c.a, c.b) for c in I.cousins(df, sibs).collect()} and uncles == {(u.elder, u.younger) for u in I.uncles(df, sibs).collect()}


def test_kin_in_pieces_against_brute_force(spark, monkeypatch):
    """Families cut in pieces of two, with several rows of a child, siblings told twice and both ways, and pairs of one or both in a set."""
    monkeypatch.setattr(I, "PIECE", 2)
    r = random.Random(18)
    rows = sorted({(f"p{r.randint(0, 5)}", f"c{r.randint(0, 30)}") for _ in range(50)} | {("p1", "p2"), ("p1", "c1"), ("p2", "c1")})
    parents = spark.createDataFrame([(p, c, f"{p}-{c}") for p, c in rows] + [("p0", "c0", "e0"), ("p0", "c0", "e1")], "parent string, child string, edge_id string")
    of = spark.createDataFrame([("c1",), ("p2",), ("c9",)], "entity string")
    every = {(s.a, s.b): tuple(s) for s in I.siblings(parents).collect()}
    some = {(s.a, s.b): tuple(s) for s in I.siblings(parents, of=of).collect()}
    assert some == {k: v for k, v in every.items() if set(k) & {"c1", "p2", "c9"}} and some
    told = [("p0", "p3", "s1", False), ("p0", "p3", "s2", True), ("p3", "p0", "s3", True), ("p1", "p2", "s4", True), ("p4", "p5", "s5", False)]
    edges, want = [tuple(x) for x in parents.collect()], {}
    for (a, b, es, inferred), (p, x, e1), (q, y, e2) in product(told, edges, edges):
        if p == a and q == b and x != y:
            k, v = (min(x, y), max(x, y)), (inferred, [e1, es, e2])
            want[k] = min(want.get(k, v), v)
    got = I.cousins(parents, spark.createDataFrame(told, "a string, b string, edge_id string, inferred boolean")).collect()
    assert {(c.a, c.b): (c.certainty == 68, list(c.premises)) for c in got} == want and len(got) == len(want)
