"""Steps whose shuffles or memory must not grow with what a query does not need."""

import random
import re

from pyspark.sql import functions as F

from weft.operators import graph as G
from weft.operators import overlap as O
from weft.operators import relational as R
from weft.operators import validation as V
from weft.plans import graph as P
from weft.sources import tables as T


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_paths_move_edges_of_their_front_alone(spark, tmp_path):
    r = random.Random(3)
    rows = [(f"a{r.randint(0, 8)}", f"b{r.randint(0, 8)}") for _ in range(30)] + [("a99", "b99"), ("a0", "b0")]
    e = G.each_way(spark.createDataFrame([(a, b, f"{a}-{b}") for a, b in rows + rows[:9]], "a string, b string, id string"), "a", "b", "id")
    start = spark.createDataFrame([("a0",), ("b0",)], "node string")
    key = lambda d: sorted((x.src, x.dst, tuple(x.ids), tuple(x.steps), x.delta, x.length) for x in d.collect())
    want = key(G.canonical_paths(e.distinct(), sources=start.withColumnRenamed("node", "src")))
    assert key(G.paths_from(e, start)) == want and {x[-1] for x in want} >= {1, 2, 3}
    spark.createDataFrame([(1, 1), (1, 1)], "l_suppkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert "Exchange" not in _plan(P.supply_edges(spark, str(tmp_path)))


def test_path_invariants_see_paths_over_repeated_lines(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 2), (3, 3)], "l_suppkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    moved = []
    at_front = G._at_front
    monkeypatch.setattr(G, "_at_front", lambda e, f: moved.append(at_front(e, f)) or moved[-1])
    assert P.path_invariants(spark, str(tmp_path)).count() == 0
    assert moved and all("p0000003" not in {x.src for x in m.collect()} for m in moved)


def test_component_around_is_whole_beyond_its_rounds(spark):
    chain = [(f"n{i:02}", f"n{i + 1:02}") for i in range(12)]
    e = G.each_way(spark.createDataFrame([(a, b, "x") for a, b in chain + chain[:3] + [("z1", "z2")]], "a string, b string, id string"), "a", "b", "id")
    want = sorted({x for c in chain for x in c})
    around = lambda focus, rounds: sorted(x.node for x in G.component_around(e, spark.createDataFrame([(focus,)], "node string"), rounds).collect())
    assert around("n07", 2) == want
    assert around("z2", 8) == ["z1", "z2"]


def test_shared_targets_of_large_targets_and_sources(spark):
    r = random.Random(8)
    rows = [(f"s{r.randint(0, 14):02}", f"p{r.randint(0, 12):02}") for _ in range(120)] + [("x", "x"), ("s00", "x"), ("x", "s00")]
    e = spark.createDataFrame(rows + rows[:20], "src string, dst string")
    of = {a: {m for x, m in rows if x == a and m != a} for a, _ in rows}
    want = sorted((a, b, m, i + 1) for a in of for b in of if a < b for i, m in enumerate(sorted((of[a] & of[b]) - {a, b})[:5]))
    got = G.shared_targets(e, sent=3, heavy=20)
    assert sorted(tuple(x) for x in got.collect()) == want
    assert _plan(got).count("REPARTITION_BY_NUM") >= 2  # as many tasks as there are meetings, not as a session has


def test_contexts_are_dealt_over_as_many_tasks_as_edges_need(spark, monkeypatch):
    monkeypatch.setattr(T, "TASK_ROWS", 2)
    e = spark.createDataFrame([("a", "m"), ("m", "b"), ("m", "b"), ("a", "n"), ("n", "b"), ("a", "b"), ("b", "b"), ("a", "a")] * 2, "src string, dst string")
    got = G.two_hop_contexts(e, spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "a")], "a string, b string"))
    assert sorted(tuple(x) for x in got.collect()) == [("a", "b", "m", 1), ("a", "b", "n", 2)]
    assert ", 8), REPARTITION_BY_NUM" in _plan(got)


def test_cooccurrences_are_dealt_over_as_many_tasks_as_rows_need(spark, monkeypatch):
    monkeypatch.setattr(T, "TASK_ROWS", 2)
    d = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (2, 2), (2, 3), (None, 1), (3, None), (3, 1)] + [(9, 9)] * 3, "p long, e long")
    got = R.cooccurrences(d, "p", "e")
    assert sorted(tuple(x) for x in got.collect()) == [(1, 2, 2), (1, 3, 1), (2, 3, 1)]
    assert ", 6), REPARTITION_BY_NUM" in _plan(got)


def test_evidence_of_a_group_is_ordered_once(spark):
    d = spark.createDataFrame([(1, [("b", None, 2)]), (1, [("a", "x", 3), ("b", None, 1)]), (1, [("a", "x", 2), ("b", "y", 5)]), (2, [])], "g long, e array<struct<s:string,p:string,c:int>>")
    got = d.groupBy("g").agg(R.united_evidence("e", ["s", "p"]).alias("e"))
    assert {x.g: [tuple(y) for y in x.e] for x in got.collect()} == {1: [("a", "x", 2), ("b", None, 1), ("b", "y", 5)], 2: []}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("array_sort(") == 1


def test_coverage_meets_in_one_grouping(spark, monkeypatch):
    monkeypatch.setattr(T, "TASK_ROWS", 2)
    frame = lambda rows: spark.createDataFrame(rows, "k long, i long")
    whole, parts = frame([(1, 1), (1, 1), (1, 2), (1, 3), (None, 1)]), frame([(1, 1), (1, 3), (1, 3), (2, 1), (2, 1), (None, 1)])
    got = V.partition_coverage(parts, whole, "k", "i", 20)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 2, "missing"), (1, 3, "overlap"), (2, 1, "unknown"), (None, 1, "missing"), (None, 1, "unknown")], key=str)
    assert "Join" not in _plan(got) and ", 10), REPARTITION_BY_NUM" in _plan(got)


def test_sets_are_moved_to_their_entity_and_to_their_class_alone(spark, monkeypatch):
    plans, kept = [], O.kept
    monkeypatch.setattr(O, "kept", lambda d: plans.append(_plan(d)) or kept(d))
    d = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (3, 1), (3, 2), (4, None), (None, 1)], "e long, i long")
    pairs, ma, mb = O.scores_above(d, d, "e", "e", "i", 70_000)
    assert sorted((x.a, x.b, x.shared, x.members_a, x.members_b) for x in pairs.collect()) == [(1, 1, 2, 2, 2), (2, 1, 1, 1, 2), (2, 2, 1, 1, 1)]
    assert sorted((x.e, x.cls, x.n) for x in ma.collect()) == [(1, 1, 2), (2, 2, 1), (3, 1, 2)]
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 2, 2]  # items' places, and each side's classes


def test_paths_are_moved_as_numbers(spark, monkeypatch):
    plans, kept = [], G.kept
    monkeypatch.setattr(G, "kept", lambda d: plans.append(_plan(d)) or kept(d))
    r = random.Random(4)
    rows = [(f"a{r.randint(0, 9)}", f"b{r.randint(0, 9)}") for _ in range(26)] + [("b0", "b0"), ("a0", "b0"), ("b1", None)]
    e = G.each_way(spark.createDataFrame([(a, b, x) for a, b in rows for x in ("y", "x!", "x")], "a string, b string, id string"), "a", "b", "id")
    start = spark.createDataFrame([("a0",), ("b0",)], "node string")
    key = lambda d: sorted((x.src, x.dst, tuple(x.ids), tuple(x.steps), x.delta, x.length) for x in d.collect())
    want = key(G.canonical_paths(e, sources=start.withColumnRenamed("node", "src")))
    plans.clear()
    for front in (0, G.FRONT):
        monkeypatch.setattr(G, "FRONT", front)
        assert key(G.paths_from(e, start)) == want and want[-1]
    assert not any("min(struct(ids" in p for p in plans) and any("ordinal" in p for p in plans)


def test_meetings_are_dealt_over_as_many_tasks_as_pairs_need(spark, monkeypatch):
    monkeypatch.setattr(T, "TASK_ROWS", 2)
    rows = [("x", 1), ("x", 2), ("x", 2), ("y", 1), ("y", 2), ("z", 2), ("z", 3), ("w", 4), (None, 1), ("w", None)] + [("hot", e) for e in (1, 2, 4)]
    d = spark.createDataFrame(rows, "i string, e long")
    for counted, want in ((False, [(1, 2, "hot"), (1, 2, "x"), (1, 2, "y"), (2, 3, "z")]), (True, [(1, 2, 3), (2, 3, 1)])):
        got, heavy = (O.counted_meetings if counted else O.meetings)(d, "i", "e", 2)
        assert sorted(map(tuple, got.collect())) == want
        assert sorted(map(tuple, heavy.select("i", "e", "n").collect())) == [("hot", e, 3) for e in (1, 2, 4)]
    d = spark.range(20).select((F.col("id") % 2).cast("string").alias("i"), (F.col("id") + 1).alias("e"))
    got, _ = O.counted_meetings(d, "i", "e", 10)
    assert got.count() == 90 and ", 45), REPARTITION_BY_NUM" in _plan(got)


def test_a_path_is_moved_once_for_all_leaves_of_its_end(spark, tmp_path, monkeypatch):
    moved, dealt = [], G._dealt
    monkeypatch.setattr(G, "_dealt", lambda left, right, keys: moved.append((left.count(), right.count())) or dealt(left, right, keys))
    pairs = [("a", "b")] + [(f"{at}{i:02}", at) for at in "ab" for i in range(20)]
    e = G.each_way(spark.createDataFrame([(x, y, f"{x}-{y}") for x, y in pairs + pairs[:5]], "a string, b string, id string"), "a", "b", "id")
    got = G.all_canonical_paths(e, str(tmp_path / "paths")).collect()
    near = {}
    for x, y in pairs:
        near.setdefault(x, []).append(y), near.setdefault(y, []).append(x)

    def paths(ids):
        yield ids
        for y in near[ids[-1]] if len(ids) < 5 else ():
            if y not in ids:
                yield from paths((*ids, y))

    step = lambda x, y: f"{x}-{y}:{x}->{y}" if (x, y) in pairs else f"{y}-{x}:{x}->{y}"
    want = sorted((p, tuple(map(step, p, p[1:]))) for x in near for p in paths((x,)) if len(p) > 1)  # a tree: one path for each pair
    assert sorted((tuple(p.ids), tuple(p.steps)) for p in got) == want and len(want) == 42 * 41
    assert moved == [(4, 2)]  # lists of a and b to each of the two, not a row for each leaf


def test_counted_meetings_move_a_pair_once(spark, monkeypatch):
    r = random.Random(6)
    rows = [(f"i{r.randint(0, 60)}", r.randint(0, 14)) for _ in range(120)] + [(h, e) for h in ("h1", "h2") for e in range(12) if r.random() < 0.8] * 2 + [("same", 3)] * 9
    d = spark.createDataFrame(rows + [(None, 1), ("i1", None)], "i string, e long")
    of = {}
    for i, e in rows:
        of.setdefault(i, set()).add(e)
    met = {(a, b) for es in of.values() if len(es) <= 4 for a in es for b in es if a < b}
    want = sorted((a, b, sum({a, b} <= es for es in of.values())) for a, b in met)
    hot = sorted((i, e, len(es)) for i, es in of.items() if len(es) > 4 for e in es)
    for sent, wide in ((O.SENT, O.WIDE), (O.SENT, 0), (0, 0)):
        monkeypatch.setattr(O, "SENT", sent), monkeypatch.setattr(O, "WIDE", wide)
        got, heavy = O.counted_meetings(d, "i", "e", 4)
        if sent:  # not once more for its heavy items
            assert len(re.findall(r"hashpartitioning\(a#\d+L?", _plan(got))) == 1
        assert sorted(map(tuple, got.collect())) == want and sorted(map(tuple, heavy.select("i", "e", "n").collect())) == hot
