"""Nested ids, fingerprints that follow changes, tables that change together, numbers in one shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from weft.operators import fingerprints as P
from weft.operators import mutation as M
from weft.operators import nested as N
from weft.operators import relational as R
from weft.sources import snapshots as V


def walk(value, parts, fn):
    """The same walk by hand."""
    if isinstance(value, list):
        return [walk(x, parts, fn) for x in value]
    if value is None:
        return None
    if not parts:
        return fn(value)
    return {**value, parts[0]: walk(value[parts[0]], parts[1:], fn)}


def test_ids_are_replaced_at_any_depth(spark):
    r = random.Random(1)
    ids = [f"old-{i}" for i in range(30)] + ["other", None]
    pick = lambda: r.choice(ids)
    rows = [
        {"k": i, "a.b": pick(), "s": r.choice([None, {"id": pick(), "n": i}]), "many": r.choice([None, [], [None, {"inner": {"ids": r.choice([None, [pick(), pick()]])}, "id": pick()}, {"inner": None, "id": pick()}]]), "nest": [[{"id": pick()}], None, []]}
        for i in range(80)
    ]
    kind = "k int, `a.b` string, s struct<id: string, n: int>, many array<struct<inner: struct<ids: array<string>>, id: string>>, nest array<array<struct<id: string>>>"
    df = spark.createDataFrame(rows, kind)
    to = {f"old-{i}": f"new-{i}" for i in range(0, 30, 2)}
    mapping = spark.createDataFrame([*to.items(), *list(to.items())[:3], ("old-1", None)], "old string, new string")
    paths = [["a.b"], "s.id", "many.inner.ids", "many.id", "nest.id"]
    want = {}
    for row in rows:
        out = dict(row)
        for p in paths:
            top, *rest = p if isinstance(p, list) else p.split(".")
            out[top] = walk(out[top], rest, lambda v: to.get(v, v))
        want[row["k"]] = out
    got = {x.k: x.asDict(recursive=True) for x in N.remapped(df, mapping, "k", paths).collect()}
    assert got == want
    left, seen = {(x.k, x.path, x.value) for x in N.unmapped(df, mapping, "k", paths, "^old-").collect()}, set()
    for row in rows:
        for p in paths:
            top, *rest = p if isinstance(p, list) else p.split(".")
            walk(row[top], rest, lambda v: seen.add((row["k"], ".".join([top, *rest]), v)))
    assert left == {x for x in seen if x[2].startswith("old-") and x[2] not in {*to, "old-1"}} and len(left) > 50
    with pytest.raises(ValueError, match="becomes both"):
        N.remapped(df, spark.createDataFrame([("x", "y"), ("x", "z")], "old string, new string"), "k", ["s.id"])
    with pytest.raises(ValueError, match="no field"):
        N.remapped(df, mapping, "k", ["s.nothing"])
    assert N.remapped(df.limit(0), mapping, "k", paths).count() == 0 and N.remapped(df, mapping.limit(0), "k", paths).count() == 80


def test_former_ids(spark):
    df = spark.createDataFrame([(["a", " ", "a", "old-1"], "old-2"), (None, " old-3 "), (["old-4"], "old-4"), (["x"], "new-1"), (None, None)], "former array<string>, id string")
    assert [r.f for r in df.select(N.former_ids(F.col("former"), F.col("id"), "^old-").alias("f")).collect()] == [["a", "old-1", "old-2"], ["old-3"], ["old-4"], ["x"], []]
    assert {(r.id, r.n) for r in N.repeated_ids(df, "id", "former", "^old-").collect()} == {("old-4", 2)}


def test_states_add_and_subtract(spark):
    r = random.Random(2)
    rows = [(r.choice("ab"), r.choice(["x", None, "", "y\u001fz", "y"]), r.choice([1, 2, None])) for _ in range(300)]
    df = lambda some: spark.createDataFrame(some, "part string, x string, y int")
    state = lambda some: P.state(df(some), ["x", "y"], ["part"])
    old, new = rows[:200], rows[50:]
    got = P.changed(state(old), ["part"], state(rows[200:]), state(rows[:50]))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, state(r.sample(new, len(new))).repartition(7).collect()))
    assert P.total(got).first() == P.total(P.state(df(new), ["x", "y"], ["y"]).drop("y").withColumn("part", F.monotonically_increasing_id())).first()
    assert P.total(state(rows)).first() != P.total(state(rows[1:])).first() != P.total(state([*rows[1:], rows[1]])).first()
    assert P.total(state(rows[:0])).first().n_rows == 0 and P.changed(state(rows), ["part"], taken=state(rows)).count() == 0
    with pytest.raises(Exception, match="did not have"):
        P.changed(state([("a", "x", 1)]), ["part"], taken=state([("a", "x", 2)])).collect()
    assert {(d.part, d.fault) for d in P.drifted(state([("a", "x", 1), ("b", "x", 1), ("d", "x", 1)]), state([("a", "x", 2), ("c", "x", 1), ("d", "x", 1)]), ["part"]).collect()} == {("a", "changed"), ("b", "missing"), ("c", "new")}


def test_different_rows_have_different_signatures(spark):
    rows = [("a\u001fb", "c"), ("a", "b\u001fc"), ("a\\sb", "c"), ("a\\", "sb\u001fc"), (None, "x"), ("", "x"), ("\u0000", "x"), ("\\0", "x"), ("\\\\0", "x")]
    got = spark.createDataFrame(rows, "a string, b string").select(M.row_signature("a", "b").alias("s")).collect()
    assert len({r.s for r in got}) == len(rows)


def test_tables_change_together_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "store")
    one = lambda *xs: spark.createDataFrame([(x,) for x in xs], "x int")
    rows = lambda name, version=None: sorted(r.x for r in V.read(spark, root, name, version).collect())
    assert V.manifest(spark, root) == (0, {}) and V.commit(spark, root, {"a": one(1), "b": one(2)}) == 1
    with pytest.raises(Exception, match="no"):
        V.commit(spark, root, {"a": one(5), "b": one(6).select(F.raise_error(F.lit("no")).cast("int").alias("x"))})
    assert V.versions(spark, root) == [1] and (rows("a"), rows("b")) == ([1], [2])
    # the rows come from the tables themselves
    assert V.apply(spark, root, lambda now: {"a": now["a"].union(now["b"]), "b": now["a"]}) == {"a": 1, "b": 2}
    assert (rows("a"), rows("b"), rows("a", 1)) == ([1, 2], [1], [1])
    assert V.apply(spark, root, lambda now: {"a": now["a"]}) == {"a": 0} and V.versions(spark, root) == [1, 2]
    assert V.apply(spark, root, lambda now: {"a": one()}, "dry-run") == {"a": 2} and rows("a") == [1, 2]
    with pytest.raises(ValueError, match="not applied"):
        V.apply(spark, root, lambda now: {"a": one()}, "check")
    with pytest.raises(V.Conflict):
        V.commit(spark, root, {"a": one(9)}, base=1)
    with pytest.raises(V.Conflict):
        V.put(spark, root, 2, {})
    V._fs(spark, root)[0].create(V._fs(spark, f"{root}/_manifests/{3:010}.claim")[1]).close()  # another commit is at work
    with pytest.raises(V.Conflict):
        V.commit(spark, root, {"a": one(9)})
    V._fs(spark, root)[0].delete(V._fs(spark, f"{root}/_manifests/{3:010}.claim")[1], False)
    assert V.commit(spark, root, {"c": one(7)}, dropped=["b"]) == 3
    with pytest.raises(ValueError, match="no table"):
        V.read(spark, root, "b")
    assert V.vacuum(spark, root, 1) == [3] and rows("a") == [1, 2] and rows("c") == [7]
    with pytest.raises(ValueError, match="no version"):
        rows("a", 1)


def test_numbers_of_a_skewed_table(spark):
    r = random.Random(3)
    rows = [(1 if r.random() < 0.7 else r.randint(0, 9), r.randint(0, 3)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int")
    got = R.numbered(df.repartition(5), ["a"], 10).collect()
    assert sorted(x.ordinal for x in got) == list(range(11, 3011)) and [x.a for x in sorted(got, key=lambda x: x.ordinal)] == sorted(a for a, _ in rows)
    # the same numbers however the rows come
    again = R.numbered(df.orderBy("b"), ["a"], 10).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert R.numbered(df.limit(0), ["a"]).count() == 0
    plan = R.numbered(df, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_part" not in plan.split("BroadcastExchange")[0]  # rows are not shuffled again


def test_texts_reach_python_a_few_at_a_time(spark):
    """What Python holds of the texts is bounded by rows a batch, however many rows a partition has."""
    from weft.functions import text as X

    df = spark.createDataFrame([("Été  ‍A-b",), (None,), ("",), ("ﬁx́",)], "t string").select(X.folded(F.col("t")).alias("f"))
    assert [r.f for r in df.collect()] == ["ete a b", None, "", "fix"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
