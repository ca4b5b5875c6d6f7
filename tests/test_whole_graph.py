"""Queries over all lines, against brute force."""

import random

import pytest

from tests.test_operators import brute_paths
from weft import registry
from weft.operators import graph as G
from weft.plans import graph as P


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    r = random.Random(5)
    rows = [(r.randint(1, 5), r.randint(1, 7)) for _ in range(16)] + [(1, 1), (8, 9)]
    at = str(tmp_path_factory.mktemp("lines"))
    spark.createDataFrame(rows + rows[:4], "l_suppkey long, l_partkey long").write.parquet(f"{at}/lineitem.parquet")
    return at, sorted({(f"s{s:07}", f"p{p:07}") for s, p in rows})


def test_component_has_all_lines(spark, lines):
    at, edges = lines
    want = {"p0000001"}
    while more := {x for e in edges if want & set(e) for x in e} - want:
        want |= more
    assert {x.node for x in registry.QUERIES["component_of_focus"](spark, at).collect()} == want


def test_contexts_of_all_pairs(spark, lines):
    at, edges = lines
    got = sorted(tuple(x) for x in registry.QUERIES["shared_parts"](spark, at).collect())
    want = []
    for a, b in sorted({(x, y) for x, _ in edges for y, _ in edges if x < y}):
        both = sorted({p for s, p in edges if s == a} & {p for s, p in edges if s == b})[:5]
        want += [(a, b, p, i + 1) for i, p in enumerate(both)]
    assert got == want and want


def test_paths_run_over_all_lines(spark, lines, monkeypatch):
    at, edges = lines
    both = [(a, b, f"{a}-{b}") for a, b in edges] + [(b, a, f"{a}-{b}") for a, b in edges]
    want = {k: (v[0], ">".join(v[1])) for k, v in brute_paths(both, 4).items() if k[0] in P.SOURCES}
    got = {(x.src, x.dst): (x.length, x.ids) for x in registry.QUERIES["paths_2_to_4"](spark, at).collect()}
    assert got == want and want
    # the invariants see the same paths
    monkeypatch.setattr(G, "path_faults", lambda paths: paths.select("src", "dst"))
    assert {tuple(x) for x in registry.QUERIES["path_invariants"](spark, at).collect()} == set(want)


def test_neighbours_over_any_flag_and_quantity(spark, tmp_path):
    rows = [(1, 1, "N", 3), (2, 1, "A", 50), (1, 2, "R", 46), (3, 2, "R", 2), (4, 3, "R", 50)]
    lines = spark.createDataFrame([(i, 1, s, p, f, "O", float(q)) for i, (s, p, f, q) in enumerate(rows)], "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_returnflag string, l_linestatus string, l_quantity double")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {tuple(x) for x in registry.QUERIES["two_hop_neighbourhood"](spark, str(tmp_path)).collect()}
    assert got == {("s1", "p1"), ("s2", "p1"), ("s1", "p2"), ("s3", "p2")}
