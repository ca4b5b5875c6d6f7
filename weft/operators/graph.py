"""Paths, neighbourhoods, components and views of an entity graph, as joins level by level."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.operators.inference import _dealt, _in_pieces, grandparents, siblings
from weft.operators.relational import numbered
from weft.operators.validation import faults
from weft.sources.tables import in_tasks, kept


def both_ways(edges: DataFrame, a: str, b: str, edge_id: str) -> DataFrame:
    """(src, dst, edge_id, way): each edge forward and in reverse, once for each (src, dst, edge_id)."""
    return each_way(edges, a, b, edge_id).dropDuplicates(["src", "dst", "edge_id"])


def each_way(edges: DataFrame, a: str, b: str, edge_id: str) -> DataFrame:
    """``both_ways`` with edges as often as they are given."""
    f = edges.select(F.col(a).alias("src"), F.col(b).alias("dst"), F.col(edge_id).alias("edge_id"), F.lit(1).alias("way"))
    r = edges.select(F.col(b).alias("src"), F.col(a).alias("dst"), F.col(edge_id).alias("edge_id"), F.lit(-1).alias("way"))
    return f.unionByName(r)


def without_edges(edges: DataFrame, excluded: Column) -> DataFrame:
    """Edges of which no path is made go: those of an excluded class, as inferred kinship that paths explain."""
    return edges.filter(~F.coalesce(excluded, F.lit(False)))


def with_passages(edges: DataFrame, evidence: DataFrame, most: int = 3) -> DataFrame:
    """Adds ``passages``, an edge's first ones by (edge_id, pos, passage); blank ones do not count. Ranks are cut before they are gathered."""
    w = Window.partitionBy("edge_id").orderBy("pos", "passage")
    some = evidence.filter(F.trim("passage") != "").withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= most)
    lists = some.groupBy("edge_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("_rn", "passage"))), lambda x: x["passage"]).alias("passages"))
    return edges.join(lists, "edge_id", "left").withColumn("passages", F.coalesce("passages", F.array().cast("array<string>")))


def path_states(paths: DataFrame, edges: DataFrame, key: str = "id") -> DataFrame:
    """(key, n, statuses, inferred, all_inferred): how many of a path's edges are in each status.

    ``paths`` has ``edge_ids``, ``edges`` edge_id, status and inferred. ``statuses`` are sorted (status, n).
    """
    steps = paths.select(key, F.explode("edge_ids").alias("edge_id")).join(edges.select("edge_id", F.coalesce("status", F.lit("")).alias("status"), F.coalesce("inferred", F.lit(False)).alias("inferred")), "edge_id")
    by = steps.groupBy(key, "status").agg(F.count("*").alias("n"), F.count_if("inferred").alias("i"))
    one = by.groupBy(key).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("status", "n"))).alias("statuses"), F.sum("i").alias("inferred"))
    return one.withColumn("all_inferred", F.col("inferred") == F.col("n"))


def canonical_paths(edges: DataFrame, depth: int = 4, pairs: DataFrame | None = None, sources: DataFrame | None = None) -> DataFrame:
    """(src, dst, ids, steps, delta, length): the canonical shortest path of every ordered pair within ``depth`` steps.

    Of equally short paths the least list of ids wins, then the least list of
    "edge:from->to". One path for each pair and level is carried on, as the
    least path's beginning is least too. ``edges`` is (src, dst, edge_id, way);
    ``delta`` sums the ways. With ``pairs`` (src, dst), only these are reported
    and only their sources start; with ``sources`` (src), only these start.
    """
    return _levels(kept(_least_steps(edges)), depth, pairs, sources)


def _least_steps(edges: DataFrame) -> DataFrame:
    """(src, dst, step, way): of edges from one node to another the least step."""
    step = F.concat(F.col("edge_id"), F.lit(":"), F.col("src"), F.lit("->"), F.col("dst"))
    one = edges.select("src", "dst", step.alias("step"), "way").groupBy("src", "dst").agg(F.min(F.struct("step", "way")).alias("s"))
    return one.select("src", "dst", "s.step", "s.way")


def _levels(one: DataFrame, depth: int, pairs: DataFrame | None = None, sources: DataFrame | None = None) -> DataFrame:
    """``canonical_paths`` over (src, dst, step, way), one row for each src and dst."""
    start = one if sources is None else one.join(sources.select("src").distinct(), "src", "left_semi")
    start = start if pairs is None else start.join(pairs.select("src").distinct(), "src", "left_semi")
    level = kept(_first_level(start))
    found = [level]
    nxt = _next_steps(one)
    wanted = pairs.select("src", "dst").distinct() if pairs is not None else None
    for d in range(2, depth + 1):
        if wanted is not None:  # sources whose pairs are all found go no further
            wanted = kept(wanted.join(level.select("src", "dst"), ["src", "dst"], "left_anti"))
            level = level.join(wanted.select("src").distinct(), "src", "left_semi")
            if d == depth:
                nxt = nxt.join(wanted.select(F.col("dst").alias("to")).distinct(), "to", "left_semi")
        least = _grown(level, nxt).groupBy("src", "dst").agg(F.min(F.struct("ids", "steps", "delta")).alias("p"))
        for before in found:
            least = least.join(before.select("src", "dst"), ["src", "dst"], "left_anti")
        level = kept(least.select("src", "dst", "p.*", F.lit(d).alias("length")))
        found.append(level)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out if pairs is None else out.join(pairs.select("src", "dst").distinct(), ["src", "dst"], "left_semi")


def _first_level(one: DataFrame) -> DataFrame:
    """Paths of one step of (src, dst, step, way)."""
    return one.filter("src <> dst").select("src", "dst", F.array("src", "dst").alias("ids"), F.array("step").alias("steps"), F.col("way").alias("delta"), F.lit(1).alias("length"))


def _next_steps(one: DataFrame) -> DataFrame:
    return one.select(F.col("src").alias("mid"), F.col("dst").alias("to"), F.col("step").alias("s"), F.col("way").alias("w"))


def _grown(level: DataFrame, nxt: DataFrame) -> DataFrame:
    """A level's paths with one step more, but for those that meet themselves."""
    grown = level.join(nxt, F.col("dst") == F.col("mid")).filter("to <> src AND NOT array_contains(ids, to)")
    return grown.select("src", F.col("to").alias("dst"), F.array_append("ids", F.col("to")).alias("ids"), F.array_append("steps", F.col("s")).alias("steps"), (F.col("delta") + F.col("w")).alias("delta"))


#: Nodes of a search's front up to which all tasks are sent it.
FRONT = 200_000


def _at_front(edges: DataFrame, front: DataFrame) -> DataFrame:
    """``edges`` that begin at nodes of a kept ``front`` (node). A front of few nodes goes to the edges, so none of the others is moved."""
    front = front.withColumnRenamed("node", "src")
    return edges.join(F.broadcast(front) if front.count() <= FRONT else front, "src", "left_semi")


def _sent(df: DataFrame) -> DataFrame:
    """A kept ``df`` that all tasks are sent, if it has as few rows as a front."""
    return F.broadcast(df) if df.count() <= FRONT else df


def paths_from(edges: DataFrame, start: DataFrame, depth: int = 4) -> DataFrame:
    """``canonical_paths`` from the nodes of ``start`` (node), for few of a large graph; ``edges`` may repeat.

    Each level reads the edges, and those that begin at its front meet its paths: what is moved grows with what the sources reach and not with
    the graph. A path is moved as its number in the order of its level's ids; nodes of a path are found before, so none is met again.
    """
    level = kept(_first_level(_least_steps(_at_front(edges, kept(start.select("node").distinct())))))
    found = [level]
    for d in range(2, depth + 1):
        order = numbered(level, ["ids"])
        front = kept(order.select(F.col("src").alias("from"), F.col("dst").alias("mid"), "ordinal"))
        met = edges.join(_sent(front), F.col("src") == F.col("mid")).filter("dst <> from")
        step = F.concat(F.col("edge_id"), F.lit(":"), F.col("mid"), F.lit("->"), F.col("dst"))
        grown = met.select(F.col("from").alias("src"), "dst", F.struct("ordinal", step.alias("step"), "way").alias("p"))
        unseen = lambda df: reduce(lambda x, f: x.join(_sent(f.select("src", "dst")), ["src", "dst"], "left_anti"), found, df)
        few = sum(f.count() for f in found) <= FRONT  # then what was found is dropped before it is moved
        least = (unseen(grown) if few else grown).groupBy("src", "dst").agg(F.min("p").alias("p")).select("src", "dst", "p.*")
        least = least if few else unseen(least)
        path = (F.array_append("ids", F.col("dst")).alias("ids"), F.array_append("steps", F.col("step")).alias("steps"), (F.col("delta") + F.col("way")).alias("delta"))
        level = kept(least.join(order.select("ordinal", "ids", "steps", "delta"), "ordinal").select("src", "dst", *path, F.lit(d).alias("length")))
        found.append(level)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def all_canonical_paths(edges: DataFrame, folder: str, depth: int = 4, block_rows: int = 50_000_000) -> DataFrame:
    """``canonical_paths`` from every node. A node with one neighbour is on no other's way: paths are searched between all other nodes, and such
    leaves hung on to their ends, each found once and never grouped.

    The search takes a block of sources at a time, each written below ``folder``; blocks that are there already are not run again. Sources are dealt
    into blocks by the paths of two steps that start from them, about ``block_rows`` a block and no fewer than there are edges, so a block's levels
    have a bounded size, and reading the graph for each costs no more than its paths. The blocks' number is written beside them: a run that is
    taken up deals them as before.
    """
    from weft.sources.tables import done, scratch_scope

    spark = edges.sparkSession
    joined = kept(_leaves_told(edges.filter("src <> dst")))
    core = kept(_each_step(joined.filter("leaf IS NULL")))
    plan = f"{folder.rstrip('/')}/plan"
    if not done(spark, plan):
        out = core.groupBy("src").agg(F.count("*").alias("n"))
        wedges = core.select(F.col("src").alias("_s"), F.col("dst").alias("src")).join(out, "src").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        rows = F.lit(max(block_rows, core.count()))
        wedges.select(F.greatest(F.ceil(F.col("n") / rows), F.lit(1)).cast("int").alias("blocks")).write.mode("overwrite").parquet(plan)
    blocks = spark.read.parquet(plan).first().blocks
    sources = core.select("src").distinct().withColumn("block", F.pmod(F.xxhash64("src"), F.lit(blocks)))
    at = [f"{folder.rstrip('/')}/paths-{k}" for k in range(blocks)]
    for k, path in enumerate(at):
        if not done(spark, path):
            with scratch_scope():  # a block's levels go when its paths are written
                _levels(core, depth, sources=sources.filter(F.col("block") == k).select("src")).write.mode("overwrite").parquet(path)
    return _hung(spark.read.parquet(*at), core, joined.filter("leaf IS NOT NULL"), depth)


def _leaves_told(edges: DataFrame) -> DataFrame:
    """(lo, hi, there, back, leaf): a row for each two nodes that are joined, the least edge (edge_id, way) each way, null for none, and which of
    the two is a leaf: it has no other neighbour, and the other has.

    Edges are moved to their two nodes, and these once more without them to find the leaves; steps are spelt out where they are read.
    """
    src, dst = F.col("src"), F.col("dst")
    ends = edges.select(F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi"), (src < dst).alias("ahead"), "edge_id", "way")
    rows = edges.count()
    step = lambda a, b: F.concat(F.col("edge_id"), F.lit(":"), F.col(a), F.lit("->"), F.col(b)).alias("step")
    least = lambda when, a, b: F.min(F.when(when, F.struct(step(a, b), "way", "edge_id")))
    both = in_tasks(ends, rows, "lo", "hi").groupBy("lo", "hi").agg(least(F.col("ahead"), "lo", "hi").alias("there"), least(~F.col("ahead"), "hi", "lo").alias("back"))
    edge = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.edge_id").alias("edge_id"), F.col(f"{c}.way").alias("way"))).alias(c)
    both = both.select("lo", "hi", edge("there"), edge("back"))
    near = in_tasks(ends.select("lo", "hi"), rows, "lo", "hi").distinct()
    near = near.select(F.explode(F.array(F.struct(F.col("lo").alias("node"), F.col("hi").alias("at")), F.struct(F.col("hi").alias("node"), F.col("lo").alias("at")))).alias("x")).select("x.*")
    degree = kept(near.groupBy("node").agg(F.min("at").alias("at"), F.max("at").alias("last")))
    inner = degree.filter("at <> last").select(F.col("node").alias("at"))
    leaves = degree.filter("at = last").join(inner, "at", "left_semi")
    return both.join(leaves.select(F.least("node", "at").alias("lo"), F.greatest("node", "at").alias("hi"), F.col("node").alias("leaf")), ["lo", "hi"], "left")


def _each_step(joined: DataFrame) -> DataFrame:
    """(src, dst, step, way) of nodes that are joined (lo, hi, there, back)."""
    way = lambda a, b, c: joined.filter(F.col(c).isNotNull()).select(F.col(a).alias("src"), F.col(b).alias("dst"), f"{c}.*")
    step = F.concat(F.col("edge_id"), F.lit(":"), F.col("src"), F.lit("->"), F.col("dst"))
    return way("lo", "hi", "there").unionByName(way("hi", "lo", "back")).select("src", "dst", step.alias("step"), "way")


def _hung(paths: DataFrame, core: DataFrame, joined: DataFrame, depth: int) -> DataFrame:
    """``paths`` between the nodes of ``core`` and those that leaves hang on to, and the paths that begin or end at such a leaf, as ``joined`` tells.

    A node's leaves are moved as lists of up to about ``PIECE``, so a path between nodes is moved once for a list and not for each leaf; a node of
    very many leaves has several lists, and its paths are made by many tasks.
    """
    low = F.col("leaf") == F.col("lo")
    hairs = joined.select(F.when(low, F.col("hi")).otherwise(F.col("lo")).alias("at"), F.col("leaf").alias("node"), F.when(low, F.col("there")).otherwise(F.col("back")).alias("up"), F.when(low, F.col("back")).otherwise(F.col("there")).alias("down"), F.lit(1).alias("l"))
    nodes = core.select(F.col("src").alias("at")).unionByName(core.select(F.col("dst").alias("at"))).unionByName(hairs.select("at")).distinct()
    edge = joined.schema["there"].dataType
    own = nodes.select("at", F.col("at").alias("node"), F.lit(None).cast(edge).alias("up"), F.lit(None).cast(edge).alias("down"), F.lit(0).alias("l"))
    some = lambda c: F.collect_list(F.when((F.col("l") == 0) | F.col(c).isNotNull(), F.struct("node", "l", F.col(c).alias("edge")))).alias(c)
    lists = kept(_in_pieces(hairs.unionByName(own), "at", "node").groupBy("at", "pieces", "piece").agg(some("up"), some("down")))
    bare = nodes.select(F.col("at").alias("src"), F.col("at").alias("dst"), F.array("at").alias("ids"), F.array().cast("array<string>").alias("steps"), F.lit(0).alias("delta"), F.lit(0).alias("length"))
    between = paths.select("src", "dst", "ids", "steps", "delta", "length").unionByName(bare)
    between = between.join(lists.select(F.col("at").alias("dst"), "pieces").distinct(), "dst").withColumnsRenamed({"src": "_a", "dst": "_b"})
    begun = lists.select(F.col("at").alias("_a"), "up").join(between, "_a").withColumn("up", F.filter("up", lambda x: x["l"] + F.col("length") <= depth)).filter(F.size("up") > 0)
    begun = begun.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    out = _dealt(begun, lists.select(F.col("at").alias("_b"), "piece", "down"), ["_b", "piece"])
    out = out.withColumn("x", F.explode("up")).withColumn("y", F.explode("down")).filter("x.node <> y.node").withColumn("n", F.col("x.l") + F.col("length") + F.col("y.l")).filter(F.col("n").between(1, depth))
    none = F.array().cast("array<string>")
    on = lambda e, c: F.when(F.col(f"{e}.l") == 1, F.array(c)).otherwise(none)
    step = lambda e, a, b: F.concat(F.col(f"{e}.edge.edge_id"), F.lit(":"), F.col(a), F.lit("->"), F.col(b))
    way = lambda e: F.when(F.col(f"{e}.l") == 1, F.col(f"{e}.edge.way")).otherwise(0)
    ids = F.concat(on("x", F.col("x.node")), "ids", on("y", F.col("y.node")))
    steps = F.concat(on("x", step("x", "x.node", "_a")), "steps", on("y", step("y", "_b", "y.node")))
    return out.select(F.col("x.node").alias("src"), F.col("y.node").alias("dst"), ids.alias("ids"), steps.alias("steps"), (way("x") + F.col("delta") + way("y")).alias("delta"), F.col("n").alias("length"))


def _least_three(half: DataFrame, end: str, via: str) -> DataFrame:
    """Of the half-paths between an end and a node the three that go by the least nodes: of these, a pair's other nodes rule out two at most."""
    w = Window.partitionBy(end, "at").orderBy(via)
    return half.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 3").drop("_rn", via)


def _met(pairs: DataFrame, ahead: DataFrame, back: DataFrame) -> DataFrame:
    """Half-paths of a pair that meet at a node; each pair's are looked up from the end that has fewer."""
    size = lambda half, end: half.groupBy(end).agg(F.count("*").alias(f"_{end}"))
    sized = pairs.join(size(ahead, "src"), "src").join(size(back, "dst"), "dst")
    from_src = sized.filter("_src <= _dst").join(ahead, "src").join(back, ["dst", "at"])
    from_dst = sized.filter("_src > _dst").join(back, "dst").join(ahead, ["src", "at"])
    ids = F.concat(F.array("src"), "by_a", F.array("at"), "by_b", F.array("dst"))
    both = from_src.unionByName(from_dst).select("src", "dst", ids.alias("ids"), F.concat("steps_a", "steps_b").alias("steps"), (F.col("way_a") + F.col("way_b")).alias("delta"))
    return both.filter(F.size(F.array_distinct("ids")) == F.size("ids")).groupBy("src", "dst").agg(F.min(F.struct("ids", "steps", "delta")).alias("p")).select("src", "dst", "p.*")


def explanation_paths(edges: DataFrame, pairs: DataFrame, depth: int = 4) -> DataFrame:
    """Paths of 2 to ``depth`` (4 at most) steps that explain given pairs; a direct edge of the same pair is not one of their steps.

    The direct edge is skipped for its own pair alone: other pairs may run over it. The search starts from both ends and meets in the middle:
    one or two steps from each source and to each goal, whatever pairs they are in, so what is kept is a row an end and node, not a pair and node.
    """
    if not 2 <= depth <= 4:
        raise ValueError("depth must be 2 to 4: halves have two steps at most")
    step = F.concat(F.col("edge_id"), F.lit(":"), F.col("src"), F.lit("->"), F.col("dst"))
    one = edges.filter("src <> dst").select("src", "dst", step.alias("step"), "way").groupBy("src", "dst").agg(F.min(F.struct("step", "way")).alias("s"))
    one = kept(one.select("src", "dst", "s.step", "s.way"))
    todo, found = kept(pairs.select("src", "dst").filter("src <> dst").distinct()), []
    none = F.array().cast("array<string>")
    for d in range(2, depth + 1):
        starts, goals = todo.select("src").distinct(), todo.select("dst").distinct()
        ahead, back = one.join(starts, "src", "left_semi"), one.join(goals, "dst", "left_semi")
        if d == 2:
            first = ahead.select("src", F.col("dst").alias("at"), none.alias("by_a"), F.array("step").alias("steps_a"), F.col("way").alias("way_a"))
        else:
            on = one.select(F.col("src").alias("mid"), F.col("dst").alias("at"), F.col("step").alias("s2"), F.col("way").alias("w2"))
            grown = ahead.withColumnRenamed("dst", "mid").join(on, "mid").filter("at <> src")
            first = grown.select("src", "at", "mid", F.array("mid").alias("by_a"), F.array("step", "s2").alias("steps_a"), (F.col("way") + F.col("w2")).alias("way_a"))
            first = _least_three(first, "src", "mid")
        if d < 4:
            last = back.select("dst", F.col("src").alias("at"), none.alias("by_b"), F.array("step").alias("steps_b"), F.col("way").alias("way_b"))
        else:
            on = one.select(F.col("dst").alias("mid"), F.col("src").alias("at"), F.col("step").alias("s1"), F.col("way").alias("w1"))
            grown = back.withColumnRenamed("src", "mid").join(on, "mid").filter("at <> dst")
            last = grown.select("dst", "at", "mid", F.array("mid").alias("by_b"), F.array("s1", "step").alias("steps_b"), (F.col("way") + F.col("w1")).alias("way_b"))
            last = _least_three(last, "dst", "mid")
        hit = kept(_met(todo, kept(first), kept(last)).withColumn("length", F.lit(d)))
        found.append(hit)
        if d < depth:
            todo = kept(todo.join(hit.select("src", "dst"), ["src", "dst"], "left_anti"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def kin_paths(parents: DataFrame, depth: int = 4) -> DataFrame:
    """``explanation_paths`` of the siblings (the lesser first) and grandparents of ``parents`` (parent, child, edge_id).

    Two siblings of which one is a leaf, in one row alone, have one path, by their parent: it is told as they meet, in pieces of a family, and
    never grouped. Other pairs are looked up.
    """
    rows = parents.select("parent", "child", "edge_id")
    edges = both_ways(rows, "parent", "child", "edge_id")
    one = kept(_least_steps(edges.filter("src <> dst")))
    leaf = rows.select(F.explode(F.array("parent", "child")).alias("child")).groupBy("child").agg(F.count("*").alias("n")).filter("n = 1").select("child", F.lit(True).alias("leaf"))
    kids = rows.select("parent", "child").distinct().join(leaf, "child", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False)))
    for name, src, dst in (("up", "child", "parent"), ("down", "parent", "child")):
        kids = kids.join(one.select(F.col("src").alias(src), F.col("dst").alias(dst), F.struct("step", "way").alias(name)), ["parent", "child"])
    kids = kept(_in_pieces(kids))
    a = kids.select("parent", "piece", F.col("child").alias("src"), F.col("leaf").alias("leaf_a"), "up")
    b = kids.select("parent", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.col("child").alias("dst"), F.col("leaf").alias("leaf_b"), "down")
    met = _dealt(a, b, ["parent", "piece"]).filter("src < dst AND (leaf_a OR leaf_b)")
    once = met.select("src", "dst", F.array("src", "parent", "dst").alias("ids"), F.array("up.step", "down.step").alias("steps"), (F.col("up.way") + F.col("down.way")).alias("delta"), F.lit(2).alias("length"))
    rest = siblings(rows.join(leaf, "child", "left_anti")).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    old = grandparents(rows).select(F.col("elder").alias("src"), F.col("younger").alias("dst"))
    own = lambda end: kids.select("parent", F.col("child").alias(end), F.col("leaf").alias(f"leaf_{end}"))
    told = old.join(own("src"), "src").join(own("dst"), ["parent", "dst"]).filter("src < dst AND (leaf_src OR leaf_dst)").select("src", "dst")
    rest = rest.unionByName(old.join(told, ["src", "dst"], "left_anti"))
    return once.unionByName(explanation_paths(edges, rest, depth))


def lineal_paths(edges: DataFrame) -> DataFrame:
    """The canonical paths of two steps that go one way, up or down: of all such paths of ``canonical_paths(edges, 2)`` those whose ``delta`` is not 0.

    Only pairs with a path of two equal ways can have one, so pairs that meet over a common neighbour alone are never made.
    """
    one = edges.select("src", "dst", "way").distinct()
    on = one.select(F.col("src").alias("mid"), F.col("dst").alias("to"), "way")
    pairs = one.withColumnRenamed("dst", "mid").join(on, ["mid", "way"]).filter("src <> to").select("src", F.col("to").alias("dst")).distinct()
    pairs = kept(pairs.join(one.select("src", "dst"), ["src", "dst"], "left_anti"))
    return explanation_paths(edges, pairs, 2).filter("delta <> 0")


def paths_of_ends(edges: DataFrame, chosen: Column) -> DataFrame:
    """The canonical paths of two steps of which either end is ``chosen``, a condition on ``node``: all such of ``canonical_paths(edges, 2)``.

    A path is grown from its chosen end, forward or back, so pairs of which neither end is chosen are never made.
    """
    one = kept(_least_steps(edges.filter("src <> dst")))
    nodes = one.select(F.explode(F.array("src", "dst")).alias("node")).distinct().filter(chosen)
    at = lambda end: nodes.withColumnRenamed("node", end)
    near = one.select(F.col("src").alias("a"), F.col("dst").alias("mid"), F.col("step").alias("s1"), F.col("way").alias("w1"))
    on = one.select(F.col("src").alias("mid"), F.col("dst").alias("b"), F.col("step").alias("s2"), F.col("way").alias("w2"))
    ahead = near.join(at("a"), "a", "left_semi").join(on, "mid")
    back = near.join(on.join(at("b"), "b", "left_semi"), "mid").join(at("a"), "a", "left_anti")
    both = ahead.select("a", "b", "mid", "s1", "s2", "w1", "w2").unionByName(back.select("a", "b", "mid", "s1", "s2", "w1", "w2")).filter("a <> b")
    best = both.groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.min(F.struct("mid", "s1", "s2", "w1", "w2")).alias("p")).join(one.select("src", "dst"), ["src", "dst"], "left_anti")
    return best.select("src", "dst", F.array("src", "p.mid", "dst").alias("ids"), F.array("p.s1", "p.s2").alias("steps"), (F.col("p.w1") + F.col("p.w2")).alias("delta"), F.lit(2).alias("length"))


def path_id(purpose: str, explains: Column | None = None) -> Column:
    """Content address of a path: 16 hex digits over purpose, the explained edge's id (empty without one), ends and steps."""
    explained = F.coalesce(explains, F.lit("")) if explains is not None else F.lit("")
    text = F.concat_ws("|", F.lit(purpose), explained, "src", "dst", F.array_join("steps", ","))
    return F.concat(F.lit("mh-"), F.substring(F.sha2(text, 256), 1, 16))


def purpose_faults(paths: DataFrame, direct: DataFrame, edges: DataFrame, basic: Sequence[str], explainable: Sequence[str]) -> DataFrame:
    """(id, fault) of paths (id, purpose, explains, src, dst, edge_ids) that break a rule of their purpose.

    A connection explains nothing and has no direct pair (``direct``: src, dst). An explanation explains a kinship
    edge (``edges``: edge_id, type, subtype) of an ``explainable`` subtype, does not use it, and goes by ``basic`` kinship alone.
    Nor may two paths have one (purpose, explains, src, dst).
    """
    kin = edges.select("edge_id", F.coalesce((F.col("type") == "kinship") & F.col("subtype").isin(list(basic)), F.lit(False)).alias("basic"), F.coalesce((F.col("type") == "kinship") & F.col("subtype").isin(list(explainable)), F.lit(False)).alias("able"))
    steps = paths.select("id", F.explode("edge_ids").alias("edge_id")).join(kin, "edge_id", "left").groupBy("id").agg(F.bool_and(F.coalesce("basic", F.lit(False))).alias("basic"))
    twice = paths.groupBy("purpose", "explains", "src", "dst").agg(F.count("*").alias("n")).filter("n > 1")
    twice = twice.select(*[F.col(c).alias(f"_{c}") for c in ("purpose", "explains", "src", "dst")], F.lit(True).alias("twice"))
    out = paths.join(steps, "id", "left").join(kin.select(F.col("edge_id").alias("explains"), "able"), "explains", "left")
    out = out.join(direct.select("src", "dst").distinct().withColumn("direct", F.lit(True)), ["src", "dst"], "left")
    out = out.join(twice, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("purpose", "explains", "src", "dst")], "left")
    link, told = F.col("purpose") == "connection", F.col("purpose") == "kinship_explanation"
    rules = {
        "purpose": ~(link | told), "direct_pair": link & F.col("direct"), "explains": link & F.col("explains").isNotNull(), "explained": told & ~F.coalesce("able", F.lit(False)),
        "uses_explained": told & F.array_contains("edge_ids", F.col("explains")), "not_basic": told & ~F.coalesce("basic", F.lit(False)), "duplicate": F.col("twice"),
    }
    return faults(out, ["id"], rules)


def path_faults(paths: DataFrame, depth: int = 4) -> DataFrame:
    """(src, dst, fault) of paths that break an invariant."""
    rules = {
        "self_pair": F.col("src") == F.col("dst"),
        "length": ~F.col("length").between(2, depth),
        "sizes": (F.size("ids") != F.col("length") + 1) | (F.size("steps") != F.col("length")),
        "ends": (F.col("ids")[0] != F.col("src")) | (F.element_at("ids", -1) != F.col("dst")),
        "repeated_node": F.size(F.array_distinct("ids")) != F.size("ids"),
        "repeated_step": F.size(F.array_distinct("steps")) != F.size("steps"),
    }
    return faults(paths, ["src", "dst"], rules)


def two_hop_contexts(edges: DataFrame, pairs: DataFrame, most: int = 5) -> DataFrame:
    """Up to ``most`` middles for each pair (a, b), the least first. ``edges`` may repeat; they are dealt over as many tasks as their number needs."""
    rows = edges.count()
    one = lambda src, dst, key: in_tasks(edges.select(F.col("src").alias(src), F.col("dst").alias(dst)), rows, *key).distinct()
    left = pairs.select("a", "b").distinct().join(one("a", "mid", ["a"]), "a").filter("mid <> a AND mid <> b")
    met = in_tasks(left, rows, "mid", "b").join(one("mid", "b", ["mid", "b"]).hint("merge"), ["mid", "b"])
    w = Window.partitionBy("a", "b").orderBy("mid")
    return met.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most).select("a", "b", "mid", "place")


#: Sources of a target that are sent in one row, about, and pairs of a source and target's sources from which they are dealt over several tasks.
SENT, HEAVY = 64, 4_000_000


def shared_targets(edges: DataFrame, most: int = 5, sent: int = SENT, heavy: int = HEAVY) -> DataFrame:
    """Up to ``most`` common targets for every two sources a < b that have one, the least first; one row a target and pair.

    A source is sent each of its targets with lists of the target's greater sources, so what is moved is a name for each meeting and not a row,
    and told apart where it arrives: a task has about as many meetings as any other, whatever their number. A source of very many meetings is
    dealt over several tasks by the other one.
    """
    one = kept(in_tasks(edges.select(F.col("src").alias("a"), F.col("dst").alias("mid")).filter("a <> mid"), edges.count(), "a", "mid").distinct())
    sizes = kept(one.groupBy("mid").agg(F.count("*").alias("n")).filter("n > 1"))
    meets = sizes.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0)).cast("long").alias("n")).first().n
    sized = kept(in_tasks(one, one.count(), "mid").join(sizes, "mid"))
    pieces = sized.groupBy("mid", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / sent)).alias("piece")).agg(F.sort_array(F.collect_list("a")).alias("bs"))
    salts = kept(sized.groupBy("a").agg(F.ceil(F.sum("n") / heavy).cast("int").alias("salts")).filter("salts > 1"))
    own = sized.select("a", "mid").join(salts, "a", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    later = F.filter("bs", lambda b: (b > F.col("a")) & (F.col("salts").isNull() | (F.pmod(F.xxhash64(b), F.col("salts")) == F.col("salt"))))
    sets = in_tasks(own, one.count(), "mid").join(pieces.hint("merge"), "mid").select("a", "salt", "mid", later.alias("bs")).filter(F.size("bs") > 0)
    met = in_tasks(sets, meets // 4, "a", "salt").select("a", "salt", "mid", F.explode("bs").alias("b"))
    w = Window.partitionBy("b", "a", "salt").orderBy("mid")  # b first: told apart by a sort's prefix
    return met.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most).select("a", "b", "mid", "place")


def spread(edges: DataFrame, start: DataFrame, value: Column | None = None, most: int | None = None) -> DataFrame:
    """(node, depth, value) reached from ``start`` (node, value), each at its first visit; the least value wins there.

    ``value`` is an expression of the node's value and the edge; rounds go on until no
    new node is met, each writing its frontier alone; what is seen is all frontiers together.
    """
    value = F.col("value") if value is None else value
    front, d = kept(start.select("node", F.lit(0).alias("depth"), "value")), 0
    seen = front
    while (most is None or d < most) and not front.isEmpty():
        d += 1
        met = front.select("node", "value").join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node"), value.alias("value"))
        met = met.groupBy("node").agg(F.min("value").alias("value")).join(seen.select("node"), "node", "left_anti")
        front = kept(met.select("node", F.lit(d).alias("depth"), "value"))
        seen = seen.unionByName(front)
    return seen


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"), F.bit_xor(F.xxhash64("v", "u", F.lit(1))).alias("g")).first()
    return r.n, r.h, r.g


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (src, dst) with the least node of its component.

    Contraction by alternating stars: each round links a node's greater neighbours, then its lesser ones, to the least of them, until the
    edges are stars about the least nodes. A chain takes about as many rounds as its length has binary digits; a node of any number of
    neighbours is one row on one side of its join. A round reads the last one's edges alone, which go when it is written.
    """
    from weft.sources.tables import dropped

    least = lambda e: e.groupBy("u").agg(F.min("v").alias("m"))
    ends = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    alone = kept(ends.select("u").unionByName(ends.select(F.col("v").alias("u"))).distinct())
    now, before = kept(ends.filter("u <> v").distinct()), None
    while (mark := _signature(now)) != before:
        before, old = mark, now
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        top = least(both).select("u", F.least("u", "m").alias("m"))
        large = now.select(F.col("v").alias("u"), F.col("u").alias("v")).join(top, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = kept(large.filter("u <> v").distinct())
        low = least(large)
        small = large.join(low, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = kept(small.distinct())
        dropped(old), dropped(large)
    return alone.join(now, "u", "left").select(F.col("u").alias("node"), F.coalesce("v", "u").alias("root"))


def component_around(edges: DataFrame, start: DataFrame, rounds: int = 8) -> DataFrame:
    """(node): all that hangs together with ``start`` (node), which is one node or several of one component; ``edges`` go both ways and may repeat.

    A front goes out for some rounds and moves the edges at it alone, so a component is found whatever else the graph has. If it is not done by
    then, what was reached counts as one node and ``components`` does the rest, so a long chain takes no round a link.
    """
    front = seen = kept(start.select("node").distinct())
    for _ in range(rounds):
        met = _at_front(edges, front).select(F.col("dst").alias("node")).filter("node IS NOT NULL").distinct()
        front = kept(met.join(seen, "node", "left_anti"))
        if front.isEmpty():
            return seen
        seen = kept(seen.unionByName(front))
    one = F.lit(seen.agg(F.min("node")).first()[0])
    far = edges.select("src", "dst")
    for end in ("src", "dst"):
        far = far.join(seen.select(F.col("node").alias(end), F.lit(True).alias("_seen")), end, "left").withColumn(end, F.when(F.col("_seen"), one).otherwise(F.col(end))).drop("_seen")
    roots = kept(components(far))
    rest = roots.join(roots.filter(F.col("node") == one).select("root"), "root", "left_semi").select("node").filter(F.col("node") != one)
    return seen.unionByName(rest)


def component(edges: DataFrame, focus: str) -> DataFrame:
    """(node, depth) of the focus's component."""
    start = edges.sparkSession.createDataFrame([(focus, 0)], "node string, value int")
    return spread(edges, start).select("node", "depth")


def generational_ranks(parents: DataFrame, focus: str) -> DataFrame:
    """Ancestors below zero, siblings 1, descendants above zero, the focus 0; (parent, child) edges of a tree."""
    start = parents.sparkSession.createDataFrame([(focus, 0)], "node string, value int")
    up = spread(parents.select(F.col("child").alias("src"), F.col("parent").alias("dst")), start, F.col("value") - 1)
    down = spread(parents.select(F.col("parent").alias("src"), F.col("child").alias("dst")), start, F.col("value") + 1)
    own = parents.filter(F.col("child") == focus).select("parent")
    beside = parents.join(own, "parent", "left_semi").filter(F.col("child") != focus).select(F.col("child").alias("node"), F.lit(1).alias("rank"))
    line = up.unionByName(down).select("node", F.col("value").alias("rank")).distinct()
    return line.unionByName(beside.join(line, "node", "left_anti")).distinct()


def family_ranks(parents: DataFrame, siblings: DataFrame, partners: DataFrame, nodes: DataFrame, focus: str, topic: DataFrame | None = None) -> DataFrame:
    """(node, rank) of every node shown around a focus.

    The focus is 0; ancestors go down from -1, each at its nearest visit; siblings are 1, partners 0;
    descendants go up from 1, or from 2 beside siblings, where no rank is given yet; the rest has its
    rank in the topic (node, rank), else 1. ``siblings`` and ``partners`` are (a, b) in any order.
    """
    spark = nodes.sparkSession
    shown = nodes.select(F.col("node").alias("src")).distinct()
    lines = parents.join(shown.withColumnRenamed("src", "parent"), "parent", "left_semi").join(shown.withColumnRenamed("src", "child"), "child", "left_semi")
    start = spark.createDataFrame([(focus, 0)], "node string, value int")

    def beside(pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.col("a").alias("x"), F.col("b").alias("node")).union(pairs.select("b", "a"))
        return kept(both.filter(F.col("x") == focus).select("node").distinct())

    seen = lambda d: d.join(shown.withColumnRenamed("src", "node"), "node", "left_semi")
    sibs, mates = beside(siblings), beside(partners)
    up = spread(lines.select(F.col("child").alias("src"), F.col("parent").alias("dst")), start, F.col("value") - 1).filter("depth > 0")
    first = 1 if sibs.isEmpty() else 2
    taken = sibs.union(mates).union(up.select("node")).distinct()  # lines of descent do not go on over these
    below = lines.join(taken, F.col("child") == F.col("node"), "left_anti")
    down = spread(below.select(F.col("parent").alias("src"), F.col("child").alias("dst")), start, F.col("value") + 1).filter("depth > 0")
    ranked = [
        start.select("node", F.lit(0).alias("rank"), F.lit(0).alias("turn")), seen(mates).select("node", F.lit(0), F.lit(1)), seen(sibs).select("node", F.lit(1), F.lit(2)),
        up.select("node", "value", F.lit(3)), down.select("node", F.col("value") + (first - 1), F.lit(4)),
    ]
    out = ranked[0]
    for r in ranked[1:]:
        out = out.union(r)
    if topic is not None:
        out = out.union(topic.join(shown.withColumnRenamed("src", "node"), "node", "left_semi").select("node", "rank", F.lit(5)))
    # a partner's rank replaces a sibling's, that an ancestor's; descendants and topics fill up
    one = out.groupBy("node").agg(F.min_by("rank", "turn").alias("rank"))
    return shown.withColumnRenamed("src", "node").join(one, "node", "left").select("node", F.coalesce("rank", F.lit(1)).alias("rank"))


def directional_ranks(edges: DataFrame, focus: str) -> DataFrame:
    """(node, rank) of the focus's network (src, dst, direction): a step along an edge adds one, against it takes one.

    ``incoming`` turns an edge round; undirected and bidirectional ones go towards 0 from below, else down. A node
    has its rank from its first visit; of several visits in one round the least rank counts.
    """
    flat = F.col("direction").isin("undirected", "bidirectional")
    along = F.when(F.col("direction") == "incoming", -1).otherwise(1)
    f = edges.select("src", "dst", F.when(~F.coalesce(flat, F.lit(False)), along).alias("way"))
    both = kept(f.union(edges.select("dst", "src", F.when(~F.coalesce(flat, F.lit(False)), -along))).distinct())
    start = edges.sparkSession.createDataFrame([(focus, 0)], "node string, value int")
    step = F.col("value") + F.coalesce("way", F.when(F.col("value") < 0, 1).otherwise(-1))
    return spread(both, start, step).select("node", F.col("value").alias("rank"))


def connected_edges(edges: DataFrame, focus: str) -> DataFrame:
    """Edges of the focus's component: both their ends have its root."""
    roots = kept(components(edges))
    own = roots.join(roots.filter(F.col("node") == focus).select("root"), "root", "left_semi").select("node")
    return edges.filter("dst IS NOT NULL").join(own, F.col("src") == F.col("node"), "left_semi")


def fold_parallel(edges: DataFrame, priority: Column) -> DataFrame:
    """One edge for each unordered pair: the greatest priority, then the least id."""
    pair = edges.withColumns({"lo": F.least("src", "dst"), "hi": F.greatest("src", "dst"), "priority": priority})
    w = Window.partitionBy("lo", "hi").orderBy(F.desc("priority"), "edge_id")
    return pair.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def ego(edges: DataFrame, focus: str, most: int) -> DataFrame:
    """The ``most`` foremost edges that touch the focus."""
    return edges.filter((F.col("src") == focus) | (F.col("dst") == focus)).orderBy(F.desc("priority"), "edge_id").limit(most)


def neighbourhood(edges: DataFrame, focus: str) -> DataFrame:
    """Edges that touch the focus or one of its neighbours."""
    near = edges.filter(F.col("src") == focus).select(F.col("dst").alias("n")).union(edges.filter(F.col("dst") == focus).select(F.col("src").alias("n")))
    near = near.distinct()
    a = edges.join(near, F.col("src") == F.col("n"), "left_semi")
    b = edges.join(near, F.col("dst") == F.col("n"), "left_semi")
    return a.unionByName(b).distinct()


@dataclass(frozen=True)
class GraphQuery:
    """Facets of a view; an empty facet filters nothing. ``merge``: groups shown as one node.

    ``family`` lets all kinship pass the filter of types, as family topics do. ``scope``: a testament.
    """

    types: Sequence[str] = ()
    groups: Sequence[str] = ()
    evidence: Sequence[str] = ()
    nodes: Sequence[str] = ()
    books: Sequence[str] = ()
    eras: Sequence[str] = ()
    scope: str = ""
    term: str = ""
    family: bool = False
    merge: Sequence[str] = field(default=())


def merge_mapping(nodes: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(node, target): members of the chosen groups, if all of them may merge, onto the least member."""
    g = nodes.filter(F.col("grp").isin(list(groups))).groupBy("grp").agg(F.min("node").alias("target"), F.bool_and("may_merge").alias("all_may"), F.count("*").alias("n"))
    return nodes.join(g.filter("all_may AND n > 1"), "grp").select("node", "target")


def chosen_mapping(options: DataFrame, chosen: DataFrame) -> DataFrame:
    """(node, target): members of a group whose chosen option names the group and its one target, where all members chose so.

    ``options`` is (node, option, grp, target) of options that merge; ``chosen`` (node, option). A target is
    not its own member's target here: it is left out.
    """
    g = options.groupBy("grp").agg(F.countDistinct("node").alias("n"), F.min("target").alias("to"))
    took = options.join(chosen, ["node", "option"]).join(g, "grp").filter("target = to").select("grp", "node").distinct()
    all_ = took.groupBy("grp").agg(F.count("*").alias("m")).join(g, "grp").filter("m = n AND n > 1 AND to IS NOT NULL").select("grp", "to")
    return took.join(all_, "grp").filter("node <> to").select("node", F.col("to").alias("target"))


def merged_nodes(nodes: DataFrame, mapping: DataFrame, sets: Sequence[str], name: str = "name", aliases: str = "aliases") -> DataFrame:
    """Nodes after a merge: a target keeps its own columns, and has the union of all members' ``sets``.

    Members' names join the aliases; the target's own name is none of these.
    """
    at = nodes.join(mapping, "node", "left").withColumn("_to", F.coalesce("target", "node")).drop("target")
    named = at.withColumn(aliases, F.concat(F.col(aliases), F.array(name)))
    u = named.groupBy(F.col("_to").alias("node")).agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(f"_{c}") for c in sets])
    own = nodes.join(mapping.select("node"), "node", "left_anti").join(u, "node")
    out = own.withColumns({c: F.col(f"_{c}") for c in sets})
    return out.withColumn(aliases, F.filter(aliases, lambda a: (a != F.col(name)) & (a != ""))).drop(*[f"_{c}" for c in sets])


def relation_facets(q: GraphQuery, has: Sequence[str]) -> Column:
    """Which edges a query's own facets let pass, of columns ``has``: type and kin, evidence, books, eras of either end, testaments, both ends in a set."""
    ok = F.lit(True)
    any_of = lambda c, some: F.arrays_overlap(c, F.array(*[F.lit(x) for x in some]))
    if q.types:
        kin = F.coalesce((F.col("raw_type") == "kinship") | F.startswith("raw_type", F.lit("kinship:")), F.lit(False)) if q.family and "raw_type" in has else F.lit(False)
        ok = ok & (F.col("type").isin(list(q.types)) | kin)
    if q.evidence:
        ok = ok & (any_of("levels", q.evidence) if "levels" in has else F.col("evidence").isin(list(q.evidence)))
    if q.books:
        ok = ok & any_of("books", q.books)
    if q.eras:
        ok = ok & (F.col("src_era").isin(list(q.eras)) | F.col("dst_era").isin(list(q.eras)))
    if q.scope:
        ok = ok & F.array_contains("testaments", q.scope)
    if q.nodes:
        ok = ok & F.col("src").isin(list(q.nodes)) & F.col("dst").isin(list(q.nodes))
    return F.coalesce(ok, F.lit(False))


def name_matches(names: Column, term: str) -> Column:
    """Whether a name of an array has the term in it, both in NFKC and lower case; an empty term is in all."""
    import unicodedata

    from weft.functions.text import normalized

    wanted = " ".join(unicodedata.normalize("NFKC", term).lower().split())
    if not wanted:
        return F.lit(True)
    # names are joined so that one call normalises them all; the joint is in no term
    all_ = F.lower(normalized("NFKC")(F.array_join(names, "\u0000")))
    return F.coalesce(F.contains(F.regexp_replace(all_, r"[ \t\r\n]+", " "), F.lit(wanted)), F.lit(False))


def visible(nodes: DataFrame, edges: DataFrame, q: GraphQuery) -> DataFrame:
    """Edges a query shows: ends mapped to merge targets, loops dropped, facets applied, equal ones once.

    ``nodes``: node, grp, name, may_merge, and era where eras are asked for; ``edges``: src, dst, edge_id,
    type, evidence, and what the query's facets read.
    """
    if q.merge:
        m = merge_mapping(nodes, q.merge)
        for end in ("src", "dst"):
            edges = edges.join(m.select(F.col("node").alias(end), "target"), end, "left").withColumn(end, F.coalesce("target", end)).drop("target")
    out = edges.filter("src <> dst")
    if q.eras:
        for end in ("src", "dst"):
            out = out.join(nodes.select(F.col("node").alias(end), F.col("era").alias(f"{end}_era")), end, "left")
    out = out.filter(relation_facets(q, out.columns)).select(*edges.columns)
    if q.groups or q.term:
        ok = nodes
        if q.groups:
            ok = ok.filter(F.col("grp").isin(list(q.groups)))
        if q.term:
            ok = ok.filter(name_matches(F.col("names") if "names" in nodes.columns else F.array("name"), q.term))
        out = out.join(ok, F.col("src") == F.col("node"), "left_semi").unionByName(out.join(ok, F.col("dst") == F.col("node"), "left_semi"))
    return out.dropDuplicates(["src", "dst", "edge_id"])


#: Stored queries by topic.
PRESETS = {"all": GraphQuery(), "family": GraphQuery(family=True, types=("kinship",))}
