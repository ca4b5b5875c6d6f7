"""Entities that share items, where one item may be in a third of all rows or in a hundred thousand sets.

Three means keep such an item from giving all pairs of its entities. Entities of equal sets are one class, scored once.
Above a threshold only rare items bring two sets together: each set is asked for by so many of its rarest items that no
pair which can reach the threshold is missed (prefix filtering), and frequent items are then only counted. Sets of up to
``SMALL`` items meet by up to ``TOGETHER`` shared items at once, so nearly all that meet are results. Where every
pair counts, items of many entities stay factored: the item with its entities stands for all their pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.operators.relational import per_10k
from weft.sources.tables import in_tasks, kept

#: Measures are rounded to ten-thousandths, so a score may be off by this much.
ROUNDING = 10
#: Sets of more items meet by single ones; of as many, 560 subsets of three are asked for.
SMALL = 16
#: Items that two small sets must share to meet, where their pair needs as many.
TOGETHER = 3
#: Bits of a hash by which small sets meet.
HASH = 40
#: Rows of a small table up to which all tasks are sent it.
SENT = 1_000_000
#: Entities of a heavy item up to which its pairs may be made, as many as one task's rows.
WIDE = 1000


def classes(sets: DataFrame, entity: str, item: str) -> DataFrame:
    """(entity, cls, n): the least entity of an equal set of items, and the set's size; nulls are no items.

    Sets are told apart by size and 128 bits of their items' hashes, summed without regard to order; no set is gathered.
    """
    mixed = lambda *salt: F.coalesce(F.bit_xor(F.when(F.col(item).isNotNull(), F.xxhash64(item, *salt))), F.lit(0))
    one = sets.groupBy(entity).agg(F.count(item).alias("n"), mixed().alias("h"), mixed(F.lit(1)).alias("g"))
    return one.join(one.groupBy("n", "h", "g").agg(F.min(entity).alias("cls")), ["n", "h", "g"]).select(entity, "cls", "n")


def _places(items: DataFrame, item: str) -> DataFrame:
    """(item, place): items from rare to frequent, by steps of frequency and then of a hash."""
    step = F.floor(F.log2(F.col("f")) * 4).cast("int") * 256
    return items.groupBy(item).agg(F.count("*").alias("f")).select(item, (step + F.pmod(F.xxhash64(item), F.lit(256))).cast("int").alias("place"))


def _ordered(items: DataFrame) -> tuple[DataFrame, int]:
    """Kept ``_places`` of the rows' items, and the number of rows."""
    return kept(_places(items, "item")), items.count()


def _prefix(sets: DataFrame, places: DataFrame, entity: str, item: str, need: Column) -> DataFrame:
    """Rows of ``sets`` (entity, item, n) by which a set meets all that share ``need`` items with it: its rarest ``n - need + 1``, and what ties with the last.

    Counted by place, so an entity's window has a row for each place and not for each item.
    """
    placed = sets.join(places, item)
    by = placed.groupBy(entity, "n", "place").agg(F.count("*").alias("m"))
    before = F.sum("m").over(Window.partitionBy(entity).orderBy("place")) - F.col("m")
    last = by.withColumn("before", before).filter(F.col("before") < F.col("n") - need + 1).groupBy(entity).agg(F.max("place").alias("last"))
    return placed.join(last, entity).filter("place <= last").select(entity, item, "n")


def _shared(pairs: DataFrame, left: DataFrame, right: DataFrame, item: str) -> DataFrame:
    """``pairs`` (a, b, n_a, n_b) with ``shared``, counted from the smaller set's side. ``left`` (a, item), ``right`` (b, item)."""
    small = F.col("n_a") <= F.col("n_b")
    one = pairs.filter(small).join(left, "a").join(right, ["b", item])
    two = pairs.filter(~small).join(right, "b").join(left, ["a", item])
    both = one.select("a", "b", "n_a", "n_b").unionByName(two.select("a", "b", "n_a", "n_b"))
    return both.groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("shared"))


def _subsets(items: Column, first: Column, size: int) -> Column:
    """Hashes of all subsets of ``size`` of a short array's ``first`` items, of which there are as many at least."""
    last = first - size
    out = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("i"), F.xxhash64(F.get(items, i)).alias("h")))
    for k in range(1, size):
        out = F.flatten(F.transform(out, lambda s: F.transform(F.sequence(s["i"] + 1, last + k), lambda j: F.struct(j.alias("i"), F.xxhash64(s["h"], F.get(items, j)).alias("h")))))
    return F.transform(out, lambda s: s["h"])


def _in_order(sets: DataFrame, places: DataFrame) -> DataFrame:
    """(e, n, items) of small sets, items from rare to frequent."""
    placed = sets.filter(F.col("n") <= SMALL).join(places, "item")
    return placed.groupBy("e", "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "item"))), lambda x: x["item"]).alias("items"))


def _rows(df: DataFrame, entity: str, item: str) -> DataFrame:
    return df.select(F.col(entity).alias("e"), F.col(item).alias("item")).filter("e IS NOT NULL AND item IS NOT NULL")


def _classed(rows: DataFrame, places: DataFrame, n_rows: int, least: int = 1) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets of ``least`` items or more, kept: (e, n, members, items), the least entity and a small set's items from rare to
    frequent; and the members (e, cls, n) of all classes, found only where they are read.

    Rows (e, item) are moved once, to their entity, and one row of a set once more, to its class. A small set is told by its items, a larger
    one by 128 bits of their hashes and never gathered.
    """
    placed = in_tasks(rows.join(places, "item"), n_rows, "e").distinct()
    first = F.row_number().over(Window.partitionBy("e").orderBy("place", "item")) <= SMALL
    mixed = lambda *salt: F.bit_xor(F.xxhash64("item", *salt))
    own = placed.withColumn("few", F.when(first, F.struct("place", "item"))).groupBy("e").agg(F.count("*").alias("n"), mixed().alias("h"), mixed(F.lit(1)).alias("g"), F.array_sort(F.collect_list("few")).alias("few"))
    small = F.col("n") <= SMALL
    items = F.transform("few", lambda x: x["item"])
    one = own.filter(F.col("n") >= least).select("e", "n", F.when(small, 0).otherwise(F.col("h")).alias("h"), F.when(small, 0).otherwise(F.col("g")).alias("g"), F.when(small, items).otherwise(F.slice(items, 1, 0)).alias("items"))
    told = ["n", "h", "g", "items"]
    classes = kept(one.groupBy(*told).agg(F.min("e").alias("e"), F.count("*").alias("members")))
    return classes, one.join(classes.select(*told, F.col("e").alias("cls")), told).select("e", "cls", "n")


def _small_pairs(left: DataFrame, right: DataFrame, need: Callable[[int, int], int], once: bool = False) -> DataFrame:
    """(a, b, n_a, n_b, shared) of small sets (e, n, items) that share ``need(n_a, n_b)`` items or more; 0: no number is enough. ``once``: only a < b.

    A pair which needs k items meets by l = min(k, ``TOGETHER``) of them at once: its l rarest shared items are within the rarest n - k + l of
    either set. Pairs are exact thereafter, as hashes only bring them together; a key is ``HASH`` bits of one and l in one number.
    """
    sizes = range(SMALL + 1)
    k = {(x, y): need(x, y) if x and y else 0 for x in sizes for y in sizes}
    lists = lambda v: F.array(*[F.lit(x) for x in v])
    rare = lambda at, l: [max((n - q + l for xy, q in k.items() if xy[at] == n and min(q, TOGETHER) == l), default=0) for n in sizes]
    some = range(1, TOGETHER + 1)
    asks = lambda at: lists([sum(comb(rare(at, l)[n], l) for l in some) for n in sizes])
    number = lambda side, at: side.filter(F.col("n") <= SMALL).agg(F.coalesce(F.sum(F.get(asks(at), F.col("n").cast("int"))), F.lit(0))).first()[0]
    rows = number(left, 0) + number(right, 1)

    def asked(side: DataFrame, at: int, end: str) -> DataFrame:
        keys = []
        for l in some:
            first = F.get(lists(rare(at, l)), F.col("n").cast("int"))
            keys.append(F.when(first > 0, F.transform(_subsets(F.col("items"), first, l), lambda h: F.shiftleft(h.bitwiseAND(F.lit((1 << HASH) - 1)), 2) + l)))
        none = F.array().cast("array<bigint>")
        small = side.filter(F.col("n") <= SMALL).select(F.col("e").alias(end), F.col("n").cast("byte").alias(f"n_{end}"), F.explode(F.concat(*[F.coalesce(x, none) for x in keys])).alias("key"))
        return in_tasks(small, rows, "key")

    wanted = lambda v: F.get(lists(v), F.col("n_a").cast("int") * len(sizes) + F.col("n_b").cast("int"))
    met = asked(left, 0, "a").join(asked(right, 1, "b"), "key").filter(F.col("key").bitwiseAND(F.lit(3)) == wanted([min(q, TOGETHER) for q in k.values()]))
    pairs = (met.filter("a < b") if once else met).select("a", "b").distinct()
    sets = lambda side, end: side.filter(F.col("n") <= SMALL).select(F.col("e").alias(end), F.col("n").alias(f"n_{end}"), F.col("items").alias(f"i_{end}"))
    out = pairs.join(sets(left, "a"), "a").join(sets(right, "b"), "b").withColumn("shared", F.size(F.array_intersect("i_a", "i_b")).cast("long"))
    return out.filter(F.col("shared") >= wanted(list(k.values()))).select("a", "b", "n_a", "n_b", "shared")


def _large_meetings(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b) of sets, one of them large or both, by the rows of their prefixes (e, item, n)."""
    a, b = (d.select(F.col("e").alias(e), "item", F.col("n").alias(f"n_{e}")) for d, e in ((left, "a"), (right, "b")))
    met = a.filter(F.col("n_a") > SMALL).join(b, "item").unionByName(a.filter(F.col("n_a") <= SMALL).join(b.filter(F.col("n_b") > SMALL), "item"))
    return met.select("a", "b", "n_a", "n_b").distinct()


def _any_large(*classes: DataFrame) -> bool:
    return any(not c.filter(F.col("n") > SMALL).isEmpty() for c in classes)


def scored(pairs: DataFrame) -> DataFrame:
    """Coverage, precision, Jaccard and their 0.5 / 0.3 / 0.2 score of ``shared``, ``n_a`` and ``n_b``, in whole numbers."""
    s, a, b = F.col("shared"), F.col("n_a"), F.col("n_b")
    out = pairs.withColumns({"coverage": per_10k(s, a), "precision": per_10k(s, b), "jaccard": per_10k(s, a + b - s)})
    return out.withColumn("score", F.col("coverage") * 5 + F.col("precision") * 3 + F.col("jaccard") * 2)


def _at_least(n: Column, part: float) -> Column:
    """The least whole number of at least ``part`` of ``n``, and 1."""
    return F.greatest(F.ceil(n * part - 1e-9), F.lit(1)).cast("long")


def scores_above(left: DataFrame, right: DataFrame, a: str, b: str, passage: str, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of passage sets whose score is ``least`` hundred-thousandths or more: (a, b, n_a, n_b, shared, measures, score, members_a,
    members_b) of class representatives, with their classes' members in number, and the members (entity, cls, n) of both sides' classes. All members of two classes have their representatives' score.

    With t the threshold, a pair shares at least (t - 0.3) / 0.7 of a's passages, as precision and Jaccard can make up for no more, and
    (t - 0.5) / 0.5 of b's; these give the prefixes. Sizes alone then rule out more, and only the rest is counted.
    """
    t = max(least - ROUNDING, 1) / 100_000
    ra, rb = _rows(left, a, passage), _rows(right, b, passage)
    places, n_rows = _ordered(ra.select("item").unionByName(rb.select("item")))
    (ca, ma), (cb, mb) = (_classed(r, places, n_rows) for r in (ra, rb))
    mean = lambda s, n: (s * 20000 + n) // (n * 2)
    score = lambda s, n, m: mean(s, n) * 5 + mean(s, m) * 3 + mean(s, n + m - s) * 2
    counted = _small_pairs(ca, cb, lambda n, m: next((s for s in range(1, min(n, m) + 1) if score(s, n, m) >= least), 0))
    if _any_large(ca, cb):
        sa, sb = (kept(r.distinct().join(c.select("e", "n"), "e")) for r, c in ((ra, ca), (rb, cb)))
        pa, pb = (_prefix(s, places, "e", "item", _at_least(F.col("n"), part)) for s, part in ((sa, (t - 0.3) / 0.7), (sb, (t - 0.5) / 0.5)))
        can = scored(_large_meetings(pa, pb).withColumn("shared", F.least("n_a", "n_b"))).filter(F.col("score") >= least)
        pairs = kept(can.select("a", "b", "n_a", "n_b"))
        counted = counted.unionByName(_shared(pairs, sa.select(F.col("e").alias("a"), "item"), sb.select(F.col("e").alias("b"), "item"), "item"))
    size = lambda c, end: c.select(F.col("e").alias(end), F.col("members").alias(f"members_{end}"))
    out = scored(counted).filter(F.col("score") >= least).join(size(ca, "a"), "a").join(size(cb, "b"), "b")
    return out, ma.withColumnRenamed("e", a), mb.withColumnRenamed("e", b)


def cooccurrences_above(df: DataFrame, passage: str, entity: str, least: int) -> tuple[DataFrame, DataFrame]:
    """Pairs a < b of class representatives that share ``least`` passages or more, with ``n_passages``, and the members (entity, cls, n) of classes.

    Members of two classes share what their representatives do; two members of one class share all their ``n``.
    """
    pairs, _, members = class_cooccurrences(df, passage, entity, least)
    return pairs, members


def class_cooccurrences(df: DataFrame, passage: str, entity: str, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``cooccurrences_above`` with the classes (cls, n, members), members in number, between its two tables."""
    rows = _rows(df, entity, passage)
    places, n_rows = _ordered(rows)
    classes, members = _classed(rows, places, n_rows, least)
    counted = _small_pairs(classes, classes, lambda n, m: least if min(n, m) >= least else 0, once=True)
    if _any_large(classes):
        own = kept(rows.distinct().join(classes.select("e", "n"), "e"))
        p = _prefix(own, places, "e", "item", F.lit(least))
        pairs = kept(_large_meetings(p, p).filter("a < b"))
        counted = counted.unionByName(_shared(pairs, own.select(F.col("e").alias("a"), "item"), own.select(F.col("e").alias("b"), "item"), "item"))
    pairs = counted.filter(F.col("shared") >= least).select("a", "b", F.col("shared").alias("n_passages"))
    return pairs, classes.select(F.col("e").alias("cls"), "n", "members"), members.withColumnRenamed("e", entity)


def meetings(df: DataFrame, item: str, entity: str, heavy: int) -> tuple[DataFrame, DataFrame]:
    """Where entities meet, with items of more than ``heavy`` entities kept apart.

    First (a, b, item): every pair a < b that meets in a light item, with all items it meets in, heavy ones too. Then (item, entity, n) of
    the heavy items: any two entities of one meet there, and those that meet nowhere else are told by these rows alone.
    """
    met, hot, n_pairs = _met(df, item, entity, heavy)
    pairs = in_tasks(kept(met), n_pairs, "a", "b")
    told = pairs.select("a", "b", "item").unionByName(_shared_heavy(pairs, hot))
    return told, hot.select(F.col("item").alias(item), F.col("e").alias(entity), "n")


def counted_meetings(df: DataFrame, item: str, entity: str, heavy: int) -> tuple[DataFrame, DataFrame]:
    """``meetings`` with a pair's items in number, (a, b, n): a pair is moved once, without its items, and counted where its rows meet.

    Heavy items of up to ``WIDE`` entities, as many as have no more pairs than the light ones, are counted along with these; pairs that meet in
    no light item then go. Of wider items, entities of equal sets are one class; where classes are few, what two of them share is counted once and
    sent to the pairs.
    """
    met, hot, n_pairs = _met(df, item, entity, heavy)
    own, spare, most = 0, max(n_pairs, SENT), heavy
    for x in hot.filter(F.col("n") <= WIDE).groupBy("n").agg(F.count("*").alias("rows")).orderBy("n").collect():  # a row for each size
        more = x.rows * (x.n - 1) // 2
        if own + more > spare:
            break
        own, most = own + more, x.n
    mid, wide = hot.filter(F.col("n") <= most), hot.filter(F.col("n") > most)
    both = met.select("a", "b", F.lit(True).alias("light")).unionByName(_pairs(mid, mid.count()).select("a", "b", F.lit(False).alias("light")))
    light = in_tasks(both, n_pairs + own, "a", "b").groupBy("a", "b").agg(F.count("*").alias("n"), F.bool_or("light").alias("light")).filter("light").drop("light")
    cls = kept(classes(wide, "e", "item").select("e", "cls"))
    told = kept(wide.select("e", "item").join(cls.select(F.col("cls").alias("e")).distinct(), "e"))
    each = told.groupBy("item").agg(F.count("*").alias("c")).agg(F.coalesce(F.sum(F.col("c") * F.col("c")), F.lit(0)).alias("met")).first()
    if each.met <= SENT and cls.count() <= SENT:
        of = lambda end: F.broadcast(cls.select(F.col("e").alias(end), F.col("cls").alias(f"c_{end}")))
        one, two = told.select(F.col("e").alias("c_a"), "item"), told.select(F.col("e").alias("c_b"), "item")
        also = kept(one.join(two, "item").groupBy("c_a", "c_b").agg(F.count("*").alias("m")))
        out = light.join(of("a"), "a", "left").join(of("b"), "b", "left").join(F.broadcast(also), ["c_a", "c_b"], "left")
    else:
        light = kept(light)
        out = light.join(_shared_heavy(light, wide).groupBy("a", "b").agg(F.count("*").alias("m")), ["a", "b"], "left")
    n = (F.col("n") + F.coalesce("m", F.lit(0))).alias("n")
    return out.select("a", "b", n), hot.select(F.col("item").alias(item), F.col("e").alias(entity), "n")


def _few(df: DataFrame) -> DataFrame:
    """A kept ``df`` that all tasks are sent, if it has few rows."""
    return F.broadcast(df) if df.count() <= SENT else df


def _pairs(sets: DataFrame, rows: int) -> DataFrame:
    """(a, b, item): pairs a < b of each item's entities, which are one list, by (item, e)."""
    lists = in_tasks(sets.select("item", "e"), rows, "item").groupBy("item").agg(F.collect_set("e").alias("es"))
    return lists.withColumn("a", F.explode("es")).withColumn("b", F.explode(F.filter("es", lambda x: x > F.col("a")))).select("a", "b", "item")


def _met(df: DataFrame, item: str, entity: str, heavy: int) -> tuple[DataFrame, DataFrame, int]:
    """(a, b, item): pairs and the light items they meet in; the kept rows (item, e, n) of heavy items; and the number of pairs' rows, or
    somewhat more where rows repeat.

    Items are counted first: rows of light ones are moved once, to their item, over as many tasks as their number needs, and a light item's
    entities, ``heavy`` at most, are one list. Only rows of items with more rows than ``heavy`` are made distinct, before they are moved.
    """
    rows, c = _rows(df, entity, item), F.col("c")
    counts = rows.groupBy("item").agg(F.count("*").alias("c")).withColumn("item", F.when(c > heavy, F.col("item")))
    weights = kept(counts.groupBy("item").agg(F.sum("c").alias("n"), F.sum(c * (c - 1)).alias("ends")))
    few = weights.filter("item IS NULL").first()
    many = _few(weights.filter("item IS NOT NULL").select("item"))
    sets = kept(rows.join(many, "item", "left_semi").distinct())
    sizes = kept(sets.groupBy("item").agg(F.count("*").alias("n")))
    hot = kept(sets.join(_few(sizes.filter(F.col("n") > heavy)), "item"))
    n = F.col("n")
    back = sizes.filter(n <= heavy).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(n * (n - 1)), F.lit(0)).alias("ends")).first()
    light = rows.join(many, "item", "left_anti").unionByName(sets.join(_few(sizes.filter(n <= heavy).select("item")), "item", "left_semi"))
    return _pairs(light, back.n + (few.n if few else 0)), hot, (back.ends + (few.ends if few else 0)) // 2


def _shared_heavy(pairs: DataFrame, hot: DataFrame) -> DataFrame:
    """(a, b, item): the heavy items that ``pairs`` (a, b) meet in."""
    of = lambda end: hot.select("item", F.col("e").alias(end))
    return pairs.select("a", "b").distinct().join(of("a"), "a").join(of("b"), ["b", "item"]).select("a", "b", "item")
