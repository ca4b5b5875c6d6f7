"""Filter interaction audit: what each filter of a chain removes, in every order, from one pass over the documents.

Native expressions give each document a mask with a bit for each filter that it fails. The filters of a text's own are
judged on the text; the last one, copies, by grouping on the text for the least ``doc_id``: every other document of the
text fails it. A histogram of masks (32 cells a part for five filters) holds all that any order can do: at a step, what
the filters before it have removed is a set, not a sequence, so steps of all permutations are sums over cells.

Defined results: a null text is an empty one; a null ``lang`` is the part of the empty string; a document without a
``doc_id`` is no copy and makes none; repeated rows count once each, and rows that share text and least ``doc_id`` are
not copies of one another; a document is good or toxic if any of its rows in ``labels`` says so; an empty table has no
parts. Texts are told apart by SHA-256. Extra columns are not read.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, table

#: The query's filters, fixed values: a text fails where the expression is true.
FILTERS = "ABCDE"


def text_filters(text: Column) -> list[Column]:
    """Failure conditions A to D of a text without nulls: short, repetitive, shouting, odd symbols."""
    words = F.array_remove(F.split(text, SPACE_CLASS + "+"), "")

    def on_words(w: Column) -> Column:
        n = F.size(w)
        return F.struct((n < 100).alias("A"), (100 * F.size(F.array_distinct(w)) < 80 * n).alias("B"))

    both = F.transform(F.array(words), on_words)[0]  # words are made once
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [both["A"], both["B"], 100 * capitals > 10 * F.length(text), text.rlike("[#$%&*|]")]


def mask_of(failures: list[Column]) -> Column:
    """A bit for each failure, the first one lowest."""
    return sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(failures)), F.lit(0))


def masks(docs: DataFrame, labels: DataFrame, failures=text_filters, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and mask; the bit after those of ``failures`` is that of copies.

    Rows are counted by (text, part, mask, labels) before they meet, so a text of any number of copies is a few rows.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    one = docs.select(t.alias("t"), F.col(doc_id).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"))
    named = one.select("id", "part", F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"), mask_of(failures(F.col("t"))).alias("m"))
    copy = 1 << len(failures(F.lit("")))
    known = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = named.groupBy("digest", "id", "part", "m").agg(F.count("*").alias("n"))
    # rows without an id find no label; the salt spreads them
    salt = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1024))).otherwise(F.lit(0).cast("long"))
    marked = rows.withColumn("salt", salt).join(known.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left").fillna(0, ["good", "toxic"])
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    groups = marked.groupBy("digest", "part", "m", "good", "toxic").agg(F.sum("n").alias("n"), first.alias("first"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("apart"))
    # a text has a row for each of its parts and labels here
    both = groups.withColumn("least", F.min("first.id").over(Window.partitionBy("digest")))
    originals = F.col("apart") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    cells = F.array(F.struct(F.col("m").alias("mask"), originals.alias("k")), F.struct((F.col("m") + copy).alias("mask"), (F.col("n") - originals).alias("k")))
    out = both.select("part", "good", "toxic", cells.alias("cells")).select("part", "good", "toxic", F.explode("cells").alias("c"))
    total = lambda c: F.sum(c).cast("long")
    return out.groupBy("part", F.col("c.mask").alias("mask")).agg(total("c.k").alias("n"), total(F.col("c.k") * F.col("good")).alias("good"), total(F.col("c.k") * F.col("toxic")).alias("toxic"))


def steps(cells: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row for each part of ``cells``, permutation of ``names`` and step, with what the step's filter does there.

    A part's cells are summed for each pair of a filter and the set of filters before it; the permutations then name their pairs.
    """
    n = len(names)
    pairs = [(f, sum(1 << k for k in s), len(s)) for f in range(n) for size in range(n) for s in combinations([k for k in range(n) if k != f], size)]
    of = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(before).alias("before"), F.lit(factorial(k) * factorial(n - 1 - k)).alias("orders")) for f, before, k in pairs])
    wide = cells.withColumn("p", F.explode(of)).select("part", "mask", "n", "good", "toxic", "p.*")
    bit, seen = F.call_function("shiftleft", F.lit(1), F.col("f")), F.col("mask").bitwiseAND(F.col("before"))
    fails, here = F.col("mask").bitwiseAND(bit) != 0, seen == 0
    total = lambda cond, c: F.sum(F.when(cond, F.col(c)).otherwise(0)).cast("long")
    summed = wide.groupBy("part", "f", "before", "orders").agg(
        total(here & ~fails, "n").alias("kept"), total(here & fails, "n").alias("removed"), total(~here & fails, "n").alias("redundant"),
        total(F.col("mask") == bit, "n").alias("unique_fails"), total(here & fails, "good").alias("good_lost"), total(here & fails, "toxic").alias("toxic_lost"),
    )
    shapley = summed.groupBy("part", "f").agg(F.sum(F.col("removed") * F.col("orders")).cast("long").alias("shapley"))
    chains = [("".join(names[f] for f in p), i + 1, p[i], sum(1 << k for k in p[:i])) for p in permutations(range(n)) for i in range(n)]
    order = cells.sparkSession.createDataFrame(chains, "filter_order string, step int, f int, before int")  # n! * n rows
    return summed.join(shapley, ["part", "f"]).join(F.broadcast(order), ["f", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps(masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
        100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'),
        coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS fails FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
p AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS seq FROM p a, p b, p c, p d, p e
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT filter_order, k::INT AS step, seq[k] AS f, list_filter(seq, lambda x, i: i < k) AS before FROM o, range(1, 6) AS r(k)),
u AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
r AS (SELECT part, filter_order, step, s.f,
  sum(CASE WHEN NOT gone AND NOT here THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND here THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN gone AND here THEN n ELSE 0 END) AS redundant, sum(CASE WHEN here AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN NOT gone AND here THEN n * good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND here THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT u.*, s.*, fails[s.f] AS here, len(list_filter(before, lambda b: fails[b])) > 0 AS gone FROM u, s) AS s GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r"""

QUERIES = {"op13_filter_audit": op13_filter_audit}
ORACLE_SQL = {"op13_filter_audit": ORACLE}
