"""Sharding by histogram sort: exact splitters first, then one exchange.

Rows are ordered by a key whose beginning is a hash of the text and whose end is a hash of the row, so shards are
shuffled samples of the corpus and equal texts are neighbours. Splitters are found without moving rows: in each round
the exact bytes and rows between candidate boundaries (probes) are counted over all partitions, and the probes are laid
anew inside the cells that hold a splitter's target. Only then do rows move, once, straight to their place.

A splitter is fixed by the data alone, not by the probes: the boundary between two groups of equal texts that is
nearest to the target, if that is within ``tolerance`` of a shard's size; else the nearest boundary between rows. So a
group is cut only where no group boundary is near enough, and a group of any size, even of rows alike in all that the
key reads, is spread over as many tasks and shards as its bytes ask for.

Defined results: a null text is placed as an empty one and has size 1; of repeated rows each gets a place of its own;
null keys are hashed as empty; an empty table gives an empty one; shards may be empty where there are fewer rows than
shards. Other columns pass through; input columns named as outputs are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, fresh, table, written

SHARDS = 16
#: A boundary between groups serves if it is within this part of a shard's size of the target.
TOLERANCE = 0.01
#: Bytes of text in a task of the exchange, and how many such tasks there are at most (they sort with spill).
PART_BYTES = 256 << 20
MAX_PARTS = 4096
#: Probes in a round, over all open cells.
PROBES = 4096
#: A task's boundary may be off by this part of its bytes; shards' boundaries are exact.
LOOSE = 0.1
#: A key has so many hexadecimal digits of the text's hash, which make its group, and as many of the row's; either is a whole number of 60 bits.
DIGITS, WIDTH = 15, 15  # bytes of both
ONE_GROUP = 1 << 4 * DIGITS
ROWS_IN_PART = 33  # bits of monotonically_increasing_id() below the partition


@dataclass(frozen=True)
class Cell:
    """Keys from ``lo`` up to ``hi``: what weighs less than them, and what they weigh, in weight and rows."""

    lo: int
    hi: int
    below: int
    rows_below: int
    weight: int
    rows: int

    def one_group(self) -> bool:
        return self.lo // ONE_GROUP == (self.hi - 1) // ONE_GROUP


@dataclass(frozen=True)
class Splitter:
    """Keys from ``key`` on lie right of it, and so do all but ``rank`` rows; ``inside`` if equal keys lie on both sides."""

    key: int
    rank: int
    inside: bool = False


def place_key(text: str, doc_id: str) -> Column:
    """The key by which rows are ordered, in hexadecimal: hash of the text, then of id and text."""
    t = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    row = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), t).cast("binary"))
    return F.concat(F.substring(t, 1, DIGITS), F.substring(row, 1, DIGITS))


def _bytes(key: int) -> bytes:
    return key.to_bytes(WIDTH, "big")


def _keys(keys: list[int]):
    """The k-th of some keys, from 1, cut out of one binary constant: an array would be made anew for each row, or by a call for each key."""
    packed = F.lit(bytearray(b"".join(map(_bytes, keys))))
    return lambda k: F.substr(packed, (k - 1) * WIDTH + 1, F.lit(WIDTH))


def _longs(values: list[int]):
    """The k-th of some whole numbers, from 1."""
    array = F.lit(values).cast("array<bigint>")
    return lambda k: F.get(array, k - 1)


def position(nth, n: int, value: Column, below: bool = False) -> Column:
    """How many of ``n`` sorted values, of which ``nth`` gives the k-th, are at most ``value`` (less than it, with ``below``), by binary search."""
    if not n:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])
    left = lambda k: nth(k) < value if below else nth(k) <= value
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= n) & left(at + step), at + step).otherwise(at))


def _span() -> list[Column]:
    """Aggregates of a cell: weight, rows, and the bounds of both halves of its keys; all of them numbers, so that they are hashed and not sorted."""
    return [F.sum("weight").alias("w"), F.count("*").alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("group", "row") for f in (F.min, F.max)]]


def _bounds(r) -> tuple[int, int]:
    """The least and greatest key that a cell may have: of one group, its very own."""
    one = r.min_group == r.max_group
    return r.min_group * ONE_GROUP + (r.min_row if one else 0), r.max_group * ONE_GROUP + (r.max_row if one else ONE_GROUP - 1)


def histogram(keyed: DataFrame, probes: list[int]) -> dict[int, tuple[int, int, int, int]]:
    """Of each cell between probes that has rows: its weight, rows, and bounds of its keys. Summed before the shuffle."""
    cell = position(_keys(probes), len(probes), F.col("key"))
    return {r.cell: (int(r.w), r.n, *_bounds(r)) for r in keyed.groupBy(cell.alias("cell")).agg(*_span()).collect()}


def _probes(cell: Cell, n: int) -> list[int]:
    """Some ``n`` even boundaries inside a cell; those of groups, while it holds several."""
    unit = 1 if cell.one_group() else ONE_GROUP
    first, last = cell.lo // unit + 1, (cell.hi - 1) // unit
    n = min(n, last - first + 1)
    return sorted({(first + (last - first) * i // max(n - 1, 1)) * unit for i in range(n)})


def _cut(cell: Cell, target: int, of: int, slack: float | None) -> Splitter | None:
    """The splitter for the weight ``target / of`` that a cell gives; None where the cell must be cut finer.

    Its ends serve within ``slack``, if that is given; rows alike, of one weight, can be cut anywhere.
    """
    low, high = target - cell.below * of, (cell.below + cell.weight) * of - target
    left, right = Splitter(cell.lo, cell.rows_below), Splitter(cell.hi, cell.rows_below + cell.rows)
    if slack is not None and min(low, high) <= slack * of:
        return left if low <= high else right
    if cell.hi - cell.lo > 1:
        return None
    each = cell.weight // cell.rows * of
    k = low // each + (2 * (low % each) > each)
    return left if not k else right if k == cell.rows else Splitter(cell.lo, cell.rows_below + k, inside=True)


def splitters(keyed: DataFrame, shards: int, parts: int, tolerance: float) -> tuple[list[Splitter], list[Splitter]]:
    """The ``shards - 1`` splitters of shards, and splitters of some ``shards * parts`` tasks.

    ``keyed`` has ``key``, its halves ``group`` and ``row`` as numbers, and ``weight``; it is read once a round. The driver gets a row for each cell: ``PROBES`` and one for each splitter.
    """
    total = keyed.agg(*_span()).first()
    if not total.n:
        return [], []
    of = shards * parts
    least, most = _bounds(total)
    whole = Cell(least, most + 1, 0, 0, int(total.w), total.n)
    open_, found = {i: (whole, True) for i in range(1, of)}, {}
    near = LOOSE * whole.weight / of
    while open_:
        for i, (cell, whole_groups) in list(open_.items()):
            ends = near if i % parts else tolerance * whole.weight / shards if whole_groups and cell.one_group() else None
            if cut := _cut(cell, i * whole.weight, of, ends):
                found[i] = cut
                del open_[i]
        cells = sorted({c for c, _ in open_.values()}, key=lambda c: c.lo)
        if not cells:
            break
        inner = {c: _probes(c, max(2, PROBES // len(cells))) for c in cells}
        probes = sorted({p for c in cells for p in (c.lo, *inner[c], c.hi)})
        counts = histogram(keyed, probes)
        at = {p: k + 1 for k, p in enumerate(probes)}
        finer = {}
        for c in cells:
            below, rows_below, finer[c] = c.below, c.rows_below, []
            for k in range(at[c.lo], at[c.hi]):
                if k in counts:
                    w, n, a, z = counts[k]
                    finer[c].append(Cell(a, z + 1, below, rows_below, w, n))
                    below, rows_below = below + w, rows_below + n
        for i, (c, _) in open_.items():
            hit = next(x for x in finer[c] if i * whole.weight < (x.below + x.weight) * of)
            open_[i] = (hit, not c.one_group())
    return [found[i] for i in range(parts, of, parts)], sorted(found.values(), key=lambda s: (s.key, s.rank))


def task_of(cuts: list[Splitter], key: Column, salt: Column) -> Column:
    """The task of a row: the number of splitters left of it; rows alike that splitters run through are dealt out by ``salt``."""
    keys, lower = [s.key for s in cuts], [s.key - (not s.inside) for s in cuts]
    high = position(_keys(keys), len(keys), key)
    if not any(s.inside for s in cuts):
        return high
    low = position(_keys(lower), len(lower), key, below=True)
    return (low + F.pmod(salt, high - low + 1)).cast("int")


def sharded(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", law: str = "bytes", tolerance: float = TOLERANCE, part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text and 1), ``shard`` and ``slot``, gapless from 0 in each shard in the order of the keys.

    ``law`` is ``bytes``, shards of near equal sizes, or ``rows``, of counts at most one apart. The rows are written to the shared folder in
    the order of shards and slots; a shard's rows are read from there, or written elsewhere with ``partitionBy("shard")``.
    """
    if law not in ("bytes", "rows"):
        raise ValueError(f"no law {law!r}")
    size = (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")
    number = lambda at: F.conv(F.substring("hex", at, DIGITS), 16, 10).cast("long")
    hexed = docs.select(place_key(text, doc_id).alias("hex"), size.alias("size"))
    keyed = written(hexed.select(F.unhex("hex").alias("key"), number(1).alias("group"), number(DIGITS + 1).alias("row"), "size"))
    weight = F.col("size") if law == "bytes" else F.lit(1).cast("long")
    parts = max(1, min(-(-(keyed.agg(F.sum("size")).first()[0] or 0) // (shards * part_bytes)), MAX_PARTS // shards))
    bounds, cuts = splitters(keyed.withColumn("weight", weight), shards, parts, tolerance if law == "bytes" else 0)

    plain = docs.drop("size", "shard", "slot")
    key, task, row = fresh(docs, "key", "task", "row")
    dealt = plain.withColumn(key, F.unhex(place_key(text, doc_id))).withColumn(task, task_of(cuts, F.col(key), F.monotonically_increasing_id()))
    done = dealt.repartitionById(len(cuts) + 1, task).sortWithinPartitions(key).drop(key, task)
    done = written(done.withColumn(row, F.monotonically_increasing_id()))

    part, inner = F.shiftright(row, ROWS_IN_PART).cast("int"), F.col(row).bitwiseAND((1 << ROWS_IN_PART) - 1)
    counts = {r.part: r.n for r in done.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # a row a task
    before = list(accumulate((counts.get(k, 0) for k in range(max(counts, default=0) + 1)), initial=0))
    starts = [0, *[b.rank for b in bounds]]
    first = _longs(starts)
    ranked = done.withColumn(row, _longs(before)(part + 1) + inner)
    # a shard without rows starts where the next one does: the last that starts at or before a row has it
    out = ranked.withColumns({"size": size, "shard": (position(first, len(starts), F.col(row)) - 1).cast("int")})
    return out.withColumn("slot", F.col(row) - first(F.col("shard") + 1)).select(*columns([*plain.columns, "size", "shard", "slot"]))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return sharded(docs).select(
        "doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def oracle(shards: int = SHARDS, percent: int = round(100 * TOLERANCE)) -> str:
    """DuckDB SQL for ``op12_sharding``; weights are counted times ``shards``, so that all is in whole numbers."""
    return f"""
WITH crcs AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
d AS (SELECT doc_id, coalesce(text, '') AS t, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size FROM documents),
k AS (SELECT *, substr(md5(t), 1, {DIGITS}) AS g, substr(md5(t), 1, {DIGITS}) || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(t)), 1, {DIGITS}) AS key FROM d),
n AS (SELECT *, row_number() OVER (ORDER BY key) - 1 AS rank FROM k),
r AS (SELECT *, {shards} * (sum(size) OVER (ORDER BY rank) - size) AS low, {shards} * sum(size) OVER (ORDER BY rank) AS high FROM n),
g AS (SELECT min(low) AS low, max(high) AS high, min(rank) AS r0, max(rank) + 1 AS r1 FROM r GROUP BY g),
goal AS (SELECT i * total AS goal, total FROM (SELECT sum(size) AS total FROM d), range(1, {shards}) AS t(i)),
cut AS (SELECT CASE WHEN 100 * least(goal - g.low, g.high - goal) <= {percent} * total THEN CASE WHEN goal - g.low <= g.high - goal THEN r0 ELSE r1 END
          WHEN goal - r.low <= r.high - goal THEN rank ELSE rank + 1 END AS place
        FROM goal JOIN g ON goal >= g.low AND goal < g.high JOIN r ON goal >= r.low AND goal < r.high),
cuts AS (SELECT list_sort(list(place)) AS cuts FROM cut)
SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(t), '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, v: xor(c >> 8, crc[xor(c & 255, v) + 1])), 4294967295) AS text_crc32,
  'bytes' AS law, len(list_filter(cuts, lambda x: x <= rank))::INT AS shard, (rank - coalesce(list_max(list_filter(cuts, lambda x: x <= rank)), 0))::BIGINT AS slot, NULL::INT AS grown_shard
FROM r, crcs, cuts"""


QUERIES = {"op12_sharding": op12_sharding}
ORACLE_SQL = {"op12_sharding": oracle()}
