"""Set similarity join on word shingles by chosen paths.

A text's set holds the hashes of its runs of ``SHINGLE`` words. Texts of equal
sets become one representative. Each set is embedded as ``SKETCH`` min-hash tokens;
a token is equal in two sets with probability their Jaccard similarity. Every run
starts at a root path. A set extends a path by each of its tokens with probability
1 / (threshold * SKETCH), by a hash of path and token, so similar sets choose
alike and meet in the same bucket. Buckets of more than ``LIMIT`` sets are split
again in the same way as long as that makes them smaller, ``DEPTH`` times at most; small
ones are compared by brute force. A bucket that keeps ``CROWD`` of its parent's sets is a
crowd of near copies, which no split parts: it is dealt into blocks, and every two
blocks meet in a task. Runs are repeated until a pair at the threshold meets with
probability ``RECALL`` after two splits (15 runs; then 0.996 after four, 0.983 after six).

Sets that look similar by their tokens are joined to candidate groups. All pairs
within a group are then decided exactly, on whole shingle sets, each pair in one
task, so links that no bucket showed are found there too. Tasks give numbers of
links and one link of each set towards its class, never the pairs.

Scale: texts are read twice and moved once, and only those of candidates go on; a
path row holds 24 bytes. Copies of a text count as one set, so a crowd of exact
copies costs nothing. Groups beyond ``BLOCK`` sets or ``BLOCK_SHINGLES`` shingles are dealt as
pairs of blocks: a set is sent once for each block, which bounds a task's memory.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ with A-Z lower-cased. Defined results:
a text of fewer words than a shingle, but not none, has one shingle of all its
words; a text without words, or null, has no set, is linked to nothing and alone in
its class. Rows of equal sets are linked to one another; so are repeated rows.
A class's id is its least doc_id that is not null. Other columns than key and text are not read.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alnum_words, columns, fresh, hold, map_text, short_batches, table, written

SHINGLE = 5
#: Links have intersection / union of THRESHOLD or more, compared in whole numbers.
THRESHOLD = (4, 5)
SKETCH = 64
LIMIT = 512
#: Sets and shingles of a block, about: a task holds two blocks, with some 60 bytes a shingle.
BLOCK = 512
BLOCK_SHINGLES = 500_000
DEPTH = 6
CROWD = 0.75
RECALL = 0.9999
#: Candidates agree in this share of their tokens: five deviations below the threshold.
LOOSE = 0.55


def runs_needed(recall: float = RECALL, depth: int = 2) -> int:
    """Runs after which a pair at the threshold has met in a bucket of this depth with probability ``recall``."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)  # a shared token is chosen once on average at the threshold
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None):
    """The distinct 64-bit hashes of the text's shingles, sorted."""
    import numpy as np
    import xxhash

    words = alnum_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(SHINGLE, len(h))
    x = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        x = _mix(x + h[i : len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(x)


def sketch(s):
    """``SKETCH`` min-hash tokens of 32 bits."""
    import numpy as np

    a = _mix(np.arange(1, SKETCH + 1, dtype=np.uint64))
    least = np.full(SKETCH, np.iinfo(np.uint64).max)
    for i in range(0, len(s), 4096):
        least = np.minimum(least, _mix(s[i : i + 4096, None] ^ a).min(axis=0))
    return _mix(least).astype(np.uint32)


def with_sketches(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``sig`` (128-bit digest of the set, null without words), ``n_set`` and ``sketch``."""

    def make():
        import xxhash

        def run(texts):
            out = [[], [], []]
            for t in texts:
                s = shingles(t)
                row = (xxhash.xxh3_128_digest(s.tobytes()), len(s), sketch(s).tobytes()) if len(s) else (None, 0, None)
                for col, x in zip(out, row, strict=True):
                    col.append(x)
            return out

        return run

    return map_text(docs, make, "sig binary, n_set int, sketch binary", [text])


PATHS = "path long, sig binary, above long"


def _choose(rows: DataFrame, runs: int) -> DataFrame:
    """Extends ``path`` of (path, sig, sketch, n) by the chosen tokens; a null path starts ``runs`` roots. ``n`` stays as ``above``."""
    kept = int((1 << 64) * THRESHOLD[1] / (THRESHOLD[0] * SKETCH))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        hold(__name__)
        place = _mix(np.arange(SKETCH, dtype=np.uint64) + np.uint64(77))
        for b in batches:
            if not b.num_rows:
                continue
            tokens = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint32).reshape(-1, SKETCH)
            tokens = _mix(tokens.astype(np.uint64) ^ place)
            old = b.column(0)
            if old.null_count:
                seeds = _mix(np.arange(1, runs + 1, dtype=np.uint64))
                roots = [np.full(len(tokens), x) for x in seeds]
            else:
                roots = [old.to_numpy().view(np.uint64)]
            for seed in roots:
                chance = _mix(tokens ^ seed[:, None])
                row, col = np.nonzero(chance < np.uint64(kept))
                path = _mix(chance[row, col] + tokens[row, col]).view(np.int64)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(path), b.column(1).take(row), b.column(3).take(row)], names=["path", "sig", "above"])

    return rows.select("path", "sig", "sketch", "n").mapInArrow(run, PATHS)


def _deal(rows: DataFrame, member: str, blocks: Column) -> DataFrame:
    """Adds ``own``, ``i`` and ``j``: every two of a key's blocks meet in one (key, i, j)."""
    blocks = blocks.cast("int")
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")


def _met(rows: DataFrame, key: str, member: str, fn, ddl: str) -> DataFrame:
    """``fn`` over the rows of each (key, i, j), each member once in either block."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(ddl)
    short_batches(rows.sparkSession)

    def run(batches):
        import pyarrow as pa

        hold(__name__)
        schema = to_arrow_schema(kind)
        stream = (r for b in batches for r in b.to_pylist())
        out = []
        for _, group in groupby(stream, key=lambda r: (r[key], r["i"], r["j"])):
            members = [next(same) for _, same in groupby(group, key=lambda r: (r["own"], r[member]))]
            if len(members) > 1 or ddl == LINKS:
                out += fn(members)
            if len(out) > 2000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, key, "i", "j").sortWithinPartitions(key, "i", "j", "own", member).mapInArrow(run, kind)


def _roots(near, whole: bool) -> list[int]:
    """The least index of each index's component: of the rows and columns of ``near`` as they are if ``whole``, else of rows, then columns."""
    import numpy as np

    m = len(near)
    n = m if whole else m + near.shape[1]
    root = np.full(n, -1)
    for first in range(n):
        if root[first] >= 0:
            continue
        root[first] = first
        todo = np.array([first])
        while len(todo):
            if whole:
                met = near[todo].any(axis=0)
            else:
                rows, cols = todo[todo < m], todo[todo >= m] - m
                met = np.concatenate([near[:, cols].any(axis=1), near[rows].any(axis=0)])
            todo = np.flatnonzero(met & (root < 0))
            root[todo] = first
    return root.tolist()


EDGES = "a binary, b binary"


def _alike(members: list[dict]) -> list[dict]:
    """Links members that agree in ``LOOSE`` of their tokens to the first of their group."""
    import numpy as np

    s = np.frombuffer(b"".join(m["sketch"] for m in members), np.uint32).reshape(-1, SKETCH)
    split = sum(m["own"] == members[0]["own"] for m in members) if members[0]["i"] != members[0]["j"] else len(members)
    left, right = (s[:split], s[split:]) if split < len(members) else (s, s)
    agree = np.zeros((len(left), len(right)), np.uint8)
    for k in range(SKETCH):
        agree += left[:, k, None] == right[None, :, k]
    root = _roots(agree >= LOOSE * SKETCH, split == len(members))
    return [{"a": members[i]["sig"], "b": members[r]["sig"]} for i, r in enumerate(root) if r != i]


LINKS = "sig binary, root binary, n_links long, n_texts long"


def _verify(members: list[dict]) -> list[dict]:
    """Exact links of a group: each member's number of them and the first of its class."""
    import numpy as np

    sets = [np.frombuffer(m["shingles"], np.uint64) for m in members]
    size = np.array([len(s) for s in sets], np.int64)
    copies = np.array([m["copies"] for m in members], np.int64)
    n = len(members)
    whole = members[0]["i"] == members[0]["j"]
    split = n if whole else sum(m["own"] == members[0]["own"] for m in members)
    rows = np.repeat(np.arange(n), size)
    _, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    shared = int((count > 1).sum())
    rank = np.empty(len(count), np.int64)
    rank[order] = np.arange(len(count))
    col = rank[inverse]
    by = np.argsort(col, kind="stable")
    rows, col = rows[by], col[by]
    left, right = (slice(0, n), slice(0, n)) if whole else (slice(0, split), slice(split, n))
    both = np.zeros((left.stop - left.start, right.stop - right.start), np.float32)
    for k in range(0, shared, 2048):
        a, b = np.searchsorted(col, [k, min(k + 2048, shared)])
        m = np.zeros((n, min(k + 2048, shared) - k), np.float32)
        m[rows[a:b], col[a:b] - k] = 1
        both += m[left] @ m[right].T
    num, den = THRESHOLD
    linked = (num + den) * both.astype(np.int64) >= num * (size[left, None] + size[None, right])
    if whole:
        np.fill_diagonal(linked, False)
    links, texts = np.zeros(n, np.int64), np.zeros(n, np.int64)
    links[left] += linked @ copies[right]
    texts[left] += linked.sum(axis=1)
    if not whole:
        links[right] += copies[left] @ linked
        texts[right] += linked.sum(axis=0)
    root = _roots(linked, whole)
    return [
        {"sig": m["sig"], "root": members[r]["sig"], "n_links": x, "n_texts": t}
        for m, r, x, t in zip(members, root, links.tolist(), texts.tolist(), strict=True)
        if whole or t
    ]


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows of two keys, written as few files."""
    return written(df.coalesce(max(8, rows // 100_000)))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of (a, b): alternating large and small stars until only stars are left.

    An edge's ends are ordered, ``a`` being the greater. What is joined is written before, so
    both sides of a join are plain shuffles and Spark can split a hub's rows.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = written(e.distinct())
    while True:
        ends = e.select(F.col("a").alias("k"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
        ends = ends.groupBy("k").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        n, tangled = ends.agg(F.sum("up"), F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()
        if not tangled:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())
        least = _small(e.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), n)
        large = _small(e.join(least, F.col("b") == F.col("u"), "left").select("a", F.coalesce("m", "b").alias("b")).distinct(), n)
        least = _small(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), n)
        small = large.join(least, F.col("a") == F.col("u")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = _small(small.union(least).distinct(), 2 * n)


def _tid() -> Column:
    """A digest of the text ``t``; null and empty texts differ."""
    return F.coalesce(F.md5(F.col("t").cast("binary")), F.lit(""))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """One row for each row of ``docs``: ``doc``, ``tid`` (digest of the text), ``root`` (of its class, null without words), ``class_id``, ``n_links``, ``n_texts``."""
    rows = docs.select(*[c.alias(x) for c, x in zip(columns([key, text]), ("doc", "t"), strict=True)]).withColumn("tid", _tid())
    sigs = written(with_sketches(rows, "t").drop("t"))
    reps = sigs.filter("n_set > 0").groupBy("sig").agg(
        F.first("sketch").alias("sketch"), F.first("n_set").alias("n_set"), F.count("*").alias("copies"), F.min("doc").alias("least"), F.min(F.struct("doc", "tid")).alias("at")
    )
    reps = written(reps)
    edges, runs, level = [], runs_needed(recall), 1
    held = reps.withColumns({"path": F.lit(None).cast("long"), "n": F.lit(None).cast("long")})
    while True:
        paths = written(_choose(held, runs))
        sizes = paths.groupBy("path").agg(F.count("*").alias("n"), F.first("above").alias("above")).filter("n > 1")
        open_ = F.lit(level < DEPTH) & (F.col("n") > LIMIT) & (F.col("above").isNull() | (F.col("n") < CROWD * F.col("above")))
        held = paths.drop("above").join(sizes.withColumn("open", open_).drop("above"), "path").join(reps.select("sig", "sketch"), "sig")
        near = _deal(held.filter("NOT open"), "sig", F.ceil(F.col("n") / BLOCK)).drop("n", "open")
        edges.append(written(_met(near, "path", "sig", _alike, EDGES)))
        if sizes.filter(open_).isEmpty():
            break
        held, level = held.filter("open"), level + 1
    groups = written(components(reduce(DataFrame.union, edges)))
    members = groups.join(reps.select(F.col("sig").alias("node"), "copies", "n_set", "at"), "node")
    sizes = members.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_set").alias("shingles"))
    members = members.join(sizes, "root").select(F.col("node").alias("sig"), F.col("root").alias("grp"), "n", F.col("shingles").alias("total"), "copies", F.col("at.doc").alias("m_doc"), F.col("at.tid").alias("m_tid"))
    whole = rows.join(members, (F.col("tid") == F.col("m_tid")) & F.col("doc").eqNullSafe(F.col("m_doc"))).drop("doc", "tid", "m_doc", "m_tid")
    whole = whole.dropDuplicates(["sig"])  # of repeated rows one
    whole = map_text(whole, lambda: lambda texts: [[shingles(t).tobytes() for t in texts]], "shingles binary", ["t"]).drop("t")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES))
    links = written(_met(_deal(whole, "sig", blocks).drop("n", "total"), "grp", "sig", _verify, LINKS))
    counted = links.groupBy("sig").agg(F.sum("n_links").alias("n_links"), F.sum("n_texts").alias("n_texts")).filter("n_texts > 0")
    roots = components(links.select(F.col("sig").alias("a"), F.col("root").alias("b")))
    classed = roots.join(reps.select(F.col("sig").alias("node"), "least"), "node")
    least = classed.groupBy("root").agg(F.min("least").alias("class_least"))
    classed = classed.join(least, "root").select(F.col("node").alias("sig"), "root", "class_least")
    found = reps.select("sig", "copies", "least").join(counted, "sig", "left").join(classed, "sig", "left")
    found = found.select(
        "sig",
        F.coalesce("root", "sig").alias("root"),
        F.coalesce("class_least", "least").alias("class_id"),
        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
    )
    # both sides of this join are plain shuffles, so that Spark can split a crowd of copies
    out = sigs.select("doc", "tid", "sig").join(written(found), "sig", "left")
    return out.select(
        "doc", "tid", "root", F.when(F.col("root").isNull(), F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"),
    )


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``class_id``, ``n_links`` (other rows linked), ``n_texts`` (other sets linked)."""
    return classes(docs, key, text, recall).select(F.col("doc").alias(key), "class_id", "n_links", "n_texts")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """One row of each class, with all its columns: that of the class's id, by the least digest of its text where several bear that id.

    Texts without words are classes of their own; of rows with equal key and text, one stays: that
    of the least hash of all its columns.
    """
    own = classes(docs, key, text, recall).filter(F.col("doc").eqNullSafe(F.col("class_id")))
    own = own.groupBy(F.coalesce("root", F.col("tid").cast("binary")).alias("class"), F.col("root").isNull().alias("alone"), "doc", "tid").agg(F.count("*").alias("n"))
    alone = own.filter("alone").select("doc", "tid", "n")
    first = own.filter("NOT alone").groupBy("class").agg(F.min(F.struct("tid", "doc", "n")).alias("x")).select("x.doc", "x.tid", "x.n")
    doc, tid, n, row = fresh(docs, "kept_doc", "kept_tid", "kept_n", "kept_row")
    kept = written(alone.union(first)).select(F.col("doc").alias(doc), F.col("tid").alias(tid), F.col("n").alias(n))
    k, t = columns([key, text])
    cols = columns(docs.columns)
    match = F.col(doc).eqNullSafe(k) & (F.col(tid) == F.coalesce(F.md5(t.cast("binary")), F.lit("")))
    once = docs.join(kept.filter(F.col(n) == 1), match, "left_semi").select(*cols)
    if kept.filter(F.col(n) > 1).isEmpty():
        return once
    some = docs.join(kept.filter(F.col(n) > 1), match).groupBy(doc, tid).agg(F.min_by(F.struct(*cols), F.xxhash64(*cols)).alias(row))
    return once.union(some.select(f"{row}.*"))


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def classes_sql(source: str = "documents") -> str:
    """DuckDB SQL: ``classed`` has doc_id, class_id, n_links and n_texts of each row of ``source``."""
    az = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    num, den = THRESHOLD
    return f"""
s0 AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), {az}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {source}),
s1 AS (SELECT rid, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1), lambda i: array_to_string(w[i : i + {SHINGLE - 1}], ' ')))) AS g FROM s0 WHERE len(w) > 0),
s2 AS (SELECT min(rid) AS rep, list(rid) AS rids, count(*) AS copies, len(any_value(g)) AS n, any_value(g) AS g FROM s1 GROUP BY md5(g::VARCHAR)),
s3 AS (SELECT rep, n, unnest(g) AS x FROM s2),
s4 AS (SELECT a.rep AS a, b.rep AS b, a.n AS an, b.n AS bn, count(*) AS c FROM s3 a JOIN s3 b ON a.x = b.x AND a.rep <> b.rep GROUP BY ALL),
s5 AS (SELECT a, b FROM s4 WHERE {num + den} * c >= {num} * (an + bn)),
s6 AS (SELECT a, count(*) AS n_texts, sum(copies) AS n_links FROM s5 JOIN s2 ON b = rep GROUP BY a),
s8 AS (SELECT rep, any_value(copies) AS copies, any_value(rids) AS rids, coalesce(any_value(n_texts), 0) AS n_texts, coalesce(any_value(n_links), 0) AS n_links, min(m) AS m
       FROM (SELECT s2.*, least(s2.rep, coalesce(r.b, s2.rep)) AS m FROM s2 LEFT JOIN reach r ON r.a = s2.rep) x LEFT JOIN s6 ON s6.a = x.rep GROUP BY rep),
s9 AS (SELECT rid, m, n_texts, n_links + copies - 1 AS n_links FROM (SELECT unnest(rids) AS rid, m, n_texts, n_links, copies FROM s8)),
s10 AS (SELECT m, min(doc_id) AS class_id FROM s9 JOIN s0 USING (rid) GROUP BY m),
classed AS (SELECT s0.rid, doc_id, CASE WHEN s9.rid IS NULL THEN doc_id ELSE class_id END AS class_id,
  coalesce(n_links, 0)::BIGINT AS n_links, coalesce(n_texts, 0)::BIGINT AS n_texts
FROM s0 LEFT JOIN s9 ON s0.rid = s9.rid LEFT JOIN s10 ON s9.m = s10.m)""".replace(
        "\ns8 AS", "\nreach AS (SELECT a, b FROM s5 UNION SELECT r.a, s5.b FROM reach r JOIN s5 ON r.b = s5.a),\ns8 AS"
    )


ORACLE = f"""WITH RECURSIVE {classes_sql()}
SELECT doc_id, class_id, n_links, n_texts FROM classed"""

QUERIES = {"op5_chosen_path": op5_chosen_path}
ORACLE_SQL = {"op5_chosen_path": ORACLE}
