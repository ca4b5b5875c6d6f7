import random
from collections import defaultdict

import pytest

from weft.llm import sharding as S


def places(df, **kw):
    out = S.sharded(df, **kw)
    rows = out.collect()
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r)
    for of in shards.values():
        assert sorted(r.slot for r in of) == list(range(len(of)))
    return out, shards


@pytest.mark.parametrize("part_bytes", [S.PART_BYTES, 2000])
def test_bytes_are_near_equal_and_groups_stay(spark, part_bytes):
    r = random.Random(4)
    texts = ["".join(r.choices("abc dé", k=r.randint(1, 400))) for _ in range(900)]
    rows = [(i, texts[r.randrange(900) if i % 5 else i % 40]) for i in range(2000)]
    _, shards = places(spark.createDataFrame(rows, "doc_id long, text string"), shards=5, part_bytes=part_bytes)
    sizes = {s: sum(x.size for x in of) for s, of in shards.items()}
    total, longest = sum(sizes.values()), max(x.size for of in shards.values() for x in of)
    assert len(sizes) == 5 and sum(map(len, shards.values())) == 2000
    assert max(sizes.values()) - min(sizes.values()) <= 2 * S.TOLERANCE * total / 5 + longest
    where = defaultdict(set)
    for s, of in shards.items():
        for x in of:
            where[x.text].add(s)
    assert sum(len(s) > 1 for s in where.values()) <= 4  # a splitter cuts one group at most


@pytest.mark.parametrize("part_bytes", [S.PART_BYTES, 300])
def test_rows_alike_are_cut(spark, part_bytes):
    """A group of any size is spread, though nothing tells its rows apart."""
    df = spark.createDataFrame([(7, "the same text again")] * 900 + [(i, f"other {i}") for i in range(100)], "doc_id long, text string")
    out, shards = places(df, shards=4, part_bytes=part_bytes)
    sizes = [sum(x.size for x in of) for of in shards.values()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 0.03 * sum(sizes) / 4 + 20
    _, by_rows = places(df, shards=7, law="rows", part_bytes=part_bytes)
    counts = [len(of) for of in by_rows.values()]
    assert max(counts) - min(counts) <= 1 and sum(counts) == 1000


def test_same_places_however_partitioned(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    a, b, c = (sorted(S.sharded(d, shards=6, part_bytes=p).select("doc_id", "shard", "slot").collect()) for d, p in ((docs, S.PART_BYTES), (docs.repartition(7), S.PART_BYTES), (docs, 5000)))
    assert a == b == c


def test_edges(odd_docs, no_docs, spark):
    clash = odd_docs.selectExpr("*", "1 AS __key", "2 AS __task", "3 AS __ROW", "'x' AS shard", "'y' AS `a.b`")
    out, shards = places(clash)
    assert sum(map(len, shards.values())) == odd_docs.count()
    assert {(r["__key"], r["__task"], r["__ROW"], r["a.b"]) for of in shards.values() for r in of} == {(1, 2, 3, "y")}
    assert {r.size for of in shards.values() for r in of if r.doc_id in (3, 4)} == {1}
    assert S.sharded(no_docs).count() == 0 and set(S.sharded(no_docs).columns) == set(no_docs.columns) | {"size", "shard", "slot"}
    with pytest.raises(ValueError):
        S.sharded(no_docs, law="key")
