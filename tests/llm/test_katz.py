import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from weft.llm import katz


def brute(docs, order):
    """Katz by definition, one document and token after the other."""
    docs = [(k, (t or "").encode().lower().split() + [katz.END], h) for k, t, h in docs]
    one, grams = collections.Counter(), {n: collections.Counter() for n in range(2, order + 1)}
    for _, w, h in docs:
        if h:
            continue
        one.update(w)
        s = [katz.BEGIN, *w]
        for n, g in grams.items():
            g.update(tuple(s[i - n + 1 : i + 1]) for i in range(max(1, n - 1), len(s)))
    total, begins = sum(one.values()), sum(not h for *_, h in docs)
    d = {1: katz.discounts([sum(v == r for v in one.values()) for r in range(1, katz.CUT + 2)])}
    d |= {n: katz.discounts([sum(v == r for v in g.values()) for r in range(1, katz.CUT + 2)]) for n, g in grams.items()}
    left = lambda c, n: d[n][c] * c if c <= katz.CUT else c - katz.CUT * (1 - d[n][katz.CUT])
    unknown = 1 - sum(left(c, 1) for c in one.values()) / total
    after = {n: collections.defaultdict(list) for n in grams}
    for n, g in grams.items():
        for x in g:
            after[n][x[:-1]].append(x[-1])

    def count(h):
        return (begins if h[0] == katz.BEGIN else one[h[0]]) if len(h) == 1 else grams[len(h)][h]

    def p(h, w):
        if not h:
            return left(one[w], 1) / total if w in one else unknown
        n = len(h) + 1
        if c := grams[n].get((*h, w)):
            return left(c, n) / count(h)
        if not count(h):
            return p(h[1:], w)
        seen = after[n][h]
        return p(h[1:], w) * (1 - sum(left(grams[n][(*h, x)], n) for x in seen) / count(h)) / (1 - sum(p(h[1:], x) for x in seen))

    for h in list(after[order])[:3] if order > 1 else []:
        assert abs(sum(p(h, w) for w in one) + p(h, b"never seen") - 1) < 1e-9
    out = []
    for k, w, h in docs:
        s = [katz.BEGIN, *w]
        score = sum(math.log10(p(tuple(s[max(0, i - order + 1) : i]), s[i])) for i in range(1, len(s)))
        base = sum(math.log10((one[x] + 0.1) / (total + 0.1 * (len(one) + 1))) for x in w)
        out.append((k, h, len(w), sum(x in one for x in w), total, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_brute_force(spark, order):
    r = random.Random(order)
    words = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(r.choice(words[: r.randint(1, 30)]) for _ in range(r.randint(0, 40))) if i % 9 else None, r.random() < 0.2) for i in range(120)]
    docs += [(5, "w1 w2", False), (5, "w1 w2", False), (None, "W1 é", True)]
    df = spark.createDataFrame(docs, "doc_id long, text string, h boolean").repartition(3)
    got = katz.score(df, F.col("h"), order=order, batch_tokens=300).collect()
    rows = sorted(((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6), round(x.score, 6)) for x in got), key=str)
    assert rows == brute(docs, order)


def test_edges(odd_docs, no_docs):
    assert katz.score(odd_docs, F.lit(False)).count() == odd_docs.count()
    assert katz.score(no_docs, F.lit(False)).count() == 0
    none = katz.score(odd_docs, F.lit(True)).collect()
    assert {r.train_tokens for r in none} == {0} and all(r.score == 0 for r in none)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_other_texts_are_scored_from_the_stored_tables(spark, order, tmp_path):
    r = random.Random(order)
    words = [f"w{i}" for i in range(25)]
    text = lambda n: " ".join(r.choice(words[: r.randint(1, 25)]) for _ in range(n))
    one = [(i, text(r.randint(0, 40)), False) for i in range(80)]
    two = [(1000 + i, f"{text(r.randint(0, 30))} new{i}", True) for i in range(30)] + [(2000, None, True)]
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, h boolean").repartition(3)
    folder = f"file://{tmp_path}/model"
    katz.score(make(one), F.col("h"), order=order, batch_tokens=300, folder=folder).count()
    got = katz.score(make(two), order=order, batch_tokens=200, model=folder).collect()
    rows = sorted(((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6), round(x.score, 6)) for x in got), key=str)
    assert rows == [x for x in brute(one + two, order) if x[1]]
    with pytest.raises(ValueError):
        katz.score(make(two), order=order + 1, model=folder)


def test_tables_hold_the_model(spark, tmp_path):
    docs = [(0, "a b a b c", False), (1, "a b", False), (2, "z", True)]
    folder = f"file://{tmp_path}/model"
    katz.score(spark.createDataFrame(docs, "doc_id long, text string, h boolean"), F.col("h"), folder=folder).count()
    rows = katz.tables(spark, folder).collect()
    assert {bytes(r.key): r["count"] for r in rows if r.kind == "word"} == {b"a": 3, b"b": 3, b"c": 1, katz.END: 2, katz.BEGIN: 2}
    # begin a, a b, b a, b c, c end, b end
    assert sorted(r["count"] for r in rows if r.kind == "gram") == [1, 1, 1, 1, 2, 3]
    contexts = [r for r in rows if r.kind == "context"]
    assert len(contexts) == 4 and all(0 < r.used < 1 and 0 < r.lower < 1 for r in contexts)
    assert {r.order for r in rows} == {1, 2}


def test_query_has_the_contracts_columns(spark, sf_dir, duck):
    rows = katz.op4_katz(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    import zlib

    words = {d.doc_id: [*(d.text or "").encode().lower().split(), katz.END] for d in docs}
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 10 == 0 for d in docs}
    c = collections.Counter(w for k, ws in words.items() if not held[k] for w in ws)
    total = sum(c.values())
    assert sorted(r.doc_id for r in rows) == sorted(words)
    for r in rows:
        w = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(w), sum(x in c for x in w), total)
        assert abs(r.base_score - sum(math.log10((c[x] + 0.1) / (total + 0.1 * (len(c) + 1))) for x in w)) < 1e-6 * len(w)
