import random
import re
from collections import Counter
from itertools import permutations

from weft.llm import filter_audit as A


def brute(rows, labels):
    """Every order applied to every document, one after the other."""
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    docs = [(i, t or "", lang or "") for i, t, lang in rows]
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    fails = []
    for i, t, _ in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        caps = len(re.findall("[A-Z]", t))
        fails.append({f for f, bad in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * caps > 10 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and least[t] < i)) if bad})
    out, shapley = {}, Counter()
    for part in {d[2] for d in docs}:
        mine = [(d[0], f) for d, f in zip(docs, fails) if d[2] == part]
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                here = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                out[part, "".join(order), k + 1] = (
                    len(left), len(here), sum(f in d[1] for d in mine) - len(here), sum(d[1] == {f} for d in mine), sum(d[0] in good for d in here), sum(d[0] in toxic for d in here),
                )
                shapley[part, f] += len(here)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS part", "1 AS mask", "2 AS id")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in A.steps(A.masks(docs, marks)).collect()}


def test_against_every_order(spark):
    r = random.Random(9)
    long = [" ".join(f"w{r.randint(0, 400)}" for _ in range(r.randint(60, 160))) for _ in range(12)]
    texts = [*long, *(x.upper() for x in long[:5]), *(x + " #tag" for x in long[:5]), "", None, "SHORT", "Éé \x0b\x0c "]
    rows = [(r.randint(0, 60) if r.random() < 0.95 else None, r.choice(texts), r.choice(["en", "de", "", None])) for _ in range(160)]
    rows += [(99, "copy", "en")] * 40 + [(98, "copy", "de")] * 3 + [(97, "copy", None)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 70, 2)] + [(4, 1, 1), (None, 1, 1)]
    out = got(spark, rows, labels)
    assert len(out) == 3 * 600 and out == brute(rows, labels)


def test_edges(spark, odd_docs, no_docs):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.steps(A.masks(no_docs, marks)).count() == 0
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text", "lang").collect()]
    out = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in A.steps(A.masks(odd_docs, marks)).collect()}
    assert out == brute(rows, [])
