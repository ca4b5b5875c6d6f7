import random

import numpy as np
from pyspark.sql import functions as F

from weft.llm import ordinal as O
from weft.llm import toxicity as T


def all_cosines(index, vectors, h, n):
    """Cosines with all examples, one by one."""
    weights = dict(zip(index.term.tolist(), index.worth.tolist(), strict=True))

    def vector(h, n):
        w = {a: (1 + np.log(b)) * weights.get(a, index.unknown) for a, b in zip(h.tolist(), n.tolist(), strict=True)}
        length = sum(x * x for x in w.values()) ** 0.5
        return {a: x / length for a, x in w.items()}

    q = vector(h, n)
    return np.array([sum(x * q.get(a, 0.0) for a, x in vector(*v).items()) for v in vectors])


def held_against_all(index, vectors, queries, k=9):
    for (h, n), (found, cosine) in zip(queries, index.nearest(queries, k), strict=True):
        want = all_cosines(index, vectors, h, n)
        order = np.lexsort((np.arange(len(want)), -np.round(want, 6)))[:k]
        order = order[want[order] > 0]
        assert np.allclose(cosine, want[order], atol=1e-6) and np.allclose(want[found], want[order], atol=1e-6)


def test_nearest_are_those_of_all_cosines():
    r = random.Random(2)

    def text():
        return " ".join(f"t{int(r.random() ** 2 * 80)}" for _ in range(r.randint(0, 9)))

    vectors = [T.hashed_counts(text()) for _ in range(700)]
    index = T.BlockMaxIndex(vectors, [r.random() < 0.2 for _ in vectors])
    held_against_all(index, vectors, [T.hashed_counts(text() + " unknown" * r.randint(0, 1)) for _ in range(150)])


def test_nearest_of_the_tables_texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    known = [r for r in rows if toxic.get(r.doc_id) is not None]
    vectors = [T.hashed_counts(r.text) for r in known]
    index = T.BlockMaxIndex(vectors, [toxic[r.doc_id] for r in known])
    held_against_all(index, vectors, [T.hashed_counts(r.text) for r in rows[:60]])


def test_terms_weigh_by_frequency_and_label():
    vectors = [T.hashed_counts(t) for t in ("bad word", "bad thing", "good word", "good thing")]
    index = T.BlockMaxIndex(vectors, [1, 1, 0, 0])
    worth = {w: index.worth[np.searchsorted(index.term, T.hashed_counts(w)[0][0])] for w in ("bad", "good", "word")}
    idf = np.log(5 / 3) + 1
    assert np.isclose(worth["bad"], idf * (T.FLOOR + 1)) and np.isclose(worth["good"], worth["bad"]) and np.isclose(worth["word"], idf * T.FLOOR)


def test_no_text_votes_on_itself():
    texts = ["vile thing here", "vile thing here", "vile sort there", "nice thing here", "nice sort there"]
    c = T.Classifier([T.hashed_counts(t) for t in texts], list("abcde"), [1, 1, 1, 0, 0])
    for t in texts:
        [(_, found, _)] = c.votes([T.hashed_counts(t)])
        assert found and not {i for i, x in enumerate(texts) if x == t} & set(found)
    assert {0, 1} <= set(c.votes([T.hashed_counts("vile thing here now")])[0][1])


def test_vote_and_calibration():
    c = T.Classifier([T.hashed_counts(t) for t in ("a b", "a c", "d e")], list("xyz"), [1, 0, 0], k=2)
    [(v, found, cosine)] = c.votes([T.hashed_counts("a b c")])
    assert set(found) == {0, 1} and np.isclose(v, (cosine[found.index(0)] + T.PRIOR / 3) / (sum(cosine) + T.PRIOR))
    c.calibrate([(0.1, 0.0), (0.2, 1.0), (0.3, 0.0), (0.9, 1.0), (None, 0.0)])
    assert np.allclose(c.at, [0.1, 0.25, 0.9]) and np.allclose(c.to, [1 / 6, 4 / 9, 2 / 3]) and np.isclose(c.alone, 1 / 6)


def test_toxicity_query_has_the_contracts_columns(spark, sf_dir):
    import zlib

    rows = T.op6_toxicity(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7)
        # labels of held-out rows are not evidence
        assert all(k in {str(x) for x in toxic} and zlib.crc32(k.encode()) % 3 != 1 for k in r.evidence)


def corpus(spark, n=600):
    r = random.Random(7)
    words = [f"word{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        toxic, good = i % 5 == 0, i % 4 != 0
        w = [r.choice(words) for _ in range(30)] + (["nasty", "vile"] if toxic else []) + ([] if good else ["###", "***"] * 5)
        r.shuffle(w)
        docs.append((i, " ".join(w)))
        labels.append((i, int(good), int(toxic)))
    docs += [(None, None), (n, ""), (n + 1, None)]
    labels += [(None, 1, 1), (n, None, None), (3, 1, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {k: (q, t) for k, q, t in labels[:n]}


def test_toxicity_on_held_out_rows(spark, odd_docs, no_docs):
    docs, labels, truth = corpus(spark)
    c = T.fit(docs, labels)
    rows = T.score(docs, c).withColumn("held", T.digest_mod(F.col("doc_id"), 3) == 1).collect()
    held = [r for r in rows if r.held and r.doc_id in truth]
    assert len(held) > 100 and np.mean([(r.score >= T.PREDICT) == bool(truth[r.doc_id][1]) for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    assert T.score(odd_docs, c).count() == odd_docs.count() and T.score(no_docs, c).count() == 0
    few = T.fit(docs, labels, most=50)
    assert len(few.keys) == 50 and len(T.fit(docs, labels, max_bytes=2000).keys) < 20
    assert set(T.fit(docs, labels, max_bytes=2000).keys) < set(T.fit(docs, labels).keys)
    # an example that does not fit is left out, wherever it stands; the rest goes on
    first = T.fit(docs, labels, most=1).keys[0]
    most = T.fit(docs.withColumn("text", F.when(F.col("doc_id") == int(first), F.array_join(F.sequence(F.lit(0), F.lit(5000)), " ")).otherwise(F.col("text"))), labels, max_bytes=20_000)
    assert first not in most.keys and len(most.keys) > 20
    assert len(T.fit(docs, labels, plain=True).keys) == len(c.keys)
    none = T.fit(docs, labels.limit(0))
    assert {r.score for r in T.score(docs, none).collect()} == {0.0}


def test_quality_on_held_out_rows(spark, odd_docs, no_docs):
    docs, labels, truth = corpus(spark)
    m = O.fit(docs, labels, O.grade_of_labels(), 3)
    few = O.fit(docs, labels, O.grade_of_labels(), 3, max_bytes=20_000)
    assert np.any(few.weights != m.weights) and not np.any(O.fit(docs, labels, O.grade_of_labels(), 3, max_bytes=10).weights)
    assert m.thresholds == sorted(m.thresholds)
    rows = O.score(docs, m).withColumn("held", T.digest_mod(F.col("doc_id"), 3) == 1).collect()
    held = [r for r in rows if r.held and r.doc_id in truth]
    assert np.mean([(r.tails[0] >= 0.5) == bool(truth[r.doc_id][0]) for r in held]) > 0.95
    assert all(r.tails[0] >= r.tails[1] and abs(r.expected_grade - sum(r.tails)) < 1e-9 for r in rows)
    assert O.score(odd_docs, m).count() == odd_docs.count() and O.score(no_docs, m).count() == 0
    assert np.allclose(O.OrdinalModel.fit([], [], 3).tails(0.0), [2 / 3, 1 / 3])


def test_gradient_lowers_the_loss():
    rows = [O.features("good text here"), O.features("bad *** ***")] * 10
    m = O.OrdinalModel.fit(rows, [1, 0] * 10, 2)
    good, bad = m.score("good text here")[0], m.score("bad *** ***")[0]
    assert good > 0.9 and bad < 0.1


def test_long_texts_are_fitted_on_all_features(spark, monkeypatch):
    text = " ".join(f"word{i}" for i in range(9000))
    docs = spark.createDataFrame([(i, text) for i in range(6)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(O.OrdinalModel, "fit", classmethod(lambda cls, rows, *a, **b: seen.extend(rows)))
    O.fit(docs, labels, F.col("quality"), 2)
    want = sorted(O.features(text)[0])
    assert len(want) > 4000 and seen and all(list(s) == want for s, _ in seen)


def plain_loss(model, rows, grades, n, penalty=1e-4):
    """The penalised mean loss of the cumulative-link model, row by row, from its definition."""
    import math

    total = 0.0
    for (slots, values), y in zip(rows, grades, strict=True):
        z = sum(model.weights[s] * v for s, v in zip(slots, values, strict=True))
        tail = [1.0, *[1 / (1 + math.exp(t - z)) for t in model.thresholds], 0.0]
        total -= math.log(tail[y] - tail[y + 1])
    return total / len(rows) + penalty / 2 * float((model.weights**2).sum())


def test_fit_is_the_least_loss():
    """No step in any weight or threshold lowers the loss of the fitted model, computed from its definition."""
    r = random.Random(8)
    rows, grades = [], []
    for _ in range(60):
        v = [r.random() for _ in range(4)]
        rows.append(([3, 17, 40, 99], v))
        grades.append(min(2, max(0, int(3 * (0.7 * v[0] - 0.4 * v[1] + 0.3 + 0.3 * r.random())))))
    assert set(grades) == {0, 1, 2}
    m = O.OrdinalModel.fit(rows, grades, 3, rounds=3000, rate=0.02)
    best = plain_loss(m, rows, grades, 3)
    assert best < plain_loss(O.OrdinalModel.fit(rows, grades, 3, rounds=1), rows, grades, 3)
    for step in (0.05, -0.05):
        for s in rows[0][0]:
            w = m.weights.copy()
            w[s] += step
            assert plain_loss(O.OrdinalModel(w, m.thresholds), rows, grades, 3) > best - 1e-5
        for k in (0, 1):
            t = list(m.thresholds)
            t[k] += step
            assert t[0] < t[1] and plain_loss(O.OrdinalModel(m.weights, t), rows, grades, 3) > best - 1e-5
    assert np.count_nonzero(m.weights) == 4


def test_quality_query_has_the_contracts_columns(spark, sf_dir):
    import zlib

    rows = O.op2_ordinal(spark, sf_dir).collect()
    docs = [r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 1 >= r.p_good >= r.p_best >= 0
        assert abs(r.expected_grade - r.p_good - r.p_best) < 1e-9 and r.kept == (r.p_good >= O.KEEP)
