import numpy as np
from pyspark.sql import functions as F

from weft.llm import decontamination as D
from weft.llm import quality_rules as Q
from weft.llm import url_filters as U


def test_quality_edges(odd_docs, no_docs):
    out = Q.judge(odd_docs)
    rows = {(r.doc_id, r["metrics"]["n_words"], r.base_failed) for r in out.collect()}
    assert {(3, 0, True), (4, 0, True), (7, 0, True)} <= rows
    assert out.filter("kept").filter("base_failed").count() == 0
    assert Q.judge(no_docs).count() == 0


def test_repeated_windows_by_hand(spark):
    texts = ["a b c d e a b c d e", "a b c d e f g h i j", "x x x x x x", "a b c d", "a b c d e x y a b c d e", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    assert [r["metrics"]["n_repeat_words"] for r in Q.with_metrics(df).orderBy("doc_id").collect()] == [10, 0, 6, 0, 10, 0]


def items(spark):
    long = " ".join(f"t{i}" for i in range(20))
    return spark.createDataFrame([(1, long), (2, "short item"), (3, None), (4, "..."), (None, long.upper())], "item_id long, text string")


def brute(text, its):
    from weft.llm.common import alnum_words

    w, hit, found = alnum_words(text), set(), set()
    for name, t in its:
        iw = alnum_words(t)
        k = min(13, len(iw))
        wins = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if iw else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i : i + k]) in wins:
                hit |= set(range(i, i + k))
                found.add("" if name is None else str(name))
    return len(w), len(hit), sorted(found)


def test_spans_against_brute_force(spark):
    its = items(spark)
    t = [f"t{i}" for i in range(20)]
    texts = [" ".join(t), "x " + " ".join(t[3:16]) + " y", " ".join(t[:12]), "a short item. SHORT, item", None, "", " ".join(t[:13] + ["z"] + t[5:])]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id int, text string")
    names = [(r.item_id, r.text) for r in its.collect()]
    for limit in (D.MAX_ITEM_BYTES, 40):  # one automaton, and several
        got = D.match_items(df, its, max_item_bytes=limit).withColumn("hit", D.n_hit()).collect()
        for r in got:
            assert (r.n_words, r.hit, sorted({i for s in r.spans for i in s["items"]})) == brute(r.text, names)


def test_pieces_leave_the_corpus_alone(spark, odd_docs, monkeypatch):
    """With many automata only hits are written, and all rows and columns stay."""
    its = items(spark)
    t = " ".join(f"t{i}" for i in range(20))
    df = odd_docs.unionByName(spark.createDataFrame([(50, t), (50, t), (51, "a short item")], "doc_id long, text string"), allowMissingColumns=True).selectExpr("*", "1 AS __digest", "2 AS __spans")
    sizes, real = [], D.written
    monkeypatch.setattr(D, "written", lambda d: sizes.append(d.columns) or real(d))
    many, one = D.match_items(df, its, max_item_bytes=40), D.match_items(df, its)
    assert many.columns == one.columns and sorted(map(str, many.collect())) == sorted(map(str, one.collect()))
    assert len(sizes) > 2 and all(c == ["digest", "spans"] for c in sizes)
    assert D.match_items(df.limit(0), its, max_item_bytes=40).count() == 0


def test_spans_are_removed(spark):
    t = " ".join(f"t{i}" for i in range(20))
    df = spark.createDataFrame([(1, f"Before, {t}; after"), (2, "clean"), (3, None)], "doc_id int, text string")
    out = {r.doc_id: r.cleaned for r in D.remove_spans(D.match_items(df, items(spark))).collect()}
    assert out == {1: "Before, ; after", 2: "clean", 3: None}


def test_decontamination_edges(spark, odd_docs, no_docs):
    assert D.match_items(odd_docs, items(spark)).count() == odd_docs.count()
    assert D.match_items(no_docs, items(spark)).count() == 0
    assert D.match_items(odd_docs, items(spark).limit(0)).filter(F.size("spans") > 0).count() == 0


def test_rules_of_hosts_and_paths(spark):
    urls = ["http://a.example.ORG/es/x?q", "https://example.org/en/12", "http://example.org", "http://x.org/", "ftp://b.com/fr/1#t", "http://com/de/", "nothing", None, "http://xorg/", "http://m.com/de"]
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id int, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df).collect()}
    assert got[0] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[1][2:] == ("example.org/en/1", "block") and got[3][2:] == ("org/", "allow")
    # all of the host that rules judge is blocked, so its other urls are too
    assert got[2] == ("example.org", "", None, "block") and got[4][2:] == ("com/fr/", "allow") and got[5][2:] == ("com/de/", "block")
    assert got[6] == ("", "", None, "allow") == got[7] and got[8][2] is None
    assert U.judge(df.limit(0)).count() == 0


def test_ranks_against_matrices(spark):
    r = np.random.default_rng(3)
    n = 12
    a = (r.random((n, n)) < 0.25) * r.integers(1, 4, (n, n))
    np.fill_diagonal(a, 0)
    t, b = r.random(n) * (r.random(n) < 0.4), r.random(n) * (r.random(n) < 0.4)
    seeds = spark.createDataFrame([(f"h{i}", float(t[i]), float(b[i])) for i in range(n)], "host string, trusted double, blocked double")
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", int(a[i, j])) for i in range(n) for j in range(n) if a[i, j]], "src string, dst string, n long")
    ahead, back = a / np.maximum(a.sum(1, keepdims=True), 1), a / np.maximum(a.sum(0, keepdims=True), 1)
    x, y = t.copy(), b.copy()
    for _ in range(30):
        x, y = 0.15 * t + 0.85 * ahead.T @ x, 0.15 * b + 0.85 * back @ y
    got = {g.host: (g.trust, g.distrust) for g in U.propagate(seeds, edges, rounds=30, tolerance=0).collect()}
    for i in range(n):
        assert np.allclose(got[f"h{i}"], (x[i], y[i]), atol=1e-9)
    links = spark.createDataFrame([("http://a.com/x", '<a class="k" href="//B.net/q">1</a><A HREF=\'https://c.org?x\'>2</A><a href="/own">3</a><a href="http://a.com">4</a>')], "url string, html string")
    assert {(e.src, e.dst, e.n) for e in U.host_edges(links).collect()} == {("a.com", "b.net", 1), ("a.com", "c.org", 1)}


def test_trust_reaches_the_end_of_a_long_chain(spark):
    n = 33
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(n)], "src string, dst string, n long").coalesce(1)
    seeds = spark.createDataFrame([("h0", 1.0, 0.0)], "host string, trusted double, blocked double")
    got = {g.host: g.trust for g in U.propagate(seeds, edges).collect()}
    assert all(np.isclose(got[f"h{i}"], 0.15 * 0.85**i) for i in range(n + 1))


def test_links_between_hosts(spark):
    pages = spark.createDataFrame(
        [
            ("http://A.x.com/1", '<a href="/in"> <a href="#top"> <a href="mailto:x@y.z"> <A class=q HREF=\'//B.x.com/q\'> <a href=https://c.net/z?u=//d.net>'),
            ("http://a.x.com/2", '<base href="http://m.x.com/d/"><a href="rel"> <a href="/abs"> <a href="http://a.x.com/own"> <a href="">'),
            ("http://c.net/", None), (None, '<a href="http://a.x.com">'),
        ],
        "url string, html string",
    )
    got = {(r.src, r.dst): r.n for r in U.host_edges(pages).collect()}
    assert got == {("a.x.com", "b.x.com"): 1, ("a.x.com", "c.net"): 1, ("a.x.com", "m.x.com"): 2}


def test_verdict_comes_through_links(spark):
    """Hosts that no rule names are blocked by what they link to, allowed by who links to them."""
    rules = (U.Rule("allow", "good.org", "/"), U.Rule("block", "bad.org", "/"))
    rows = [("http://good.org/", '<a href="http://friend.net/">'), ("http://bad.org/", None), ("http://fan.net/", '<a href="http://bad.org/">' * 3), ("http://friend.net/", None), ("http://alone.net/", "")]
    out = U.judge(spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id int, url string, html string"), rules)
    assert {r.host: r.verdict for r in out.collect()} == {"good.org": "allow", "bad.org": "block", "fan.net": "block", "friend.net": "allow", "alone.net": "allow"}


def test_pieces_of_items_hold_one_at_a_time(spark):
    """Items in many pieces give the same spans as in one."""
    its = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + k) % 60}" for k in range(5 + i))) for i in range(25)], "item_id int, text string")
    df = spark.createDataFrame([(i, " ".join(f"w{(i * 3 + k) % 60}" for k in range(80))) for i in range(12)], "doc_id int, text string")
    spans = lambda limit: {r.doc_id: [(s["start"], s["stop"], tuple(s["items"])) for s in r.spans] for r in D.match_items(df, its, max_item_bytes=limit).collect()}
    assert spans(600) == spans(D.MAX_ITEM_BYTES)
