import random

import pytest
from pyspark.sql import functions as F

from weft import registry
from weft.functions import text as X
from weft.operators import graph as G
from weft.operators import inference as I
from weft.operators import matching as D
from weft.operators import mutation as M
from weft.operators import relational as R
from weft.operators import validation as V
from weft.sources import tables as S


def joined_rows(df):
    """Rows that the joins of a collected frame's plan gave."""
    rows = []

    def walk(p):
        if "Join" in p.nodeName() and p.metrics().contains("numOutputRows"):
            rows.append(int(p.metrics().get("numOutputRows").get().value()))
        kids = [p.executedPlan()] if p.nodeName() == "AdaptiveSparkPlan" else [p.plan()] if p.nodeName().endswith("QueryStage") else [p.children().apply(i) for i in range(p.children().size())]
        for k in kids:
            walk(k)

    walk(df._jdf.queryExecution().executedPlan())
    return rows


def brute_paths(edges, depth):
    """Canonical shortest paths by trying every simple path."""
    best = {}
    out = {}
    for s, d, e in edges:
        out.setdefault(s, []).append((d, e))

    def walk(ids, steps):
        key = (ids[0], ids[-1])
        if len(steps):
            cand = (len(steps), ids, steps)
            if key not in best or cand < best[key]:
                best[key] = cand
        if len(steps) < depth:
            for d, e in out.get(ids[-1], []):
                if d not in ids:
                    walk([*ids, d], [*steps, f"{e}:{ids[-1]}->{d}"])

    for s in list(out):
        walk([s], [])
    return {k: v for k, v in best.items() if v[0] > 1}


@pytest.mark.parametrize("seed", [1, 2])
def test_canonical_paths_against_brute_force(spark, seed):
    r = random.Random(seed)
    pairs = sorted({tuple(sorted(r.sample("abcdefghij", 2))) for _ in range(14)})
    # parallel edges, and ids of different widths
    rows = [(a, b, f"x{r.randint(1, 300)}-{i}") for i, (a, b) in enumerate(pairs + pairs[:4])]
    e = G.both_ways(spark.createDataFrame(rows, "a string, b string, id string"), "a", "b", "id")
    want = brute_paths([(x.src, x.dst, x.edge_id) for x in e.collect()], 4)
    paths = G.canonical_paths(e, 4).filter("length > 1")
    got = {(p.src, p.dst): (p.length, list(p.ids), list(p.steps)) for p in paths.collect()}
    assert got == want
    assert G.path_faults(paths).count() == 0


def test_explanation_skips_the_pair_s_own_edge(spark):
    rows = [("a", "b", "e1"), ("b", "c", "e2"), ("a", "c", "direct")]
    e = G.both_ways(spark.createDataFrame(rows, "a string, b string, id string"), "a", "b", "id")
    pairs = spark.createDataFrame([("a", "c"), ("a", "b")], "src string, dst string")
    got = {(p.src, p.dst): list(p.ids) for p in G.explanation_paths(e, pairs).collect()}
    assert got == {("a", "c"): ["a", "b", "c"], ("a", "b"): ["a", "c", "b"]}


def test_merge_only_when_all_may(spark):
    n = spark.createDataFrame([("a", "g", "A", True), ("b", "g", "B", True), ("c", "h", "C", True), ("d", "h", "D", False)], "node string, grp string, name string, may_merge boolean")
    assert {(r.node, r.target) for r in G.merge_mapping(n, ["g", "h"]).collect()} == {("a", "a"), ("b", "a")}
    e = spark.createDataFrame([("a", "b", "1", "t", "x"), ("b", "c", "2", "t", "x")], "src string, dst string, edge_id string, type string, evidence string")
    assert [(r.src, r.dst) for r in G.visible(n, e, G.GraphQuery(merge=("g",))).collect()] == [("a", "c")]
    assert G.visible(n, e, G.GraphQuery()).count() == 2


def test_sibling_conflicts(spark):
    h = spark.createDataFrame([("p", "a", "1"), ("p", "b", "2"), ("a", "b", "3")], "parent string, child string, edge_id string")
    assert {(r.a, r.b): r.status for r in I.siblings(h).collect()} == {("a", "b"): "generation_conflict"}
    assert I.grandparents(h).count() == 0  # p is also b's parent


def test_upsert_actions(spark):
    old = spark.createDataFrame([(1, None, ["a"]), (2, "x", ["b"]), (3, "x", ["c"])], "s int, t string, ev array<string>")
    new = spark.createDataFrame([(1, None, ["z"]), (1, None, ["a"]), (2, "x", ["b"]), (4, "x", ["n"])], "s int, t string, ev array<string>")
    got = {r.s: (r.action, list(r.ev)) for r in M.upsert(old, new, ["s", "t"], "ev").collect()}
    assert got == {1: ("append", ["a", "z"]), 2: ("skip", ["b"]), 3: ("keep", ["c"]), 4: ("insert", ["n"])}


def test_consensus_is_null_safe(spark):
    a = spark.createDataFrame([(1, "accepted", None), (2, "accepted", "x"), (3, "rejected", "x"), (4, "accepted", "x")], "k int, status string, f string")
    b = spark.createDataFrame([(1, "accepted", None), (2, "accepted", "y"), (3, "rejected", "y"), (4, "rejected", "x")], "k int, status string, f string")
    assert {r.k: r.decision for r in M.consensus(a, b, "k", ["f"]).collect()} == {1: "accepted", 2: "pending", 3: "rejected", 4: "pending"}
    assert {r.k: r.decision for r in M.consensus(a, b, "k", ["f"], strict=True).collect()}[2] == "rejected"


def test_later_row_wins_at_equal_time(spark):
    d = spark.createDataFrame([("c", "final", "2024", 1, "a"), ("c", "final", "2024", 2, "b"), ("c", "final", "2023", 3, "z")], "k string, stage string, ts string, ord int, v string")
    assert [r.v for r in R.latest(d, ["k", "stage"], "ts", "ord").collect()] == ["b"]


def test_fingerprint_ignores_order_and_tells_null_from_empty(spark):
    f = lambda rows: M.fingerprint(spark.createDataFrame(rows, "a int, b string"), "a", "b").first().fingerprint
    assert f([(1, "x"), (2, None)]) == f([(2, None), (1, "x")])
    assert f([(1, None)]) != f([(1, "")])
    assert M.fingerprint(spark.createDataFrame([], "a int"), "a").first().n_rows == 0


def test_numbered_without_gaps(spark):
    got = [r.ordinal for r in R.numbered(spark.range(100).withColumn("x", F.col("id") % 7), ["x", "id"]).orderBy("x", "id").collect()]
    assert got == list(range(1, 101))


def test_set_checks(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert {(r.k, r.side) for r in V.key_set_diff(a, b, "k").collect()} == {(1, "left_only"), (3, "right_only")}
    assert [(r.k, r.n) for r in V.duplicate_keys(a, "k").collect()] == [(2, 2)]
    raw = spark.createDataFrame([('{"a": 1, "z": 2}',), ('{"a": 1}',)], "j string")
    assert [list(r.unknown) for r in V.unknown_fields(raw, "j", ["a"]).collect()] == [["z"]]


def test_text_functions(spark):
    d = spark.createDataFrame([("Éa-B 1", "LXX Mat.4.21a", "sonOfX", "Alpha@Mat=x")], "a string, r string, p string, l string")
    books = F.create_map(F.lit("mat"), F.lit("MAT"))
    r = d.select(X.folded(F.col("a")).alias("f"), X.reference(F.col("r"), books).alias("ref"), X.is_placeholder(F.col("p")).alias("p"), X.label_base(F.col("l")).alias("l"), X.script(F.lit("λόγος")).alias("s")).first()
    assert (r.f, tuple(r.ref), r.p, r.l, r.s) == ("ea b 1", ("MAT", 4, 21, "MAT 4:21", True), True, "Alpha", "greek")


def test_name_and_word_rules(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    L = F.lit
    assert [one(X.is_placeholder(L(x))) for x in ("mother", "Mother_Teresa", "unnamed#1", "the_wife2_of_y", "Person_of_z", "daughter in law of w", None)] == [False, False, True, True, False, True, False]
    assert one(X.clean_name(L(" > A (x) <b>B</b>\tC"))) == "A B C" and one(X.clean_token(L("[a]  (b){c}"))) == "a b{c}"
    assert one(X.identity_key(L("Name (a)@Mat=G1 ??"))) == "name @mat=g1"
    books = F.create_map(L("mat"), L("MAT"))
    assert [one(X.reference(L(x), books)) for x in ("Foo.1.1", "Mat.1.0", "Mat.1", "", None)] == [None] * 5
    assert one(X.reference(L("Mat.1.2-30"), books)) is None and one(X.reference(L("Mat.1.2-3"), books)).passage == "MAT 1:2"
    items = one(X.relation_items(L("Amram@Mat.1.1; Mat.2.2 + Jo (?), >Aa@Mat.1.1")))
    assert [(i.key, i.uncertain, list(i.refs)) for i in items] == [("Amram", False, ["Mat.1.1", "Mat.2.2"]), ("Jo", True, []), ("Aa", False, ["Mat.1.1"])]
    # words of one beginning are no match, words of one stem are
    stems = lambda a, b: one(D.stem_forms(L(a), L(b), ["ου", "ος", "ην", "ης"]))
    assert stems("αρισταρχος", "αριστοβουλος") is None and stems("αρισταρχος", "αρισταρχου") == "stem" and stems("ιωαννης", "ιωαννην") == "stem"
    assert stems("abcd", "abcdef") == "prefix" and stems("abc", "abcd") is None and stems("abcd", "abcdefg") is None


def test_range_of_more_than_the_limit_is_no_range(spark):
    d = spark.createDataFrame([(1, 21), (1, 22), (5, 4), (3, 3), (None, 2)], "lo int, hi int")
    got = [(r.lo, r.hi) for r in R.expand_range(d, "lo", "hi", "x").select("lo", "hi").distinct().collect()]
    assert sorted(got) == [(1, 21), (3, 3)]


def test_upsert_stops_where_no_one_row_is_meant(spark):
    old = spark.createDataFrame([(1, ["a"]), (1, ["b"]), (2, ["c"])], "s int, ev array<string>")
    new = lambda *e: spark.createDataFrame([(1, list(e))], "s int, ev array<string>")
    with pytest.raises(ValueError, match="ambiguous"):
        M.upsert(old, new("z"), ["s"], "ev")
    got = sorted((r.action, list(r.ev)) for r in M.upsert(old, new("a"), ["s"], "ev").filter("s = 1").collect())
    assert got == [("keep", ["b"]), ("skip", ["a"])]
    with pytest.raises(ValueError, match="duplicate"):
        M.upsert(old.union(old), new("a"), ["s"], "ev")
    with pytest.raises(ValueError, match="not applied"):
        M.applied(M.upsert(old.filter("s = 2"), new("z"), ["s"], "ev"), "check")
    done = []
    assert M.applied(M.upsert(old.filter("s = 2"), new("z"), ["s"], "ev"), "apply", done.append).count() == 2 and len(done) == 1


def test_decisions_hold_for_what_was_seen(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    d = lambda *x: spark.createDataFrame(list(x), "k int, v string, decision string")
    assert {r.k: r.decision for r in V.overridden(rows, d((1, "a", "no")), "k", ["v"], {"decision": "yes"}).collect()} == {1: "no", 2: "yes"}
    for bad in (d((1, "old", "no")), d((9, "a", "no")), d((1, "a", "no"), (1, "a", "yes"))):
        with pytest.raises(ValueError):
            V.overridden(rows, bad, "k", ["v"], {"decision": "yes"})


def test_snapshots_and_reviewers_that_do_not_match_raise(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    assert R.aligned({"one": a, "two": b}, "k").count() == 2
    for wrong in (b.filter("k = 1"), b.union(b)):
        with pytest.raises(ValueError):
            R.aligned({"one": a, "two": wrong}, "k")
    assert M.agreed(a, a, "k", ["v"]).count() == 2
    for wrong in (b, a.filter("k = 1"), a.union(a)):
        with pytest.raises(ValueError):
            M.agreed(a, wrong, "k", ["v"])
    with pytest.raises(ValueError):
        V.coverage(a.union(a), a, ["k"], "v")


def test_drift_and_rebuilds(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    f = lambda d: M.fingerprint(d, "k", "v").first()
    assert f(a).n_rows == 3 and f(a).fingerprint != f(a.distinct()).fingerprint
    assert not M.idempotent(lambda: spark.range(3).select(F.rand().alias("r")), ["r"]).first().same


def test_longest_hit_wins(spark):
    t = spark.createDataFrame([(1, "a b c d".split())], "k int, w array<string>")
    names = spark.createDataFrame([("a b",), ("b",), ("a",), ("c d",), ("b c",)], "name string")
    hits = D.phrase_hits(t, names, "w", "name")
    assert hits.count() == 5
    assert sorted(r.name for r in D.longest_only(hits, "k", "name").collect()) == ["a b", "c d"]


def test_names_of_any_length_are_found(spark):
    t = spark.createDataFrame([(1, "a b c d e a b".split())], "k int, w array<string>")
    names = spark.createDataFrame([("a b c d",), ("a b c d e a b",), ("b",)], "name string")
    assert sorted((r.name, r.pos) for r in D.phrase_hits(t, names, "w", "name").collect()) == [("a b c d", 1), ("a b c d e a b", 1), ("b", 2), ("b", 7)]


@pytest.mark.parametrize("name_bytes", [D.NAME_BYTES, 25])
def test_dictionary_against_one_pattern(spark, name_bytes):
    """As one pattern of all names, longest first, between characters that are no letters."""
    import re

    r = random.Random(4)
    names = {r.choice(["o'neil", "st. john", "x-y", "ab", "ab ab", "a", "-q", "é", "naïve b", "İx", "b ab"]) for _ in range(30)} | {"".join(r.choices("ab .-'", k=r.randint(2, 9))) for _ in range(25)}
    texts = ["".join(r.choices(["a", "B", "ab", " ", "O'Neil", "St. John", "-", ".", "É", "İX", "naïve", "x"], k=r.randint(0, 60))) for _ in range(60)] + [None, ""]
    low = lambda x: "".join(c.lower() if len(c.lower()) == 1 else c for c in x)
    names = sorted({low(n) for n in names}, key=lambda n: (-len(n), n))
    one = re.compile("(?<![a-z])(?:" + "|".join(map(re.escape, names)) + ")(?![a-z])")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "pos_of int, text string")
    known = spark.createDataFrame([(k, n.upper() if n.isascii() else n) for k, n in enumerate(names)] + [(900 + k, n) for k, n in enumerate(names[:3])] + [(1, None), (2, "")], "id int, name string")
    got = {}
    for h in D.dictionary_scan(df, known, "pos_of", "text", "id", "name", name_bytes=name_bytes).collect():
        got.setdefault((h.pos_of, h.pos, h.name), set()).add(h.id)
        assert h.length == len(h.name)
    want = {(i, m.start(), m[0]) for i, t in enumerate(texts) for m in one.finditer(low(t or ""))}
    assert set(got) == want and len(want) > 100
    assert all(len(ids) == 1 + (n in names[:3]) for (_, _, n), ids in got.items())
    every = {(h.pos_of, h.pos, h.name) for h in D.dictionary_scan(df, known, "pos_of", "text", "id", "name", True, name_bytes).collect()}
    assert every == {(i, m.start(), n) for i, t in enumerate(texts) for n in names for m in re.finditer(f"(?=(?<![a-z]){re.escape(n)}(?![a-z]))", low(t or ""))}
    assert D.dictionary_scan(df, known.limit(0), "pos_of", "text", "id", "name").count() == 0 == D.dictionary_scan(df.limit(0), known, "pos_of", "text", "id", "name").count()


def test_sections_and_markup(spark, tmp_path):
    (tmp_path / "s.txt").write_text("junk\n$== PERSON\nAlpha\n–one\n@Skip\n–two\nBeta\n$== PLACE\nTown\n–x\n")
    lines = S.read_lines(spark, str(tmp_path / "s.txt"))
    c = F.col("line")
    s = S.sectioned(lines, c.startswith("$== PERSON"), c.startswith("$== PLACE"), ~c.startswith("–"), c.startswith("–"))
    got = [(r.record, r.kind, r.line) for r in s.orderBy("pos").collect()]
    assert got == [(1, "header", "Alpha"), (1, "child", "–one"), (2, "header", "@Skip"), (2, "child", "–two"), (3, "header", "Beta")]
    (tmp_path / "m.usfm").write_text("\\id GEN x\n\\c 1\n\\v 1 In the \\v 2 and\ngoes on\n\\c 2\n\\v 3-5 range\n")
    u = {(r.chapter, r.verse): r.text for r in S.usfm_passages(S.read_lines(spark, str(tmp_path / "m.usfm"))).collect()}
    assert u == {(1, 1): "In the", (1, 2): "and goes on", (2, 3): "range", (2, 4): "range", (2, 5): "range"}


def test_readers_and_sinks(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1}\n\n{"a": 2}\nbad\n')
    assert S.read_jsonl(spark, str(p), "a int", mode="permissive").filter("a IS NOT NULL").count() == 2
    with pytest.raises(Exception):
        S.read_jsonl(spark, str(p), "a int").collect()
    assert S.read_jsonl(spark, str(tmp_path / "none"), "a int", missing_ok=True).count() == 0
    df = spark.createDataFrame([(1, None), (2, 'q"x')], "a int, b string")
    S.write_csv(df, str(tmp_path / "csv"))
    text = "".join(f.read_text() for f in (tmp_path / "csv").glob("part*"))
    assert '"1",""' in text and '"2","q""x"' in text
    assert S.write_if_small(df, str(tmp_path / "out"), 2) and not S.write_if_small(df, str(tmp_path / "out"), 1)
    assert not (tmp_path / "out").exists()
    inv = S.file_inventory(spark, str(p)).first()
    reg = spark.createDataFrame([("a.jsonl", inv.bytes, "0" * 64, inv.lines), ("gone", 1, "x", 1)], "name string, bytes long, sha256 string, lines long")
    assert {(r.name, r.fault) for r in S.lock_violations(S.file_inventory(spark, str(p)), reg).collect()} == {("a.jsonl", "hash"), ("gone", "missing")}


def test_files_in_order_and_captures(spark, tmp_path):
    for name, text in (("b.txt", "1:2\tIn Thé\n1:3\tx\n"), ("a.txt", "Mat 1:1\tOne-two\n1:1\tagain\nno tab\n"), (".hidden.txt", "1:1\tx\n"), ("c.md", "1:1\tx\n")):
        (tmp_path / name).write_text(text)
    (tmp_path / "d.txt.folder").mkdir()
    assert [p.rpartition("/")[2] for p in S.listed(spark, str(tmp_path), r"\.txt$")] == ["a.txt", "b.txt"]
    lines = S.read_files(spark, str(tmp_path), r"\.txt$")
    assert sorted({(r.file_no, r.file.rpartition("/")[2]) for r in lines.collect()}) == [(0, "a.txt"), (1, "b.txt")]
    assert S.read_files(spark, str(tmp_path), "none").count() == 0
    books = F.create_map(F.lit("a"), F.lit("MAT"), F.lit("b"), F.lit("MRK"))
    assert {r.passage: r.text for r in S.verse_texts(lines, books).collect()} == {"MAT 1:1": "again", "MRK 1:2": "in the", "MRK 1:3": "x"}
    cap = tmp_path / "cap.json"
    ok = '{"source_id": "s", "count": 2, "rows": [{"title": "A (Person)", "at": "1"}, {"title": "B (Person)", "at": "2"}]}'
    read = lambda text, **k: (cap.write_text(text), S.read_captured(spark, str(cap), "title: string, at: string", "s", title=r"\(Person\)$", **k))[1]
    assert read(ok, n_rows=2).count() == 2
    for bad in (ok.replace('"count": 2', '"count": 3'), ok.replace('"s"', '"t"'), ok.replace("B (Person)", "B"), ok.replace("B (Person)", "A (Person)").replace('"2"', '"1"')):
        with pytest.raises(ValueError):
            read(bad)


def test_reports_and_swaps(spark, tmp_path):
    import json

    S.write_report(spark.createDataFrame([(1, "é")], "n int, a string"), str(tmp_path / "r.json"))
    S.write_report(spark.createDataFrame([(2, "x")], "n int, a string"), str(tmp_path / "r.json"))
    text = (tmp_path / "r.json").read_text()
    assert json.loads(text) == {"a": "x", "n": 2} and text.startswith('{\n  "a"')
    with pytest.raises(ValueError):
        S.write_report(spark.range(5).toDF("n"), str(tmp_path / "r.json"), 3)
    path = str(tmp_path / "t")
    S.write_atomic(spark.range(3).toDF("n"), path)
    S.write_atomic(spark.read.parquet(path).filter("n > 0"), path)  # rows may come from the table itself
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception):
        S.write_atomic(spark.range(3).select(F.raise_error(F.lit("no")).alias("n")), path)
    assert spark.read.parquet(path).count() == 2 and {p.name for p in tmp_path.iterdir() if not p.name.startswith(".")} == {"r.json", "t"}


def test_documents_fall_back(spark, tmp_path):
    other = spark.createDataFrame([(7,)], "a int")
    assert S.read_document(spark, str(tmp_path / "none.json"), "a int", other).first().a == 7
    (tmp_path / "d.json").write_text('{\n "a": 1\n}')
    assert S.read_document(spark, str(tmp_path / "d.json"), "a int", other).first().a == 1


def test_marked_names_lemmas_and_code_lines(spark, tmp_path):
    p = spark.createDataFrame([(r"In \pn Adam\pn* and \+pn Eve\+pn* \pn Adam\pn* went",), ("none",)], "text string")
    assert [(list(r.names), r.text) for r in S.marked_names(p).collect()] == [(["Adam", "Eve"], "In Adam and Eve Adam went"), ([], "none")]
    tagged = spark.createDataFrame([("Ezk.1.2#01 HNpm {H0001A=אָדָם=x}",), ("Ezk.1.2#02 HNpl {H0002=קַיִן=x}",), ("Gen.1.1#01 HVq {H0003=שֵׁת=x}",)], "line string")
    books = F.create_map(F.lit("EZK"), F.lit("EZE"))
    assert {r.passage: sorted(r.lemmas) for r in S.name_lemmas(tagged, books).collect()} == {"EZE 1:2": ["אדם", "קין"]}
    f = tmp_path / "codes.txt"
    f.write_text("====\nH0001 g1234 G1234A Mat.1.1 Mat.1-2 x\nno codes Mat.1.1\n\nH0001 Mat.1.1 Foo.1.1\n")
    names = F.create_map(F.lit("mat"), F.lit("MAT"))
    parsed = S.code_lines(S.read_lines(spark, str(f)), names)
    assert sorted((r.pos, list(r.codes), list(r.refs)) for r in parsed.collect()) == [(1, ["H0001", "G1234A"], ["MAT 1:1", "MAT 1:2"]), (4, ["H0001"], ["MAT 1:1"])]
    inv = S.code_inventory(parsed, S.file_inventory(spark, str(f))).first()
    assert (inv.data_lines, inv.n_refs, list(inv.books), inv.lines) == (2, 2, ["MAT"], 5)


def test_references_of_children(spark):
    kids = S.child_rows(spark.createDataFrame([("– Name\traw\tx\tword\t\tMat.1.1; LXX 1Ki.2.3, Foo.1.1",)], "line string"))
    books = F.create_map(F.lit("mat"), F.lit("MAT"), F.lit("1ki"), F.lit("1KI"))
    got = {(r.passage, r.testament, r.lxx) for r in S.child_references(kids, books, ["1KI"], ["MAT"]).collect()}
    assert got == {("MAT 1:1", "nt", False), ("1KI 2:3", "ot", True)}


def test_export_has_each_passage_once(spark):
    from weft.operators.review import export_tables

    e = spark.createDataFrame
    out = export_tables(
        e([("p1", "A"), ("p2", "B")], "node string, name string"), e([], "name_id string"), e([], "edge_id string"), e([], "option string"),
        e([("m1", "p1", "MAT 1:1", "nt", "s", "ok"), ("m2", "p1", "GEN 1:1", "ot", "s", "ok"), ("m3", "p2", "MAT 1:1", "nt", "s", "ok")], "mention_id string, node string, passage string, testament string, source string, status string"),
        e([("a1", "MAT 1:1", "nt", "s", "x", 0.5, "n")], "edge_id string, passage string, testament string, source string, level string, certainty double, note string"), e([("s",)], "source string"),
    )
    assert {(r.node, r.n_nt, r.n_ot, r.testament) for r in out["person_nodes"].collect()} == {("p1", 1, 1, "nt,ot"), ("p2", 1, 0, "nt")}
    assert sorted(r.passage for r in out["passage_nodes"].collect()) == ["GEN 1:1", "MAT 1:1"] and len(out) == 8


def test_passages_codes_and_children(spark, tmp_path):
    (tmp_path / "x.xml").write_text('<b><verse ref="A 1:1">In <i>the</i></verse>\n<verse ref="A 1:2">x</verse><verse ref="A 1:1">end</verse></b>')
    assert {r.ref: r.text for r in S.xml_passages(spark, str(tmp_path / "x.xml")).collect()} == {"A 1:1": "In the end", "A 1:2": "x"}
    lines = spark.createDataFrame([("A.1\tH0001 H0002A",), ("A.1\tH0001",), ("none",)], "line string")
    assert [(r.ref, list(r.codes)) for r in S.tagged_codes(lines).collect()] == [("A.1", ["H0001", "H0002A"])]
    kids = spark.createDataFrame([("– Name\traw\tλόγος\tword\t\tMat.1.1; Mat.1.2",), ("– Group\traw\tabc",)], "line string")
    got = [(r.significance, r.language, r.scope, r.status, len(r.refs)) for r in S.child_rows(kids).collect()]
    assert got == [("Name", "grc", "canonical", "accepted", 2), ("Group", "latn", "variant", "pending", 0)]
    p = spark.createDataFrame([(1, "ab ab c")], "p int, t string")
    assert {(r.token, r.n) for r in S.token_counts(p, "t", "[a-z]+", "p").collect()} == {("ab", 2), ("c", 1)}
    from weft.operators.review import export_graph

    export_graph({"nodes": kids, "edges": p}, str(tmp_path / "graph"))
    assert (tmp_path / "graph/nodes").exists() and (tmp_path / "graph/edges").exists()


def test_items_of_lists_are_trimmed_of_spaces_alone(spark):
    d = spark.createDataFrame([("Mat.1.10; 1Ki.1.21, Mat.2.20",)], "r string")
    assert list(d.select(X.references(F.col("r")).alias("x")).first().x) == ["Mat.1.10", "1Ki.1.21", "Mat.2.20"]
    assert [i.raw for i in d.select(X.relation_items(F.lit("A10, B21")).alias("x")).first().x] == ["A10", "B21"]


@pytest.mark.parametrize("name", [q for q in sorted(registry.QUERIES) if q.endswith("_faults")])
def test_fault_lists_are_the_same_however_read(spark, sf_dir, tmp_path, name):
    """Collected, counted and written, in the order of their columns, a list of faults is one and the same."""
    df = registry.QUERIES[name](spark, sf_dir)
    n = df.count()
    df.write.parquet(str(tmp_path / "out"))
    assert n > 0 and len(df.collect()) == n == spark.read.parquet(str(tmp_path / "out")).count()


def _pairs_apart(edges, src, dst, depth):
    """The canonical path of 2 to ``depth`` steps between two nodes without the edge between them, by trying all."""
    rest = [x for x in edges if x[:2] != (src, dst)]
    best = brute_paths([x for x in rest if x[1] != src], depth).get((src, dst))
    return best[1] if best else None


@pytest.mark.parametrize("seed", range(3))
def test_explanations_meet_in_the_middle(spark, seed):
    r = random.Random(seed)
    undirected = {tuple(sorted(r.sample("abcdefghij", 2))) for _ in range(14 + 4 * seed)}
    both = [(x, y, f"{x}{y}") for a, b in undirected for x, y in ((a, b), (b, a))]
    nodes = sorted({x for e in undirected for x in e})
    df = spark.createDataFrame([(*e, 1 if e[0] < e[1] else -1) for e in both], "src string, dst string, edge_id string, way int")
    pairs = spark.createDataFrame([(a, b) for a in nodes for b in nodes], "src string, dst string")
    got = {(p.src, p.dst): (list(p.ids), list(p.steps), p.length, p.delta) for p in G.explanation_paths(df, pairs).collect()}
    for a in nodes:
        for b in nodes:
            want = _pairs_apart(both, a, b, 4) if a != b else None
            assert (got[a, b][0] if want else got.get((a, b))) == (list(want) if want else None), (a, b)
    for ids, steps, length, delta in got.values():
        assert steps == [f"{x}{y}:{x}->{y}" for x, y in zip(ids, ids[1:])] and length == len(steps) and delta == sum(1 if x < y else -1 for x, y in zip(ids, ids[1:]))


def test_a_chain_is_contracted_in_few_rounds(spark, monkeypatch):
    n, rounds = 10_000, []
    seen = G._signature
    monkeypatch.setattr(G, "_signature", lambda e: rounds.append(1) or seen(e))
    order = list(range(n))
    random.Random(1).shuffle(order)
    chain = [(f"{a:05}", f"{b:05}") for a, b in zip(order, order[1:])]
    made = len(S._made)
    df = spark.createDataFrame(chain, "src string, dst string").coalesce(2)
    got = G.components(df).groupBy("root").count().collect()
    assert [tuple(x) for x in got] == [("00000", n)] and len(rounds) < 30
    assert len(S._made) - made <= 2  # the rounds' tables are gone


def test_components_by_hand(spark):
    e = [("b", "a"), ("c", "b"), ("x", "y"), ("y", "x"), ("z", "z"), ("c", None), ("q", "p"), ("q", "p")] + [("hub", f"s{i}") for i in range(50)]
    got = {r.node: r.root for r in G.components(spark.createDataFrame(e, "src string, dst string")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x", "z": "z", "p": "p", "q": "p", "hub": "hub", **{f"s{i}": "hub" for i in range(50)}}
    assert G.components(spark.createDataFrame([], "src string, dst string")).count() == 0
    near = G.connected_edges(spark.createDataFrame(e, "src string, dst string"), "b")
    assert sorted(tuple(r) for r in near.collect()) == [("b", "a"), ("c", "b")]


def test_all_paths_in_blocks_are_taken_up(spark, tmp_path):
    r = random.Random(3)
    both = [(x, y, f"{x}{y}") for a, b in {tuple(sorted(r.sample("abcdefghijk", 2))) for _ in range(18)} for x, y in ((a, b), (b, a))]
    df = spark.createDataFrame([(*e, 1) for e in both], "src string, dst string, edge_id string, way int")
    want = {k: list(v[1]) for k, v in brute_paths(both, 4).items()}
    at = str(tmp_path / "paths")
    got = {(p.src, p.dst): list(p.ids) for p in G.all_canonical_paths(df, at, block_rows=30).filter("length > 1").collect()}
    assert got == want
    blocks = sorted(p.name for p in (tmp_path / "paths").iterdir())
    assert len(blocks) > 3
    (tmp_path / "paths" / blocks[0] / "_SUCCESS").unlink()  # one block was not finished
    before = {b: (tmp_path / "paths" / b / "_SUCCESS").stat().st_mtime_ns for b in blocks[1:]}
    assert {(p.src, p.dst): list(p.ids) for p in G.all_canonical_paths(df, at, block_rows=1).filter("length > 1").collect()} == want
    assert before == {b: (tmp_path / "paths" / b / "_SUCCESS").stat().st_mtime_ns for b in blocks[1:]}


def test_views_as_query_strings():
    from weft.operators import topics as T

    topics = T.presets({"team": ["a", "b"]})
    assert set(topics) == {"all", "dynasty", "family", "discipleship", "team", "acts"} and topics["all"] == G.GraphQuery()
    assert topics["family"].types[:4] == ("亲属关系-父母", "候选亲属关系-父母", "亲属关系-子女", "候选亲属关系-子女") and len(set(topics["family"].types)) == len(topics["family"].types) == 32
    assert topics["acts"].types == ("长期同工", "候选长期同工", "师徒", "候选师徒", "差派", "候选差派", "接待", "候选接待", "司法行为", "候选司法行为", "候选亲属关系-父母", "候选亲属关系-子女", "候选亲属关系-手足", "候选亲属关系-配偶", "候选亲属关系-其他")
    assert T.to_query_string(T.View()) == "" and T.from_query_string("") == T.View()
    views = [
        T.View(G.GraphQuery(types=("x y", "z"), books=("ACT",), eras=("é&=",), term="a b", scope="nt", evidence=("ancient", "modern")), "custom", "traditional", "p1", False, True),
        T.View(topics["team"], "team", person="p"), T.View(G.GraphQuery(evidence=T.NO_EVIDENCE)), T.View(G.GraphQuery(scope="ot", term="名")),
    ]
    for v in views:
        got = T.from_query_string("?" + T.to_query_string(v), topics)
        same = lambda x: (x.topic, x.identity, x.person, x.direct, x.paths, x.query.term, x.query.scope, sorted(x.query.types), sorted(x.query.books), sorted(x.query.eras), sorted(x.query.evidence), x.query.nodes)
        assert same(got) == same(v)
    odd = T.from_query_string("topic=nothing&scope=moon&evidence=bad,ancient&identity=x&direct=2&paths=2", topics)
    assert odd == T.View(G.GraphQuery(evidence=("ancient",)))
    assert T.from_query_string("topic=team&books=ACT", topics).query.books == ()  # a topic has its own facets


def test_rules_of_senses_by_hand(spark):
    from weft.functions import senses as E
    from weft.plans.senses import UNMARKED, VERSES

    df = spark.createDataFrame([(i, *v[:7]) for i, v in enumerate(VERSES)], "i int, verse string, passage string, aliases string, label string, own boolean, endpoint boolean, patriarch boolean")
    s = E.mention_sense(F.col("verse"), F.col("passage"), F.split("aliases", " "), F.col("label"), F.col("own"), F.col("endpoint"), F.col("patriarch"), F.lit(True))
    got = {r.i: (r.s.kind, r.s.reason) if r.s else (None, None) for r in df.select("i", s.alias("s")).collect()}
    assert got == {i: v[7:] for i, v in enumerate(VERSES)} and len({v[8] for v in VERSES}) == 19
    marks = spark.createDataFrame([("\\v 1 属 \\pn 约 书\\pn* 人 \\+pn 亚\\+pn*。",), ("none",), (None,)], "v string").select(E.marked_names(F.col("v")).alias("m")).collect()
    assert [[tuple(x) for x in r.m or ()] for r in marks] == [[("约书", "1属", "人亚。"), ("亚", "1属约书人", "。")], [], []]
    edge = spark.createDataFrame([(v,) for v, _ in UNMARKED] + [(None,)], "v string").select(E.explicit_name(F.col("v"), F.array(F.lit(""), F.lit("约书亚")))["snippet"].alias("s")).collect()
    assert [r.s for r in edge] == [x for _, x in UNMARKED] + [None]


def test_lineal_paths_are_the_canonical_ones_that_go_one_way(spark):
    import random

    from weft.operators import graph as G

    r = random.Random(3)
    rows = [(f"n{r.randint(0, 12)}", f"n{r.randint(0, 12)}", f"e{i}") for i in range(30)]
    e = G.both_ways(spark.createDataFrame([x for x in rows if x[0] != x[1]], "a string, b string, edge_id string"), "a", "b", "edge_id")
    told = lambda d: {(p.src, p.dst): (tuple(p.ids), tuple(p.steps), p.delta) for p in d.collect()}
    want = told(G.canonical_paths(e, 2).filter("length = 2 AND delta <> 0"))
    assert told(G.lineal_paths(e)) == want and want


def _hairy(seed):
    """A graph of a few nodes in chains and rings with leaves, one of them of very many, an edge alone and one that goes one way."""
    r = random.Random(seed)
    rows = {tuple(sorted(r.sample("abcdef", 2))) for _ in range(5)} | {("x", "y"), ("h", "a"), ("a", "b")}
    rows |= {(f"l{i}", r.choice("ab")) for i in range(6)} | {(f"m{i:03}", "h") for i in range(12)}
    return [(x, y, f"{x}{y}") for a, b in sorted(rows) for x, y in ((a, b), (b, a))] + [("one", "b", "oneb"), ("a", "a", "aa")]


@pytest.mark.parametrize("seed", [1, 3])
def test_all_paths_hang_leaves_on_to_the_rest(spark, tmp_path, monkeypatch, seed):
    both = _hairy(seed)
    df = spark.createDataFrame([(*e, 1 if e[0] < e[1] else -1) for e in both], "src string, dst string, edge_id string, way int")
    monkeypatch.setattr(I, "PIECE", 5)  # the hub's leaves are in pieces
    searched, levels = [], G._levels
    monkeypatch.setattr(G, "_levels", lambda one, *a, **k: searched.append({x for e in one.select("src", "dst").collect() for x in e}) or levels(one, *a, **k))
    got = G.all_canonical_paths(df, str(tmp_path / "paths"), block_rows=1).collect()
    want = {k: (v[0], list(v[1]), list(v[2])) for k, v in brute_paths(both, 4).items()}
    assert {(p.src, p.dst): (p.length, list(p.ids), list(p.steps)) for p in got if p.length > 1} == want and len({(p.src, p.dst) for p in got}) == len(got)
    assert {(p.src, p.dst) for p in got if p.length == 1} == {e[:2] for e in both if e[0] != e[1]}
    assert all(p.delta == sum(1 if x < y else -1 for x, y in zip(p.ids, p.ids[1:])) for p in got)
    # leaves are in no search, and a block has as many paths as the graph has edges: no search for each source
    assert not {x for s in searched for x in s if x[0] in "lm" or x == "one"} and len(searched) <= 4


def test_paths_of_ends_are_the_canonical_ones_and_no_others_are_made(spark):
    r = random.Random(4)
    rows = [(f"{r.choice('nR')}{r.randint(0, 7)}", f"n{r.randint(0, 7)}", f"e{i}") for i in range(26)]
    e = G.both_ways(spark.createDataFrame([x for x in rows if x[0] != x[1]], "a string, b string, edge_id string"), "a", "b", "edge_id")
    told = lambda d: {(p.src, p.dst): (tuple(p.ids), tuple(p.steps), p.delta, p.length) for p in d.collect()}
    want = told(G.canonical_paths(e, 2).filter("length = 2 AND (src LIKE 'R%' OR dst LIKE 'R%')"))
    assert told(G.paths_of_ends(e, F.col("node").startswith("R"))) == want and want
    # a family of 2000: its children's four million pairs are never made
    hub = G.both_ways(spark.range(2000).select(F.lit("n").alias("a"), F.concat(F.lit("c"), "id").alias("b"), F.col("id").cast("string").alias("edge_id")).union(spark.createDataFrame([("R", "n", "r")])), "a", "b", "edge_id")
    paths = G.paths_of_ends(hub, F.col("node").startswith("R")).select("src", "dst").groupBy("src").count()
    assert sum(r["count"] for r in paths.collect()) == 4000 and max(joined_rows(paths)) < 20_000


@pytest.mark.parametrize("few", [0, 1000])
def test_structure_faults_by_hand_and_without_moving_rows(spark, monkeypatch, few):
    monkeypatch.setattr(I, "FEW", few)
    base = spark.createDataFrame([("e1",), ("e2",), ("e3",), ("e1",)], "edge_id string")
    rows = [("ok", ["e1", "e2"]), ("none", None), ("empty", []), ("one", ["e1"]), ("null", ["e1", None]), ("twice", ["e1", "e1"]), ("odd", ["e1", "x"]), ("odds", ["x", "y", "e2"]), ("both", ["x", "x"]), ("three", ["e1", None, "e3"])]
    df = spark.createDataFrame(rows, "id string, premises array<string>")
    got = {r.id: r.fault for r in I.structure_faults(df, base).collect()}
    assert got == {"none": "too_few", "empty": "too_few", "one": "too_few", "null": "too_few", "twice": "repeated", "odd": "unknown_premise", "odds": "unknown_premise", "both": "repeated"}
    assert ("Exchange" in I.structure_faults(df, base)._jdf.queryExecution().executedPlan().toString()) == (few == 0)


def test_kin_paths_explain_all_siblings_and_grandparents(spark, monkeypatch):
    monkeypatch.setattr(I, "PIECE", 3)
    r = random.Random(6)
    rows = sorted({(f"n{r.randint(0, 4)}", f"{r.choice('nc')}{r.randint(0, 12)}") for _ in range(34)} | {("n0", "n1"), ("n1", "n0"), ("n2", "n2"), ("q", "z1"), ("q", "z2"), ("q", "z2")})
    df = spark.createDataFrame([(p, c, f"{p}-{c}") for p, c in rows] + [("q", "z2", "again"), ("q", "z3", "x"), ("q", "z4", "y")], "parent string, child string, edge_id string")
    pairs = I.grandparents(df).select(F.col("elder").alias("src"), F.col("younger").alias("dst")).unionByName(I.siblings(df).select(F.col("a").alias("src"), F.col("b").alias("dst")))
    told = lambda d: sorted((p.src, p.dst, tuple(p.ids), tuple(p.steps), p.delta, p.length) for p in d.collect())
    looked_up, explained = [], G.explanation_paths
    want = told(explained(G.both_ways(df, "parent", "child", "edge_id"), pairs))
    monkeypatch.setattr(G, "explanation_paths", lambda e, p, d: looked_up.extend((x.src, x.dst) for x in p.collect()) or explained(e, p, d))
    assert told(G.kin_paths(df)) == want and want
    assert not {("z1", "z3"), ("z3", "z4"), ("z2", "z4")} & set(looked_up) and {("z1", "z3"), ("z2", "z4")} <= {x[:2] for x in want}


def test_token_ids_meet_once_for_each_token(spark):
    texts = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["c"]), (3, []), (4, None), (5, ["b", None])] + [(k, ["hot"]) for k in range(10, 110)], "k int, w array<string>")
    names = spark.createDataFrame([("a", 7), ("a", 7), ("b", 7), ("b", 3), ("d", 1), (None, 2)] + [("hot", i) for i in range(200)], "name string, id int")
    ids = R.token_ids(texts, "k", "w", names, "name", "id")
    got = {r.k: r.ids for r in ids.collect()}
    assert got == {1: [3, 7], 5: [3, 7]} | {k: list(range(200)) for k in range(10, 110)}
    assert max(joined_rows(ids)) == 103  # tokens with a name, not tokens and entities
