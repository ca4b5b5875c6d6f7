import random
import re
import zlib
from collections import Counter

import pytest

from weft.llm import variants as W


def near(a, b):
    """Exactly one edit apart, by trying all edits of ``a``."""
    letters = set(b)
    return a != b and (
        b in {a[:i] + a[i + 1 :] for i in range(len(a))} or b in {a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in letters} or b in {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in letters}
    )


def brute(counts, ratio=5):
    """All pairs, then forms followed one by one."""
    form, out = {}, {}
    for w, n in counts.items():
        best = sorted((-counts[o], o) for o in counts if abs(len(o) - len(w)) <= 1 and near(w, o))
        out[w] = len(best)
        form[w] = best[0][1] if best and -best[0][0] >= ratio * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, out[w], counts[form[w]] if form[w] else None))
    return rows


@pytest.mark.parametrize("length", [2, 5, 6, 7])
def test_halves_against_all_pairs(length):
    """Few letters and so crowds on every half: all near words are found, and only those."""
    r = random.Random(length)
    pool = {"".join(r.choices("abé", k=n)) for n in (length - 1, length, length + 1) for _ in range(500)}
    own = [w for w in pool if len(w) == length]
    halves = W.Halves(own)
    for w in pool:
        assert halves.near(w) == {o for o in own if near(w, o)}


def test_one_edit():
    for a, b, want in (("ab", "ab", False), ("ab", "b", True), ("a", "", True), ("", "", False), ("abc", "acb", False), ("abc", "abd", True), ("aab", "ab", True), ("abcd", "ab", False), ("ab", "ba", False)):
        assert W.one_edit(a, b) is want and W.one_edit(b, a) is want


def test_groups_against_brute_force(spark):
    r = random.Random(1)
    base = ["separate", "définite", "abcdefgh", "kkkkkk", "x" * 70]
    words = set(base)
    for w in base * 40:
        for _ in range(r.randint(1, 3)):
            i = r.randrange(len(w))
            w = r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("aek") + w[i + 1 :], w[:i] + r.choice("aek") + w[i:]])
        words.add(w)
    counts = {w: r.choice([5, 6, 25, 30, 125, 150, 700, 3000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    for k in ({}, {"shard_words": 7, "scan_words": 20}):
        assert {tuple(x) for x in W.grouped(df, **k).collect()} == brute(counts)


def test_long_chain_of_forms(spark):
    """Each word is the form of the next: roots lie nine steps away."""
    counts = {"a" * k + "bcdef": 5**k for k in range(1, 11)}
    got = {x.word: (x.form, x.root) for x in W.grouped(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got["abcdef"] == ("aabcdef", "a" * 10 + "bcdef") and {root for _, root in got.values()} == {"a" * 10 + "bcdef"}


def test_words_of_documents_by_definition(spark, odd_docs, no_docs):
    r = random.Random(2)
    pool = ["Separate", "sepaRATE", "seperate", "Élan_vital", "ÉLANvital", "naïveté", "日本separate語", "x1separate", "straße", "Ğseparate", "separat", "÷×÷×÷×÷"]
    rows = [(i if i % 9 else None, " ".join(r.choices(pool, k=r.randint(0, 60))), "x") for i in range(400)] + [(5, None, "x"), (6, "", "y")]
    want = Counter()
    for i, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run if h % 7 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    got = W.vocabulary(spark.createDataFrame(rows, "doc_id long, text string, word string"), one_in=7)
    assert {tuple(x) for x in got.collect()} == {(w, n) for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert W.grouped(W.vocabulary(odd_docs, least=4)).count() > 0
    assert W.grouped(W.vocabulary(no_docs)).count() == 0
