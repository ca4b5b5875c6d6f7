import random

import numpy as np

from weft.llm import chosen_path as C


def brute(docs):
    """Classes and links by comparing all pairs."""
    sets = [set(C.shingles(t).tolist()) for _, t in docs]
    n = len(docs)
    linked = [[i != j and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            for j in range(n):
                if linked[x][j] and j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [docs[j][0] for j in seen if docs[j][0] is not None]
        cls = (min(ids) if ids else None) if sets[i] else docs[i][0]
        out.append((docs[i][0], cls, sum(map(bool, linked[i])), len({frozenset(sets[j]) for j in range(n) if linked[i][j]} - {frozenset(sets[i])})))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    r = random.Random(4)
    words = [f"v{i}" for i in range(400)]
    docs = []
    for i in range(60):
        base = [r.choice(words) for _ in range(r.randint(0, 120))]
        docs.append((i, " ".join(base)))
        for k in range(r.randint(0, 4)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                if copy:
                    copy[r.randrange(len(copy))] = r.choice(words)
            docs.append((100 + 10 * i + k, " ".join(copy).upper()))
    docs += [(900, None), (901, ""), (902, "one two"), (903, "one, two!"), (None, "one two"), (902, "one two")]
    got = C.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs)


def test_blocks_count_each_pair_once():
    r = random.Random(1)
    base = [r.getrandbits(60) for _ in range(100)]
    members = []
    for i in range(12):
        s = np.unique(np.array(base[i % 4 :] + [r.getrandbits(60) for _ in range(i % 5)], np.uint64))
        members.append({"sig": bytes([i]), "shingles": s.tobytes(), "sketch": C.sketch(s).tobytes(), "copies": 1 + i % 3, "own": i % 2})
    whole = {x["sig"]: (x["n_links"], x["n_texts"]) for x in C._verify([m | {"i": 0, "j": 0, "own": 0} for m in members])}
    total = {m["sig"]: [0, 0] for m in members}
    for i, j in ((0, 0), (0, 1), (1, 1)):
        some = sorted((m | {"i": i, "j": j} for m in members if m["own"] in (i, j)), key=lambda m: m["own"])
        for x in C._verify(some):
            total[x["sig"]][0] += x["n_links"]
            total[x["sig"]][1] += x["n_texts"]
    assert whole == {k: tuple(v) for k, v in total.items()}


def test_components_of_near_matrices():
    near = np.eye(5, dtype=bool)
    near[1, 3] = near[3, 1] = near[3, 4] = near[4, 3] = True
    assert C._roots(near, True) == [0, 1, 2, 1, 1]
    # rows 0, 1, 2 and columns 3, 4
    assert C._roots(np.array([[True, False], [False, True], [False, True]]), False) == [0, 1, 1, 0, 1]


def test_components_of_edges(spark):
    r = random.Random(3)
    key = lambda i: i.to_bytes(2, "big")
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    got = {bytes(x.node): bytes(x.root) for x in C.components(spark.createDataFrame([(key(a), key(b)) for a, b in pairs], "a binary, b binary")).collect()}
    top = {i: i for p in pairs for i in p}
    for _ in top:
        for a, b in pairs:
            top[a] = top[b] = min(top[a], top[b])
    assert got == {key(i): key(t) for i, t in top.items()}
    assert C.components(spark.createDataFrame([], "a binary, b binary")).count() == 0


def test_crowds_and_boilerplate_are_found_alike(spark, monkeypatch):
    """With small limits, buckets are split several times, crowds are dealt into blocks: rows as by comparing all pairs."""
    monkeypatch.setattr(C, "LIMIT", 8)
    monkeypatch.setattr(C, "BLOCK", 10)
    monkeypatch.setattr(C, "BLOCK_SHINGLES", 600)
    r = random.Random(9)
    words = [f"v{i}" for i in range(900)]
    common = [r.choice(words) for _ in range(60)]
    docs = [(i, " ".join(common + [r.choice(words) for _ in range(60)])) for i in range(60)]
    crowd = [r.choice(words) for _ in range(120)]
    for i in range(40):
        copy = list(crowd)
        copy[r.randrange(len(copy))] = r.choice(words)
        docs.append((100 + i, " ".join(copy)))
    got = C.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs)


def test_a_task_of_long_texts_stays_small():
    """Two blocks of near copies, at the bounds of a task, in a process of its own."""
    import subprocess
    import sys

    code = """
import numpy as np
from weft.llm import chosen_path as C
r = np.random.default_rng(1)
base = np.unique(r.integers(0, 2**63, 20000).astype(np.uint64))
n = C.BLOCK_SHINGLES // 20000
members = []
for i in range(2 * n):
    s = base.copy(); s[r.integers(0, len(s), 300)] = r.integers(0, 2**63, 300).astype(np.uint64)
    members.append({"sig": i.to_bytes(16, "big"), "shingles": np.unique(s).tobytes(), "copies": 1, "own": i // n, "i": 0, "j": 1})
peak = lambda: int(next(x for x in open("/proc/self/status") if x.startswith("VmHWM")).split()[1]) / 1024
before = peak()
out = C._verify(members)
assert all(x["n_links"] == n for x in out) and len(out) == 2 * n
print(peak(), before)
"""
    peak, before = map(float, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())
    assert peak < 300, (peak, before)


def test_runs_meet_the_target():
    assert C.runs_needed(0.99, 1) == 5 and C.runs_needed(0.9999, 2) == 15


def test_edges(odd_docs, no_docs):
    got = {(r.doc_id, r.class_id, r.n_links) for r in C.join(odd_docs).collect()}
    assert {(1, 1, 3), (2, 1, 3), (6, 1, 3), (3, 3, 0), (4, 4, 0), (7, 7, 0), (None, None, 0), (5, 5, 0)} == got
    assert C.join(no_docs).count() == 0
