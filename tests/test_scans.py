"""Files and partitions that many tasks run over give what one task gives."""

import random
import re

import pytest
from pyspark.sql import functions as F

from weft.operators import relational as R
from weft.operators import scans as C
from weft.sources import tables as S


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_lines_of_split_files(spark, tmp_path, small_splits):
    r = random.Random(1)
    files = {}
    for name, n, end in (("a.txt", 9000, "\n"), ("b.txt", 3, ""), ("c d é.txt", 4000, "\r\n\n"), ("empty.txt", 0, "")):
        lines = ["".join(r.choices("abé\t", k=r.choice([0, 3, 40]))) for _ in range(n)]
        (tmp_path / name).write_bytes(("\r\n".join(lines) + end).encode())
        files[name] = {(i, x) for i, x in enumerate(lines) if x}
    df = S.read_lines(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    got = {}
    for x in df.collect():
        got.setdefault(x.file.rpartition("/")[2].replace("%20", " ").replace("%C3%A9", "é"), set()).add((x.pos, x.line))
    assert got == {k: v for k, v in files.items() if v}


def test_sections_over_segments(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT", 37)
    r = random.Random(2)
    lines = [r.choice(["$== PERSON", "$== PLACE", *["head" + str(i % 7), "–child" + str(i)] * 3, ""]) for i in range(3000)]
    (tmp_path / "s.txt").write_text("\n".join(lines))
    want, open_, record = [], False, 0
    for i, x in enumerate(lines):
        if x.startswith("$=="):
            open_ = x == "$== PERSON"
        elif open_ and x:
            record += not x.startswith("–")
            if record:
                want.append((i, x, record))
    c = F.col("line")
    s = S.sectioned(S.read_lines(spark, str(tmp_path / "s.txt")), c == "$== PERSON", c == "$== PLACE", ~c.startswith("–"), c.startswith("–"))
    assert sorted((x.pos, x.line, x.record) for x in s.collect()) == want


def test_markup_over_segments(spark, tmp_path, small_splits, monkeypatch):
    r = random.Random(3)
    lines = []
    for b in range(6):
        lines.append(f"\\id B{b}")
        for ch in range(1, 5):
            lines.append(f"\\c {ch}")
            for v in range(1, 30, 2):
                lines += [f"\\v {v}{r.choice(['', f'-{v + 1}'])} w{v} \\v {v + 50} x"] + [f"more {k}" for k in range(r.randint(0, 2))]
    (tmp_path / "m.usfm").write_text("\n".join(lines))
    read = lambda: sorted((x.book, x.chapter, x.verse, x.text) for x in S.usfm_passages(S.read_lines(spark, str(tmp_path / "m.usfm"))).collect())
    whole = read()
    monkeypatch.setattr(C, "SEGMENT", 11)
    assert read() == whole and len({x[:3] for x in whole}) == len(whole) > 6 * 4 * 30
    assert [x for x in whole if x[:3] == ("B0", 1, 51)][0][3].startswith("x")


@pytest.mark.parametrize("end", ["</verse>", "</verse>\n</doc>\n", "</verse><verse ref='open'>never closed"])
def test_elements_of_a_split_file(spark, tmp_path, small_splits, end):
    r = random.Random(4)
    text = "<doc>\n" + "</verse>\n".join(f"<verse\n ref='A {i % 900}'>" + "<b>w</b>\n" * r.randint(0, 20) + f"{i} <verse" for i in range(2000)) + end
    (tmp_path / "x.xml").write_text(text)
    want = {}
    for x in re.findall(r"(?s)<verse\b[^>]*>.*?</verse>", text):
        body = re.sub(r"\s+", " ", re.sub(r"<[^>]*>", " ", x)).strip()
        want.setdefault(re.search(r"ref\s*=\s*[\"']([^\"']*)", x)[1], []).append(body)
    got = {x.ref: x.text for x in S.xml_passages(spark, str(tmp_path / "x.xml")).collect()}
    assert got == {k: " ".join(v) for k, v in want.items()} and len(got) == 900


def test_forward_fill_of_one_partition(spark):
    r = random.Random(5)
    rows = [(r.choice([None, "hot", "hot", "hot", "x", f"p{i % 50}"]), i, r.random() < 0.01, r.choice([None, f"v{i}"])) for i in range(20_000)]
    df = spark.createDataFrame(r.sample(rows, len(rows)), "p string, i int, opens boolean, v string")
    got = {x.i: (x.section, x.opener) for x in R.filled_forward(df, ["p"], ["i"], F.col("opens"), "v").collect()}
    state, want = {}, {}
    for p, i, opens, v in rows:
        n, last = state.get(p, (0, None))
        state[p] = (n + opens, v if opens and v is not None else last)
        want[i] = state[p]
    assert got == want
    assert R.filled_forward(df.limit(0), ["p"], ["i"], F.col("opens"), "v").count() == 0
