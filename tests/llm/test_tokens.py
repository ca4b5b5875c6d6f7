import random
import struct
import zlib
from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weft.llm import bpe, token_files
from weft.llm.common import shared_dir

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
CHARS = "aab \n\t'ést0192.,!<|>ÀÉİΣς日本́ǅ̈ 　\x1c\x85—😀½²lS#*"


@pytest.fixture(scope="module")
def byte_lib():
    return Tokenizer.from_file(BYTE)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=CHARS, max_size=60))
def test_bpe_equals_the_library(text):
    lib, own = Tokenizer.from_file(BYTE) if not hasattr(test_bpe_equals_the_library, "lib") else test_bpe_equals_the_library.lib, bpe.load(BYTE)
    test_bpe_equals_the_library.lib = lib
    want = lib.encode(text, add_special_tokens=False).ids
    assert list(array("I", own.encode(text))) == want
    assert own.decode(own.encode(text)) == lib.decode(want, skip_special_tokens=False)


def test_bpe_long_pieces(byte_lib):
    r = random.Random(1)
    for text in ("a" * 3000, "ab" * 2000, " " * 500, "".join(r.choice("etaoinshr") for _ in range(20000)), "<|endoftext|>" * 3):
        assert list(array("I", bpe.load(BYTE).encode(text))) == byte_lib.encode(text, add_special_tokens=False).ids


def test_bpe_edges(odd_docs, no_docs, byte_lib):
    out = bpe.round_trip(odd_docs, BYTE)
    assert set(out.columns) == set(odd_docs.columns) | {"ids", "decoded"}
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        want = byte_lib.encode(r.text or "", add_special_tokens=False).ids
        assert list(array("I", bytes(r.ids))) == want
        assert r.decoded == (r.text or "")
    assert bpe.round_trip(no_docs, BYTE).count() == 0
    assert bpe.decode(bpe.encode(odd_docs.select("text"), BYTE), BYTE).filter("decoded <> coalesce(text, '')").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=CHARS, max_size=40), max_size=8))
def test_word_encoder_equals_the_library(texts):
    enc = token_files.load(WORD)
    kind = "H" if enc.width == 2 else "I"
    want = [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    assert [list(array(kind, x)) for x in enc.encode(texts)] == want


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 40, 700])
def test_perfect_hash_is_minimal(n):
    r = random.Random(n)
    for _ in range(20):
        keys = [str(r.random()) for _ in range(n)]
        m = token_files.PerfectHash.build(keys)
        if n:
            h, b, _ = token_files.key_hashes(keys)
            assert sorted(m.slots(h, b).tolist()) == list(range(n))


def test_files_round_trip(spark, odd_docs, no_docs):
    folder = shared_dir(spark)
    made = token_files.write(odd_docs, WORD, folder, file_bytes=30_000)
    rows = sorted(token_files.read(made).collect(), key=lambda r: r.start)
    lib = Tokenizer.from_file(WORD)
    docs = sorted(odd_docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [None if r.key is None else int(r.key) for r in rows] == [d.doc_id for d in docs]
    start = 0
    for r in rows:
        assert r.start == start
        start += len(r.ids) // 4
    want = sorted((d.doc_id or -1, zlib.crc32(struct.pack(f"<{len(i)}I", *i))) for d in docs for i in [lib.encode(d.text or "", add_special_tokens=False).ids + [2]])
    assert sorted((int(r.key) if r.key else -1, zlib.crc32(bytes(r.ids))) for r in rows) == want
    first = made.orderBy("file").first()
    reader = token_files.Reader(first.path)
    assert all(len(x) == 0 for x in reader.find([f"absent{i}" for i in range(200)]))
    assert [len(x) for x in reader.find([None])] == [1]
    assert token_files.read(token_files.write(no_docs, WORD, shared_dir(spark))).count() == 0


def test_lookup_over_files(spark):
    r = random.Random(6)
    rows = [(i, " ".join(r.choice("abcdef") for _ in range(r.randint(0, 30)))) for i in r.sample(range(-50, 3000), 300)]
    rows += [(7000, f"hot {i}") for i in range(120)] + [(None, "null key"), (None, None)]  # a key of many rows may lie in several files
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made = token_files.write(docs, WORD, shared_dir(spark), file_bytes=1500)
    assert made.count() > 3
    asked = [k for k, _ in rows[:50]] + [7000, None, 12345, -999, rows[0][0]]
    got = token_files.lookup(made, spark.createDataFrame([(k,) for k in asked], "doc_id long"), "doc_id").collect()
    lib = Tokenizer.from_file(WORD)
    want = [(None if k is None else str(k), struct.pack(f"<{len(i)}I", *i)) for k, t in rows if k in set(asked) for i in [lib.encode(t or "", add_special_tokens=False).ids + [2]]]
    assert sorted(((x.key, bytes(x.ids)) for x in got), key=str) == sorted(want, key=str)
    text = spark.createDataFrame([("b", "x"), ("a10", "y"), ("a9", "z")], "id string, text string")
    made = token_files.write(text, WORD, shared_dir(spark), key="id", file_bytes=1)
    assert [x.key for x in token_files.lookup(made, spark.createDataFrame([("a9",), ("a",)], "id string"), "id").collect()] == ["a9"]


def test_query_has_the_contracts_columns(spark, sf_dir):
    rows = sorted(token_files.op1_token_files(spark, sf_dir).collect(), key=lambda r: r.doc_id)
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda d: d.doc_id)
    lib, start = Tokenizer.from_file(WORD), 0
    assert [r.doc_id for r in rows] == [d.doc_id for d in docs]
    for r, d in zip(rows, docs, strict=True):
        ids = lib.encode(d.text or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_bpe_query_has_the_contracts_columns(spark, sf_dir, byte_lib):
    import hashlib

    rows = {r.doc_id: r for r in bpe.op8_bpe(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert sorted(rows) == sorted(d.doc_id for d in docs)
    for d in docs:
        ids = byte_lib.encode(d.text or "", add_special_tokens=False).ids
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(byte_lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_files_are_cut_by_bytes(spark, tmp_path):
    """Long texts side by side make no long file, whatever the keys are; null keys come first, keys beyond 2 ** 53 keep their order."""
    rows = [(2**60 + i, "word " * (2000 if i < 50 else 2), f"k{i:04}é") for i in range(1000)] + [(None, "null key", None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, name string").repartition(7)
    for key in ("doc_id", "name"):
        made = token_files.write(df, public_tokenizers.path("word_bpe_49k.json"), "file://" + str(tmp_path / key), key=key, file_bytes=100_000)
        files = made.orderBy("file").collect()
        assert 5 <= len(files) <= 7 and max(f.n_tokens for f in files) <= 2 * sum(f.n_tokens for f in files) / len(files)
        got = token_files.read(made).orderBy("start").collect()
        assert [r.key for r in got] == [None] * 3 + [str(r[0 if key == "doc_id" else 2]) for r in rows[:1000]]
    assert token_files._bounds(df.limit(0).select(df.doc_id.alias("k"), df.doc_id.alias("h"), df.doc_id.alias("size")), 10) == []
