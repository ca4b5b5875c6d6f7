"""Token-id files with a minimal perfect hash index.

``write`` deals documents by ranges of their key, cut by the bytes of their texts, encodes them and writes one
binary file for each range: the ids of all its documents, one after the other as
little-endian unsigned 32-bit integers, then the keys in order, then an index. The
index is a minimal perfect hash of the file's distinct keys (hash and displace):
a key gives a bucket, the bucket's pilot gives a slot, and the slot holds a
32-bit fingerprint of the key, its first entry and the number of its entries.
So a look-up costs one hash, one pilot and one slot, whatever the file's size, and
an absent key is told by its fingerprint; what passes it is held against the stored key. Over all files,
``lookup`` finds a key's files by a binary search of their first and last keys, which are sent to
the executors (some 100 bytes a file, of ``MAX_FILES`` at most), and then its entries by their indexes.

File: ``WTOK``, version and bytes of an id, payload, sections, then a footer of section offsets.
Files go to the shared folder under a name of their own and are renamed when
whole, so tasks that run again replace their file by an equal one.

Memory is bounded by a batch of texts and a file's index: texts stream from the
sorted partition to the file, and ``read`` fetches each document by its offset.

Defined results: a null or empty text has only the end id. A null key comes first
and is found as None. Rows of one key lie side by side, in order of their texts'
hashes, and each has an entry of its own. No documents give no files.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from array import array
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import byte_chars
from .common import hold, shared_dir, short_batches, table

MAGIC = b"WTOK\x01\x00\x00"
#: Bytes of text in a file, about, and how many files there are at most: beyond, files are larger. A file is one task's work.
FILE_BYTES = 32 << 20
MAX_FILES = 16_384
#: Places in a file's range at which it may be cut.
CUTS = 16
#: Pieces in a worker's memo before it becomes the older one and a new one begins; about 160 bytes each.
MEMO = 1_000_000
MANIFEST = "file long, path string, n_docs long, n_tokens long, first_key string, last_key string"
SECTIONS = ("keys", "key_ends", "key_null", "starts", "pilots", "prints", "first", "count")


def filesystem(uri: str):
    """Arrow's file system of a URI and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class Encoder:
    """A tokenizers file, with a memo of what it gave for pieces between white space.

    It is for tokenizers that drop white space before they split words, as
    ``word_bpe_49k.json`` does: no id then depends on what is beyond white space.
    Texts with special tokens or rare white space are encoded as they are.
    """

    odd = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|<\|").search
    odd_bytes = b"\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
    #: Beyond these, lower-casing and composition by the library and by Python may differ.
    beyond_latin = re.compile(r"[^\x00-\u024f]|\u0130").search
    letters = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+").fullmatch
    word_and_marks = re.compile(r"([a-z\xdf-\xf6\xf8-\xff]+)([.,;:!?#*$%&|)\"]+)").fullmatch

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        #: Bytes of an id.
        self.width = 2 if self.tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.memo = Pieces(self, {})
        #: The characters that stand for bytes in the vocabulary.
        self.char_of = {b: c for c, b in byte_chars().items()}
        tries = ["the", "straße", "éaux", "zzzqx", "internationalisation", "ÿß".lower()]
        #: Whether a word of lower-case letters goes to the model as it is, byte by byte.
        self.plain = [self._word(w) for w in tries] == self._ids(tries)

    def _word(self, word: str) -> bytes:
        """Ids of a word of lower-case Latin letters, by the library's model alone: normalising and splitting leave it as it is."""
        data = word if word.isascii() else "".join(map(self.char_of.__getitem__, word.encode()))
        return array("H" if self.width == 2 else "I", [t.id for t in self.tok.model.tokenize(data)]).tobytes()

    def _ids(self, texts: list[str]) -> list[bytes]:
        kind = "H" if self.width == 2 else "I"
        return [array(kind, e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, text: str) -> list[str] | None:
        """The text's pieces between white space, in lower case; None if it must be encoded as it is."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            if self.odd(text):
                return None
            return (text if self.beyond_latin(text) else text.lower()).split()
        # the same test as ``odd``, on one byte a character
        if len(raw.translate(None, self.odd_bytes)) < len(raw) or "<|" in text:
            return None
        return text.lower().split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        get, out = self.memo.__getitem__, []
        for t in texts:
            s = self.pieces(t or "")
            out.append(self._ids([t])[0] if s is None else b"".join(map(get, s)))
        if len(self.memo) > MEMO:
            self.memo = Pieces(self, self.memo)
        return out


class Pieces(dict):
    """Ids of pieces, found when they are first asked for; what ``older`` knows is not found anew."""

    def __init__(self, encoder: Encoder, older: dict[str, bytes]):
        self.encoder, self.older = encoder, dict(older)  # without its own older ones

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            e = self.encoder
            if e.plain and e.letters(piece):
                out = e._word(piece)
            elif m := e.word_and_marks(piece):
                out = self[m[1]] + self[m[2]]
            else:
                out = e._ids([piece])[0]
        self[piece] = out
        return out


@lru_cache(maxsize=1)
def load(path: str) -> Encoder:
    return Encoder(path)


def forget() -> None:
    load.cache_clear()


def key_hashes(keys: list[str | None]):
    """A 64-bit hash, a 32-bit one for the bucket and a 32-bit fingerprint of each key."""
    import numpy as np
    import xxhash

    d = b"".join(xxhash.xxh3_128_digest(b"\x00" if k is None else b"\x01" + k.encode()) for k in keys)
    h = np.frombuffer(d, "<u8").reshape(-1, 2)
    return h[:, 0], h[:, 1] >> np.uint64(32), (h[:, 1] & np.uint64(0xFFFFFFFF)).astype("<u4")


def _spread(h, d, n: int):
    """A place below ``n`` for each hash, another one for each ``d``."""
    import numpy as np

    x = h + np.asarray(d, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(n)).astype(np.int64)


class PerfectHash:
    """Minimal and perfect over its keys: n keys, slots 0 to n - 1."""

    PER_BUCKET = 4

    def __init__(self, pilots, n: int):
        self.pilots, self.n = pilots, n

    @classmethod
    def build(cls, keys: list[str | None]) -> PerfectHash:
        import numpy as np

        n = len(keys)
        buckets = max(1, -(-n // cls.PER_BUCKET))
        pilots = np.zeros(buckets, "<u8")
        if not n:
            return cls(pilots, 0)
        h, b, _ = key_hashes(keys)
        b = (b % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(b, kind="stable")
        ends = np.searchsorted(b[order], np.arange(buckets + 1))
        free = np.ones(n, bool)
        at = np.arange(n)
        for k in sorted(range(buckets), key=lambda k: ends[k] - ends[k + 1]):
            own = order[ends[k] : ends[k + 1]]
            if not len(own):
                break
            for d in range(1 << 20):
                p = _spread(h[own], np.array([d], np.uint64), n)
                if len(own) > 1 and len(set(p.tolist())) < len(own):
                    continue
                fits = free[(at + p[0]) % n]
                for x in p[1:]:
                    fits = fits & free[(at + x) % n]
                if (shift := int(fits.argmax())) or fits[0]:
                    free[(p + shift) % n] = False
                    pilots[k] = d * n + shift
                    break
            else:
                raise ValueError("no pilot found: two keys have equal hashes")
        return cls(pilots, n)

    def slots(self, h, b):
        import numpy as np

        n = np.uint64(self.n)
        pilot = self.pilots[(b % np.uint64(len(self.pilots))).astype(np.int64)]
        return (_spread(h, pilot // n, self.n) + (pilot % n).astype(np.int64)) % self.n


class Writer:
    """Streams documents in key order to one file; ``close`` gives its manifest row."""

    def __init__(self, folder: str, number: int, width: int = 4):
        self.number, self.width = number, width
        self.fs, self.folder = filesystem(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.uri = f"{folder}/tokens-{number:08d}.bin"
        self.path = f"{self.folder}/tokens-{number:08d}.bin"
        self.tmp = f"{self.folder}/_{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.tmp)
        self.out.write(MAGIC + bytes([width]))
        self.keys: list[str | None] = []
        self.lengths = array("q")

    def add(self, keys: list[str | None], ids: list[bytes]) -> None:
        self.out.write(b"".join(ids))
        self.keys += keys
        self.lengths.extend(len(x) // self.width for x in ids)

    def close(self) -> dict:
        import numpy as np

        starts = np.concatenate([[0], np.cumsum(np.array(self.lengths, np.int64))]).astype("<u8")
        first, count, distinct = [], [], []
        for i, k in enumerate(self.keys):
            if i and k == self.keys[i - 1]:
                count[-1] += 1
            else:
                distinct.append(k)
                first.append(i)
                count.append(1)
        mph = PerfectHash.build(distinct)
        firsts, counts, prints = (np.zeros(len(distinct), "<u4") for _ in range(3))
        if distinct:
            h, b, fingerprint = key_hashes(distinct)
            slot = mph.slots(h, b)
            firsts[slot], counts[slot], prints[slot] = first, count, fingerprint
        raw = [(k or "").encode() for k in self.keys]
        sections = {
            "keys": b"".join(raw),
            "key_ends": np.cumsum([len(r) for r in raw]).astype("<u8").tobytes(),
            "key_null": bytes(k is None for k in self.keys),
            "starts": starts.tobytes(),
            "pilots": mph.pilots.tobytes(),
            "prints": prints.tobytes(),
            "first": firsts.tobytes(),
            "count": counts.tobytes(),
        }
        at, table_ = 8 + self.width * int(starts[-1]), []
        for name in SECTIONS:
            self.out.write(sections[name])
            table_ += [at, len(sections[name])]
            at += len(sections[name])
        self.out.write(struct.pack(f"<{len(table_)}QQ", *table_, at))
        self.out.close()
        self.fs.move(self.tmp, self.path)
        return {"file": self.number, "path": self.uri, "n_docs": len(self.keys), "n_tokens": int(starts[-1]), "first_key": self.keys[0], "last_key": self.keys[-1]}

    def drop(self) -> None:
        self.out.close()
        self.fs.delete_file(self.tmp)


class Reader:
    """Keyed access to one file: its index in memory, ids fetched by offset."""

    def __init__(self, uri: str):
        import numpy as np

        fs, path = filesystem(uri)
        self.f = fs.open_input_file(path)
        end, n = self.f.size(), 2 * len(SECTIONS)
        *at, index_end = struct.unpack(f"<{n + 1}Q", self.f.read_at(8 * (n + 1), end - 8 * (n + 1)))
        *magic, self.width = self.f.read_at(8, 0)
        if bytes(magic) != MAGIC or index_end != end - 8 * (n + 1):
            raise ValueError(f"{uri} is not a whole token file")
        part = {s: self.f.read_at(at[2 * i + 1], at[2 * i]) for i, s in enumerate(SECTIONS)}
        self.starts = np.frombuffer(part["starts"], "<u8")
        self.prints, self.first, self.count = (np.frombuffer(part[s], "<u4") for s in ("prints", "first", "count"))
        self.mph = PerfectHash(np.frombuffer(part["pilots"], "<u8"), len(self.prints))
        ends = np.frombuffer(part["key_ends"], "<u8").tolist()
        begins = [0, *ends[:-1]]
        self._keys = (part["keys"], begins, ends, part["key_null"])

    def keys(self) -> list[str | None]:
        """Keys in the order of the payload, each entry's own."""
        raw, begins, ends, null = self._keys
        return [None if z else raw[a:b].decode() for a, b, z in zip(begins, ends, null, strict=True)]

    def find(self, keys: list[str | None]) -> list[range]:
        """The entries of each key; an empty range for an absent one."""
        if not len(self.prints) or not keys:
            return [range(0)] * len(keys)
        h, b, fingerprint = key_hashes(keys)
        slot = self.mph.slots(h, b)
        hit = (self.prints[slot] == fingerprint).tolist()
        first, count = self.first[slot].tolist(), self.count[slot].tolist()
        return [range(i, i + n) if ok and self._key(i) == k else range(0) for k, ok, i, n in zip(keys, hit, first, count, strict=True)]

    def _key(self, entry: int) -> str | None:
        raw, begins, ends, null = self._keys
        return None if null[entry] else raw[begins[entry] : ends[entry]].decode()

    def ids(self, entry: int) -> bytes:
        """The ids of an entry as little-endian unsigned 32-bit integers."""
        import numpy as np

        a, b = int(self.starts[entry]), int(self.starts[entry + 1])
        data = self.f.read_at(self.width * (b - a), 8 + self.width * a)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4").tobytes()

    def close(self) -> None:
        self.f.close()


def _rank(k, h: int) -> tuple:
    """How (key, hash) is ordered: null first, text by its bytes as Spark orders it."""
    return (k is not None, (k.encode() if isinstance(k, str) else k) if k is not None else 0, h)


def _bounds(narrow: DataFrame, file_bytes: int) -> list[tuple]:
    """Where ranges of (k, h) begin, all but the first, so that each has about ``file_bytes`` of ``size``; at most ``MAX_FILES`` ranges.

    Rows without their texts are put in order once; each task sums what it has and tells the places of some of its rows, ``CUTS`` for a file's bytes.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    total = int(narrow.agg(F.sum("size")).first()[0] or 0)
    n = max(1, min(-(-total // file_bytes), MAX_FILES))
    if n == 1:
        return []
    step = max(total // n // CUTS, 1)
    kind = narrow.select("k", "h").schema.add("part", "long").add("below", "long").add("last", "boolean")
    types = to_arrow_schema(kind).types

    def mark(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, below, rows, k, h = TaskContext.get().partitionId(), 0, [], None, 0
        for b in batches:
            for k, h, size in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if below // step != (below + size) // step or not below:
                    rows.append((k, h, part, below, False))
                below += size
        if below:
            rows.append((k, h, part, below, True))
        columns = zip(*rows, strict=True) if rows else ([],) * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=kind.names)

    ordered = narrow.repartitionByRange(F.col("k").asc_nulls_first(), "h").sortWithinPartitions(F.col("k").asc_nulls_first(), "h")
    told = sorted(ordered.mapInArrow(mark, kind).collect(), key=lambda r: (r.part, r.below, r["last"]))
    out, before = [], 0
    for r in told:  # a place is taken if it is the first at or beyond the next file's beginning
        if r["last"]:
            before += r.below
        elif before + r.below >= (len(out) + 1) * total // n and len(out) < n - 1:
            out.append(_rank(r.k, r.h))
    return sorted(set(out))


def _place(bounds: list[tuple]):
    """A function of (k, h): the number of bounds at or before it."""
    import bisect

    import pyarrow as pa

    def at(k, h):
        return pa.array([bisect.bisect_right(bounds, _rank(a, b)) for a, b in zip(k.to_pylist(), h.to_pylist(), strict=True)], pa.int32())

    at.__annotations__ = dict.fromkeys(("k", "h", "return"), pa.Array)  # whole numbers stay whole, unlike in pandas
    return F.arrow_udf(at, "int")


def write(
    docs: DataFrame, tokenizer: str, folder: str, key: str = "doc_id", text: str = "text", end_id: int | None = 2, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Writes ``docs`` in ascending order of ``key`` below ``folder``; the files' manifest, as a written table."""
    spark = docs.sparkSession
    short_batches(spark)
    dealt = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("h"))
    bounds = _bounds(dealt.select("k", "h", (F.coalesce(F.octet_length("t"), F.lit(0)) + 1).cast("long").alias("size")), file_bytes)
    dealt = dealt.withColumn("at", _place(bounds)("k", "h")).repartitionById(len(bounds) + 1, "at").sortWithinPartitions(F.col("k").asc_nulls_first(), "h")
    dealt = dealt.select(F.col("k").cast("string").alias("k"), "t")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        hold(__name__)
        out, enc = None, load(tokenizer)
        end = end_id.to_bytes(enc.width, "little") if end_id is not None else b""
        try:
            for b in batches:
                if not b.num_rows:
                    continue
                out = out or Writer(folder, TaskContext.get().partitionId(), enc.width)
                out.add(b.column(0).to_pylist(), [x + end for x in enc.encode(b.column(1).to_pylist())])
            if out:
                row, out = out.close(), None
                yield pa.RecordBatch.from_pylist([row])
        finally:
            if out:
                out.drop()

    made = dealt.mapInArrow(run, MANIFEST)
    made.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Each document of the files by a look-up of its key: key, file, n_tokens, ids (binary) and start over all files."""
    total = F.sum("n_tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("base", F.coalesce(total, F.lit(0)))

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("key", pa.string()), ("file", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
        for b in batches:
            for f in b.to_pylist():
                r = Reader(f["path"])
                keys = r.keys()
                for i in range(0, len(keys), 256):
                    some = list(dict.fromkeys(keys[i : i + 256]))
                    if i and some and some[0] == keys[i - 1]:
                        some = some[1:]  # its entries are out already
                    rows = [
                        {"key": k, "file": f["file"], "start": f["base"] + int(r.starts[e]), "ids": r.ids(e)}
                        for k, found in zip(some, r.find(some), strict=True)
                        for e in found
                    ]
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                r.close()

    n = max(1, manifest.count())
    return files.select("file", "path", "base").repartition(n, "file").mapInArrow(run, "key string, file long, start long, ids binary")


def lookup(manifest: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The entries of each different key of ``keys``, over all files: key (text), file, start in it, ids. Absent keys have no row.

    Keys are ordered as their column's type is, whole numbers or text, null first.
    """
    import bisect

    number = keys.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    rank = (lambda k: (k is not None, int(k) if k is not None else 0)) if number else (lambda k: (k is not None, (k or "").encode()))
    files = sorted(manifest.select("file", "path", "first_key", "last_key").collect(), key=lambda f: f.file)
    first, last = [rank(f.first_key) for f in files], [rank(f.last_key) for f in files]
    sent = keys.sparkSession.sparkContext.broadcast((first, last, [f.file for f in files], [f.path for f in files]))

    def place(batches):
        import pyarrow as pa

        firsts, lasts, numbers, _ = sent.value
        for b in batches:
            out = [(k, i) for k in b.column(0).to_pylist() for i in range(bisect.bisect_left(lasts, rank(k)), bisect.bisect_right(firsts, rank(k)))]
            yield pa.record_batch([pa.array([k for k, _ in out], pa.string()), pa.array([i for _, i in out], pa.int32())], ["key", "at"])

    def fetch(batches):
        import pyarrow as pa

        _, _, numbers, paths = sent.value
        schema = pa.schema([("key", pa.string()), ("file", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
        reader, now = None, None
        for b in batches:
            found = []
            for k, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if i != now:
                    if reader:
                        reader.close()
                    reader, now = Reader(paths[i]), i
                found += [{"key": k, "file": numbers[i], "start": int(reader.starts[e]), "ids": reader.ids(e)} for e in reader.find([k])[0]]
            yield pa.RecordBatch.from_pylist(found, schema)
        if reader:
            reader.close()

    short_batches(keys.sparkSession)
    placed = keys.select(F.col(key).cast("string").alias("key")).distinct().mapInArrow(place, "key string, at int")
    return placed.repartition("at").sortWithinPartitions("at").mapInArrow(fetch, "key string, file long, start long, ids binary")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = shared_dir(spark)
    made = write(docs, public_tokenizers.path("word_bpe_49k.json"), folder)
    return read(made).select(
        F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


QUERIES = {"op1_token_files": op1_token_files}
ORACLE_SQL: dict[str, str] = {}
