"""Spelling variants: words one edit apart, each grouped under the frequent word that it varies.

Of two words one insertion, deletion or replacement apart, one half of either stands unchanged at the same end of the
other. So the words of one length are dealt into shards, and a shard's task builds an Aho-Corasick automaton of both
halves of each of its words. All words that are at most one code point longer or shorter are scanned past it; a half
that is found where it must stand (the first at the start, the second at the end) names words whose other half is then
verified. Halves that many words share are split in halves again, so no list of all words of a common beginning is
compared. A scan gives one row a word and shard, the number of near words and the best of them, never the pairs.

Defined results: a null or empty text has no words; a null id is the empty text in the damage rule; repeated rows count
as often as they occur; an empty table gives no words; ties of n go to the first word in code-point order. Other
columns are not read. Words may be of any length.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hold, short_batches, table, written

#: Letters of a run, [A-Za-zÀ-ÿ]; A-Z become a-z, all else ends a run. Over Latin-1 bytes, a byte a code point.
RUNS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: The query's damage: one in so many (document, run) loses a code point.
DAMAGE = 199
#: Words of an automaton, and words scanned past it in one task.
SHARD_WORDS = 50_000
SCAN_WORDS = 2_000_000
#: Words that share a half are compared one by one up to this number.
CROWD = 16
#: Different words that a task counts before it sends them on.
HELD_WORDS = 200_000


def damaged(doc_id: bytes, run: bytes, one_in: int) -> bytes:
    """A Latin-1 run, or the run without one code point where ``one_in`` divides the crc32 of ``<doc_id>:<run>``."""
    h = zlib.crc32(doc_id + b":" + (run if run.isascii() else run.decode("latin-1").encode()))
    at = h % len(run)
    return run if h % one_in else run[:at] + run[at + 1 :]


def words_of(doc_id: object, text: str | None, one_in: int | None = None, least: int = MIN_LENGTH) -> Counter:
    """How often a text has each word of ``least`` code points or more, as Latin-1."""
    runs = Counter(w for w in (text or "").encode("latin-1", "replace").translate(RUNS).split() if len(w) >= least)
    if not one_in:
        return runs
    name, out = str("" if doc_id is None else doc_id).encode(), Counter()
    for w, n in runs.items():
        if len(w := damaged(name, w, one_in)) >= least:
            out[w] += n
    return out


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", one_in: int | None = None, least: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all documents' words of ``least`` code points and ``min_count`` occurrences or more; counted in the tasks before the shuffle."""
    import pyarrow as pa

    short_batches(docs.sparkSession)

    def count(batches):
        hold(__name__)
        held: Counter = Counter()

        def sent():
            b = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return b

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.update(words_of(i, t, one_in, least))
                if len(held) >= HELD_WORDS:
                    yield sent()
        yield sent()

    counts = docs.select(F.col(doc_id).cast("string"), F.col(text)).mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point tells two strings apart."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(b))
    return a[i + 1 :] == (b[i + 1 :] if len(a) == len(b) else b[i:])


class Rests:
    """What is left of words that share a half: finds those one edit from a given rest.

    More than ``CROWD`` are told apart by their own halves, of which one is unchanged again.
    """

    def __init__(self, items: list[tuple[str, str]]):
        self.items, self.sides, self.lengths = items, None, ()
        if len(items) > CROWD and max(len(r) for r, _ in items) > 1:
            heads, tails = defaultdict(list), defaultdict(list)
            for r, w in items:
                h = len(r) // 2
                heads[len(r), r[:h]].append((r[h:], w))
                tails[len(r), r[h:]].append((r[:h], w))
            if max(map(len, heads.values())) < len(items) or max(map(len, tails.values())) < len(items):
                self.lengths = sorted({n for n, _ in heads})
                self.sides = tuple({k: Rests(v) for k, v in side.items()} for side in (heads, tails))
                self.items = []

    def near(self, rest: str, out: set[str]) -> None:
        if self.sides is None:
            out.update(w for r, w in self.items if one_edit(r, rest))
            return
        heads, tails = self.sides
        for n in self.lengths:
            if abs(n - len(rest)) <= 1:
                h = n // 2
                if (x := heads.get((n, rest[:h]))) is not None:
                    x.near(rest[h:], out)
                if (x := tails.get((n, rest[len(rest) - (n - h) :] if len(rest) >= n - h else ""))) is not None:
                    x.near(rest[: len(rest) - (n - h)], out)


class Halves:
    """The automaton of both halves of words of one length."""

    def __init__(self, words: list[str]):
        import ahocorasick

        self.length, self.counts = len(words[0]), {}
        self.h = self.length // 2
        sides: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))
        for w in words:
            sides[w[: self.h]][0].append((w[self.h :], w))
            sides[w[self.h :]][1].append((w[: self.h], w))
        self.automaton = ahocorasick.Automaton()
        for half, (first, second) in sides.items():
            self.automaton.add_word(half, (len(half), Rests(first) if first else None, Rests(second) if second else None))
        self.automaton.make_automaton()

    def near(self, word: str) -> set[str]:
        """The words one edit away from ``word``, which is at most one longer or shorter."""
        out: set[str] = set()
        for end, (n, first, second) in self.automaton.iter(word):
            if first is not None and n == self.h and end == n - 1:
                first.near(word[n:], out)
            if second is not None and n == self.length - self.h and end == len(word) - 1:
                second.near(word[: len(word) - n], out)
        return out


def near_words(vocab: DataFrame, shard_words: int = SHARD_WORDS, scan_words: int = SCAN_WORDS) -> DataFrame:
    """(word, n_near, best, best_n) of the words of ``vocab`` (word, n), a written table, that have near words.

    Shards hold words of one length. A word is sent to the shards of its own length and the two beside it; a shard that many words
    would pass is built in several tasks, each of which scans its slice of them.
    """
    import pyarrow as pa

    v = vocab.select("word", "n", F.length("word").alias("len"))
    sizes = v.groupBy("len").agg(F.count("*").alias("n"))
    beside = sizes.select(F.explode(F.array(*[F.col("len") + d for d in (-1, 0, 1)])).alias("len"), "n").groupBy("len").agg(F.sum("n").alias("scans"))
    up = lambda c, most: F.ceil(F.col(c) / most).cast("int")
    bands = sizes.select("len", up("n", shard_words).alias("shards")).join(beside, "len").select(F.col("len").alias("band"), "shards", up("scans", scan_words).alias("slices"))
    h = lambda salt: F.xxhash64("word", F.lit(salt))
    inner = v.join(bands, F.col("len") == F.col("band")).select(
        "band", F.pmod(h(1), F.col("shards")).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("kind"), "word", "n"
    )
    wide = v.select("word", "n", F.explode(F.array(*[F.col("len") + d for d in (-1, 0, 1)])).alias("band")).join(bands, "band")
    scanned = wide.select("band", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.pmod(h(2), F.col("slices")).cast("int").alias("slice"), F.lit(1).alias("kind"), "word", "n")
    both = inner.unionByName(scanned).repartition("band", "shard", "slice").sortWithinPartitions("band", "shard", "slice", "kind")
    short_batches(vocab.sparkSession)

    def scan(batches):
        hold(__name__)
        key, counts, halves = None, {}, None
        for b in batches:
            out = []
            for band, shard, part, kind, word, n in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if (band, shard, part) != key:
                    key, counts, halves = (band, shard, part), {}, None
                if not kind:
                    counts[word] = n
                    continue
                if halves is None:
                    halves = Halves(list(counts))
                if found := halves.near(word):
                    best = min(found, key=lambda w: (-counts[w], w))
                    out.append((word, len(found), best, counts[best]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else ([],) * 4, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["word", "n_near", "best", "best_n"])

    got = both.mapInArrow(scan, "word string, n_near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return got.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.minus")).alias("best_n"))


def grouped(vocab: DataFrame, ratio: int = RATIO, min_count: int = MIN_COUNT, shard_words: int = SHARD_WORDS, scan_words: int = SCAN_WORDS) -> DataFrame:
    """``vocab`` (word, n) with ``form``, ``root``, ``n_near`` and ``form_n``.

    A word's form is its most frequent near word, if that is ``ratio`` times as frequent. Counts grow by ``ratio`` with each step from form
    to form, so the steps to a root are at most the logarithm of the greatest count; they are doubled in each join.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: forms of forms could run in circles")
    held = written(vocab)
    most = held.agg(F.max("n")).first()[0] or 0
    best = held.join(near_words(held, shard_words, scan_words), "word", "left")
    fits = F.col("best_n") >= ratio * F.col("n")
    words = written(best.select("word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best_n")).alias("form_n")))
    roots, steps = words.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), max(1, int(math.log(max(most / min_count, 1), ratio) + 1e-9))
    for _ in range(math.ceil(math.log2(steps))):
        next_ = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = written(roots.join(next_, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return words.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(vocabulary(table(spark, sf_dir, "documents"), one_in=DAMAGE))


ORACLE = r"""
WITH RECURSIVE crcs AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
counts AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashes AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(coalesce(doc_id::VARCHAR, '') || ':' || run), '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, v: xor(c >> 8, crc[xor(c & 255, v) + 1])), 4294967295) AS h FROM counts, crcs),
results AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashes),
v AS (SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, (i - 1)::INT) || substr(word, (i + 1)::INT) AS less FROM v, range(1, length(word) + 1) AS t(i)),
pairs AS (SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN v b ON a.less = b.word UNION SELECT b.word, a.word FROM cut a JOIN v b ON a.less = b.word),
near AS (SELECT p.word, o.word AS best, o.n AS best_n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, o.word) AS k FROM pairs p JOIN v o ON p.other = o.word),
w AS (SELECT v.word, CASE WHEN best_n >= 5 * n THEN best END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM v LEFT JOIN near ON v.word = near.word AND k = 1),
up(word, root) AS (SELECT word, word FROM w WHERE form IS NULL UNION ALL SELECT w.word, up.root FROM w JOIN up ON w.form = up.word)
SELECT w.word, form, root, n, n_near, form_n FROM w JOIN up ON w.word = up.word"""

QUERIES = {"op11_spelling_variants": op11_spelling_variants}
ORACLE_SQL = {"op11_spelling_variants": ORACLE}
