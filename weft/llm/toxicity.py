"""Toxicity by the nearest labelled examples.

Examples are a bounded sample of labelled documents: at most ``MAX_EXAMPLES`` rows and
``MAX_BYTES`` of text. All their words are index terms. A vector holds (1 + ln tf) * idf of
every word of a text, times ``FLOOR`` plus the squared correlation of the word's presence with
the label (``plain`` leaves this factor out), at length one; a word that no example has counts towards the length with
a frequency of 0. The index is inverted: for each term and block of examples the
postings and their greatest weight. A query adds up the blocks' greatest possible
cosines, scores blocks from the greatest down, and stops when no block left can
reach the k-th best: the neighbours are exactly those of all cosines. Terms of more than one
in ``ROWS`` examples are kept as whole rows, whose part of all cosines is one matrix product for a
batch of queries; bounds count it as it is. Examples with a common heaviest term lie side by
side, so that blocks differ. Votes are weighted by cosine; a monotone
map, fitted on examples' votes, makes them probabilities. An example with the same words and
counts as the query has no vote, in the fit as in scoring: no text is judged by its own label.

The index is broadcast; its size is bounded by ``MAX_EXAMPLES`` and ``MAX_BYTES``
whatever the corpus. Documents are scored where they are read. Words are told apart by
64-bit hashes.

Defined results: a text without any word of the examples, empty and null texts among them,
has no neighbours and the smoothed share of label 1 among examples without any. Without examples the
score is 0. Equal cosines go to the example of the lesser key. Repeated rows give
repeated results. Input columns named ``score``, ``evidence`` or ``cosines`` are replaced.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alnum_words, digest_mod, map_text, short_batches, table, written
from .labelled import sample

MAX_EXAMPLES = 4000
MAX_BYTES = 16_000_000
#: What a word weighs that tells nothing of the label; one that tells all weighs this and 1.
FLOOR = 0.01
BLOCK = 64
#: Terms that more than one in ``ROWS`` examples has are whole rows.
ROWS = 16
NEIGHBOURS = 9
#: Cosine's worth of the overall share in each vote.
PRIOR = 0.2
PREDICT = 0.7
#: Queries whose whole rows' part is computed at once.
BATCH = 128
_MEMO = 20_000


def hashed_counts(text: str | None):
    """Sorted hashes of the text's words, and how often each occurs."""
    import numpy as np
    import xxhash

    c = Counter(alnum_words(text))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, c), np.uint64, len(c))
    n = np.fromiter(c.values(), np.uint32, len(c))
    order = np.argsort(h)
    return h[order], n[order]


def digest(h, n) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(h.tobytes() + n.tobytes())


def ranges(begin, size):
    """All of begin[i] .. begin[i] + size[i] - 1, one range after the other."""
    import numpy as np

    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


class BlockMaxIndex:
    """Postings of unit vectors by term and block of ``BLOCK`` examples; terms of many examples as whole rows."""

    def __init__(self, vectors: list[tuple], labels, plain: bool = False):
        """``vectors``: sorted term hashes and counts of each example; examples in key order. ``plain``: weights are TF-IDF alone."""
        import numpy as np

        self.n = len(vectors)
        self.blocks = max(1, -(-self.n // BLOCK))
        h = np.concatenate([v[0] for v in vectors]) if vectors else np.zeros(0, np.uint64)
        own = np.repeat(np.arange(self.n), [len(v[0]) for v in vectors]) if vectors else np.zeros(0, np.int64)
        self.term, at = np.unique(h, return_inverse=True)
        df = np.bincount(at, minlength=len(self.term))
        hit = np.bincount(at, np.asarray(labels, float)[own], len(self.term)) if self.n else df
        n, p = float(max(self.n, 1)), float(sum(labels))
        spread = np.maximum(p * (n - p) * df * (n - df), 1e-300)
        told = np.where((df < n) & (0 < p < n), (n * hit - p * df) ** 2 / spread, 0.0)
        self.worth = (np.log((1 + n) / (1 + df)) + 1) * (1 if plain else FLOOR + told)
        self.unknown = (math.log(1 + n) + 1) * (1 if plain else FLOOR)
        weight = np.concatenate([self.unit(*v)[1] for v in vectors]) if vectors else np.zeros(0)
        # an example's place: by its heaviest term that others have too, then by key
        heaviest = np.full(self.n, -1)
        order = np.lexsort((np.where(df[at] > 1, weight, 0.0), own))
        last = np.flatnonzero(np.diff(own[order], append=-1))
        heaviest[own[order][last]] = at[order[last]]
        self.number = np.lexsort((np.arange(self.n), heaviest))  # of the example at each place, in key order
        place = np.empty(self.n, np.int64)
        place[self.number] = np.arange(self.n)
        where = place[own]
        common = df * ROWS > self.n
        self.row = np.where(common, np.cumsum(common) - 1, -1)
        self.rows = np.zeros((int(common.sum()), self.n))
        some = common[at]
        self.rows[self.row[at[some]], where[some]] = weight[some]
        at, where, weight = at[~some], where[~some], weight[~some]
        order = np.lexsort((where, at))
        self.example, self.weight = where[order].astype(np.int32), weight[order]
        slot = at[order] * self.blocks + where[order] // BLOCK
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        self.slot_block = slot[first] % self.blocks
        self.slot_most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.slot_begin = np.append(first, len(slot))
        self.term_begin = np.searchsorted(slot[first], np.arange(len(self.term) + 1) * self.blocks)

    def unit(self, h, n):
        """Numbers of the terms that the index has, and their weights, all terms together being at length one."""
        import numpy as np

        if not len(self.term):
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.term, h), len(self.term) - 1)
        known = self.term[at] == h
        tf = 1 + np.log(n)
        w, rest = tf[known] * self.worth[at[known]], tf[~known] * self.unknown
        length = math.sqrt(float(w @ w + rest @ rest))
        return at[known], w / length if length else w

    def nearest(self, queries: list[tuple], k: int, without=None) -> list[tuple]:
        """For each query exactly the ``k`` examples of the greatest positive cosines, as numbers in key order, and these."""
        import numpy as np

        units = [self.unit(*q) for q in queries]
        common = np.zeros((len(queries), len(self.rows)))
        for i, (t, w) in enumerate(units):
            row = self.row[t]
            common[i, row[row >= 0]] = w[row >= 0]
        common = common @ self.rows  # whole rows' part of all cosines
        return [self._search(t, w, common[i], k, without[i] if without else ()) for i, (t, w) in enumerate(units)]

    def _search(self, t, w, score, k: int, without):
        import numpy as np

        if not len(t):
            return np.zeros(0, np.int64), np.zeros(0)
        sparse = self.row[t] < 0
        t, w = t[sparse], w[sparse]
        begin = self.term_begin[t]
        size = self.term_begin[t + 1] - begin
        slots = ranges(begin, size)
        block, w = self.slot_block[slots], np.repeat(w, size)
        score[list(without)] = 0
        bound = np.bincount(block, w * self.slot_most[slots], self.blocks) + np.maximum.reduceat(score, np.arange(0, self.n, BLOCK))
        order = np.argsort(-bound, kind="stable")
        begin = self.slot_begin[slots]
        size = self.slot_begin[slots + 1] - begin
        done, step = 0, 2
        kth = np.partition(score, self.n - k)[self.n - k] if self.n > k else 0.0  # by whole rows alone
        while done < len(order) and bound[order[done]] > max(kth - 1e-9, 0):
            some = order[done : done + step]
            chosen = np.zeros(self.blocks, bool)
            chosen[some[bound[some] >= kth - 1e-9]] = True
            own = np.flatnonzero(chosen[block])
            at = ranges(begin[own], size[own])
            score += np.bincount(self.example[at], np.repeat(w[own], size[own]) * self.weight[at], self.n)
            score[list(without)] = 0
            done, step = done + step, self.blocks
            if self.n > k:
                kth = np.partition(score, self.n - k)[self.n - k]
        found = np.flatnonzero(score > max(kth - 1e-12, 0))
        number = self.number[found]
        order = np.lexsort((number, -np.round(score[found], 12)))[:k]
        return number[order], score[found][order]


class Classifier:
    def __init__(self, vectors: list[tuple], keys: list[str], labels, k: int = NEIGHBOURS, plain: bool = False):
        import numpy as np

        self.keys, self.k = keys, k
        self.labels = np.array(labels, float)
        self.index = BlockMaxIndex(vectors, self.labels, plain)
        self.share = float(self.labels.mean()) if len(labels) else 0.0
        self.at = self.to = np.zeros(0)
        self.alone = self.share
        self.memo: dict = {}
        place = np.argsort(self.index.number)
        #: Places of the examples by their words and counts: these do not vote on themselves.
        self.same: dict[bytes, list[int]] = {}
        for i, v in enumerate(vectors):
            self.same.setdefault(digest(*v), []).append(int(place[i]))

    def votes(self, queries: list[tuple]) -> list[tuple[float | None, list[int], list[float]]]:
        """The share of label 1 among the nearest examples, weighted by cosine; None without any. Also these and their cosines."""
        out = []
        for i in range(0, len(queries), BATCH):
            some = queries[i : i + BATCH]
            for found, cosine in self.index.nearest(some, self.k, [self.same.get(digest(*q), ()) for q in some]):
                v = float((cosine @ self.labels[found] + PRIOR * self.share) / (cosine.sum() + PRIOR)) if len(found) else None
                out.append((v, found.tolist(), cosine.tolist()))
        return out

    def calibrate(self, votes: list[tuple[float | None, float]]) -> None:
        """Pools adjacent violators over examples' votes and labels."""
        import numpy as np

        none = [y for v, y in votes if v is None]
        self.alone = (sum(none) + self.share) / (len(none) + 1)
        pools: list[list[float]] = []  # vote sum, label sum, count
        for v, y in sorted((v, y) for v, y in votes if v is not None):
            pools.append([v, y, 1])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        self.at = np.array([p[0] / p[2] for p in pools])
        self.to = np.array([(p[1] + self.share) / (p[2] + 1) for p in pools])

    def scores(self, texts: list[str | None]) -> list[tuple[float, list[str], list[float]]]:
        """Probability of label 1, keys of the three nearest examples and their cosines."""
        import numpy as np

        queries = [hashed_counts(t) for t in texts]
        known = [digest(*q) for q in queries]
        if len(self.memo) > _MEMO:
            self.memo.clear()
        new = {d: q for d, q in zip(known, queries, strict=True) if d not in self.memo}
        for d, (v, found, cosine) in zip(new, self.votes(list(new.values())), strict=True):
            p = self.alone if v is None else float(np.interp(v, self.at, self.to)) if len(self.at) else v
            self.memo[d] = (min(max(p, 0.0), 1.0), [self.keys[i] for i in found[:3]], cosine[:3])
        return [self.memo[d] for d in known]


def _packed():
    """Maker of the columns ``h`` and ``n``: a text's word hashes and counts as bytes."""

    def run(texts):
        out = [hashed_counts(t) for t in texts]
        return [[h.tobytes() for h, _ in out], [n.tobytes() for _, n in out]]

    return lambda: run


def _unpacked(h: bytes, n: bytes):
    import numpy as np

    return np.frombuffer(h, np.uint64), np.frombuffer(n, np.uint32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MAX_EXAMPLES, max_bytes: int = MAX_BYTES, plain: bool = False) -> Classifier:
    """Fits on at most ``most`` labelled rows of ``max_bytes`` together, those of the least hashes of their key that fit; executors cast the examples' votes."""
    spark = docs.sparkSession
    short_batches(spark)
    rows = map_text(sample(docs, labels, F.col(label).cast("int"), most), _packed(), "h binary, n binary", ["t"])
    rows = written(rows.withColumn("size", F.octet_length("t")).withColumn("order", F.xxhash64("k")).drop("t"))
    total, taken = 0, []
    for r in sorted(rows.select("order", "k", "size").collect(), key=lambda r: (r["order"], r.k)):  # at most ``most`` rows
        if total + r["size"] <= max_bytes:
            total += r["size"]
            taken.append((r["order"], r.k))
    if not taken:
        return Classifier([], [], [])
    rows = rows.join(F.broadcast(spark.createDataFrame(taken, rows.select("order", "k").schema)), ["order", "k"], "left_semi")
    got = sorted(rows.select("k", "y", "h", "n").collect(), key=lambda r: r.k)
    c = Classifier([_unpacked(r.h, r.n) for r in got], [str(r.k) for r in got], [r.y for r in got], plain=plain)
    sent = spark.sparkContext.broadcast(c)

    def cast(batches):
        import pyarrow as pa

        for b in batches:
            votes = [v for v, _, _ in sent.value.votes(list(map(_unpacked, b.column(0).to_pylist(), b.column(1).to_pylist())))]
            yield pa.record_batch([pa.array(votes, pa.float64()), b.column(2)], ["v", "y"])

    tasks = max(1, min(len(got) // 250, spark.sparkContext.defaultParallelism))
    votes = rows.select("h", "n", F.col("y").cast("double").alias("y")).repartition(tasks).mapInArrow(cast, "v double, y double").collect()
    sent.destroy()
    c.calibrate([(r.v, r.y) for r in votes])
    return c


def score(docs: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """Adds ``score``, ``evidence`` (keys of the nearest examples) and ``cosines``."""
    sent = docs.sparkSession.sparkContext.broadcast(classifier)

    def make():
        c = sent.value
        return lambda texts: [list(x) for x in zip(*c.scores(texts), strict=True)] or [[], [], []]

    return map_text(docs, make, "score double, evidence array<string>, cosines array<double>", [text])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (digest_mod(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT).cast("int").alias("predicted"),
        "evidence",
    )


QUERIES = {"op6_toxicity": op6_toxicity}
ORACLE_SQL: dict[str, str] = {}
