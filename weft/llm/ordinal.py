"""Quality by ordinal regression with cumulative links.

A text's score is one weighted sum of hashed features, shared by all grades;
ordered thresholds cut it: P(grade >= k) = 1 / (1 + exp(threshold_k - score)).
Features are words, their beginnings, and shapes of raw tokens (runs of symbols,
capitals, repeats), hashed into ``SLOTS`` weights, (1 + ln count) each, at length
one. Weights and thresholds are fitted together by Adam on the penalised
likelihood of at most ``MAX_ROWS`` labelled rows. The sample's sparse features go to the driver, ``MAX_BYTES`` of them at most:
rows are taken in the order of their keys' hashes, each with all its features, and one that does not fit is passed over. What is broadcast is ``SLOTS`` weights.

Defined results: null and empty texts have the one feature of their length.
Repeated rows give repeated results. With no labelled rows every grade is equally
likely and all is kept. Documents are scored where they are read. Input columns named
``tails`` or ``expected_grade`` are replaced.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import digest_mod, map_text, short_batches, table, written
from .labelled import sample, tokens

SLOTS = 1 << 16
MAX_ROWS = 8000
#: Bytes of packed features that the driver takes, 8 for each feature of a text; some five times as much while it fits.
MAX_BYTES = 48_000_000
KEEP = 0.5
_MARKS = re.compile(rb"[#*$%&|<>!?=_~^+\\/-]{2,}|\|")


def features(text: str | None) -> tuple[list[int], list[float]]:
    """Slots and values of length one."""
    import xxhash

    data = (text or "").encode("utf-8", "surrogatepass")
    raw = data.split()
    found = Counter(tokens(text))
    found.update(b"\x00m" + m[:3] for m in _MARKS.findall(data))
    found[b"\x00caps"] = sum(w.isupper() and len(w) > 1 for w in raw)
    found[b"\x00same"] = sum(a == b for a, b in zip(raw, raw[1:], strict=False))
    n = len(raw)
    total = Counter()
    for f, c in found.items():
        if c:
            total[xxhash.xxh3_64_intdigest(f) % SLOTS] += c
    values = {s: 1 + math.log(c) for s, c in total.items()}
    norm = math.sqrt(sum(v * v for v in values.values())) or 1.0
    values = {s: v / norm for s, v in values.items()}
    # shares of odd tokens and the length count beside the words
    for name, x in ((b"caps", found[b"\x00caps"] / max(n, 1)), (b"same", found[b"\x00same"] / max(n, 1)), (b"marks", sum(c for f, c in found.items() if f[:2] == b"\x00m") / max(n, 1)), (b"len%d" % min(n.bit_length(), 5), 1.0)):
        s = xxhash.xxh3_64_intdigest(b"\x00share" + name) % SLOTS
        values[s] = values.get(s, 0.0) + min(x, 2.0)
    return list(values), list(values.values())


class OrdinalModel:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights, thresholds: list[float]):
        self.weights, self.thresholds = weights, thresholds

    @classmethod
    def fit(cls, rows: list[tuple[list[int], list[float]]], grades: list[int], n_grades: int, rounds: int = 150, rate: float = 0.1, penalty: float = 1e-4) -> OrdinalModel:
        import numpy as np

        if not rows:
            return cls(np.zeros(SLOTS), [math.log(k / (n_grades - k)) for k in range(1, n_grades)])
        slot = np.concatenate([np.array(r[0], np.int64) for r in rows])
        value = np.concatenate([np.array(r[1]) for r in rows])
        row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        y = np.array(grades)
        share = np.array([(y >= k).mean() for k in range(1, n_grades)]).clip(1e-3, 1 - 1e-3)
        first = np.log((1 - share) / share)
        p = np.concatenate([np.zeros(SLOTS), [first[0]], np.log(np.maximum(np.diff(first), 1e-2))])
        m, v = np.zeros_like(p), np.zeros_like(p)
        for step in range(1, rounds + 1):
            cut = np.concatenate([[-np.inf], p[SLOTS] + np.concatenate([[0], np.cumsum(np.exp(p[SLOTS + 1 :]))]), [np.inf]])
            z = np.bincount(row, value * p[slot], len(rows))
            above = 1 / (1 + np.exp(np.clip(cut[y] - z, -40, 40)))  # P(grade >= own); 1 for grade 0
            beyond = 1 / (1 + np.exp(np.clip(cut[y + 1] - z, -40, 40)))
            above[y == 0], beyond[y == n_grades - 1] = 1, 0
            own = np.maximum(above - beyond, 1e-12)
            da, db = above * (1 - above) / own, beyond * (1 - beyond) / own
            dz = (da - db) / len(rows)
            g = np.zeros_like(p)
            g[:SLOTS] = -np.bincount(slot, value * dz[row], SLOTS) + penalty * p[:SLOTS]
            dcut = np.zeros(n_grades - 1)
            for k in range(1, n_grades):
                dcut[k - 1] = (da[y == k].sum() - db[y == k - 1].sum()) / len(rows)
            g[SLOTS] = dcut.sum()
            for k in range(1, n_grades - 1):
                g[SLOTS + k] = dcut[k:].sum() * math.exp(p[SLOTS + k])
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        cut = p[SLOTS] + np.concatenate([[0], np.cumsum(np.exp(p[SLOTS + 1 :]))])
        return cls(p[:SLOTS], cut.tolist())

    def tails(self, z: float) -> list[float]:
        """P(grade >= k) for k = 1 up."""
        return [1 / (1 + math.exp(min(max(t - z, -700), 700))) for t in self.thresholds]

    def score(self, text: str | None) -> list[float]:
        s, x = features(text)
        return self.tails(float(self.weights[s] @ x))


def fit(docs: DataFrame, labels: DataFrame, grade: Column, n_grades: int, most: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> OrdinalModel:
    """Fits on at most ``most`` labelled rows whose crc32(doc_id as text) mod 3 is not 1, and ``max_bytes`` of their features."""
    short_batches(docs.sparkSession)

    def make():
        def run(texts):
            out = []
            for t in texts:
                some = sorted(zip(*features(t), strict=True))
                out.append((array("i", [a for a, _ in some]).tobytes(), array("f", [b for _, b in some]).tobytes()))
            return [[a for a, _ in out], [b for _, b in out]]

        return run

    rows = map_text(sample(docs, labels, grade, most), make, "s binary, x binary", ["t"]).drop("t")
    rows = written(rows.withColumns({"size": F.octet_length("s") + F.octet_length("x"), "order": F.xxhash64("k")}))
    total, taken = 0, []
    for r in sorted(rows.select("order", "k", "size").collect(), key=lambda r: (r["order"], r.k)):  # at most ``most`` rows
        if total + r["size"] <= max_bytes:
            total += r["size"]
            taken.append((r["order"], r.k))
    fits = docs.sparkSession.createDataFrame(taken, rows.select("order", "k").schema)
    got = sorted(rows.join(F.broadcast(fits), ["order", "k"], "left_semi").collect(), key=lambda r: r.k)
    return OrdinalModel.fit([(array("i", bytes(r.s)), array("f", bytes(r.x))) for r in got], [r.y for r in got], n_grades)


def score(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """Adds ``tails``, P(grade >= k) for k = 1 up, and ``expected_grade``, their sum."""
    import numpy as np

    sent = docs.sparkSession.sparkContext.broadcast(OrdinalModel(np.asarray(model.weights, np.float64), model.thresholds))
    out = map_text(docs, lambda: lambda texts: [[sent.value.score(t) for t in texts]], "tails array<double>", [text])
    return out.withColumn("expected_grade", F.aggregate("tails", F.lit(0.0), lambda a, x: a + x))




def grade_of_labels() -> Column:
    """0 low quality, 1 good but toxic, 2 good."""
    q, t = F.col("quality").cast("int"), F.coalesce(F.col("toxic"), F.lit(0)).cast("int")
    return F.when(q <= 0, 0).when(t > 0, 1).when(q > 0, 2)


def op2_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), grade_of_labels(), 3)
    return score(docs, model).select(
        "doc_id",
        (digest_mod(F.col("doc_id"), 3) == 1).alias("held_out"),
        "expected_grade",
        F.col("tails")[0].alias("p_good"),
        F.col("tails")[1].alias("p_best"),
        (F.col("tails")[0] >= KEEP).alias("kept"),
    )


QUERIES = {"op2_ordinal": op2_ordinal}
ORACLE_SQL: dict[str, str] = {}
