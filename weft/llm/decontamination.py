"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds all word sequences that occur in a normalised item. A
document's words stream through it; the length of the longest suffix that occurs
in an item is tracked at each word. Where it reaches a window's length, the
window is an occurrence, and its words are hit. Spans are removed, or documents
rejected, by limits on length and coverage.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ with A-Z lower-cased. A window is
``window`` consecutive words of an item; a shorter item is one window.

The items are sent to the executors, where each worker builds their automaton once. Items beyond
``MAX_ITEM_BYTES`` are dealt into several automata by hash; the documents go past one after the
other, so that what is broadcast, and what a worker holds, is one of them. Only what is hit is written, by the text's digest: the
corpus is read once for each automaton and never rewritten. Each document
costs a fixed amount a word, so a hot source or a very long text needs no split.

Defined results: null and empty texts have no words, no hits and are not
contaminated; items without words never occur; items of equal text occur
together; a null item id is listed as the empty text. Repeated rows give repeated
results, no items or no documents give no hits or no rows. Input columns named as
an output are replaced.
"""

from __future__ import annotations

import hashlib
import re
from array import array

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alnum_words, columns, fresh, hold, map_text, short_batches, table, written
from .suffix import SuffixAutomaton

WINDOW = 13
#: Bytes of item text in one automaton; a worker takes about 50 bytes for each.
MAX_ITEM_BYTES = 2_000_000
SPANS = "spans array<struct<start:int,stop:int,items:array<string>>>"


def _also(held: dict[int, str | set[str]], state: int, name: str) -> None:
    now = held.get(state)
    if now is None:
        held[state] = name
    elif isinstance(now, set):
        now.add(name)
    elif now != name:
        held[state] = {now, name}


class ItemAutomaton:
    """Suffix automaton over the items' words, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.word_id: dict[bytes, int] = {}
        rows = [(name, tuple(self.word_id.setdefault(w, len(self.word_id)) for w in words)) for name, words in items]
        auto = SuffixAutomaton(max(1, len(self.word_id)))
        held: dict[int, str | set[str]] = {}  # most states have one item
        whole: dict[tuple[int, ...], set[str]] = {}
        self.short: dict[int, tuple[int, tuple[str, ...]]] = {}
        self.shortest = window
        for name, ids in rows:
            for n, state in enumerate(auto.add(ids), 1):
                # an item's words before the window's end are its suffixes' states
                if n >= window and auto.size[state] >= window:
                    _also(held, state, name)
            if 0 < len(ids) < window:
                whole.setdefault(ids, set()).add(name)
                self.shortest = min(self.shortest, len(ids))
        order = auto.finish()
        self.step, self.link, self.size, self.alphabet = auto.step, auto.link, auto.size, auto.alphabet
        same: dict[tuple[str, ...], tuple[str, ...]] = {}
        #: Items with the window that ends in a state, sorted; states of the same items share them.
        self.held: dict[int, tuple[str, ...]] = {}
        for s in order:  # what holds a string holds its suffixes; longer states are done before
            names = held.pop(s, None)
            if names is None:
                continue
            if self.size[self.link[s]] >= window:
                for name in [names] if isinstance(names, str) else names:
                    _also(held, self.link[s], name)
            else:  # asked for are only states whose shorter suffixes are no windows
                own = (names,) if isinstance(names, str) else tuple(sorted(names))
                self.held[s] = same.setdefault(own, own)
        for ids, names in whole.items():
            s = 0
            for c in ids:
                s = self.step[s * self.alphabet + c]
            self.short[s] = (len(ids), tuple(sorted(names)))
        #: The nearest state at or above, up the suffix links, that is a whole short item.
        self.short_up = array("i", [-1]) * len(auto)
        for s in reversed(order):
            self.short_up[s] = s if s in self.short else self.short_up[self.link[s]]

    def match(self, words: list[bytes]) -> list[tuple[int, int, tuple[str, ...]]]:
        """Every occurrence of a window: first word, word after the last, items with the window."""
        if not self.word_id or len(words) < self.shortest:
            return []
        ids = list(map(self.word_id.get, words))
        out, begin, shortest = [], 0, self.shortest
        while begin < len(ids):
            try:
                stop = ids.index(None, begin)
            except ValueError:
                stop = len(ids)
            if stop - begin >= shortest:
                self._run(ids, begin, stop, out)
            begin = stop + 1
        return out

    def _run(self, ids: list[int], begin: int, stop: int, out: list) -> None:
        step, n, link, size, window, short_up = self.step.get, self.alphabet, self.link, self.size, self.window, self.short_up
        state = length = 0
        some_short = bool(self.short)
        for i in range(begin, stop):
            c = ids[i]
            while (to := step(state * n + c)) is None and state:
                state = link[state]
                length = size[state]
            if to is None:
                continue
            state, length = to, length + 1
            if length >= window:
                s = state
                while size[link[s]] >= window:
                    s = link[s]
                out.append((i + 1 - window, i + 1, self.held[s]))
            if some_short:
                s = short_up[state]
                while s >= 0:
                    size_, names = self.short[s]
                    if size_ <= length:
                        out.append((i + 1 - size_, i + 1, names))
                    s = short_up[link[s]]


def _piece(items: DataFrame, k: int, n: int) -> list[tuple[str, list[bytes]]]:
    """The k-th of n pieces of the items (i, t), dealt by hash."""
    part = items if n == 1 else items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
    return [(r.i, alnum_words(r.t)) for r in part.toLocalIterator()]


def match_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words`` and ``spans``: each run of hit words with the items that have a window in it."""
    items = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    n = 1 + (items.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // max_item_bytes
    spark = docs.sparkSession
    if n > 1:
        return _match_pieces(docs, items, n, text, window)
    sent = spark.sparkContext.broadcast(_piece(items, 0, 1))

    def make():
        auto = _automaton(sent, window)

        def run(texts):
            words = [alnum_words(t) for t in texts]
            return [[len(w) for w in words], [_joined(auto.match(w)) for w in words]]

        return run

    return map_text(docs, make, f"n_words bigint, {SPANS}", [text])


def _match_pieces(docs: DataFrame, items: DataFrame, n: int, text: str, window: int) -> DataFrame:
    """As ``match_items``, with the items in ``n`` pieces: hits of each are written by the text's digest, and joined to the documents at the end."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    spark, kind = docs.sparkSession, StructType.fromDDL(f"digest binary, {SPANS}")
    short_batches(spark)
    digest = F.unhex(F.sha2(F.coalesce(columns([text])[0], F.lit("")).cast("binary"), 256))
    texts, hits = docs.select(digest.alias("digest"), columns([text])[0].alias("t")), None
    for k in range(n):
        sent = spark.sparkContext.broadcast(_piece(items, k, n))

        def scan(batches, sent=sent):
            hold(__name__)
            auto = _automaton(sent, window)
            for b in batches:
                some = [(i, found) for i, t in enumerate(b.column(1).to_pylist()) if (found := auto.match(alnum_words(t)))]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i for i, _ in some], pa.int64())), pa.array([_joined(x) for _, x in some], to_arrow_type(kind["spans"].dataType))], names=kind.names)

        one = written(texts.mapInArrow(scan, kind).groupBy("digest").agg(F.first("spans").alias("spans")))  # copies of a text have the same
        sent.destroy()
        hits = one if hits is None else hits.unionByName(one)
    of = hits.groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # n lists at most
    key, own = fresh(docs.drop("n_words", "spans"), "digest", "spans")
    plain = docs.drop("n_words", "spans").withColumn(key, digest)
    out = plain.join(of.select(F.col("digest").alias(key), F.col("spans").alias(own)), key, "left")

    def make():
        return lambda texts, found: [[len(alnum_words(t)) for t in texts], [_joined([(s["start"], s["stop"], s["items"]) for s in x or ()]) for x in found]]

    return map_text(out, make, f"n_words bigint, {SPANS}", [text, own]).select(*columns([*plain.drop(key).columns, "n_words", "spans"]))


_built: dict = {}


def forget() -> None:
    _built.clear()


def _automaton(sent, window: int) -> ItemAutomaton:
    """The automaton of broadcast items, built once in each worker."""
    key = (sent.id if hasattr(sent, "id") else id(sent), window, hashlib.sha256(repr(sent.value).encode()).digest())
    if key not in _built:
        _built.clear()
        _built[key] = ItemAutomaton(sent.value, window)
    return _built[key]


def _joined(found: list[tuple[int, int, tuple[str, ...]]]) -> list[dict]:
    """Overlapping occurrences as runs of hit words."""
    out: list[dict] = []
    for start, stop, names in sorted(found, key=lambda x: (x[0], x[1])):
        if out and start <= out[-1]["stop"]:
            out[-1]["stop"] = max(stop, out[-1]["stop"])
            out[-1]["items"].update(names)
        else:
            out.append({"start": start, "stop": stop, "items": set(names)})
    for s in out:
        s["items"] = sorted(s["items"])
    return out


def n_hit(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]))


def contaminated(spans: str = "spans", n_words: str = "n_words") -> Column:
    """The contract's rule: a twentieth of the words or more are hit."""
    return (F.size(spans) > 0) & (20 * n_hit(spans) >= F.col(n_words))


def remove_spans(matched: DataFrame, min_words: int = WINDOW, text: str = "text", out: str = "cleaned") -> DataFrame:
    """Adds ``text`` without the spans of ``min_words`` words or more that ``match_items`` found."""
    words = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def make():
        def run(texts, spans):
            cleaned = []
            for t, found in zip(texts, spans, strict=True):
                long = [s for s in found or () if s["stop"] - s["start"] >= min_words]
                if t is None or not long:
                    cleaned.append(t)
                    continue
                data = t.encode()
                at = [m.span() for m in words.finditer(data)]
                keep, end = [], 0
                for s in long:
                    keep.append(data[end : at[s["start"]][0]])
                    end = at[s["stop"] - 1][1]
                cleaned.append(b"".join([*keep, data[end:]]).decode("utf-8", "replace"))
            return [cleaned]

        return run

    return map_text(matched, make, f"{out} string", [text, "spans"])


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = match_items(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda s: s["items"]))))
    return m.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def hits_sql(source: str = "documents") -> str:
    """DuckDB SQL: ``hits`` has each document's row number, words, hit words and items."""
    az = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    words = lambda t: f"regexp_extract_all(translate(coalesce({t}, ''), {az}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
c0 AS (SELECT row_number() OVER () AS rid, doc_id, {words('text')} AS w FROM {source}),
c1 AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {words('text')} AS w FROM benchmark),
c2 AS (SELECT item, least(len(w), {WINDOW}) AS k, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM c1 WHERE len(w) > 0),
c3 AS (SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM c2),
c4 AS (SELECT rid, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM c0, (SELECT DISTINCT k FROM c3) WHERE len(w) >= k),
c5 AS (SELECT rid, i, c4.k, item FROM c4 JOIN c3 ON c4.k = c3.k AND array_to_string(w[i : i + c4.k - 1], ' ') = g),
c6 AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM c5) GROUP BY rid),
c7 AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM c5) GROUP BY rid),
hits AS (SELECT c0.rid, doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
           coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
         FROM c0 LEFT JOIN c6 ON c0.rid = c6.rid LEFT JOIN c7 ON c0.rid = c7.rid)"""


ORACLE = f"""WITH {hits_sql()}
SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM hits"""

QUERIES = {"op7_decontamination": op7_decontamination}
ORACLE_SQL = {"op7_decontamination": ORACLE}
