"""Katz backoff language model over a corpus, counted and evaluated in batches.

The corpus is cut into batches of about ``BATCH_TOKENS`` tokens. Each is written
once to the shared folder as local word ids. What batches have in common is
settled by exchanges: a batch sends its distinct keys (words, n-grams or
contexts) with partial counts, dealt into buckets by ranges of the key's hash; each
bucket adds them up, writes its part of the model, and answers every batch in the batch's own order.
So a key, however frequent, crosses the network once for each batch that has it, and
nothing is gathered on the driver but sums of a fixed size.

The model is tables, partitioned by ranges of the key's hash: words with their counts; for each order
above the n-grams with their counts, and the contexts with the sums that make their backoff weights. They are
written as Parquet with the answers, a row a bucket, its keys and numbers packed. ``tables`` gives
them as plain rows, with discounted probabilities and weights; ``score`` takes a stored ``model`` for other
texts, whose batches then only ask.

P1(w) = d(c) c / N, and what that leaves is the probability of any unknown word.
Pn(w|h) = d(c) c / c(h) where the n-gram was seen, else alpha(h) Pn-1(w|h'), with
alpha(h) = (1 - sum of d(c) c / c(h)) / (1 - sum of Pn-1) over the words seen after
h, so each distribution sums to one over the known words and the unknown one; an
unseen h has alpha 1. d is Good and Turing's discount up to ``CUT``, and beyond it the
same absolute amount as at ``CUT``, so that every context keeps some mass. If counts
of counts give no discount between 0 and 1 (small corpora), it is (r - 0.5) / r.

Words are compared as strings, so base counts are exact; n-grams by 64-bit hashes:
of 10**10 different n-grams about three share one.

Defined results: a null or empty text is its end alone. A null key counts as the
empty text for the split. Repeated rows count and score once each. With no training
rows, N is 0: base uses (0.1) / (0.1 * (V + 1)) as given, and the model gives every
token the unknown word's probability, which is then 1.
"""

from __future__ import annotations

import uuid
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import digest_mod, shared_dir, short_batches, space_words, table
from .token_files import filesystem

#: Tokens of a batch, about: a worker needs some 150 bytes for each.
BATCH_TOKENS = 2_000_000
#: Counts up to this are discounted by Good and Turing's estimate.
CUT = 5
END, BEGIN = b" end", b" begin"
BLOB = "batch long, bucket int, payload binary"

# arrays of whole numbers as bytes: the planes of their bytes, compressed


def pack(a) -> bytes:
    import numpy as np
    import pyarrow as pa

    a = np.ascontiguousarray(a, "<u8")
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(a).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if len(a) else b"")


def unpack(b: bytes):
    import numpy as np
    import pyarrow as pa

    n = int.from_bytes(b[:8], "little")
    if not n:
        return np.zeros(0, "<u8")
    planes = np.frombuffer(pa.decompress(b[8:], decompressed_size=8 * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).reshape(-1).view("<u8")


def join_parts(parts: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def split_parts(b: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(b):
        n = int.from_bytes(b[at : at + 8], "little")
        out.append(b[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def deltas(keys):
    import numpy as np

    return np.diff(keys, prepend=np.uint64(0)) if len(keys) else keys


def summed(d):
    import numpy as np

    return np.cumsum(d, dtype="<u8")


class Store:
    """Files of one run in the shared folder; a file appears when it is whole."""

    def __init__(self, folder: str):
        self.fs, self.folder = filesystem(folder)

    def put(self, name: str, data: bytes) -> None:
        self.fs.create_dir(self.folder, recursive=True)
        tmp = f"{self.folder}/_{uuid.uuid4().hex}"
        with self.fs.open_output_stream(tmp) as f:
            f.write(data)
        self.fs.move(tmp, f"{self.folder}/{name}")

    def get(self, name: str) -> bytes:
        with self.fs.open_input_file(f"{self.folder}/{name}") as f:
            return f.read()


def word_hash(words: list[bytes]):
    import numpy as np
    import xxhash

    return np.frombuffer(b"".join(xxhash.xxh3_64_digest(w)[::-1] for w in words), "<u8")


def bucket_ends(keys, buckets: int):
    """Where each bucket's range of sorted 64-bit keys ends."""
    import numpy as np

    bounds = np.array([min((i << 64) // buckets, (1 << 64) - 1) for i in range(1, buckets)], "<u8")
    return [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]


class Batch:
    """The tokens of a batch: local word ids of each document with its begin and end."""

    def __init__(self, words: list[bytes], ids, lengths, train, doc_keys):
        """``ids``: BEGIN is 0, END is 1. ``lengths`` hold words and END, without BEGIN."""
        self.words, self.ids, self.lengths, self.train, self.doc_keys = words, ids, lengths, train, doc_keys

    def save(self) -> bytes:
        import pyarrow as pa

        keys = pa.BufferOutputStream()
        with pa.ipc.new_stream(keys, pa.schema([("k", self.doc_keys.type)])) as w:
            w.write_batch(pa.record_batch([self.doc_keys], ["k"]))
        text = b" ".join(self.words[2:])
        return join_parts([
            len(text).to_bytes(8, "little") + (pa.compress(text, codec="zstd", asbytes=True) if text else b""),
            pack(self.ids), pack(self.lengths), pack(self.train), keys.getvalue().to_pybytes(),
        ])

    @classmethod
    def load(cls, data: bytes) -> Batch:
        import numpy as np
        import pyarrow as pa

        text, ids, lengths, train, keys = split_parts(data)
        n = int.from_bytes(text[:8], "little")
        words = pa.decompress(text[8:], decompressed_size=n, codec="zstd", asbytes=True).split(b" ") if n else []
        keys = pa.ipc.open_stream(keys).read_all().column(0).combine_chunks()
        return cls([BEGIN, END, *words], unpack(ids).astype(np.int64), unpack(lengths).astype(np.int64), unpack(train).astype(bool), keys)

    def places(self):
        """Each token's place in its document, BEGIN being 0, and whether it is trained on."""
        import numpy as np

        size = self.lengths + 1
        begin = np.cumsum(size) - size
        place = np.arange(len(self.ids)) - np.repeat(begin, size)
        return place, np.repeat(self.train, size)

    def grams(self, order: int):
        """Hashes of the n-grams that end at each token; true where there is one. Also of the order below, one token before."""
        import numpy as np

        h = word_hash(self.words)[self.ids]
        place, _ = self.places()
        g = before = h
        for n in range(2, order + 1):
            before = np.concatenate([np.zeros(1, "<u8"), g[:-1]])
            x = (before ^ (before >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)
            x = (x + h) * np.uint64(0x94D049BB133111EB)
            g = x ^ (x >> np.uint64(32))
        return g, before, place >= max(1, order - 1)


def discounts(counts_of_counts: list[int], cut: int = CUT) -> list[float]:
    """d(r) for r = 0 .. cut from the numbers of keys seen 1 .. cut + 1 times."""
    n = [0, *counts_of_counts]
    out = [0.0]
    rest = (cut + 1) * n[cut + 1] / n[1] if n[1] else 1.0
    for r in range(1, cut + 1):
        d = ((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest) if n[r] and rest != 1 else 0.0
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return out


def discounted(counts, d: list[float]):
    """d(c) * c of whole counts."""
    import numpy as np

    cut = len(d) - 1
    amount = cut * (1 - d[cut])
    return np.where(counts <= cut, np.array(d)[np.minimum(counts, cut).astype(np.int64)] * counts, counts - amount)


def _groups(batches, key: str):
    """Rows of Arrow batches that are sorted by ``key``, group by group."""
    rows = (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist())
    return groupby(rows, key=lambda r: r[key])


def _out(rows, schema, most: int = 64):
    import pyarrow as pa

    some = []
    for r in rows:
        some.append(r)
        if len(some) == most:
            yield pa.RecordBatch.from_pylist(some, schema)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def _each(df: DataFrame, key: str, n: int, fn, ddl: str) -> DataFrame:
    """``fn(key, rows)`` over the rows of each key, sorted by batch and bucket."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl

    def run(batches):
        schema = to_arrow_schema(kind)
        yield from _out((r for k, rows in _groups(batches, key) for r in fn(k, list(rows))), schema)

    # keys are numbers, dealt evenly; batches are numbered within the tasks that cut them
    task = F.col(key) if key == "bucket" else F.xxhash64(key)
    return df.repartitionById(n, F.pmod(task, F.lit(n)).cast("int")).sortWithinPartitions(key, "batch", "bucket").mapInArrow(run, kind)


#: The batch number of a bucket's part of the model.
MODEL = -1
STATS = f"{BLOB}, n_keys long, total long, seen array<long>"


def _stats(counts) -> dict:
    """Sums over a bucket's keys: how many, their total, how many of each small count."""
    import numpy as np

    return {"n_keys": int((counts > 0).sum()), "total": int(counts.sum()), "seen": np.bincount(np.minimum(counts, CUT + 2).astype(np.int64), minlength=CUT + 3)[1 : CUT + 2].tolist()}


def _word_part(words: list[bytes], counts) -> bytes:
    import pyarrow as pa

    text = b"\n".join(words)
    return join_parts([len(text).to_bytes(8, "little") + (pa.compress(text, codec="zstd", asbytes=True) if text else b""), pack(counts)])


def _words(payload: bytes) -> tuple[list[bytes], list[int]]:
    import pyarrow as pa

    text, counts = split_parts(payload)
    n = int.from_bytes(text[:8], "little")
    return pa.decompress(text[8:], decompressed_size=n, codec="zstd", asbytes=True).split(b"\n") if n else [], unpack(counts).tolist()


def _add_words(bucket: int, rows: list[dict]):
    import numpy as np

    total: dict[bytes, int] = {}
    sent = []
    for r in rows:
        words, counts = _words(r["payload"])
        for w, c in zip(words, counts, strict=True):
            total[w] = total.get(w, 0) + c
        if r["batch"] >= 0:
            sent.append((r["batch"], words))
    counted = np.fromiter((c for w, c in total.items() if w != BEGIN), np.int64)
    known = sorted(w for w, c in total.items() if c)
    yield {"batch": MODEL, "bucket": bucket, "payload": _word_part(known, [total[w] for w in known]), **_stats(counted)}
    for batch, words in sent:
        yield {"batch": batch, "bucket": bucket, "payload": pack(np.fromiter(map(total.__getitem__, words), np.int64, len(words)))}


def _add_grams(bucket: int, rows: list[dict]):
    import numpy as np

    parts = [[unpack(p) for p in split_parts(r["payload"])] for r in rows]
    keys = np.concatenate([summed(p[0]) for p in parts])
    counts = np.concatenate([p[1] for p in parts]).astype(np.int64)
    distinct, inverse = np.unique(keys, return_inverse=True)
    total = np.bincount(inverse, counts, len(distinct)).astype(np.int64)
    there = total > 0
    yield {"batch": MODEL, "bucket": bucket, "payload": join_parts([pack(deltas(distinct[there])), pack(total[there])]), **_stats(total)}
    trained = np.flatnonzero(counts > 0)
    own = np.zeros(len(keys), np.int64)
    own[trained[np.unique(keys[trained], return_index=True)[1]]] = 1
    answer, at = 2 * total[inverse] + own, 0
    for r, p in zip(rows, parts, strict=True):
        if r["batch"] >= 0:
            yield {"batch": r["batch"], "bucket": bucket, "payload": pack(answer[at : at + len(p[0])])}
        at += len(p[0])


def _add_contexts(bucket: int, rows: list[dict]):
    import numpy as np

    parts = [split_parts(r["payload"]) for r in rows]
    keys = [summed(unpack(p[0])) for p in parts]
    sums = [[np.frombuffer(p[k], "<f8") for p in parts] for k in (1, 2)]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = [np.bincount(inverse, np.concatenate(s), len(distinct)) for s in sums]
    there = total[0] > 0
    some = distinct[there]
    yield {"batch": MODEL, "bucket": bucket, "payload": join_parts([pack(deltas(some)), total[0][there].tobytes(), total[1][there].tobytes(), pack(np.zeros(len(some), "<u8"))])}
    at = 0
    for r, p, k in zip(rows, parts, keys, strict=True):
        mine = inverse[at : at + len(k)][unpack(p[3]).astype(bool)]
        at += len(k)
        if r["batch"] < 0:
            continue
        yield {"batch": r["batch"], "bucket": bucket, "payload": join_parts([total[0][mine].tobytes(), total[1][mine].tobytes()])}


class Model:
    """What is known of the whole corpus: sizes and discounts, by order."""

    def __init__(self):
        self.n_train = self.vocabulary = 0
        self.seen_mass = 0.0
        self.d: list[list[float]] = [[]]

    def learn(self, answers: DataFrame, first: bool) -> None:
        s = answers.filter(f"batch = {MODEL}").agg(F.sum("n_keys"), F.sum("total"), *[F.sum(F.col("seen")[i]) for i in range(CUT + 1)]).first()
        if first:
            self.vocabulary, self.n_train = int(s[0] or 0), int(s[1] or 0)
        self.d.append(discounts([int(x or 0) for x in s[2:]]))


class Evaluation:
    """Log probabilities of a batch's tokens, order by order, as answers come in."""

    def __init__(self, store: Store, batch: int, model: Model):
        import numpy as np

        self.store, self.name, self.model = store, f"batch-{batch}", model
        self.b = Batch.load(store.get(self.name))
        self.place, self.train = self.b.places()
        self.counts = unpack(store.get(f"{self.name}-1")).astype(np.int64)
        d, n = model.d[1], max(model.n_train, 1)
        mass = discounted(self.counts, d) / n
        unknown = 1.0 - model.seen_mass if model.n_train else 1.0
        with np.errstate(divide="ignore"):
            self.lp = np.log10(np.where(self.counts > 0, mass, unknown))[self.b.ids]
        # tokens as contexts of the next: how often each was followed by one
        self.followed = self.counts[self.b.ids]

    def raise_to(self, order: int, want_context: bool = False):
        """Goes on to n-grams of this order, whose answers are in the store; the contexts' sums too unless they are wanted."""
        import numpy as np

        g, before, there = self.b.grams(order)
        at = np.flatnonzero(there)
        tokens, contexts = len(g), before[at]
        distinct, inverse = np.unique(g[at], return_inverse=True)
        del g, before, there  # a batch's arrays are large: few live at once
        answer = unpack(self.store.get(f"{self.name}-{order}")).astype(np.int64)
        total, own = answer >> 1, (answer & 1).astype(bool)
        c = total[inverse]
        context_count = self.followed[at - 1]
        seen = c > 0
        share = np.zeros(len(at))
        share[seen] = discounted(c[seen], self.model.d[order]) / context_count[seen]
        asked = ~seen & (context_count > 0)
        wanted = np.unique(contexts[asked])
        if want_context:
            # each n-gram is added up by one batch, at its first place there
            first = np.full(len(distinct), len(at))
            np.minimum.at(first, inverse, np.arange(len(at)))
            first = first[own]
            sent, back = np.unique(np.concatenate([contexts[first], wanted]), return_inverse=True)
            add = lambda x: np.bincount(back[: len(first)], x, len(sent))
            return sent, add(share[first]), add(10 ** self.lp[at[first]]), np.isin(sent, wanted)
        low = self.lp[at]
        if len(wanted):
            used, lower = (np.frombuffer(x, "<f8") for x in split_parts(self.store.get(f"{self.name}-{order}-contexts")))
            alpha = np.maximum(1 - used, 1e-300) / np.maximum(1 - lower, 1e-300)
            low[asked] += np.log10(alpha)[np.searchsorted(wanted, contexts[asked])]
        with np.errstate(divide="ignore"):
            self.lp[at] = np.where(seen, np.log10(np.where(seen, share, 1.0)), low)
        followed = np.zeros(tokens, np.int64)
        followed[at] = c
        self.followed = followed
        return None


def score(
    docs: DataFrame, held_out=None, order: int = 2, key: str = "doc_id", text: str = "text", batch_tokens: int = BATCH_TOKENS, folder: str | None = None, model: str | None = None
) -> DataFrame:
    """Scores all rows under a model of those for which the column ``held_out`` is false.

    Gives ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``. The model's tables are
    written below ``folder`` (a new one of the shared folder by default). With ``model``, a folder of an earlier call of the same order,
    nothing is learned: its tables score the rows.
    """
    from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

    if order < 1:
        raise ValueError("the order is 1 or more")
    spark = docs.sparkSession
    short_batches(spark)
    folder = folder or shared_dir(spark)
    key_field = docs.schema[key]
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.lit(True).alias("h") if model else held_out.alias("h"))
    n = max(1, rows.rdd.getNumPartitions())
    meta = spark.read.json(f"{model}/meta").first() if model else None
    if meta and meta.order != order:
        raise ValueError(f"the stored model has order {meta.order}")
    buckets = meta.buckets if meta else max(8, 2 * n)
    spark.createDataFrame([(order, buckets)], "order int, buckets int").coalesce(1).write.mode("overwrite").json(f"{folder}/meta")

    def with_model(sent: DataFrame, name: str) -> DataFrame:
        """What batches send, and the stored model's part of each bucket."""
        return sent.unionByName(spark.read.parquet(f"{model}/{name}").filter(f"batch = {MODEL}").select("batch", "bucket", "payload")) if model else sent

    def cut(batches):
        """Writes batches; sends their words."""
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        store, part, number = Store(folder), TaskContext.get().partitionId(), 0
        schema = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary())])

        def fresh():
            return {BEGIN: 0, END: 1}, [], [], [], []

        def close():
            local, ids, lengths, train, keys = held
            words = list(local)
            b = Batch(words, np.concatenate(ids), np.array(lengths), np.array(train), pa.concat_arrays(keys))
            batch = (part << 20) + number
            store.put(f"batch-{batch}", b.save())
            place, trained = b.places()
            counts = np.bincount(b.ids[trained], minlength=len(words))
            hashes = word_hash(words)
            by = np.argsort(hashes, kind="stable")
            ends = bucket_ends(hashes[by], buckets)
            for k in range(buckets):
                own = by[ends[k] : ends[k + 1]]
                if len(own):
                    yield {"batch": batch, "bucket": k, "payload": _word_part([words[i] for i in own.tolist()], counts[own])}

        held, tokens = fresh(), 0
        for b in batches:
            local, ids, lengths, train, keys = held
            for t, h in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words = space_words(t)
                ids.append(np.fromiter((0, *[local.setdefault(w, len(local)) for w in words], 1), np.int64, len(words) + 2))
                lengths.append(len(words) + 1)
                train.append(not h)
                tokens += len(words) + 2
            keys.append(b.column(0))
            if tokens >= batch_tokens:
                yield from _out(close(), schema)
                held, tokens, number = fresh(), 0, number + 1
        if held[2]:
            yield from _out(close(), schema)

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    known = Model()
    words = kept(rows.mapInArrow(cut, BLOB), "words")
    n = max(1, words.select("batch").distinct().count())  # a task for each batch
    answers = kept(_each(with_model(words, "word_counts"), "bucket", buckets, _add_words, STATS), "word_counts")
    known.learn(answers, True)
    d1 = known.d[1]
    # the mass of the known words: from counts of counts, as d(c) c is c less a fixed amount beyond the cut
    s = answers.filter(f"batch = {MODEL}").agg(*[F.sum(F.col("seen")[i]) for i in range(CUT)]).first()
    small = [int(x or 0) for x in s]
    n_above = known.vocabulary - sum(small)
    above = known.n_train - sum(r * x for r, x in enumerate(small, 1)) - n_above * CUT * (1 - d1[CUT])
    known.seen_mass = (sum(d1[r] * r * x for r, x in enumerate(small, 1)) + above) / max(known.n_train, 1)

    def place_words(store: Store, batch: int, answer: list[dict]) -> None:
        import numpy as np

        b = Batch.load(store.get(f"batch-{batch}"))
        by = np.argsort(word_hash(b.words), kind="stable")
        counts = np.zeros(len(b.words), "<u8")
        counts[by] = np.concatenate([unpack(r["payload"]) for r in answer])
        store.put(f"batch-{batch}-1", pack(counts))

    def send_grams(order: int):
        def run(batch, answer):
            import numpy as np

            store = Store(folder)
            if order == 2:
                place_words(store, batch, answer)
            else:
                _keep_contexts(store, batch, order - 1, answer)
            b = Batch.load(store.get(f"batch-{batch}"))
            g, _, there = b.grams(order)
            _, train = b.places()
            distinct, inverse = np.unique(g[there], return_inverse=True)
            counts = np.bincount(inverse, train[there], len(distinct)).astype(np.int64)
            ends = bucket_ends(distinct, buckets)
            for k in range(buckets):
                if ends[k + 1] > ends[k] or not k:  # a batch without keys still gets an answer
                    own = slice(ends[k], ends[k + 1])
                    yield {"batch": batch, "bucket": k, "payload": join_parts([pack(deltas(distinct[own])), pack(counts[own])])}

        return run

    def send_contexts(order: int):
        def run(batch, answer):
            import numpy as np

            store = Store(folder)
            store.put(f"batch-{batch}-{order}", pack(np.concatenate([unpack(r["payload"]) for r in answer])))
            e = Evaluation(store, batch, known)
            for o in range(2, order):
                e.raise_to(o)
            sent, used, lower, wanted = e.raise_to(order, want_context=True)
            ends = bucket_ends(sent, buckets)
            for k in range(buckets):
                if ends[k + 1] > ends[k] or not k:  # a batch without keys still gets an answer
                    own = slice(ends[k], ends[k + 1])
                    yield {"batch": batch, "bucket": k, "payload": join_parts([pack(deltas(sent[own])), used[own].tobytes(), lower[own].tobytes(), pack(wanted[own])])}

        return run

    def finish(batch, answer):
        import numpy as np

        store = Store(folder)
        if order == 1:
            place_words(store, batch, answer)
        else:
            _keep_contexts(store, batch, order, answer)
        e = Evaluation(store, batch, known)
        b, c = e.b, e.counts[e.b.ids]
        for o in range(2, order + 1):
            e.raise_to(o)
        token = e.place > 0
        begin = np.cumsum(b.lengths) - b.lengths
        base = np.log10((c[token] + 0.1) / (known.n_train + 0.1 * (known.vocabulary + 1)))
        per_doc = lambda x: np.add.reduceat(x, begin).tolist()  # noqa: E731  every document has its end
        yield from (
            {key: k, "held_out": not t, "n_tokens": n_, "n_known": w, "train_tokens": known.n_train, "base_score": x, "score": y}
            for k, t, n_, w, x, y in zip(
                b.doc_keys.to_pylist(), b.train.tolist(), b.lengths.tolist(), per_doc((c[token] > 0).astype(np.int64)), per_doc(base), per_doc(e.lp[token]), strict=True
            )
        )

    answered = answers.filter("batch >= 0").select("batch", "bucket", "payload")
    for o in range(2, order + 1):
        sent = with_model(_each(answered, "batch", n, send_grams(o), BLOB), f"gram_counts_{o}")
        counted = kept(_each(sent, "bucket", buckets, _add_grams, STATS), f"gram_counts_{o}")
        known.learn(counted, False)
        back = counted.filter("batch >= 0").select("batch", "bucket", "payload")
        sent = with_model(_each(back, "batch", n, send_contexts(o), BLOB), f"context_sums_{o}")
        answered = kept(_each(sent, "bucket", buckets, _add_contexts, BLOB), f"context_sums_{o}").filter("batch >= 0")
    result = StructType([
        StructField(key, key_field.dataType), StructField("held_out", BooleanType()), StructField("n_tokens", LongType()), StructField("n_known", LongType()),
        StructField("train_tokens", LongType()), StructField("base_score", DoubleType()), StructField("score", DoubleType()),
    ])
    return _each(answered, "batch", n, finish, result)


TABLES = "order int, bucket int, kind string, key binary, count long, used double, lower double"


def tables(spark: SparkSession, folder: str) -> DataFrame:
    """The stored model as rows (order, bucket, kind, key, count, used, lower), plain and unsorted.

    Kinds: ``word`` (its bytes), ``gram`` (8-byte hash of an n-gram) with their counts; ``context`` (hash of an n-gram of the
    order below) with the discounted mass ``used`` by the n-grams seen after it and the mass ``lower`` these have in the
    order below. A context's backoff weight is (1 - used) / (1 - lower).
    """
    order = spark.read.json(f"{folder}/meta").first().order
    out = None
    for name, kind, o in [("word_counts", "word", 1), *[(f"{x}_{o}", k, o) for o in range(2, order + 1) for x, k in (("gram_counts", "gram"), ("context_sums", "context"))]]:
        part = spark.read.parquet(f"{folder}/{name}").filter(f"batch = {MODEL}").select("bucket", "payload")
        rows = part.mapInArrow(_plain_rows(kind, o), TABLES)
        out = rows if out is None else out.unionByName(rows)
    return out


def _plain_rows(kind: str, order: int):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(TABLES))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for bucket, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if kind == "word":
                    keys, numbers = _words(payload)
                    columns = [numbers, None, None]
                else:
                    p = split_parts(payload)
                    keys = [k.to_bytes(8, "little") for k in summed(unpack(p[0])).tolist()]
                    columns = [unpack(p[1]).astype(np.int64), None, None] if kind == "gram" else [None, np.frombuffer(p[1], "<f8"), np.frombuffer(p[2], "<f8")]
                n = len(keys)
                cols = [pa.array([order] * n, pa.int32()), pa.array([bucket] * n, pa.int32()), pa.array([kind] * n, pa.string()), pa.array(keys, pa.binary())]
                cols += [pa.nulls(n, f.type) if c is None else pa.array(c, f.type) for c, f in zip(columns, list(schema)[4:], strict=True)]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return run


def _keep_contexts(store: Store, batch: int, order: int, answer: list[dict]) -> None:
    parts = [split_parts(r["payload"]) or [b"", b""] for r in answer]
    store.put(f"batch-{batch}-{order}-contexts", join_parts([b"".join(p[k] for p in parts) for k in (0, 1)]))


def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, digest_mod(F.col("doc_id"), 10) == 0)


QUERIES = {"op4_katz": op4_katz}
ORACLE_SQL: dict[str, str] = {}
