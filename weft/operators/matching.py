"""Joins of words and phrases within texts and passages."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_grams(texts: DataFrame, words: str, n: int) -> DataFrame:
    """One row for each run of ``n`` words, with ``pos`` from 1 and ``gram``; by position, so no window over texts."""
    last = F.size(words) - n + 1
    rows = texts.filter(last >= 1).withColumn("pos", F.explode(F.sequence(F.lit(1), last)))
    return rows.withColumn("gram", F.array_join(F.slice(words, F.col("pos"), n), " "))


def phrase_hits(texts: DataFrame, names: DataFrame, words: str, name: str) -> DataFrame:
    """Every occurrence of a name, of any number of words: rows of texts with ``pos`` and of names.

    Names meet runs of as many words by an equi join, a pass for each length that a name has; for names of many lengths,
    or with marks between their words, ``dictionary_scan`` takes one pass.
    """
    out = None
    lengths = names.select(F.size(F.split(name, " ")).alias("n")).distinct().collect()
    for n in sorted(r.n for r in lengths) or [1]:
        own = names.filter(F.size(F.split(name, " ")) == n)
        g = word_grams(texts, words, n).drop(words)
        hit = g.join(own, F.col("gram") == F.col(name)).drop("gram")
        out = hit if out is None else out.unionByName(hit)
    return out


def _leftmost(hits: DataFrame, key: str, length: Column, *carried: str) -> DataFrame:
    """(key, pos, carried): of overlapping hits of a text the leftmost, of these the longest, then on from its end. Hits of one place and length stay together.

    A text's hits are gathered in one row, which its length bounds.
    """
    item = F.struct("pos", (-length).alias("less"), *carried)
    one = hits.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("all"))
    kind = one.schema["all"].dataType.simpleString()
    start = F.struct(F.lit(0).cast("long").alias("reach"), F.lit(-1).cast("long").alias("at"), F.array().cast(kind).alias("kept"))

    def step(acc, h):
        end = (h["pos"] - h["less"]).cast("long")
        takes = (h["pos"] >= acc["reach"]) | ((h["pos"] == acc["at"]) & (end == acc["reach"]))
        return F.struct(F.when(takes, end).otherwise(acc["reach"]).alias("reach"), F.when(takes, h["pos"].cast("long")).otherwise(acc["at"]).alias("at"), F.when(takes, F.array_append(acc["kept"], h)).otherwise(acc["kept"]).alias("kept"))

    kept = F.aggregate("all", start, step, lambda acc: acc["kept"])
    return one.select(key, F.explode(kept).alias("h")).select(key, "h.pos", *[F.col(f"h.{c}").alias(c) for c in carried])


def longest_only(hits: DataFrame, key: str, name: str) -> DataFrame:
    """(key, pos, name): of overlapping hits of a text the leftmost, of these the longest, then on from its end; lengths are in words."""
    return _leftmost(hits, key, F.size(F.split(name, " ")), name)


#: Names of an automaton, in bytes; beyond it names are dealt into several, one pass over the texts each.
NAME_BYTES = 2 << 20
_automaton: tuple = ("", None)


def _lowered(text: str) -> str:
    """Lower case, a letter a letter, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _is_letter(text: str, at: int) -> bool:
    return 0 <= at < len(text) and "a" <= text[at] <= "z"


def dictionary_scan(texts: DataFrame, names: DataFrame, key: str, text: str, entity: str, name: str, overlapping: bool = False, name_bytes: int = NAME_BYTES) -> DataFrame:
    """(key, pos, length, name, entity) for each occurrence of a name in a text, in any case, with no letter A-Z on either side; ``pos`` counts code points from 0.

    Names may have any length and any characters. Of overlapping occurrences the leftmost counts, of these the longest, as one pattern of all
    names would give; with ``overlapping`` all count. Texts go once past an Aho-Corasick automaton of all names, and are not shuffled: only hits are.
    Null and empty texts have none, null and empty names are none, and a name of several entities gives a row for each.
    """
    import pyarrow as pa
    from pyspark.sql.types import StructField, StructType, LongType, StringType

    own = names.select(F.col(entity), F.lower(F.col(name)).alias("name")).filter("name <> ''").distinct()
    words = own.select("name").distinct()
    total = words.agg(F.coalesce(F.sum(F.octet_length("name")), F.lit(0))).first()[0]
    shards = max(1, -(-total // name_bytes))
    kind = StructType([StructField(key, texts.schema[key].dataType), StructField("pos", LongType()), StructField("length", LongType()), StructField("name", StringType())])
    out = None
    for k in range(shards):
        some = [_lowered(r.name) for r in words.filter(F.pmod(F.xxhash64("name"), F.lit(shards)) == k).collect()]  # at most about name_bytes
        mark = uuid.uuid4().hex

        def scan(batches, some=some, mark=mark):
            import ahocorasick

            global _automaton
            if _automaton[0] != mark:
                a = ahocorasick.Automaton()
                for w in some:
                    a.add_word(w, w)
                if some:
                    a.make_automaton()
                _automaton = (mark, a)
            find = _automaton[1]
            for b in batches:
                rows, pos, length, found = [], [], [], []
                for i, t in enumerate(b.column(1).to_pylist() if some else ()):
                    low = _lowered(t or "")
                    for end, w in find.iter(low):
                        at = end + 1 - len(w)
                        if not (_is_letter(low, at - 1) or _is_letter(low, end + 1)):
                            rows.append(i), pos.append(at), length.append(len(w)), found.append(w)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(pos, pa.int64()), pa.array(length, pa.int64()), pa.array(found, pa.string())], names=[key, "pos", "length", "name"])

        hit = texts.select(key, text).mapInArrow(scan, kind)
        out = hit if out is None else out.unionByName(hit)
    if not overlapping:
        out = _leftmost(out, key, F.col("length"), "length", "name")
    return out.join(own, "name").select(key, "pos", "length", "name", entity)


def similar_words(words: DataFrame, passage: str, word: str, endings: Sequence[str], alphabet: str = "Greek") -> DataFrame:
    """(passage, a, b, how): words a < b of a passage that are one name by ``stem_forms``.

    Both rules need equal first three letters of the stems, so these join; never all pairs of a passage.
    """
    w = words.select(passage, word).distinct().withColumn("_head", F.substring(_cut(F.col(word), endings, alphabet), 1, 3))
    a, b = w.select(passage, "_head", F.col(word).alias("a")), w.select(passage, "_head", F.col(word).alias("b"))
    both = a.join(b, [passage, "_head"]).filter("a < b")
    return both.select(passage, "a", "b", stem_forms(F.col("a"), F.col("b"), endings, alphabet).alias("how")).filter("how IS NOT NULL")


def _cut(c: Column, endings: Sequence[str], alphabet: str) -> Column:
    from weft.functions.text import stemmed

    return F.when(c.rlike(rf"^\p{{Is{alphabet}}}+$"), stemmed(c, endings)).otherwise(c)


def proposals(rows: DataFrame, pair: list[str], way: str, passage: str) -> DataFrame:
    """(pair, way, passages) of pairs whose passages tell one orientation alone; ``way`` is null where a passage tells none."""
    told = rows.filter(F.col(way).isNotNull()).groupBy(*pair, way).agg(F.array_sort(F.collect_set(passage)).alias("passages"))
    one = told.groupBy(*pair).agg(F.count("*").alias("_n"), F.min(way).alias(way), F.max_by("passages", way).alias("passages"))
    return one.filter("_n = 1").drop("_n")


def stem_forms(a: Column, b: Column, endings: Sequence[str], alphabet: str = "Greek") -> Column:
    """How two folded words are one name: ``equal``, ``stem`` (equal without their endings), or ``prefix`` (one stem of 4 letters or more begins the other, 2 letters longer at most)."""
    x, y = _cut(a, endings, alphabet), _cut(b, endings, alphabet)
    short, long = F.when(F.length(x) <= F.length(y), x).otherwise(y), F.when(F.length(x) <= F.length(y), y).otherwise(x)
    stem = (x == y) & (F.length(x) >= 3)
    prefix = (F.length(short) >= 4) & F.startswith(long, short) & (F.length(long) - F.length(short) <= 2)
    return F.when(a == b, "equal").when(stem, "stem").when(prefix, "prefix")


def relation_kinds() -> dict:
    """How a text tells of a kind of relation between two labels: expressions of (text, a, b) that give ``ab``, ``ba`` or null."""
    from weft.functions import text as X

    return {"kinship": X.parent_phrase, "commission": lambda t, a, b: X.verb_phrase(t, a, b, *X.COMMISSION), "hostile": lambda t, a, b: X.verb_phrase(t, a, b, *X.HOSTILE)}


def direct_proposals(candidates: DataFrame, passages: DataFrame, labels: DataFrame, kind: str, disputed: DataFrame | None = None) -> DataFrame:
    """(id, subject, object, kind, passages) of candidates that their passages' words tell, all one way round.

    ``candidates`` is (id, a, b, label_a, label_b, kinds), ``passages`` (id, passage, snippet), ``labels`` (passage, label, entity) of all mentions. A
    passage counts only where each label names one entity, the candidate's own. Candidates of ``disputed`` entities are left out.
    """
    c = candidates.filter(F.array_contains("kinds", kind) & (F.length("label_a") > 0) & (F.length("label_b") > 0) & (F.col("label_a") != F.col("label_b")))
    if disputed is not None:
        for end in ("a", "b"):
            c = c.join(disputed.select(F.col("entity").alias(end)).distinct(), end, "left_anti")
    one = labels.groupBy("passage", "label").agg(F.count_distinct("entity").alias("n"), F.min("entity").alias("entity")).filter("n = 1")
    end = lambda e: one.select("passage", F.col("label").alias(f"label_{e}"), F.col("entity").alias(e))
    rows = c.join(passages.select("id", "passage", "snippet"), "id").join(end("a"), ["passage", "label_a", "a"]).join(end("b"), ["passage", "label_b", "b"])
    told = rows.select("id", "a", "b", "passage", relation_kinds()[kind](F.col("snippet"), F.col("label_a"), F.col("label_b")).alias("way"))
    found = proposals(told, ["id", "a", "b"], "way", "passage")
    ahead = F.col("way") == "ab"
    return found.select("id", F.when(ahead, F.col("a")).otherwise(F.col("b")).alias("subject"), F.when(ahead, F.col("b")).otherwise(F.col("a")).alias("object"), F.lit(kind).alias("kind"), "passages")


def evidence_alignment(edges: DataFrame, evidence: str, mentions: DataFrame, locator) -> DataFrame:
    """(edge_id, n_read, both, one, alignment): whether an edge's ends (src, dst) are mentioned at a passage of its evidence.

    ``evidence`` is an array of structs or of texts; ``locator`` gives an item's passage, null where it names none. Mentions (entity, passage) meet
    the exploded items twice, by equi joins. An edge none of whose items names a passage is ``non_nt_locator``.
    """
    m = mentions.filter(F.col("passage").isNotNull()).select("entity", "passage").distinct()
    items = edges.select("edge_id", "src", "dst", F.explode_outer(evidence).alias("item")).select("edge_id", "src", "dst", locator(F.col("item")).alias("passage"))
    for end in ("src", "dst"):
        items = items.join(m.select(F.col("entity").alias(end), "passage", F.lit(True).alias(f"_{end}")), [end, "passage"], "left")
    hit = lambda c: F.coalesce(F.col(c), F.lit(False))
    by = items.groupBy("edge_id").agg(
        F.count("passage").alias("n_read"), F.coalesce(F.bool_or(hit("_src") & hit("_dst")), F.lit(False)).alias("both"), F.coalesce(F.bool_or(hit("_src") | hit("_dst")), F.lit(False)).alias("one"),
    )
    alignment = F.when(F.col("n_read") == 0, "non_nt_locator").when(F.col("both"), "both_endpoints_mentioned").when(F.col("one"), "one_endpoint_mentioned").otherwise("neither_endpoint_mentioned")
    return by.withColumn("alignment", alignment)
