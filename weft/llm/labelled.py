"""A bounded sample of labelled documents, and the tokens classifiers see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, digest_mod

PREFIX = 6


def sample(docs: DataFrame, labels: DataFrame, grade: Column, most: int, key: str = "doc_id", text: str = "text", held_out_mod: int = 3) -> DataFrame:
    """At most ``most`` labelled documents as (key, text, y), those of the least hashes of their key.

    Only rows whose crc32(key as text) mod ``held_out_mod`` is not 1 are taken. A key with
    several labels has the greatest; null grades and null keys are no labels. Of repeated
    documents one counts.
    """
    own = labels.select(F.col(key).alias("k"), grade.alias("y")).filter("k IS NOT NULL AND y IS NOT NULL")
    own = own.filter(digest_mod(F.col("k"), held_out_mod) != 1).groupBy("k").agg(F.max("y").alias("y"))
    own = own.orderBy(F.xxhash64("k"), "k").limit(most)  # bounded, so it may be broadcast
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(own), "k")
    return rows.groupBy("k").agg(F.min("t").alias("t"), F.first("y").alias("y"))


def beginnings(word: bytes, sizes: tuple[int, ...] = (PREFIX,)) -> list[bytes]:
    """The word, and its first bytes of the given numbers where it is longer, marked."""
    return [word] + [b"^" + word[:n] for n in sizes if len(word) > n]


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, and the first ``PREFIX`` bytes of longer ones, marked."""
    words = alnum_words(text)
    return words + [b"^" + w[:PREFIX] for w in words if len(w) > PREFIX]
