"""A training corpus in five stages, each the operator of that name over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``, with any further ones that ``docs`` has, as they are, whatever
their names. Rows are written as Parquet between stages, so lost executors cost at most
a stage's own tasks. Every stage gives no rows for no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import bpe, chosen_path, decontamination, pii, quality_rules
from weft.llm.common import sheltered, table, written

KEY = pii.KEY
#: Pieces in the tokenizer's memos: fewer than by default, as earlier stages leave the executors' JVMs large.
MEMO = 100_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts have no words and go. Repeated rows share their verdict.
    """
    return sheltered(docs, ["metrics", "base_failed", "kept"], lambda d: quality_rules.judge(d).filter("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one document stays, that of the class's id.

    Texts without words, null ones among them, are no copies of others. Of rows with equal
    doc_id and text one stays; a doc_id that several texts bear is told apart by the text.
    """
    return chosen_path.deduplicated(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by test items go.

    Null and empty texts stay, as does everything where there are no items. Repeated rows share their verdict.
    """
    items = table(spark, sf_dir, "benchmark")
    return sheltered(docs, ["n_words", "spans"], lambda d: decontamination.match_items(d, items).filter(~decontamination.contaminated()))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts becomes surrogates, and ``n_chars`` follows the text.

    Null and empty texts stay as they are, with their ``n_chars``. Repeated rows stay alike.
    """
    out = pii.replace_entities(docs, KEY)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars")) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids; with the contract's digests of ids and decoded text.

    Null and empty texts have no ids. Repeated rows stay. Of other columns lang and source are kept.
    """
    import public_tokenizers

    done = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.json"), memo=MEMO)
    return done.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("pii", personal_data),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs


#: Surrogates and token ids are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None
