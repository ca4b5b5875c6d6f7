"""Quality rules: a threshold table compiled into one Spark projection.

``quality_metrics`` turns a text into counts of words, symbols, stop words and
lines; ``compile_rules`` turns a table of thresholds into one boolean column
over those counts. Both are built-in Spark expressions only, evaluated row by
row without a shuffle, so a long text or a hot source costs its own row alone.

Defined results: a null text has no words and fails the length rule; so does an
empty one. Rows are judged one by one: repeated rows give repeated results, an
empty table gives an empty one. Other columns pass through; input columns named ``metrics``,
``base_failed`` or ``kept`` are replaced. Windows of words are told apart by 64-bit hashes: of a text's
million windows, some two different ones share a hash once in 3e7 texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, fresh, table

WINDOW = 5
STOP_WORDS = (
    "the of and to in a is that it for was on with be as at by an this are or from "
    "der die und das von zu den mit ist auf für im dem ein eine sich nicht "
    "de la le et les des en un une que est dans qui sur pour du au pas par "
    "el los y se del las por con no su lo es al"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= metric <= high`` must hold for texts of ``min_words`` words or more."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: The contract's rules: fixed values.
BASE_RULES = (
    Rule("words", "n_words", low=10),
    Rule("repeated_words", "repeat_word_pct", high=20),
)
#: The method's own thresholds.
RULES = (
    Rule("symbols_per_word", "symbol_ratio", high=0.1),
    Rule("bangs_per_word", "bang_ratio", high=0.3),
    Rule("mean_word_length", "mean_word_chars", low=2.5, high=15),
    Rule("stop_words", "stop_word_ratio", low=0.03, min_words=50),
    Rule("duplicate_lines", "dup_line_ratio", high=0.5, min_words=20),
)


def _repeat_words(words: Column, grams: Column) -> Column:
    """Words in windows found twice or more: the union of the windows' spans."""
    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(sorted_pairs: Column) -> Column:
        beside = F.zip_with(
            sorted_pairs,
            F.slice(sorted_pairs, 2, F.greatest(F.size(sorted_pairs) - 1, F.lit(0))),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
        )
        return F.sort_array(F.array_distinct(F.flatten(F.filter(beside, lambda x: x.isNotNull()))))

    def covered(at: Column) -> Column:
        gaps = F.zip_with(
            at,
            F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))),
            lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)),
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)

    # transform over a one-element array evaluates its element once: a let-binding
    def bind(value: Column, body) -> Column:
        return F.transform(F.array(value), body)[0]

    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(
        bind(pairs, lambda p: bind(starts(p), covered))
    )


def with_metrics(df: DataFrame, text: str = "text", out: str = "metrics", stop_words: tuple[str, ...] | list[str] = STOP_WORDS) -> DataFrame:
    """Adds the struct ``out`` of all metrics of the column ``text``. ``stop_words`` are counted as they are and capitalised."""
    tmp, grammed = fresh(df, out, "grams")
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(t, SPACE_CLASS + "+"), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.withColumn(tmp, F.struct(words.alias("w"), lines.alias("l")))
    w, n = F.col(f"{tmp}.w"), F.size(F.col(f"{tmp}.w"))
    grams = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(grammed, grams)
    count = lambda c: c.cast("long")
    base = F.struct(
        count(n).alias("n_words"),
        count(F.length(F.array_join(w, ""))).alias("word_chars"),
        count(F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", ""))).alias("n_symbols"),
        count(F.size(F.col(f"{tmp}.l"))).alias("n_lines"),
        count(F.size(F.col(f"{tmp}.l")) - F.size(F.array_distinct(F.col(f"{tmp}.l")))).alias("n_dup_lines"),
        _repeat_words(w, F.col(grammed)).alias("n_repeat_words"),
        count(F.size(F.filter(w, lambda x: x.isin(*stop_words, *[s.capitalize() for s in stop_words])))).alias("n_stop_words"),
        count((F.length(t) - F.length(F.replace(t, F.lit("!!"), F.lit("")))) / 2).alias("n_bangs"),
        # not deterministic: a filter on the verdict stays above, and the arrays are made once a row
        F.monotonically_increasing_id().alias("row"),
    )
    m = lambda c: F.col(out)[c]
    per_word = lambda c: F.coalesce(m(c) / F.nullif(m("n_words"), F.lit(0)), F.lit(0.0))
    df = df.withColumn(out, base).drop(tmp, grammed)
    return df.withColumn(
        out,
        F.struct(
            F.col(f"{out}.*"),
            (per_word("n_repeat_words") * 100).alias("repeat_word_pct"),
            per_word("n_symbols").alias("symbol_ratio"),
            per_word("n_bangs").alias("bang_ratio"),
            per_word("word_chars").alias("mean_word_chars"),
            per_word("n_stop_words").alias("stop_word_ratio"),
            F.coalesce(m("n_dup_lines") / F.nullif(m("n_lines"), F.lit(0)), F.lit(0.0)).alias("dup_line_ratio"),
        ),
    )


def compile_rules(rules: tuple[Rule, ...], metrics: str = "metrics") -> Column:
    """One boolean column: true where every rule of the table holds."""
    parts = []
    for r in rules:
        m = F.col(f"{metrics}.{r.metric}")
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (m >= F.lit(r.low))
        if r.high is not None:
            ok = ok & (m <= F.lit(r.high))
        parts.append(ok if not r.min_words else (F.col(f"{metrics}.n_words") < r.min_words) | ok)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def base_failed(metrics: str = "metrics") -> Column:
    """The contract's rule in whole numbers, free of rounding."""
    n, r = F.col(f"{metrics}.n_words"), F.col(f"{metrics}.n_repeat_words")
    return (n < 10) | (100 * r > 20 * n)


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, stop_words: tuple[str, ...] | list[str] = STOP_WORDS) -> DataFrame:
    """``df`` with ``metrics``, ``base_failed`` and ``kept``.

    The rule on stop words knows the languages of its list, English, German, French and Spanish by default; for
    others pass their words, or rules without it.
    """
    m = with_metrics(df, text, stop_words=stop_words)
    return m.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & compile_rules(rules)})


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select(
        "doc_id",
        "metrics.n_words",
        "metrics.word_chars",
        "metrics.n_symbols",
        "metrics.n_dup_lines",
        "metrics.n_repeat_words",
        "base_failed",
        "kept",
    )


def verdict_sql(source: str = "documents") -> str:
    """DuckDB SQL for ``judge`` over ``source``: a row number ``rid`` and the metrics of each row."""
    stops = ", ".join(f"'{x}'" for s in STOP_WORDS for x in (s, s.capitalize()))
    return f"""
w0 AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {source}),
w1 AS (SELECT rid, doc_id, t,
         list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM w0),
w2 AS (SELECT rid, unnest(range(1, len(w) - 3)) AS i, w FROM w1 WHERE len(w) >= 5),
w3 AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS c FROM w2),
w4 AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i+1, i+2, i+3, i+4]) AS p FROM w3 WHERE c > 1) GROUP BY rid),
w5 AS (SELECT w1.rid, doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: x IN ({stops}))) AS n_stop,
         (length(t) - length(replace(t, '!!', ''))) // 2 AS n_bangs
       FROM w1 LEFT JOIN w4 ON w1.rid = w4.rid),
w6 AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM w5),
judged AS (SELECT *, (NOT base_failed
         AND n_symbols / n_words::DOUBLE <= 0.1 AND n_bangs / n_words::DOUBLE <= 0.3
         AND word_chars / n_words::DOUBLE BETWEEN 2.5 AND 15
         AND (n_words < 50 OR n_stop / n_words::DOUBLE >= 0.03)
         AND (n_words < 20 OR n_dup_lines / n_lines::DOUBLE <= 0.5)) AS kept FROM w6)"""


ORACLE = f"""WITH {verdict_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""

QUERIES = {"op10_quality_rules": op10_quality_rules}
ORACLE_SQL = {"op10_quality_rules": ORACLE}
