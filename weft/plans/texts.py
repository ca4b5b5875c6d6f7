"""Queries over text functions and text joins, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import text as X
from weft.operators import matching as D
from weft.plans.relational import t

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


@query("SELECT doc_id, md5(trim(lower(regexp_replace(regexp_replace(strip_accents(text), '[^\\p{L}\\p{N}\\s]', ' ', 'g'), '\\s+', ' ', 'g')))) AS folded FROM documents")
def text_fold(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.md5(X.folded(F.col("text"))).alias("folded"))


_STRIP = "html"
for _p in (r"(?s)<!--.*?-->", r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>", "<[^>]*>", "&[a-zA-Z#0-9]+;", r"[\x00-\x1f]"):
    _STRIP = f"regexp_replace({_STRIP}, '{_p}', ' ', 'g')"


@query(f"SELECT page_id, md5(trim(regexp_replace({_STRIP}, ' +', ' ', 'g'), ' ')) AS plain FROM pages")
def markup_strip(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", F.md5(X.stripped_markup(F.col("html"))).alias("plain"))


LANGS = ("en", "de", "fr", "es")


@query("""SELECT page_id, regexp_extract(url, '://[^/]+/([a-z]{2})/', 1) AS book, TRY_CAST(regexp_extract(url, '://[^/]+/[a-z]{2}/([0-9]+)', 1) AS INT) AS number,
CASE WHEN regexp_extract(url, '://[^/]+/([a-z]{2})/', 1) IN ('en', 'de') THEN 'ot' WHEN regexp_extract(url, '://[^/]+/([a-z]{2})/', 1) IN ('fr', 'es') THEN 'nt' END AS side FROM pages""")
def locator_parse(spark, sf_dir):
    book = F.regexp_extract("url", "://[^/]+/([a-z]{2})/", 1)
    number = F.nullif(F.regexp_extract("url", "://[^/]+/[a-z]{2}/([0-9]+)", 1), F.lit("")).cast("int")
    return t(spark, sf_dir, "pages").select("page_id", book.alias("book"), number.alias("number"), X.testament(book, ["en", "de"], ["fr", "es"]).alias("side"))


CUES = {"kin": ("the thing", "of the"), "hostile": ("stupid", "trash", "scum"), "license": ("license", "rights reserved"), "contact": ("@",)}


@query("SELECT doc_id, array_to_string(list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"contains(lower(text), '{x}')" for x in v) + f" THEN '{k}' END" for k, v in CUES.items()) + "], lambda x: x IS NOT NULL), ',') AS cues FROM documents")
def cue_detection(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.array_join(X.cue_types(F.lower("text"), CUES), ",").alias("cues"))


@query("""SELECT doc_id, len(regexp_extract_all(text, 'the ')) AS n_label, len(regexp_extract_all(text, 'the of')) AS n_group,
len(regexp_extract_all(text, 'the ')) > 0 AND len(regexp_extract_all(text, 'the ')) = len(regexp_extract_all(text, 'the of')) AS collective,
regexp_matches(text, '[Tt]he [a-z]+ of [a-z]+') AS phrase FROM documents""")
def phrase_grammar(spark, sf_dir):
    c = F.col("text")
    return t(spark, sf_dir, "documents").select(
        "doc_id", F.regexp_count(c, F.lit("the ")).cast("long").alias("n_label"), F.regexp_count(c, F.lit("the of")).cast("long").alias("n_group"),
        X.only_collective(c, "the ", "of").alias("collective"), c.rlike("[Tt]he [a-z]+ of [a-z]+").alias("phrase"),
    )


#: Occurrences of the items' texts, and of their sentences, as names: whole and in any case, with no letter beside them.
_NAMED = r"""n AS (SELECT DISTINCT item_id, lower(s) AS name FROM (SELECT item_id, text AS s FROM benchmark UNION ALL SELECT item_id, unnest(string_split(text, '. ')) FROM benchmark) WHERE length(s) >= 6),
p AS (SELECT doc_id, name, lower(text) AS t, string_split(lower(text), name) AS parts FROM documents, (SELECT DISTINCT name FROM n) WHERE contains(lower(text), name)),
k AS (SELECT doc_id, name, t, parts, unnest(range(1, len(parts))) AS k FROM p),
o AS (SELECT doc_id, name, t, length(name) AS length, (list_sum(list_transform(parts[1:k], lambda x: length(x))) + (k - 1) * length(name))::BIGINT AS pos FROM k),
h AS (SELECT doc_id, name, length, pos FROM o WHERE NOT regexp_matches(substr(t, pos, 1), '[a-z]') AND NOT regexp_matches(substr(t, pos + length + 1, 1), '[a-z]'))"""


def _named(spark, sf_dir, overlapping):
    items = t(spark, sf_dir, "benchmark")
    names = items.select("item_id", "text").unionByName(items.select("item_id", F.explode(F.split("text", r"\. ")).alias("text"))).filter(F.length("text") >= 6)
    return D.dictionary_scan(t(spark, sf_dir, "documents").select("doc_id", "text"), names, "doc_id", "text", "item_id", "text", overlapping)


@query(f"""WITH {_NAMED} SELECT item_id, count(*) AS n_hits, count(DISTINCT doc_id) AS n_docs, array_to_string(list_transform(list_sort(list(doc_id * 100000 + pos))[1:25], lambda x: x::VARCHAR), ',') AS first
FROM h JOIN n USING (name) GROUP BY item_id""")
def dictionary_hits(spark, sf_dir):
    """Every occurrence of every name, by item."""
    from weft.operators.relational import capped_list

    hits = _named(spark, sf_dir, True).withColumn("at", F.col("doc_id") * 100000 + F.col("pos"))
    docs = hits.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"))
    c = capped_list(hits, "item_id", "at", 25).join(docs, "item_id")
    return c.select("item_id", F.col("n").alias("n_hits"), "n_docs", F.array_join(F.col("first").cast("array<string>"), ",").alias("first"))


@query(f"""WITH {_NAMED} SELECT doc_id, pos, length, md5(name) AS name, item_id FROM h JOIN n USING (name)
WHERE NOT EXISTS (SELECT 1 FROM h x WHERE x.doc_id = h.doc_id AND x.length > h.length AND x.pos <= h.pos AND x.pos + x.length >= h.pos + h.length)""")
def dictionary_longest(spark, sf_dir):
    """Leftmost and longest occurrences: a sentence within a hit of its whole text is none. Sentences never overlap otherwise."""
    return _named(spark, sf_dir, False).withColumn("name", F.md5(F.col("name").cast("binary")))


@query("""SELECT p_partkey, CASE WHEN regexp_matches(p_type, '(ING|ED)$') THEN regexp_replace(p_type, '(ING|ED)$', '') ELSE p_type END AS stem, substr(p_name, 1, 1) || '…' AS short FROM part""")
def stems_and_snippets(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", X.stemmed(F.col("p_type"), ["ING", "ED"]).alias("stem"), X.snippet(F.col("p_name"), 2).alias("short"))


@query("""SELECT event_id, CASE WHEN value IS NULL OR isnan(value) THEN 'medium' WHEN value / 100 >= 0.85 THEN 'high' WHEN value / 100 >= 0.65 THEN 'medium' ELSE 'low' END AS bucket,
json_extract_string(props, '$.k') AS k FROM events""")
def confidence_buckets(spark, sf_dir):
    return t(spark, sf_dir, "events").select("event_id", X.bucket(F.col("value") / 100).alias("bucket"), F.get_json_object("props", "$.k").alias("k"))


@query("SELECT event_id, 'k' AS unknown FROM events WHERE json_exists(props, '$.k')")
def unknown_fields(spark, sf_dir):
    from weft.operators.validation import unknown_fields as run

    return run(t(spark, sf_dir, "events").select("event_id", "props"), "props", ["id", "name"]).select("event_id", F.array_join("unknown", ",").alias("unknown"))


_SUFFIXES = ("ing", "ed", "er", "on", "s")
_STEM = "CASE " + " ".join(f"WHEN ends_with(w, '{e}') AND length(w) >= {len(e) + 3} THEN left(w, -{len(e)})" for e in _SUFFIXES) + " ELSE w END"


@query(f"""WITH a AS (SELECT DISTINCT item_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda x: x <> '')) AS w FROM benchmark), s AS (SELECT item_id, w, {_STEM} AS s FROM a),
p AS (SELECT x.item_id, x.w AS a, y.w AS b, CASE WHEN length(x.s) <= length(y.s) THEN x.s ELSE y.s END AS short, CASE WHEN length(x.s) <= length(y.s) THEN y.s ELSE x.s END AS long FROM s x JOIN s y ON x.item_id = y.item_id AND x.w < y.w)
SELECT * FROM (SELECT item_id, a, b, CASE WHEN short = long AND length(short) >= 3 THEN 'stem' WHEN length(short) >= 4 AND starts_with(long, short) AND length(long) - length(short) <= 2 THEN 'prefix' END AS how FROM p) WHERE how IS NOT NULL""")
def stem_prefix_join(spark, sf_dir):
    words = F.explode(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda x: x != ""))
    return D.similar_words(t(spark, sf_dir, "benchmark").select("item_id", words.alias("w")), "item_id", "w", _SUFFIXES, "Latin")
