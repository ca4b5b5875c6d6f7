"""The published record of an entity: names, aliases, books, mentions, options and notes in one nested row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.functions import published as P

#: Aliases of a record.
MOST_ALIASES = 40


def first_seen(df: DataFrame, key: str, value: str, order: str, out: str, most: int | None = None) -> DataFrame:
    """(key, out): distinct values of a key in the order in which each first occurs, at most ``most``. Repeats go before values are gathered."""
    one = df.groupBy(key, value).agg(F.min(order).alias("_at"))
    if most is not None:
        w = Window.partitionBy(key).orderBy("_at", value)
        one = one.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= most)
    return one.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", value))), lambda x: x[value]).alias(out))


def entity_records(nodes: DataFrame, names: DataFrame, mentions: DataFrame, options: DataFrame, testament: Column | None = None) -> DataFrame:
    """One nested row for each entity.

    ``nodes``: node, name (null or blank where there is none), latin, sex, testaments, note. ``names``: name_id, node, text.
    ``mentions``: mention_id, node, passage, location, source. ``options``: node, option, status, scope, grp, target.
    An entity without a name has its first alias in Latin letters, else ``latin``, else its id, and ``fallback`` true. ``testament``
    is an expression of ``book`` (ot, nt or null); without an option of its own an entity is independent.
    """
    testament = F.when(F.col("book").isin(P.OLD_BOOKS), "ot").when(F.col("book").isNotNull(), "nt") if testament is None else testament
    m = mentions.withColumn("passage", F.regexp_replace(F.trim("passage"), r"(?i)^STEP:", "")).withColumn("book", P.passage_book(F.col("passage"))).withColumn("testament", testament)
    spots = m.groupBy("node", F.struct("passage", F.coalesce("location", F.lit("")).alias("location"), F.coalesce("source", F.lit("")).alias("source")).alias("spot")).agg(F.first("book").alias("book"), F.first("testament").alias("testament"))
    told = spots.groupBy("node").agg(
        F.array_sort(F.collect_list("spot")).alias("mentions"), F.array_sort(F.collect_set("book")).alias("books"), F.array_sort(F.collect_set("testament")).alias("in"),
        F.count_if(F.col("testament") == "nt").alias("n_nt"), F.count_if(F.col("testament") == "ot").alias("n_ot"),
    )
    known = names.withColumn("text", F.trim("text")).filter("text <> ''")
    latin = known.filter(F.col("text").rlike("[A-Za-z]")).groupBy("node").agg(F.min_by("text", F.struct("name_id", "text")).alias("latin_name"))
    base = nodes.join(latin, "node", "left")
    shown = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in ("name", "latin_name", "latin")], F.col("node"))
    base = base.withColumns({"shown": shown, "fallback": F.coalesce(F.trim("name"), F.lit("")) == ""})
    other = known.join(base.select("node", "shown"), "node").filter("text <> shown")
    aliases = first_seen(other, "node", "text", "name_id", "aliases", MOST_ALIASES)
    one = options.groupBy("node", "option").agg(F.min(F.struct("status", "scope", "grp", "target")).alias("o"))
    opts = one.groupBy("node").agg(F.array_sort(F.collect_list(F.struct(F.col("option").alias("id"), "o.status", F.coalesce("o.scope", F.lit("default")).alias("scope"), "o.grp", "o.target"))).alias("options"))
    out = base.join(aliases, "node", "left").join(told, "node", "left").join(opts, "node", "left")
    kind = opts.schema["options"].dataType.simpleString()
    alone = F.array(F.struct(F.concat("node", F.lit("-main")).alias("id"), F.lit("independent").alias("status"), F.lit("default").alias("scope"), F.lit(None).alias("grp"), F.lit(None).alias("target"))).cast(kind)
    empty = lambda c, t: F.coalesce(c, F.array().cast(t))
    strings = "array<string>"
    return out.select(
        F.struct(
            P.canonical_id(F.col("node")).alias("id"), F.when(P.canonical_id(F.col("node")) != F.col("node"), F.array("node")).otherwise(F.array().cast(strings)).alias("legacy_ids"),
            F.col("shown").alias("name"), F.coalesce(F.nullif("latin", F.lit("")), "shown").alias("latin"), F.when(F.col("sex").isin("male", "female", "mixed"), F.col("sex")).otherwise("unknown").alias("sex"),
            empty("aliases", strings).alias("aliases"), P.era(F.col("testaments"), F.col("books"), F.col("note")).alias("era"), empty("books", strings).alias("books"),
            empty("mentions", told.schema["mentions"].dataType.simpleString()).alias("mentions"), empty("in", strings).alias("testaments"),
            F.struct(F.coalesce("n_nt", F.lit(0)).alias("nt"), F.coalesce("n_ot", F.lit(0)).alias("ot")).alias("counts"), F.coalesce("options", alone).alias("options"), F.col("fallback"),
        ).alias("entity")
    )
