"""People and their relations out of a sectioned file: records, what excludes them, and edges that both ends may tell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.functions import text as X
from weft.operators.relational import resolve
from weft.sources.tables import child_rows

#: Fields of a header, parted by tabs.
FIELDS = ("unified_raw", "description", "parents", "siblings", "partners", "offspring", "tribe", "summary", "type")


def headers(sections: DataFrame) -> DataFrame:
    """(file, record, key, name, and ``FIELDS``) of header rows; ``key`` is what stands before the equals sign, ``name`` what stands before the at sign."""
    part = lambda i: F.trim(F.coalesce(F.get(F.split("line", "\t"), F.lit(i)), F.lit("")))
    rows = sections.filter("kind = 'header'").select("file", "record", *[part(i).alias(n) for i, n in enumerate(FIELDS)])
    return rows.withColumns({"key": F.trim(F.regexp_extract("unified_raw", r"^([^=]*)", 1)), "name": X.clean_name(F.regexp_extract("unified_raw", r"^([^@=]*)", 1))})


def people(sections: DataFrame, named: str = "(?i)^named?", group: str = "(?i)^(?:group|people)") -> DataFrame:
    """Headers of single people, with ``forms`` and ``refs``, how many of each their child rows have.

    Articles (``@`` first) are none; nor are records of which a child row tells a group, or none names the person. A child row belongs to the header
    before it, so one that is left out takes its own with it.
    """
    kids = child_rows(sections.filter("kind = 'child'").select("file", "record", "line"))
    told = kids.groupBy("file", "record").agg(
        F.bool_or(F.col("significance").rlike(named)).alias("_named"), F.bool_or(F.col("significance").rlike(group)).alias("_group"), F.count_distinct("text").alias("forms"), F.sum(F.size("refs")).alias("refs"),
    )
    ok = ~F.startswith(F.col("unified_raw"), F.lit("@")) & (F.col("name") != "")
    return headers(sections).filter(ok).join(told.filter("_named AND NOT _group").drop("_named", "_group"), ["file", "record"])


def relations(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kind, src, dst, uncertain) of ``people``'s lists, each edge once, and a ledger (key, field, raw, how) of what names no one.

    A parent edge may be told by either end; siblings and partners are told once, the lesser key first. Names are resolved by key, else by
    a name that one person alone has.
    """
    fields = ("parents", "siblings", "partners", "offspring")
    out = None
    for f in fields:
        one = records.select("key", F.lit(f).alias("field"), F.explode(X.relation_items(F.col(f))).alias("i"))
        out = one if out is None else out.unionByName(one)
    asked = out.select(F.col("key").alias("own"), "field", F.col("i.raw").alias("raw"), F.trim(F.regexp_replace("i.raw", r"=.*$|\(\?\)", "")).alias("ref"), F.col("i.key").alias("label"), F.col("i.uncertain").alias("uncertain"))
    done = resolve(asked, records.select("key", "name"), "ref", "label", "key", "name")
    lost = done.filter("resolved IS NULL").select(F.col("own").alias("key"), "field", "raw", "how")
    up, down = F.col("field") == "parents", F.col("field") == "offspring"
    kind = F.when(up | down, "parent").when(F.col("field") == "siblings", "sibling").otherwise("partner")
    src = F.when(up, F.col("resolved")).when(down, F.col("own")).otherwise(F.least("own", "resolved"))
    dst = F.when(up, F.col("own")).when(down, F.col("resolved")).otherwise(F.greatest("own", "resolved"))
    edges = done.filter("resolved IS NOT NULL AND resolved <> own").select(kind.alias("kind"), src.alias("src"), dst.alias("dst"), "uncertain")
    return edges.groupBy("kind", "src", "dst").agg(F.bool_and("uncertain").alias("uncertain")), lost


def sectioned_people(lines: DataFrame, opens: str = "PERSON", closes: Sequence[str] = ("PLACE", "OTHER")) -> DataFrame:
    """The records of a file's sections of people, as ``sectioned`` gives them."""
    from weft.sources.tables import sectioned

    c = F.col("line")
    mark = lambda word: c.rlike(rf"^\$=+ *{word}")
    closed: Column = F.lit(False)
    for word in closes:
        closed = closed | mark(word)
    return sectioned(lines, mark(opens), closed, ~c.rlike(r"^[–\-]"), c.rlike(r"^[–\-]"))
