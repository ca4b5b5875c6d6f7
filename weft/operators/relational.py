"""Routing, classification, joins with reasons, aggregates and windows over entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.operators.validation import faults
from weft.sources.tables import in_tasks


def classify(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """The label of the first rule that holds."""
    out = None
    for when, label in rules:
        out = F.when(when, label) if out is None else out.when(when, label)
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def route(df: DataFrame, reasons: Sequence[tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and a ledger of the others with the first ``reason`` that holds."""
    marked = df.withColumn("reason", classify(reasons))
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")


def zero_filled_counts(df: DataFrame, domain: DataFrame, keys: list[str], out: str = "n") -> DataFrame:
    """Counts for every key of the domain, zeros where there is none."""
    return domain.join(df.groupBy(*keys).agg(F.count("*").alias(out)), keys, "left").fillna(0, [out])


def lookup(df: DataFrame, table: DataFrame, on: list[str], defaults: dict) -> DataFrame:
    """Left join with defaults in place of nulls for what is not found."""
    return df.join(table, on, "left").fillna(defaults)


def ordered_concat(value: str, order: str, sep: str = "; ") -> Column:
    """Values as one text in the order of another column; an aggregate."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order), F.col(value)))), lambda s: s[value]), sep)


def united_evidence(evidence: str, keys: Sequence[str]) -> Column:
    """Arrays of evidence structs of a group as one, an aggregate: of items equal in ``keys`` the least, in order of these."""
    all_ = F.flatten(F.collect_list(evidence))
    keyed = F.array_sort(F.transform(all_, lambda e: F.struct(F.struct(*[e[k].alias(k) for k in keys]).alias("key"), e.alias("e"))))
    # a list of the list, so that it is made once and not again for each of its items
    firsts = F.transform(F.array(keyed), lambda l: F.transform(F.filter(l, lambda x, i: (i == 0) | ~F.get(l, i - 1)["key"].eqNullSafe(x["key"])), lambda x: x["e"]))
    return firsts[0]


def summary(df: DataFrame, columns: Sequence[str], places: int = 4) -> DataFrame:
    """(metric, least, most, mean): the mean rounded; zeros for an empty table."""
    zero = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    aggs = df.agg(*[F.struct(F.lit(c).alias("metric"), zero(F.min(c)).alias("least"), zero(F.max(c)).alias("most"), zero(F.round(F.avg(c), places)).alias("mean")).alias(c) for c in columns])
    return aggs.select(F.explode(F.array(*columns)).alias("x")).select("x.*")


def nested_sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the sizes of the arrays of all rows summed, by column; null arrays are empty."""
    return df.agg(*[F.coalesce(F.sum(F.greatest(F.size(F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType))), F.lit(0))), F.lit(0)).cast("long").alias(c) for c in columns])


def distinct_structs(df: DataFrame, keys: list[str], fields: list[str], out: str) -> DataFrame:
    """One row a key with the sorted distinct structs of ``fields``; distinct before they are gathered."""
    one = df.select(*keys, F.struct(*fields).alias(out)).distinct()
    return one.groupBy(*keys).agg(F.array_sort(F.collect_list(out)).alias(out))


def gathered(df: DataFrame, signature: list[str], arrays: dict[str, str], prefix: str, wrap: dict[str, Column] | None = None) -> DataFrame:
    """One candidate for each signature: an id in its order, the sorted distinct values of each array column (by its new name), wrapped by expressions."""
    sets = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(a) for c, a in arrays.items()]
    one = numbered(df.groupBy(*signature).agg(*sets), signature)
    return one.withColumn("id", padded_id(prefix, F.col("ordinal"))).drop("ordinal").withColumns(wrap or {})


def merge_group_faults(options: DataFrame, scopes: Sequence[str] = ("common_tradition", "common-tradition")) -> DataFrame:
    """(grp, fault) of groups of options (grp, member, target, scope): two members at least, one target, which is a member with a target, and the fixed scope."""
    g = options.filter("grp IS NOT NULL").groupBy("grp").agg(
        F.countDistinct("member").alias("n"), F.countDistinct("target").alias("targets"), F.min("target").alias("target"),
        F.collect_set(F.when(F.col("target").isNotNull(), F.col("member"))).alias("members"), F.bool_and(F.col("scope").isNull() | F.lower("scope").isin(list(scopes))).alias("scoped"),
    )
    rules = {
        "too_few": F.col("n") < 2, "several_targets": F.col("targets") > 1, "no_target": (F.col("n") > 1) & F.col("target").isNull(),
        "target_not_member": (F.col("n") > 1) & (F.col("targets") == 1) & ~F.array_contains("members", F.col("target")), "scope": ~F.col("scoped"),
    }
    return faults(g, ["grp"], rules)


def merge_by_key(df: DataFrame, keys: list[str], least: dict[str, str], joined: dict[str, tuple[str, str]], united: dict[str, str]) -> DataFrame:
    """One row a key: least values, texts joined in order, sets of values sorted. A key's different values are gathered in its row, which is what it asks for."""
    aggs = [F.min(c).alias(a) for a, c in least.items()]
    aggs += [ordered_concat(c, o).alias(a) for a, (c, o) in joined.items()]
    aggs += [F.array_sort(F.collect_set(c)).alias(a) for a, c in united.items()]
    return df.groupBy(*keys).agg(*aggs)


def best(df: DataFrame, keys: list[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. The window's limit runs before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def rank_margin(df: DataFrame, key: str, score: str) -> DataFrame:
    """``rank`` (dense, by falling score) and the margin of rank 1 to the next different score.

    ``margin_or_zero`` is 0 where there is only one score, ``margin_or_score`` then the score
    itself; both are 0 beyond rank 1.
    """
    one = df.select(key, score).distinct()  # ranks are of different scores
    places = one.withColumn("rank", F.dense_rank().over(Window.partitionBy(key).orderBy(F.desc(score))))
    second = one.groupBy(key).agg(F.max(score).alias("_top")).join(one, key).filter(F.col(score) < F.col("_top")).groupBy(key).agg(F.max(score).alias("_second"))
    ranked = null_safe_join(null_safe_join(df, places, [key, score], "left"), second, [key], "left")
    first = F.col("rank") == 1
    zero = F.lit(0).cast(df.schema[score].dataType)
    return ranked.withColumns({
        "margin_or_zero": F.when(first, F.coalesce(F.col(score) - F.col("_second"), zero)).otherwise(zero),
        "margin_or_score": F.when(first, F.col(score) - F.coalesce("_second", zero)).otherwise(zero),
    }).drop("_second")


def nth(df: DataFrame, keys: list[str], value: str, order: str, n: int = 1) -> DataFrame:
    """(keys, value): the n-th value of each key in an order; keys with fewer are left out. The first needs no window."""
    if n == 1:
        return df.groupBy(*keys).agg(F.min_by(value, F.struct(order, value)).alias(value))
    w = Window.partitionBy(*keys).orderBy(order, value)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == n).select(*keys, value)


def top_with_more(df: DataFrame, order: Sequence[Column], most: int) -> tuple[DataFrame, DataFrame]:
    """The first ``most`` rows, and one row with ``n_more``, how many follow."""
    return df.orderBy(*order).limit(most), df.agg(F.greatest(F.count("*") - most, F.lit(0)).alias("n_more"))


def custom_rank(first: Column, number: Column, text: Column) -> list[Column]:
    """An order: what ``first`` holds for, then by the number in an id, then by its text."""
    return [F.when(F.coalesce(first, F.lit(False)), 0).otherwise(1), F.coalesce(number, F.lit(0)), text]


def selected_first(key: Column, selected: str, name: Column, collation: str = "UNICODE") -> list[Column]:
    """An order: the selected row, then by name in a language's order."""
    return [F.when(key == selected, 0).otherwise(1), F.collate(name, collation)]


def top_rank_groups(df: DataFrame, key: str, score: str, k: int) -> DataFrame:
    """Rows of the ``k`` best different scores of each key, ties kept."""
    w = Window.partitionBy(key).orderBy(F.desc(score))
    return df.withColumn("rank", F.dense_rank().over(w)).filter(F.col("rank") <= k)


#: Bytes of a range in which rows are numbered, as they are written.
RANGE_BYTES = 128 << 20
_ROWS = 33  # bits of monotonically_increasing_id() below the partition


def numbered(df: DataFrame, order: list[str], after: Column | int = 0) -> DataFrame:
    """Adds ``ordinal``: the row's place in the whole order, without one task seeing all rows.

    Rows move once: they are dealt into ranges of the order, of about ``RANGE_BYTES``, sorted there and written with their place in the range; what
    the ranges before hold is counted from what was written. Rows equal in ``order`` are told apart by a hash of all their columns, so ranges can be cut
    between them and a run again gives the same numbers; rows equal in all columns are alike.
    """
    from weft.sources.tables import dropped, kept

    spark, held = df.sparkSession, kept(df)  # ranges are sampled from what is written, not from a second run of the plan
    size = int(str(held._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # of the files
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    tie = held.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    dealt = tie.repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    dealt = kept(dealt.withColumn("_row", F.monotonically_increasing_id()))
    dropped(held)
    counts = dealt.groupBy(F.shiftright("_row", _ROWS).alias("_part")).agg(F.count("*").alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    out = dealt.withColumn("_part", F.shiftright("_row", _ROWS)).join(F.broadcast(before), "_part")  # a row a range
    place = F.col("_before") + F.col("_row").bitwiseAND((1 << _ROWS) - 1) + 1
    return out.withColumn("ordinal", (place + after).cast("long")).drop("_part", "_row", "_before")


def padded_id(prefix: str, number: Column, width: int = 6) -> Column:
    """Zero-padded ids; wider numbers are not cut."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0")))


def id_number(c: Column) -> Column:
    return F.regexp_extract(c, r"(\d+)$", 1).cast("long")


def reuse_ids(df: DataFrame, known: DataFrame, key: str, order: list[str], prefix: str, width: int = 6) -> DataFrame:
    """Keeps the ids of known keys and numbers the rest after the greatest of them, in the given order."""
    top = known.agg(F.max(id_number(F.col("id")))).first()[0] or 0
    held = df.join(known.select(key, "id"), key, "left")
    fresh = numbered(held.filter("id IS NULL").drop("id"), order, int(top))
    fresh = fresh.withColumn("id", padded_id(prefix, F.col("ordinal"), width)).drop("ordinal")
    return held.filter("id IS NOT NULL").unionByName(fresh)


def filled_forward(df: DataFrame, partition: list[str], order: list[str], opens: Column, value: str) -> DataFrame:
    """``section``: how many rows have opened one so far; ``opener``: the value at the last of them. A partition of any size runs in segments."""
    from weft.operators.scans import running

    return running(df, partition, order, {"opener": F.when(opens, F.col(value))}, {"section": opens})


def capped_list(df: DataFrame, key: str, value: str, most: int) -> DataFrame:
    """All rows of each key counted, and the ``most`` least values listed; ranks are cut before they are gathered."""
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    w = Window.partitionBy(key).orderBy(value)
    some = df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most).groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("first"))
    return n.join(some, key)


def priority_union(sources: Sequence[DataFrame], keys: list[str], order: Sequence[Column] = ()) -> DataFrame:
    """Union in which a later source's row replaces an earlier one's of the same key."""
    out = None
    for k, s in enumerate(sources):
        s = s.withColumn("_priority", F.lit(k))
        out = s if out is None else out.unionByName(s)
    return best(out, keys, [F.desc("_priority"), *order, _any(out)]).drop("_priority")


def _any(df: DataFrame) -> Column:
    """An order of rows that are equal in what counts, the same in every run."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def latest(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last version of each key; of equal ones, the later position, and then one and the same in every run."""
    return best(df, keys, [*[F.desc(c) for c in order], _any(df)])


def resolve(rows: DataFrame, table: DataFrame, ref: str, label: str, key: str, name: str, row_id: str | None = None, refs: DataFrame | None = None, passages: DataFrame | None = None) -> DataFrame:
    """``resolved`` and ``how``: by exact key, else by a label that one row alone has, else by references, else null with the reason.

    With ``refs`` (row_id, passage) and ``passages`` (key, passage), a label of several rows is that of
    the only one which shares a passage with the row; these meet by label and passage, never all pairs.
    """
    names = table.groupBy(name).agg(F.count("*").alias("_n"), F.min(key).alias("_by_label"))
    exact = table.select(F.col(key).alias("_by_key"))
    out = rows.join(exact, F.col(ref) == F.col("_by_key"), "left").join(names, F.col(label) == F.col(name), "left").drop(name)
    how = F.when(F.col("_by_key").isNotNull(), "key").when(F.col("_n") == 1, "label")
    found = F.coalesce("_by_key", F.when(F.col("_n") == 1, F.col("_by_label")))
    if refs is not None and passages is not None:
        asked = out.filter("_by_key IS NULL AND _n > 1").select(row_id, F.col(label).alias("_label")).join(refs.select(row_id, "passage").distinct(), row_id)
        named = table.select(F.col(key).alias("_key"), F.col(name).alias("_label")).join(passages.select(F.col(key).alias("_key"), "passage").distinct(), "_key")
        met = asked.join(named, ["_label", "passage"]).groupBy(row_id).agg(F.countDistinct("_key").alias("_met"), F.min("_key").alias("_by_ref"))
        out = out.join(met, row_id, "left")
        how = how.when((F.col("_n") > 1) & (F.col("_met") == 1), "reference_overlap")
        found = F.coalesce(found, F.when(F.col("_met") == 1, F.col("_by_ref")))
    how = how.when(F.col("_n") > 1, "ambiguous_label").otherwise("missing_label")
    return out.withColumns({"resolved": found, "how": how}).drop("_by_key", "_n", "_by_label", "_met", "_by_ref")


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi join in which null meets null; the right side's keys go."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in on])


def expand_range(df: DataFrame, lo: str, hi: str, out: str, most: int = 21) -> DataFrame:
    """One row for each whole number of a range of at most ``most``; wider and inverted ranges, and nulls, give none."""
    fits = (F.col(hi) >= F.col(lo)) & (F.col(hi) - F.col(lo) < most)
    return df.filter(fits).withColumn(out, F.explode(F.sequence(F.col(lo), F.col(hi))))


def cooccurrences(df: DataFrame, passage: str, entity: str) -> DataFrame:
    """(a, b, n_passages): entities a < b that share passages. Entities are distinct in a passage before the join.

    Passages are dealt over as many tasks as the rows need, so what a task sorts and counts does not grow with the table.
    """
    rows = df.count()
    d = in_tasks(df.select(passage, entity), rows, passage, entity).distinct()
    side = lambda end: in_tasks(d.select(passage, F.col(entity).alias(end)), rows, passage)
    met = side("a").join(side("b").hint("merge"), passage).filter("a < b")
    return met.groupBy("a", "b").agg(F.count("*").alias("n_passages"))


def per_10k(part: Column, whole: Column) -> Column:
    """part / whole in ten-thousandths, rounded half up in whole numbers."""
    return F.floor((part * 20000 + whole) / (whole * 2)).cast("long")


def overlap_scores(left: DataFrame, right: DataFrame, a: str, b: str, passage: str) -> DataFrame:
    """Coverage, precision, Jaccard and their 0.5 / 0.3 / 0.2 score of passage sets, from an equi join on passages.

    Measures are ten-thousandths; the score is of the rounded measures, in hundred-thousandths.
    """
    l, r = left.select(a, passage).distinct(), right.select(b, passage).distinct()
    shared = l.join(r, passage).groupBy(a, b).agg(F.count("*").alias("shared"))
    out = shared.join(l.groupBy(a).agg(F.count("*").alias("n_a")), a).join(r.groupBy(b).agg(F.count("*").alias("n_b")), b)
    out = out.withColumns({
        "coverage": per_10k(F.col("shared"), F.col("n_a")),
        "precision": per_10k(F.col("shared"), F.col("n_b")),
        "jaccard": per_10k(F.col("shared"), F.col("n_a") + F.col("n_b") - F.col("shared")),
    })
    return out.withColumn("score", F.col("coverage") * 5 + F.col("precision") * 3 + F.col("jaccard") * 2)


def signature_groups(df: DataFrame, entity: str, item: str) -> DataFrame:
    """Entities of equal sets of items: the set, how many have it, the least of them.

    Sets are told apart by their hashes, and only the one of each group's least entity is gathered.
    """
    from weft.operators.overlap import classes

    sets = df.select(entity, item).distinct()
    groups = classes(sets, entity, item).groupBy("cls").agg(F.count("*").alias("n")).filter("n > 1")
    own = sets.join(groups, F.col(entity) == F.col("cls")).groupBy("cls", "n").agg(F.array_sort(F.collect_set(item)).alias("signature"))
    return own.select("signature", "n", F.col("cls").alias("first"))


def remap(df: DataFrame, mapping: DataFrame, columns: list[str]) -> DataFrame:
    """Old ids in the given columns replaced by new ones; ids without an entry stay."""
    for c in columns:
        m = mapping.select(F.col("old").alias(c), F.col("new").alias("_new"))
        df = df.join(m, c, "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    return df


def remap_array(df: DataFrame, mapping: DataFrame, key: str, column: str, parent: str | None = None) -> DataFrame:
    """Old ids within an array column replaced by new ones, in place and order; a struct ``parent`` may hold the array.

    Items meet the mapping by a join, and come back by ``key``, which is one row's own.
    """
    path = f"{parent}.{column}" if parent else column
    m = mapping.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    items = df.select(key, F.posexplode(path).alias("_at", "_old")).join(m, "_old", "left")
    new = items.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", F.coalesce("_new", "_old").alias("_id")))), lambda x: x["_id"]).alias("_ids"))
    out = df.join(new, key, "left")
    ids = F.coalesce("_ids", path)
    return out.withColumn(parent or column, F.col(parent).withField(column, ids) if parent else ids).drop("_ids")


def aligned(snapshots: dict[str, DataFrame], key: str) -> DataFrame:
    """One row a key that every snapshot has once, each as a struct of its name; raises unless all have the same keys, each once."""
    out, wrong = None, None
    for name, s in snapshots.items():
        n = s.groupBy(key).agg(F.count("*").alias(f"_{name}"))
        wrong = n if wrong is None else wrong.join(n, key, "full")
        one = s.select(key, F.struct(*[c for c in s.columns if c != key]).alias(name))
        out = one if out is None else out.join(one, key)
    bad = wrong.filter(~F.coalesce(_all([F.col(f"_{n}") == 1 for n in snapshots]), F.lit(False)))
    if row := bad.first():
        raise ValueError(f"snapshots do not align at {row[key]!r}")
    return out


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def token_ids(texts: DataFrame, key: str, tokens: str, names: DataFrame, name: str, entity: str) -> DataFrame:
    """(key, ids): the sorted distinct entities whose name is one of a row's tokens; rows without any are left out.

    A name's entities are gathered before they meet the tokens, so a row moves once for each token and not for each entity.
    """
    one = names.select(name, entity).filter(F.col(entity).isNotNull()).distinct().groupBy(name).agg(F.collect_list(entity).alias("_ids"))
    t = texts.select(key, F.explode(F.array_distinct(tokens)).alias(name))
    met = t.join(one, name).groupBy(key).agg(F.flatten(F.collect_list("_ids")).alias("_all"))
    return met.select(key, F.array_sort(F.array_distinct("_all")).alias("ids"))


def code_join(left: DataFrame, right: DataFrame, code: str, ref: str) -> DataFrame:
    """Rows that meet at a reference by equal codes, or by codes equal without their suffix letter; the exact one wins."""
    from weft.functions.text import base_code as base

    l = left.withColumn("_base", base(F.col(code)))
    r = right.select(F.col(code).alias("right_code"), ref, base(F.col(code)).alias("_base"), *[c for c in right.columns if c not in (code, ref)])
    both = l.join(r, [ref, "_base"])
    exact = F.col(code) == F.col("right_code")
    is_base = (F.col(code) == F.col("_base")) | (F.col("right_code") == F.col("_base"))
    return both.withColumn("how", F.when(exact, "exact").when(is_base, "base")).filter("how IS NOT NULL").drop("_base")
