"""Checks that return rows: what violates a rule, a key, a reference or a count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.sources.tables import in_tasks


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows of ``child`` whose non-null ``fk`` no row of ``parent`` has (left anti join)."""
    return child.filter(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def orphan_counts(child: DataFrame, references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(fk, n_orphans, n_keys) of each column of ``references`` (to a parent and its key), zeros included: one scan of ``child`` for all of them.

    Values are counted by column before they meet the parents' keys, so a value of any number of rows is one row there.
    """
    pairs = [F.struct(F.lit(fk).alias("fk"), F.col(fk).cast("string").alias("key")) for fk in references]
    counts = child.select(F.explode(F.array(*pairs)).alias("r")).select("r.fk", "r.key").filter("key IS NOT NULL").groupBy("fk", "key").agg(F.count("*").alias("n"))
    known = None
    for fk, (parent, pk) in references.items():
        one = parent.select(F.lit(fk).alias("fk"), F.col(pk).cast("string").alias("key"))
        known = one if known is None else known.unionByName(one)
    lost = counts.join(known, ["fk", "key"], "left_anti").groupBy("fk").agg(F.sum("n").alias("n_orphans"), F.count("*").alias("n_keys"))
    names = child.sparkSession.createDataFrame([(fk,) for fk in references], "fk string")
    return names.join(lost, "fk", "left").select("fk", F.coalesce("n_orphans", F.lit(0)).alias("n_orphans"), F.coalesce("n_keys", F.lit(0)).alias("n_keys"))


def faults(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """(keys, fault): the names of ``rules`` true of a row, one row each; an unknown rule is no fault.

    The list has a select of its own: where it is made of struct fields and exploded in one select, Spark's pruning of
    nested columns changes the plan's output, and rows are lost or cannot be written.
    """
    named = [F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]
    return df.select(*keys, F.array_compact(F.array(*named)).alias("_faults")).select(*keys, F.explode("_faults").alias("fault"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys of more than one row, with their number ``n``; summed before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` with ``violated``, the names of rules that do not hold, for rows with any. Null counts as not holding."""
    named = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("violated", F.array_compact(F.array(*named))).filter(F.size("violated") > 0)


def required(*columns: str) -> dict[str, Column]:
    return {f"{c}_required": F.col(c).isNotNull() for c in columns}


def unknown_fields(raw: DataFrame, json: str, declared: list[str]) -> DataFrame:
    """Rows of JSON text with keys beyond the declared ones: an explicit schema would drop them silently."""
    keys = F.json_object_keys(json)
    extra = F.array_except(keys, F.array(*[F.lit(c) for c in declared]))
    return raw.withColumn("unknown", extra).filter(F.size("unknown") > 0)


def key_set_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side) of distinct keys on one side only; empty when the sets are equal."""
    a = left.select(key).distinct().withColumn("in_left", F.lit(True))
    b = right.select(key).distinct().withColumn("in_right", F.lit(True))
    both = a.join(b, key, "full").filter("in_left IS NULL OR in_right IS NULL")
    return both.select(key, F.when(F.col("in_right").isNull(), "left_only").otherwise("right_only").alias("side"))


def except_both(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Rows of each side without a partner on the other, duplicates kept."""
    keys = list(keys)
    a = left.join(right.select(*keys), keys, "left_anti").withColumn("side", F.lit("left_only"))
    return a.unionByName(right.join(left.select(*keys), keys, "left_anti").withColumn("side", F.lit("right_only")))


def count_check(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(metric, expected, actual, ok) from one-row, one-column frames."""
    rows = [
        e.toDF("expected").crossJoin(a.toDF("actual")).select(F.lit(name).alias("metric"), "expected", "actual", (F.col("expected") == F.col("actual")).alias("ok"))
        for name, (e, a) in pairs.items()  # one row each
    ]
    return reduce(DataFrame.unionByName, rows)


def partition_coverage(parts: DataFrame, whole: DataFrame, key: str, item: str, rows: int = 0) -> DataFrame:
    """Items of ``whole`` that no part has, or several have, and items of parts that ``whole`` lacks.

    Both sides meet in one grouping and no join, dealt over as many tasks as about ``rows`` rows need. An item with a null is equal to none of the other side.
    """
    side = lambda d, known: d.select(key, item, F.lit(known).alias("_known"))
    both = in_tasks(side(whole, True).unionByName(side(parts, False)), rows, key, item)
    apart = F.when(F.col(key).isNull() | F.col(item).isNull(), F.col("_known"))
    out = both.groupBy(key, item, apart.alias("_apart")).agg(F.bool_or("_known").alias("known"), F.count_if(~F.col("_known")).alias("n"))
    fault = F.when(~F.col("known"), "unknown").when(F.col("n") == 0, "missing").when(F.col("n") > 1, "overlap")
    return out.withColumn("fault", fault).filter("fault IS NOT NULL").select(key, item, "fault")


def unsorted(df: DataFrame, order: list[str], partition: list[str] | None = None) -> DataFrame:
    """Rows whose ``order`` columns are not greater than those of the row before, by position ``pos``."""
    from pyspark.sql import Window

    now = F.struct(*order)
    before = F.lag(now).over(Window.partitionBy(*(partition or [])).orderBy("pos"))
    return df.withColumn("before", before).filter(F.col("before") >= now).drop("before")


def edge_faults(edges: DataFrame, nodes: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """(edge_id, fault) of edges (edge_id, src, dst, passage) with an unknown end, a loop, a blank passage or, with ``sources``, an unknown source."""
    known = nodes.select("node").distinct()
    out = edges
    for end in ("src", "dst"):
        out = out.join(known.select(F.col("node").alias(end), F.lit(True).alias(f"_{end}")), end, "left")
    rules = {
        "unknown_src": F.col("_src").isNull(), "unknown_dst": F.col("_dst").isNull(), "self_loop": F.col("src").eqNullSafe(F.col("dst")),
        "empty_passage": F.coalesce(F.trim("passage"), F.lit("")) == "",
    }
    if sources is not None:
        out = out.join(sources.select("source").distinct().withColumn("_known", F.lit(True)), "source", "left")
        rules["unknown_source"] = F.col("_known").isNull()
    return faults(out, ["edge_id"], rules)


def coverage(targets: DataFrame, rows: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """(kind, required, covered) of an inventory's targets by null-safe key; raises if two targets have one key."""
    if row := duplicate_keys(targets, *keys).first():
        raise ValueError(f"the inventory has a key twice: {[row[k] for k in keys]}")
    return _covered(targets, rows, keys).groupBy(kind).agg(F.count("*").alias("required"), F.count_if("covered").alias("covered"))


def uncovered(targets: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Targets of an inventory that no row covers."""
    return _covered(targets, rows, keys).filter("NOT covered").drop("covered")


def _covered(targets: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    have = rows.select(*[F.col(k).alias(f"_h_{k}") for k in keys]).distinct().withColumn("_hit", F.lit(True))
    both = targets.join(have, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys], "left")
    return both.withColumn("covered", F.col("_hit").isNotNull()).drop("_hit", *[f"_h_{k}" for k in keys])


def implied(rules: dict[str, tuple[Column, Column]]) -> dict[str, Column]:
    """Rules that hold where their condition (the first column) does not, or what it asks for does; for ``violations``."""
    return {name: ~F.coalesce(when, F.lit(False)) | F.coalesce(must, F.lit(False)) for name, (when, must) in rules.items()}


def access_policy(complete: bool = False) -> dict[str, Column]:
    """What a source's license asks of its access, files and review; with ``complete``, what a release asks too.

    Columns: license_status, access_status, n_files, full_text_in_git, review_status, release_required.
    """
    # fixed values: names of states
    public = F.col("license_status") == "verified_public_domain"
    open_ = F.col("access_status").isin("locked_public_download", "official_temporary_access_verified", "controlled_digital_lending_verified", "member_access_verified")
    files = F.coalesce("n_files", F.lit(0)) > 0
    rules = {
        "public_is_locked": (public, F.col("access_status") == "locked_public_download"), "public_has_files": (public, files),
        "restricted_without_files": (~F.coalesce(public, F.lit(False)), ~files), "restricted_not_in_git": (~F.coalesce(public, F.lit(False)), ~F.col("full_text_in_git")),
        "review_after_access": (~F.col("review_status").eqNullSafe("not_started"), open_),
    }
    if complete:
        rules["complete_for_release"] = (F.coalesce("release_required", F.lit(True)), F.col("review_status") == "completed")
    return implied(rules)


def distinct_in_all(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """One row: how many different keys the frames have together, and each of them."""
    out = None
    for name, df in frames.items():
        one = df.select(key, F.lit(name).alias("_frame"))
        out = one if out is None else out.unionByName(one)
    return out.agg(F.countDistinct(key).alias("n"), *[F.countDistinct(F.when(F.col("_frame") == name, F.col(key))).alias(f"n_{name}") for name in frames])


def overridden(rows: DataFrame, decisions: DataFrame, key: str, snapshot: list[str], defaults: dict[str, str]) -> DataFrame:
    """``rows`` with the columns of ``defaults`` from a table of decisions (key, these, the ``snapshot`` columns).

    Raises if a decision's key is unknown or used twice, or if its snapshot is no longer the row's: decisions hold for what was seen.
    """
    d = decisions.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_s_{c}") for c in snapshot], *[F.col(c).alias(f"_d_{c}") for c in defaults])
    if row := d.groupBy("_key").count().filter("count > 1").first():
        raise ValueError(f"two decisions on {row['_key']!r}")
    changed = F.lit(False)
    for c in snapshot:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    both = d.join(rows.withColumn("_known", F.lit(True)), F.col("_key") == F.col(key), "left")
    if row := both.filter(F.col("_known").isNull() | changed).first():
        raise ValueError(f"the decision on {row['_key']!r} is about " + ("no row" if row["_known"] is None else "another state of its row"))
    out = rows.join(d.drop(*[f"_s_{c}" for c in snapshot]), F.col(key) == F.col("_key"), "left")
    return out.withColumns({c: F.coalesce(f"_d_{c}", F.lit(v)) for c, v in defaults.items()}).drop("_key", *[f"_d_{c}" for c in defaults])
