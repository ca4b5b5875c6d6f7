"""Upserts, updates, soft deletes and splits as new DataFrames; fingerprints; reviewers' consensus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ambiguous_targets(target: DataFrame, incoming: DataFrame, signature: list[str], evidence: str) -> DataFrame:
    """(signature, n, fault) of incoming rows that no one target row takes: several have the signature, none or several of them exactly its evidence."""
    many = target.groupBy(*signature).agg(F.count("*").alias("n"), F.collect_list(F.array_sort(F.array_distinct(evidence))).alias("_all")).filter("n > 1")
    new = _united(incoming, signature, evidence)
    cond = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in signature]
    equal = F.size(F.filter("_all", lambda e: e == F.col("_new")))
    met = many.join(new, cond).withColumn("_equal", equal).filter("_equal <> 1")
    return met.select(*signature, "n", F.when(F.col("_equal") == 0, "ambiguous").otherwise("duplicate").alias("fault"))


def _united(incoming: DataFrame, signature: list[str], evidence: str) -> DataFrame:
    """One row a signature (``_s_`` columns) with all its evidence, ``_new``."""
    one = incoming.groupBy(*signature).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(evidence)))).alias("_new"))
    return one.select(*[F.col(c).alias(f"_s_{c}") for c in signature], "_new")


def upsert(target: DataFrame, incoming: DataFrame, signature: list[str], evidence: str) -> DataFrame:
    """Rows of both by a null-safe signature, with ``action``: keep, skip (nothing new), append (evidence) or insert.

    ``evidence`` is an array; what is appended keeps its order behind the old. Of
    several incoming rows of a signature the evidence is united first. Where several target rows have a signature, the one with
    exactly the evidence is skipped and the others kept; if there is none, or several, it raises, as nothing tells which row is meant.
    """
    if row := ambiguous_targets(target, incoming, signature, evidence).first():
        raise ValueError(f"{row.fault}: {row.n} rows have the signature {[row[c] for c in signature]}")
    one = _united(incoming, signature, evidence)
    cond = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in signature]
    several = target.groupBy(*[F.col(c).alias(f"_m_{c}") for c in signature]).agg(F.count("*").alias("_n")).filter("_n > 1")
    old = target.join(several, [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in signature], "left")
    old = old.select(*signature, F.coalesce(F.col(evidence), F.array().cast(target.schema[evidence].dataType)).alias("_old"), F.col("_n").isNotNull().alias("_many"))
    both = old.join(one, cond, "full")
    more = F.array_except("_new", "_old")
    other = F.col("_many") & (F.array_sort(F.array_distinct("_old")) != F.col("_new"))
    action = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull() | F.coalesce(other, F.lit(False)), "keep").when(F.size(more) == 0, "skip").otherwise("append")
    merged = F.when(F.col("_old").isNull(), F.col("_new")).when(F.col("_new").isNull() | F.coalesce(other, F.lit(False)), F.col("_old")).otherwise(F.concat("_old", more))
    keys = [F.when(F.col("_old").isNull(), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for c in signature]
    return both.select(*keys, merged.alias(evidence), action.alias("action"))


def numbered_inserts(plan: DataFrame, target: DataFrame, signature: list[str], prefix: str, width: int = 4) -> DataFrame:
    """The plan's rows with ``id``: inserts are numbered after the target's greatest id, in order of their signature; null for the others."""
    from weft.operators.relational import id_number, numbered, padded_id

    top = target.agg(F.max(id_number(F.col("id")))).first()[0] or 0
    new = numbered(plan.filter("action = 'insert'"), signature, int(top))
    new = new.withColumn("id", padded_id(prefix, F.col("ordinal"), width)).drop("ordinal")
    return plan.filter("action <> 'insert'").withColumn("id", F.lit(None).cast("string")).unionByName(new)


def applied(plan: DataFrame, mode: str, write=None) -> DataFrame:
    """Runs a change in one of three modes and gives its counts (action, n).

    ``dry-run`` only counts; ``check`` raises if anything would be inserted or appended; ``apply`` hands the plan to ``write``.
    """
    if mode not in ("dry-run", "check", "apply"):
        raise ValueError(f"unknown mode {mode!r}")
    counts = plan.groupBy("action").agg(F.count("*").alias("n"))
    if mode == "check" and (row := counts.filter("action IN ('insert', 'append')").first()):
        raise ValueError(f"not applied: {row.n} rows to {row.action}")
    if mode == "apply":
        write(plan)
    return counts


def updated(target: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of ``target`` with the given columns replaced where ``changes`` has the key."""
    c = changes.select(F.col(key), *[F.col(x).alias(f"_n_{x}") for x in columns], F.lit(True).alias("_hit"))
    out = target.join(c, key, "left")
    return out.withColumns({x: F.when(F.col("_hit"), F.col(f"_n_{x}")).otherwise(F.col(x)) for x in columns}).drop("_hit", *[f"_n_{x}" for x in columns])


def soft_deleted(df: DataFrame, ids: DataFrame, key: str, status: str, to: str) -> DataFrame:
    """``status`` set to ``to`` for the keys of ``ids``; no row goes."""
    hit = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    return df.join(hit, key, "left").withColumn(status, F.when(F.col("_hit"), F.lit(to)).otherwise(F.col(status))).drop("_hit")


def cascaded(tables: dict[str, tuple[DataFrame, str, str]], ids: DataFrame, key: str, to: dict[str, str], note: str, note_column: str = "note") -> dict[str, DataFrame]:
    """``soft_deleted`` for every table (rows, its key's column, its status column); rows that change get the note behind their own."""
    out = {}
    for name, (df, own, status) in tables.items():
        hit = ids.select(F.col(key).alias(own)).distinct().withColumn("_hit", F.lit(True))
        changed = F.col("_hit") & ~F.col(status).eqNullSafe(F.lit(to[name]))
        df = df.join(hit, own, "left")
        df = df.withColumn(note_column, F.when(changed, F.concat_ws("; ", F.nullif(F.col(note_column), F.lit("")), F.lit(note))).otherwise(F.col(note_column)))
        out[name] = df.withColumn(status, F.when(F.col("_hit"), F.lit(to[name])).otherwise(F.col(status))).drop("_hit")
    return out


def inserted_if_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows whose keys it lacks; null is a key like any other. Of several rows of a key the least counts."""
    rest = [c for c in target.columns if c not in keys]
    one = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")) if rest else rows.select(*keys).distinct()
    one = one.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
    held = target.select(*[F.col(c).alias(f"_k_{c}") for c in keys])
    fresh = one.join(held, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys], "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def split_records(records: DataFrame, partitions: DataFrame, key: str, items: str, relations: list[str] | None = None) -> DataFrame:
    """(key, part, items): each record's array cut by (key, part, wanted); a record without partitions is one part.

    The columns ``relations`` stay in parts that ``keeps`` them and are emptied in others; parts without items go.
    """
    out = records.join(partitions, key, "left")
    part, whole = F.coalesce("part", F.lit(1)), F.col("wanted").isNull()
    some = F.when(whole, F.col(items)).otherwise(F.filter(items, lambda x: F.array_contains("wanted", x)))
    more = [F.when(whole | F.coalesce("keeps", F.lit(False)), F.col(c)).otherwise("").alias(c) for c in relations or []]
    out = out.select(key, part.alias("part"), some.alias(items), *more, whole.alias("_whole"))
    return (out.filter(F.col("_whole") | (F.size(items) > 0)) if relations is not None else out).drop("_whole")


def carried_over(fresh: DataFrame, old: DataFrame, content: list[str], decisions: dict[str, str]) -> DataFrame:
    """Decisions of an earlier ledger for rows of the same content, null being a content too; the defaults for the rest.

    Of several earlier decisions on one content the least counts, in order of the columns.
    """
    one = old.groupBy(*[F.col(c).alias(f"_o_{c}") for c in content]).agg(F.min(F.struct(*decisions)).alias("_old"))
    both = fresh.join(one, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in content], "left")
    out = both.withColumns({d: F.coalesce(F.col("_old")[d], F.lit(v)) for d, v in decisions.items()})
    return out.drop("_old", *[f"_o_{c}" for c in content])


def row_signature(*columns: str) -> Column:
    """SHA-256 of the columns as text; null differs from empty, and what joins columns is escaped within them, so different rows never make one text."""
    def text(c: str) -> Column:
        t = F.col(c).cast("string")
        escaped = F.replace(F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit("\u001f"), F.lit("\\s")), F.lit("\u0000"), F.lit("\\0"))
        return F.coalesce(F.when(t.rlike("[\\\\\\x00\\x1F]"), escaped).otherwise(t), F.lit("\u0000"))

    return F.sha2(F.concat_ws("\u001f", *[text(c) for c in columns]), 256)


def fingerprint(df: DataFrame, *columns: str) -> DataFrame:
    """One row: the table's rows, and SHA-256 over its row hashes, as a tree.

    Different hashes with their counts are gathered by their first ``FINGERPRINT_DIGITS`` digits, what these give by all but
    their last two digits, and so on, so no row holds more than 256 digests, or a part of the different rows.
    """
    h = df.groupBy(row_signature(*columns).alias("h")).agg(F.count("*").alias("n"))  # equal rows are counted first
    digest = lambda x: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(x)), lambda s: F.concat_ws(":", s["k"], s["d"])), "\n"), 256)
    level = h.groupBy(F.substring("h", 1, FINGERPRINT_DIGITS).alias("p")).agg(digest(F.struct(F.col("h").alias("k"), F.col("n").cast("string").alias("d"))).alias("d"), F.sum("n").alias("n"))
    for k in range(FINGERPRINT_DIGITS - 2, 0, -2):
        level = level.groupBy(F.substring("p", 1, k).alias("q")).agg(digest(F.struct(F.col("p").alias("k"), F.col("d"))).alias("d"), F.sum("n").alias("n")).withColumnRenamed("q", "p")
    return level.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), digest(F.struct(F.col("p").alias("k"), F.col("d"))).alias("fingerprint"))


def drift(expected: DataFrame, tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(name, n_rows, want, drifted) of tables against their recorded (name, n_rows, fingerprint); a table without a record has drifted."""
    now = None
    for name, (df, columns) in tables.items():
        one = fingerprint(df, *columns).select(F.lit(name).alias("name"), "n_rows", "fingerprint")
        now = one if now is None else now.unionByName(one)
    was = expected.select("name", F.col("n_rows").alias("want"), F.col("fingerprint").alias("_was"))
    return now.join(was, "name", "full").select("name", "n_rows", "want", (~F.col("fingerprint").eqNullSafe(F.col("_was"))).alias("drifted"))


def idempotent(build, columns: list[str]) -> DataFrame:
    """One row: whether building twice gives the same rows: (first, second, same), fingerprints of ``build()``."""
    a, b = (fingerprint(build(), *columns).select(F.lit("t").alias("name"), F.col("fingerprint").alias(x)) for x in ("first", "second"))
    return a.join(b, "name").select("first", "second", (F.col("first") == F.col("second")).alias("same"))


#: Digits of a row's hash by which hashes are first gathered: 16 ** 4 groups.
FINGERPRINT_DIGITS = 4


def consensus(a: DataFrame, b: DataFrame, key: str, fields: list[str], strict: bool = False) -> DataFrame:
    """(key, decision) of two reviewers: accepted or rejected where both agree on all fields, else pending.

    Both have ``status``. With ``strict``, disagreement is rejected instead of pending.
    """
    r = b.select(key, F.col("status").alias("_status"), *[F.col(f).alias(f"_{f}") for f in fields])
    both = a.join(r, key)
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col(f"_{f}"))
    out = (
        F.when((F.col("status") == "accepted") & (F.col("_status") == "accepted") & same, "accepted")
        .when((F.col("status") == "rejected") & (F.col("_status") == "rejected"), "rejected")
        .otherwise("rejected" if strict else "pending")
    )
    return both.select(key, out.alias("decision"))


def agreed(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``a`` where both reviewers judged the same keys, each once, and agree on every field; raises otherwise."""
    one = a.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n")).join(b.groupBy(F.col(key).alias("_l")).agg(F.count("*").alias("_m")), F.col("_k").eqNullSafe(F.col("_l")), "full")
    if row := one.filter(~F.coalesce((F.col("_n") == 1) & (F.col("_m") == 1), F.lit(False))).first():
        raise ValueError(f"the reviewers do not cover the same keys once: {row['_k'] if row['_k'] is not None else row['_l']!r}")
    r = b.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    differs = F.lit(False)
    for f in fields:
        differs = differs | ~F.col(f).eqNullSafe(F.col(f"_{f}"))
    if row := a.join(r, F.col(key).eqNullSafe(F.col("_key"))).filter(differs).first():
        raise ValueError(f"the reviewers disagree on {row[key]!r}")
    return a


def three_way(rounds: DataFrame, boards: DataFrame, options: DataFrame, key: str, fields: list[str], locators: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(key, decision, issues) of two rounds and a board that must be equal in ``status`` and all fields.

    ``rounds`` is (key, round, status, fields ..., refs) with rounds 1 and 2, ``boards`` the same without a round; ``options`` (key, target) the
    targets that a key may have. ``fields`` begins with the action and the target. Accepted only where the target is one of the options (merge_existing), or
    there is neither (create_new), and for each of the ``locators`` a reference (``ref``) holds; rejected where all reject with every field null; else pending.
    """
    action, target = fields[:2]
    sides = {"a": rounds.filter("round = 1"), "b": rounds.filter("round = 2"), "c": boards}
    out = None
    for s, df in sides.items():
        one = df.select(key, *[F.col(c).alias(f"{s}_{c}") for c in ("status", *fields, "refs")])
        out = one if out is None else out.join(one, key, "left")
    n = options.groupBy(key).agg(F.collect_set("target").alias("options"))
    out = out.join(n, key, "left").withColumn("options", F.coalesce("options", F.array().cast("array<string>")))
    refs = F.flatten(F.array(*[F.coalesce(f"{s}_refs", F.array().cast("array<string>")) for s in sides]))
    equal = F.lit(True)
    for f in fields:
        equal = equal & F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")) & F.col(f"a_{f}").eqNullSafe(F.col(f"c_{f}"))
    every = lambda value: F.coalesce((F.col("a_status") == value) & (F.col("b_status") == value) & (F.col("c_status") == value), F.lit(False))
    merge, create = F.col(f"a_{action}") == "merge_existing", F.col(f"a_{action}") == "create_new"
    fits = F.coalesce((merge & F.array_contains("options", F.col(f"a_{target}"))) | (create & F.col(f"a_{target}").isNull() & (F.size("options") == 0)), F.lit(False))
    out = out.withColumns({"refs": refs, "equal": equal, "yes": every("accepted"), "no": every("rejected"), "fits": fits})
    held = {n_: F.coalesce(F.exists("refs", c), F.lit(False)) for n_, c in locators.items()}
    issues = F.array_compact(F.array(F.when(~(F.col("yes") & F.col("equal")), "disagreement"), F.when(F.col("yes") & F.col("equal") & ~F.col("fits"), "target"), *[F.when(F.col("yes") & F.col("equal") & ~c, F.lit(n_)) for n_, c in held.items()]))
    none = F.lit(True)
    for s in sides:
        for f in fields:
            none = none & F.col(f"{s}_{f}").isNull()
    out = out.withColumn("issues", issues)
    decision = F.when(F.size("issues") == 0, "accepted").when(F.col("no") & none, "rejected").otherwise("pending")
    return out.select(key, decision.alias("decision"), F.when(decision == "rejected", F.array().cast("array<string>")).otherwise(F.col("issues")).alias("issues"))


def gated(df: DataFrame, gates: dict[str, Column]) -> DataFrame:
    """Adds ``issues``, the names of gates that do not hold, and ``decision``: accepted without any, else rejected."""
    issues = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in gates.items()]))
    return df.withColumn("issues", issues).withColumn("decision", F.when(F.size("issues") == 0, "accepted").otherwise("rejected"))


def release_gate(df: DataFrame, pending: Column, blocked: Column) -> DataFrame:
    """One row: rows, pending, blocked and the release's status."""
    n = df.agg(F.count("*").alias("n_rows"), F.count_if(pending).alias("n_pending"), F.count_if(blocked).alias("n_blocked"))
    status = F.when(F.col("n_blocked") > 0, "blocked").when(F.col("n_pending") > 0, "pending").otherwise("ready")
    return n.withColumn("status", status)
