"""Review ledgers: inherited kinds, staged coverage, final decisions, coverage classes, promotion; publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.operators.validation import faults


def inherited_kinds(rows: DataFrame, record: str, order: str, kind: str, same: Column, alias: str, plain: str) -> DataFrame:
    """(record, order, kind): a row without a kind takes the one before it if ``same`` holds, or if both have one alias and that kind is not ``plain``.

    The chain runs from row to row, so a record's rows are folded in one expression; a record bounds them.
    """
    one = rows.groupBy(record).agg(F.sort_array(F.collect_list(F.struct(order, F.col(kind).alias("k"), same.alias("s"), F.col(alias).alias("a")))).alias("all"))
    of, out = rows.schema[order].dataType.simpleString(), f"array<struct<{order}:{rows.schema[order].dataType.simpleString()},kind:string>>"
    start = F.struct(F.lit(None).cast("string").alias("k"), F.lit(None).cast(rows.schema[alias].dataType.simpleString()).alias("a"), F.array().cast(out).alias("out"))

    def step(acc: Column, r: Column) -> Column:
        chained = (r["a"] == acc["a"]) & (acc["k"] != plain)
        k = F.coalesce(r["k"], F.when(r["s"] | chained, acc["k"]))
        return F.struct(k.alias("k"), r["a"].alias("a"), F.array_append(acc["out"], F.struct(r[order].cast(of).alias(order), k.alias("kind"))).alias("out"))

    return one.select(record, F.explode(F.aggregate("all", start, step, lambda acc: acc["out"])).alias("r")).select(record, f"r.{order}", "r.kind")


def stage_faults(ledger: DataFrame, expected: DataFrame, stages: list[str], key: str, stage: str) -> DataFrame:
    """(stage, key, fault): each stage covers exactly the expected keys, each once."""
    want = expected.select(key).distinct().crossJoin(ledger.sparkSession.createDataFrame([(s,) for s in stages], f"{stage} string"))  # a few stages
    n = ledger.groupBy(key, stage).agg(F.count("*").alias("n"))
    both = want.withColumn("want", F.lit(True)).join(n, [key, stage], "full")
    fault = F.when(F.col("want").isNull(), "unexpected").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate")
    return both.withColumn("fault", fault).filter("fault IS NOT NULL").select(stage, key, "fault")


def final_decision(round1: Column, round2: Column, board: Column, audit: Column, target: Column, action: Column) -> Column:
    """The state of a review: the board decides, if its audit passed; else two equal rounds do; a merge needs a target."""
    decided = F.when(board.isNotNull() & (audit == "passed"), board).when(board.isNotNull(), "pending").when(round1.eqNullSafe(round2), round1)
    return F.when((decided == "accepted") & (action == "merge_existing") & target.isNull(), "pending").otherwise(F.coalesce(decided, F.lit("pending")))


def coverage_class(excluded: Column, hits: Column, exact: Column, risky: int) -> Column:
    """Excluded, without a match, inconclusive (many hits and none exact), or accepted."""
    return F.when(excluded, "excluded").when(F.coalesce(hits, F.lit(0)) == 0, "no_match").when((hits > risky) & ~exact, "inconclusive").otherwise("accepted")


def promoted(accepted: DataFrame, entities: DataFrame, group: str, prefix: str) -> DataFrame:
    """(candidate, entity, action): accepted candidates join their target, or one new entity for each group, numbered after the last."""
    from weft.operators.relational import id_number, numbered, padded_id

    top = entities.agg(F.max(id_number(F.col("entity")))).first()[0] or 0
    merged = accepted.filter("target IS NOT NULL").select("candidate", F.col("target").alias("entity"), F.lit("merge_existing").alias("action"))
    fresh = accepted.filter("target IS NULL")
    ids = numbered(fresh.select(group).distinct(), [group], int(top)).withColumn("entity", padded_id(prefix, F.col("ordinal"))).drop("ordinal")
    return merged.unionByName(fresh.join(ids, group).select("candidate", "entity", F.lit("create_new").alias("action")))


def shared_locators(claims: DataFrame, matches: DataFrame) -> DataFrame:
    """(claim, locator, title): locators at which both ends of a claim (claim, a, b) are matched (entity, locator, title)."""
    m = matches.select("entity", "locator", "title").distinct()
    one = claims.join(m.withColumnRenamed("entity", "a"), "a")
    return one.join(m.withColumnRenamed("entity", "b"), ["b", "locator", "title"]).select("claim", "locator", "title").distinct()


def locator_faults(ledger: DataFrame, snapshot: DataFrame, key: str, fields: list[str], lines: DataFrame | None = None) -> DataFrame:
    """(key, fault) of ledger rows whose ``fields`` (the locator and what it names) differ from the snapshot's.

    With ``lines`` (source, n_lines), a row's ``line`` must be one of its source's too.
    """
    s = snapshot.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    out = ledger.join(s, F.col(key) == F.col("_key"), "left")
    rules = {f"{f}_drift": F.col("_key").isNotNull() & ~F.col(f).eqNullSafe(F.col(f"_{f}")) for f in fields}
    rules["not_in_snapshot"] = F.col("_key").isNull()
    if lines is not None:
        out = out.join(lines.select("source", "n_lines"), "source", "left")
        rules["line"] = ~F.coalesce(F.col("line").between(1, F.col("n_lines")), F.lit(False))
    return faults(out, [key], rules)


def ledger_faults(rows: DataFrame, key: str, fields: list[str], known: DataFrame) -> DataFrame:
    """(key, fault) of review rows that break the rules of a ledger.

    Rows have ``round1``, ``round2`` and ``final``, structs of status, reviewer and the ``fields``, and ``audit``, of status and board (whether the
    board decided). A key is known and comes once; pending decisions have neither fields nor a reviewer, decided ones a reviewer; an accepted
    one has all fields. A final acceptance needs a passed audit, and either the board's word or both rounds' acceptance with equal fields.
    """
    twice = rows.groupBy(key).agg(F.count("*").alias("_n"))
    out = rows.join(twice, key, "left").join(known.select(key).distinct().withColumn("_known", F.lit(True)), key, "left")
    rules = {"unknown": F.col("_known").isNull(), "duplicate": F.col("_n") > 1}
    for r in ("round1", "round2", "final"):
        d = F.col(r)
        some, every = F.lit(False), F.lit(True)
        for f in fields:
            some, every = some | d[f].isNotNull(), every & d[f].isNotNull()
        pending = d["status"] == "pending"
        rules |= {
            f"{r}_status": ~F.coalesce(d["status"].isin("pending", "accepted", "rejected"), F.lit(False)), f"{r}_pending_has_fields": pending & (some | d["reviewer"].isNotNull()),
            f"{r}_without_reviewer": ~pending & d["reviewer"].isNull(), f"{r}_accepted_without_fields": (d["status"] == "accepted") & ~every,
        }
    a, b, z, board = F.col("round1"), F.col("round2"), F.col("final"), F.coalesce(F.col("audit")["board"], F.lit(False)) & (F.col("audit")["status"] == "passed")
    accepted = z["status"] == "accepted"
    differs = F.lit(False)
    for f in fields:
        differs = differs | ~z[f].eqNullSafe(a[f]) | ~z[f].eqNullSafe(b[f])
    rules |= {
        "audit_open": accepted & ~F.coalesce(F.col("audit")["status"] == "passed", F.lit(False)),
        "rounds_not_accepted": accepted & ~board & ((a["status"] != "accepted") | (b["status"] != "accepted")), "rounds_differ": accepted & ~board & differs,
    }
    return faults(out, [key], rules)


def promoted_rows(accepted: DataFrame, names: DataFrame, mentions: DataFrame, held_names: DataFrame, held_mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names and mentions of promoted candidates beside those held: (entity, language, name) and (entity, passage, source), each once.

    ``accepted`` is what ``promoted`` gives; ``names`` (candidate, language, name) and ``mentions`` (candidate, passage, source). Blank names go.
    """
    from weft.operators.mutation import inserted_if_absent

    of = accepted.select("candidate", "entity")
    n = names.filter(F.trim("name") != "").join(of, "candidate").select("entity", "language", "name")
    m = mentions.join(of, "candidate").select("entity", "passage", "source")
    return inserted_if_absent(held_names, n, ["entity", "language", "name"]), inserted_if_absent(held_mentions, m, ["entity", "passage", "source"])


def export_tables(nodes: DataFrame, names: DataFrame, edges: DataFrame, options: DataFrame, mentions: DataFrame, evidence: DataFrame, sources: DataFrame) -> dict[str, DataFrame]:
    """The graph's tables by name: five of nodes (persons, names, edges, options, passages), mentions, evidence and sources.

    Persons carry their mentions by testament; a passage occurs once. ``mentions`` is (mention_id, node, passage, testament, source, status), ``evidence`` (edge_id, passage, testament, source, level, certainty, note).
    """
    counts = mentions.groupBy("node").agg(F.count_if(F.col("testament") == "nt").alias("n_nt"), F.count_if(F.col("testament") == "ot").alias("n_ot"))
    people = nodes.join(counts, "node", "left").fillna(0, ["n_nt", "n_ot"]).withColumn("n_all", F.col("n_nt") + F.col("n_ot"))
    people = people.withColumn("testament", F.array_join(F.array_compact(F.array(F.when(F.col("n_nt") > 0, "nt"), F.when(F.col("n_ot") > 0, "ot"))), ","))
    passages = mentions.select("passage", "testament").union(evidence.select("passage", "testament")).groupBy("passage").agg(F.min("testament").alias("testament"))
    return {
        "person_nodes": people, "name_nodes": names, "assertion_nodes": edges, "identity_option_nodes": options, "passage_nodes": passages,
        "mention_edges": mentions.drop("testament"), "assertion_evidence": evidence.drop("testament"), "evidence_nodes": sources,
    }


def export_graph(tables: dict[str, DataFrame], folder: str) -> None:
    """Each node or edge table as quoted CSV below ``folder``."""
    from weft.sources.tables import write_csv

    for name, df in tables.items():
        write_csv(df, f"{folder.rstrip('/')}/{name}")
