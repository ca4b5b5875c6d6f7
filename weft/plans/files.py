"""Queries over scans and sinks: rows of a table are written in a format, to the folder that the cluster shares, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import review as W
from weft.plans.relational import t
from weft.plans.rules import strings
from weft.sources import tables as S

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def _lines(df, order: list[str], array) -> str:
    """The lines of ``array`` of all rows in text files, each with whole keys of ``order[0]``, in order; the folder's path."""
    path = S.scratch(df.sparkSession)
    rows = df.select(*order, F.posexplode(array).alias("_k", "line"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(n, order[0]).sortWithinPartitions(*order, "_k").select("line").write.text(path)
    return path


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority FROM orders")
def jsonl_round_trip(spark, sf_dir):
    path = S.scratch(spark)
    S.write_jsonl(t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority")), path)
    return S.read_jsonl(spark, path, "o_orderkey long, o_custkey long, priority string")


@query("SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 5 <> 0")
def jsonl_permissive(spark, sf_dir):
    path = S.scratch(spark)
    k = F.col("o_orderkey")
    t(spark, sf_dir, "orders").select(F.when(k % 5 == 0, F.concat(F.lit('{"k": '), k.cast("string"))).otherwise(F.concat(F.lit('{"k": '), k.cast("string"), F.lit("}")))).write.text(path)
    return S.read_jsonl(spark, path, "k long", mode="permissive").filter("k IS NOT NULL").unionByName(S.read_jsonl(spark, f"{path}-none", "k long", missing_ok=True))


@query("""SELECT c_custkey::VARCHAR AS k, 'say "' || c_name || '", ok' AS quoted, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END AS maybe FROM customer""")
def csv_round_trip(spark, sf_dir):
    path = S.scratch(spark)
    c = t(spark, sf_dir, "customer")
    S.write_csv(c.select(F.col("c_custkey").alias("k"), F.concat(F.lit('say "'), "c_name", F.lit('", ok')).alias("quoted"), F.when(F.col("c_custkey") % 2 == 1, F.col("c_mktsegment")).alias("maybe")), path)
    return spark.read.option("header", True).option("escape", '"').option("emptyValue", "").schema("k string, quoted string, maybe string").csv(path).select("k", "quoted", F.coalesce("maybe", F.lit("")).alias("maybe"))


@query("""WITH c AS (SELECT DISTINCT conv_id, turn, role = 'user' OR turn = (SELECT min(turn) FROM conversations x WHERE x.conv_id = c.conv_id) AS h FROM conversations c)
SELECT '–' || conv_id || '.' || turn AS child, conv_id || '.' || (SELECT max(turn) FROM c h WHERE h.conv_id = c.conv_id AND h.h AND h.turn < c.turn) AS header FROM c WHERE NOT h""")
def sectioned_file(spark, sf_dir):
    """Conversations as sections of a file: users' turns are headers, others' are their children."""
    c = t(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.bool_or(F.col("role") == "user").alias("user"))
    ends = c.groupBy("conv_id").agg(F.min("turn").alias("first"), F.max("turn").alias("last"))
    c = c.join(ends, "conv_id")
    name = F.concat_ws(".", "conv_id", "turn")
    line = F.when(F.col("user") | (F.col("turn") == F.col("first")), name).otherwise(F.concat(F.lit("–"), name))
    around = F.array_compact(F.array(F.when(F.col("turn") == F.col("first"), "$== PERSON"), line, F.when(F.col("turn") == F.col("last"), "$== PLACE"), F.when(F.col("turn") == F.col("last"), "–not a person's")))
    lines = S.read_lines(spark, _lines(c, ["conv_id", "turn"], around))
    x = F.col("line")
    s = S.sectioned(lines, x == "$== PERSON", x == "$== PLACE", ~x.startswith("–"), x.startswith("–"))
    heads = s.filter("kind = 'header'").select("file", "record", F.col("line").alias("header"))
    return s.filter("kind = 'child'").select("file", "record", F.col("line").alias("child")).join(heads, ["file", "record"]).select("child", "header")


@query("""SELECT 'C' || conv_id AS book, conv_id % 3 + 1 AS chapter, (turn + 1)::INT AS verse, md5(text) || ' of N' || turn || ' on ' || role AS text, 'N' || turn AS name FROM conversations""")
def marked_up_file(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    n = F.col("turn").cast("string")
    first = F.row_number().over(S.Window.partitionBy("conv_id").orderBy("turn")) == 1
    verse = F.concat(F.lit("\\v "), (F.col("turn") + 1).cast("string"), F.lit(" "), F.md5(F.col("text").cast("binary")), F.lit(" of \\pn N"), n, F.lit("\\pn*"))
    lines = F.array_compact(F.array(F.when(F.col("first"), F.concat(F.lit("\\id C"), F.col("conv_id").cast("string"))), F.when(F.col("first"), F.concat(F.lit("\\c "), (F.col("conv_id") % 3 + 1).cast("string"))), verse, F.concat(F.lit("on "), "role")))
    p = S.usfm_passages(S.read_lines(spark, _lines(c.withColumn("first", first), ["conv_id", "turn"], lines)))
    p = S.marked_names(p)
    return p.select("book", F.col("chapter").cast("long").alias("chapter"), "verse", "text", F.element_at("names", 1).alias("name"))


@query("""SELECT 'A ' || l_orderkey || ':' || l_linenumber AS ref, string_agg(l_partkey::VARCHAR || ' and ' || l_suppkey, ' ' ORDER BY l_partkey, l_suppkey, l_extendedprice) AS text FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def xml_file(spark, sf_dir):
    l = t(spark, sf_dir, "lineitem")
    verse = F.concat(F.lit('<verse ref="A '), F.col("l_orderkey").cast("string"), F.lit(":"), F.col("l_linenumber").cast("string"), F.lit('">'), F.col("l_partkey").cast("string"), F.lit(" <i>and</i> "), F.col("l_suppkey").cast("string"), F.lit("</verse>"))
    path = _lines(l, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], F.array(verse))
    return S.xml_passages(spark, path).select("ref", "text")


_CODE = "'H' || lpad((l_partkey % 10000)::VARCHAR, 4, '0')"


@query(f"""SELECT 'Mat ' || l_orderkey % 999 || ':' || l_linenumber AS passage, array_to_string(list_sort(list(DISTINCT {_CODE})), ',') AS codes, count(*) AS n_lines FROM lineitem GROUP BY 1""")
def code_file(spark, sf_dir):
    l = t(spark, sf_dir, "lineitem")
    line = F.concat(F.lit("Mat."), (F.col("l_orderkey") % 999).cast("string"), F.lit("."), F.col("l_linenumber").cast("string"), F.lit("\tx H"), F.lpad((F.col("l_partkey") % 10000).cast("string"), 4, "0"), F.lit(" y"))
    parsed = S.code_lines(S.read_lines(spark, _lines(l, ["l_orderkey", "l_linenumber", "l_partkey"], F.array(line, F.lit("====")))), F.create_map(F.lit("mat"), F.lit("Mat")))
    one = parsed.select(F.explode("refs").alias("passage"), "codes")
    return one.groupBy("passage").agg(strings(F.array_sort(F.array_distinct(F.flatten(F.collect_list("codes"))))).alias("codes"), F.count("*").alias("n_lines"))


@query(f"""SELECT 'Mat.' || l_orderkey AS ref, array_to_string(list_sort(list(DISTINCT {_CODE})), ',') AS codes FROM lineitem GROUP BY l_orderkey""")
def tagged_file(spark, sf_dir):
    l = t(spark, sf_dir, "lineitem")
    line = F.concat(F.lit("Mat."), F.col("l_orderkey").cast("string"), F.lit("\tx/H"), F.lpad((F.col("l_partkey") % 10000).cast("string"), 4, "0"))
    return S.tagged_codes(S.read_lines(spark, _lines(l, ["l_orderkey", "l_partkey"], F.array(line, F.lit("no tab"))))).withColumn("codes", strings("codes"))


@query("""SELECT s_suppkey AS k, 'MAT ' || s_suppkey || ':1' AS passage, 'nt' AS testament, false AS lxx FROM supplier WHERE s_suppkey < 900000 UNION ALL SELECT s_suppkey, '1KI 2:3', 'ot', true FROM supplier WHERE s_suppkey % 2 = 0""")
def child_rows(spark, sf_dir):
    k = F.col("s_suppkey").cast("string")
    line = F.concat(F.lit("– Name\traw\tx\t"), k, F.lit("\t\tMat."), k, F.lit(".1"), F.when(F.col("s_suppkey") % 2 == 0, "; LXX 1Ki.2.3").otherwise(", Foo.1.1"))
    kids = S.child_rows(t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), line.alias("line")))
    books = F.create_map(F.lit("mat"), F.lit("MAT"), F.lit("1ki"), F.lit("1KI"))
    return S.child_references(kids, books, ["1KI"], ["MAT"]).select("k", "passage", "testament", "lxx")


@query("SELECT p_name AS token, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS p_name FROM part) WHERE regexp_full_match(p_name, '[a-z]+') GROUP BY p_name")
def token_counts(spark, sf_dir):
    return S.token_counts(t(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "[a-z]+", "p_partkey").groupBy("token").agg(F.sum("n").alias("n"))


@query("SELECT true AS small_written, false AS large_written, (SELECT count(*) FROM nation WHERE n_nationkey < 20) AS n, 25 AS reported")
def sinks(spark, sf_dir):
    """A size-gated sink that writes and one that does not; a table swapped for a part of itself; a report of one row."""
    n = t(spark, sf_dir, "nation")
    a, b, c = S.scratch(spark), S.scratch(spark), S.scratch(spark)
    small, large = S.write_if_small(n, a, 25), S.write_if_small(t(spark, sf_dir, "orders"), b, 25)
    S.write_atomic(n, c)
    S.write_atomic(spark.read.parquet(c).filter("n_nationkey < 20"), c)
    S.write_report(n.agg(F.count("*").alias("reported")), f"{a}/report.json")
    report = S.read_document(spark, f"{a}/report.json", "reported int")
    return spark.read.parquet(c).agg(F.count("*").alias("n")).join(report, F.lit(True)).select(F.lit(small).alias("small_written"), F.lit(large).alias("large_written"), "n", "reported")  # one row each


@query("""SELECT 'person_nodes' AS tbl, count(*) AS n, (SELECT count(*) FROM lineitem) AS mentions FROM supplier UNION ALL SELECT 'passage_nodes', (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem UNION SELECT o_orderkey FROM orders)), 0
UNION ALL SELECT 'mention_edges', (SELECT count(*) FROM lineitem), 0 UNION ALL SELECT 'assertion_evidence', (SELECT count(*) FROM orders), 0 UNION ALL SELECT 'evidence_nodes', 5, 0 UNION ALL SELECT 'name_nodes', (SELECT count(*) FROM part), 0
UNION ALL SELECT 'assertion_nodes', (SELECT count(*) FROM orders), 0 UNION ALL SELECT 'identity_option_nodes', 25, 0""")
def graph_export(spark, sf_dir):
    """The graph's tables as CSV and back: their rows, and the persons' mentions."""
    s, l, o = t(spark, sf_dir, "supplier"), t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "orders")
    mentions = l.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("mention_id"), F.col("l_suppkey").alias("node"), F.col("l_orderkey").alias("passage"), F.when(F.col("l_orderkey") % 2 == 0, "nt").otherwise("ot").alias("testament"), F.lit("s").alias("source"), F.col("l_linestatus").alias("status"))
    evidence = o.select(F.col("o_orderkey").alias("edge_id"), F.col("o_orderkey").alias("passage"), F.when(F.col("o_orderkey") % 2 == 0, "nt").otherwise("ot").alias("testament"), F.lit("s").alias("source"), F.lit("x").alias("level"), F.lit(0.5).alias("certainty"), F.lit("n, \"q\"").alias("note"))
    tables = W.export_tables(s.select(F.col("s_suppkey").alias("node"), "s_name"), t(spark, sf_dir, "part"), o.select("o_orderkey"), t(spark, sf_dir, "nation"), mentions, evidence, t(spark, sf_dir, "region"))
    folder = S.scratch(spark)
    W.export_graph(tables, folder)
    out = None
    for name in tables:
        back = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
        n = back.agg(F.lit(name).alias("tbl"), F.count("*").alias("n"), (F.coalesce(F.sum(F.col("n_all").cast("long")), F.lit(0)) if "n_all" in back.columns else F.lit(0).cast("long")).alias("mentions"))
        out = n if out is None else out.unionByName(n)
    return out


def _named_files(df, key: str, line, *order: str) -> str:
    """A folder with one text file ``n<key>.txt`` for each key, its lines in order; a key's lines are written by one task."""
    spark, path = df.sparkSession, S.scratch(df.sparkSession)
    rows = df.select(key, *order, line.alias("line")).repartition(key).sortWithinPartitions(key, *order)
    rows.select(key, "line").write.partitionBy(key).text(f"{path}/parts")
    fs, top = S._fs(spark, path)
    for folder in fs.listStatus(S._fs(spark, f"{path}/parts")[1]):
        name = folder.getPath().getName()
        if name.startswith(f"{key}="):
            for f in fs.listStatus(folder.getPath()):
                if f.getPath().getName().startswith("part-"):
                    fs.rename(f.getPath(), S._fs(spark, f"{path}/n{name.partition('=')[2].zfill(3)}.txt")[1])
    return path


def _customers(spark, sf_dir):
    """Files of customers' lines, one a nation; a fifth of the lines have codes."""
    c = t(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("string")
    coded = F.concat(F.lit("Mat."), F.col("c_nationkey").cast("string"), F.lit("."), (F.col("c_custkey") % 1000).cast("string"), F.lit("\tx H"), F.lpad(k, 4, "0"))
    return _named_files(c, "c_nationkey", F.when(F.col("c_custkey") % 5 == 0, coded).otherwise(F.concat(F.lit("name "), "c_name")), "c_custkey")


_CUSTOMERS = """f AS (SELECT c_nationkey AS n, c_custkey, 'n' || lpad(c_nationkey::VARCHAR, 3, '0') || '.txt' AS name,
CASE WHEN c_custkey % 5 = 0 THEN 'Mat.' || c_nationkey || '.' || c_custkey % 1000 || chr(9) || 'x H' || lpad(c_custkey::VARCHAR, 4, '0') ELSE 'name ' || c_name END AS line FROM customer),
i AS (SELECT n, name, string_agg(line || chr(10), '' ORDER BY c_custkey) AS body, count(*) AS lines, count(*) FILTER (c_custkey % 5 = 0) AS coded, count(DISTINCT c_custkey % 1000) FILTER (c_custkey % 5 = 0) AS refs FROM f GROUP BY n, name)"""


@query(f"WITH {_CUSTOMERS} SELECT name, (dense_rank() OVER (ORDER BY name) - 1)::INT AS file_no, row_number() OVER (PARTITION BY name ORDER BY c_custkey) - 1 AS pos, line FROM f WHERE n <> 3")
def files_in_order(spark, sf_dir):
    """Lines of the files whose names match, in the files' order."""
    lines = S.read_files(spark, _customers(spark, sf_dir), r"^n(?!003)\d+\.txt$")
    return lines.select(F.element_at(F.split("file", "/"), -1).alias("name"), "file_no", "pos", "line")


@query(f"WITH {_CUSTOMERS} SELECT name, octet_length(encode(body))::BIGINT AS bytes, sha256(body) AS sha256, lines, coded AS data_lines, refs AS n_refs, CASE WHEN coded > 0 THEN 'MAT' ELSE '' END AS books FROM i")
def file_inventory(spark, sf_dir):
    """Each file's bytes, hash and lines, and what its coded lines refer to."""
    path = _customers(spark, sf_dir)
    parsed = S.code_lines(S.read_lines(spark, f"{path}/n*.txt"), F.create_map(F.lit("mat"), F.lit("MAT")))
    inv = S.code_inventory(parsed, S.file_inventory(spark, f"{path}/n*.txt"))
    return inv.select(F.element_at(F.split("file", "/"), -1).alias("name"), "bytes", "sha256", "lines", "data_lines", "n_refs", strings("books").alias("books"))


@query(f"""WITH {_CUSTOMERS} SELECT name, CASE n % 6 WHEN 1 THEN 'hash' WHEN 2 THEN 'bytes' WHEN 3 THEN 'lines' WHEN 4 THEN 'unregistered' END AS fault FROM i WHERE n % 6 IN (1, 2, 3, 4) UNION ALL SELECT 'gone.txt', 'missing'""")
def locked_files(spark, sf_dir):
    """Files against a lock of their bytes, hash and lines, of which some are wrong, missing or not registered."""
    path = _customers(spark, sf_dir)
    inv = S.file_inventory(spark, f"{path}/n*.txt")
    n = F.pmod(F.regexp_extract("file", r"n(\d+)\.txt$", 1).cast("int"), F.lit(6))
    lock = inv.filter(n != 4).select(F.element_at(F.split("file", "/"), -1).alias("name"), F.when(n == 2, 0).otherwise(F.col("bytes")).alias("bytes"), F.when(n == 1, "x").otherwise(F.col("sha256")).alias("sha256"), F.when(n == 3, -1).otherwise(F.col("lines")).alias("lines"))
    return S.lock_violations(inv, lock.unionByName(spark.createDataFrame([("gone.txt", 1, "x", 1)], "name string, bytes long, sha256 string, lines long")))


@query("SELECT CASE role WHEN 'user' THEN 'MAT' ELSE 'MRK' END || ' ' || (conv_id + 1) || ':' || (turn + 1) AS passage, conv_id + 1 AS chapter, turn + 1 AS verse, md5(text) || ' x' AS text FROM conversations")
def verse_file(spark, sf_dir):
    """Lines of reference and text; the book is told by the file. Of two lines of a verse the last counts."""
    c = t(spark, sf_dir, "conversations").withColumn("who", F.when(F.col("role") == "user", 1).otherwise(2))
    ref = F.concat(F.lit("Book "), (F.col("conv_id") + 1).cast("string"), F.lit(":"), (F.col("turn") + 1).cast("string"), F.lit("\t"))
    both = c.select("who", "conv_id", "turn", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"), ref.alias("ref"), F.md5(F.col("text").cast("binary")).alias("text"))
    path = _named_files(both, "who", F.concat("ref", F.when(F.col("k") == 1, "an earlier reading").otherwise(F.concat("text", F.lit("  x ")))), "conv_id", "turn", "k")
    v = S.verse_texts(S.read_lines(spark, f"{path}/n*.txt"), F.create_map(F.lit("n001"), F.lit("MAT"), F.lit("n002"), F.lit("MRK")))
    return v.select("passage", F.col("chapter").cast("long").alias("chapter"), F.col("verse").cast("long").alias("verse"), "text")


@query("""SELECT 'EZE ' || s_nationkey || ':' || s_suppkey AS passage, CASE s_suppkey % 3 WHEN 0 THEN 'אדם' WHEN 1 THEN 'אדם,קין' ELSE '' END AS lemmas FROM supplier WHERE s_suppkey % 4 <> 0""")
def lemma_file(spark, sf_dir):
    """Consonants of the proper names tagged in a file's lines, by passage; words that are no names do not count."""
    s = t(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    head = F.concat(F.lit("Ezk."), F.col("s_nationkey").cast("string"), F.lit("."), k.cast("string"), F.lit("#0"))
    name = lambda w: F.concat(head, F.lit(f"1=x\tHNpm\t{{H0120=אָדָם={w}}}"))
    lines = F.array_compact(F.array(
        F.when(k % 4 != 0, F.when(k % 3 != 2, name("Adam")).otherwise(F.concat(head, F.lit("1=x\tHNpl\tno lemma")))), F.when((k % 4 != 0) & (k % 3 == 1), F.concat(head, F.lit("2=x\tHNpm\t{H7014=קַיִן=Cain}"))), F.concat(head, F.lit("3=x\tHVqp3ms\t{H0559=אמר=say}")),
    ))
    found = S.name_lemmas(S.read_lines(spark, _lines(s, ["s_suppkey", "s_nationkey"], lines)), F.create_map(F.lit("EZK"), F.lit("EZE")))
    return found.select("passage", strings("lemmas").alias("lemmas"))


@query("""SELECT 'captured' AS what, p_name || ' ' || p_partkey || ' (Part)' AS title, p_brand AS at FROM part UNION ALL SELECT 'not a whole capture', NULL, NULL UNION ALL SELECT 'a row of another kind', NULL, NULL UNION ALL SELECT 'a row twice', NULL, NULL""")
def captured_rows(spark, sf_dir):
    """The rows of a capture, and why three others are refused: a wrong count, a title of another kind, a row that comes twice."""
    p = t(spark, sf_dir, "part")
    row = F.struct(F.concat_ws(" ", "p_name", "p_partkey", F.lit("(Part)")).alias("title"), F.col("p_brand").alias("at"))
    whole = p.agg(F.lit("s").alias("source_id"), F.count("*").alias("count"), F.collect_list(row).alias("rows"))  # one capture is one document

    def read(df):
        path = S.scratch(spark)
        df.coalesce(1).write.json(path)
        return S.read_captured(spark, path, "title: string, at: string", "s", title=r"\(Part\)$")

    def refused(df) -> str:
        try:
            read(df)
        except ValueError as e:
            return str(e).split(":")[0].replace(" of s", "")
        return "read"

    odd = F.struct(F.lit("no kind").alias("title"), F.lit("x").alias("at"))
    bad = [whole.withColumn("count", F.col("count") + 1), whole.select("source_id", (F.col("count") + 1).alias("count"), F.array_append("rows", odd).alias("rows")), whole.select("source_id", (F.col("count") + 1).alias("count"), F.concat("rows", F.slice("rows", 1, 1)).alias("rows"))]
    rows = read(whole).select(F.lit("captured").alias("what"), "title", "at")
    return rows.unionByName(spark.createDataFrame([(refused(b), None, None) for b in bad], "what string, title string, at string"))


@query("""WITH p AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0),
e AS (SELECT 'parent' AS kind, k // 2 AS a, k AS b FROM p WHERE k % 3 <> 0 UNION SELECT 'parent', k, 2 * k FROM p WHERE k % 2 = 0 UNION SELECT 'parent', k, 2 * k + 1 FROM p WHERE k % 2 = 0
  UNION SELECT 'sibling', least(k, xor(k, 1)), greatest(k, xor(k, 1)) FROM p WHERE k % 5 = 0)
SELECT kind, 'C' || lpad(a::VARCHAR, 7, '0') || '@Mat.' || a || '.1' AS src, 'C' || lpad(b::VARCHAR, 7, '0') || '@Mat.' || b || '.1' AS dst FROM e WHERE a <> b AND a IN (SELECT k FROM p) AND b IN (SELECT k FROM p)""")
def ingested_edges(spark, sf_dir):
    """Customers as people of a sectioned file, told of by themselves and by others; groups and people who are only mentioned are none."""
    from weft.operators import ingest as G

    c = t(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("long")
    name = lambda x: F.concat(F.lit("C"), F.lpad(x.cast("string"), 7, "0"))
    key = lambda x: F.concat(name(x), F.lit("@Mat."), x.cast("string"), F.lit(".1"))
    none = F.lit("")
    fields = [
        F.concat(key(k), F.lit("=G1")), none, F.when(k % 3 != 0, key(F.floor(k / 2))).otherwise(""), F.when(k % 5 == 0, name(k.bitwiseXOR(F.lit(1).cast("long")))).otherwise(""), none,
        F.when(k % 2 == 0, F.concat(key(2 * k), F.lit(" + "), name(2 * k + 1))).otherwise(""), none, none, F.lit("Male"),
    ]
    how = F.when(k % 11 == 0, "Mentioned").otherwise("named")
    lines = F.array_compact(F.array(
        F.lit("$========== PERSON"), F.concat_ws("\t", *fields), F.concat(F.lit("– "), how, F.lit("\tx\t"), name(k), F.lit("\t\t\tMat.1.1")), F.when(k % 13 == 0, "– Group\tx\tPeople\t\t\tMat.4.1"),
        F.lit("@Article\t\t\t\t\t\t\t\t"), F.lit("– named\tx\tSkipped\t\t\tMat.2.1"), F.lit("$========== PLACE"), F.concat(F.lit("Town"), name(k)),
    ))
    edges, _ = G.relations(G.people(G.sectioned_people(S.read_lines(spark, _lines(c, ["c_custkey"], lines)))))
    return edges.select("kind", "src", "dst")
