"""Queries over rules for names, references, phrases and published fields, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import published as P
from weft.functions import text as X
from weft.plans.relational import t

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def one_of(key, values: list[str]):
    """The value at key modulo their number; both here and, by ``one_of_sql``, in SQL."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def one_of_sql(key: str, values: list[str]) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"[{quoted}][({key} % {len(values)} + 1)::INT]"


def strings(c, sep=","):
    return F.array_join(c, sep)


RAW_NAMES = [" > Name (of x) <b>One</b>", "Two@Mat=G1", "Three=G2 ??", "[Four]  (bis)", "\tFive  six?", "{Seven}", "(gone)"]
_RAW = f"(SELECT p_partkey AS k, {one_of_sql('p_partkey', RAW_NAMES)} || ' ' || p_partkey AS raw, {one_of_sql('p_partkey', RAW_NAMES)} AS bare FROM part)"
_CLEAN = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '\(.*?\)', '', 'g'), '^\s*>\s*', ''), '<[^>]*>', '', 'g'), '\s+', ' ', 'g'))"


@query(rf"""SELECT k, trim(regexp_replace(regexp_replace(raw, '[()\[\]]', '', 'g'), '\s+', ' ', 'g')) AS token, {_CLEAN.format(c='raw')} AS name,
lower(trim(regexp_replace(regexp_replace({_CLEAN.format(c='bare')}, '=\S+$', ''), '\?+$', ''))) AS key FROM {_RAW}""")
def name_keys(spark, sf_dir):
    p = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), one_of(F.col("p_partkey"), RAW_NAMES).alias("bare"))
    raw = F.concat_ws(" ", "bare", F.col("k").cast("string"))
    return p.select("k", X.clean_token(raw).alias("token"), X.clean_name(raw).alias("name"), X.identity_key(F.col("bare")).alias("key"))


BOOKS = {"mat": "MAT", "mrk": "MRK", "1ki": "1KI", "gen": "GEN"}
REFS = ["Mat", "LXX 1Ki", "Gen", "Foo", "MRK"]
TAILS = ["", "a", "ff", "-2", "-Mrk", ";"]


def _books():
    return F.create_map(*[F.lit(x) for kv in BOOKS.items() for x in kv])


@query(rf"""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, {one_of_sql('l_orderkey', REFS)} || '.' || l_linenumber || '.' || (l_partkey % 40) || {one_of_sql('l_linenumber', TAILS)} AS raw FROM lineitem),
x AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '^LXX\s*', '', 'i'), '\s+', '', 'g'), 'ff$', '', 'i'), '-[A-Za-z]+$', ''), '[,;]+', '', 'g'), '-[·•0-9]$', '') AS s FROM r),
y AS (SELECT *, CASE lower(regexp_extract(s, '^([1-3]?[A-Za-z]+)\.([0-9]+)\.([0-9]+)[A-Za-z]?$', 1)) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in BOOKS.items())} END AS book,
TRY_CAST(regexp_extract(s, '^([1-3]?[A-Za-z]+)\.([0-9]+)\.([0-9]+)[A-Za-z]?$', 2) AS INT) AS c, TRY_CAST(regexp_extract(s, '^([1-3]?[A-Za-z]+)\.([0-9]+)\.([0-9]+)[A-Za-z]?$', 3) AS INT) AS v FROM x)
SELECT raw, CASE WHEN book IS NOT NULL AND v > 0 THEN book || ' ' || c || ':' || v END AS passage, CASE WHEN book IS NOT NULL AND v > 0 THEN starts_with(raw, 'LXX') END AS lxx FROM y""")
def reference_parse(spark, sf_dir):
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    raw = F.concat(one_of(k, REFS), F.lit("."), n.cast("string"), F.lit("."), (F.col("l_partkey") % 40).cast("string"), one_of(n, TAILS))
    return t(spark, sf_dir, "lineitem").select(raw.alias("raw")).withColumn("r", X.reference(F.col("raw"), _books())).select("raw", F.col("r.passage").alias("passage"), F.col("r.lxx").alias("lxx"))


@query("""SELECT s_suppkey, a AS key, a LIKE '%9' AS uncertain, 2 AS n_refs, pos FROM (SELECT s_suppkey, unnest([s_name, 'N' || s_nationkey]) AS a, unnest([1, 2]) AS pos FROM supplier)""")
def relation_list_parse(spark, sf_dir):
    s = t(spark, sf_dir, "supplier")
    raw = lambda name: F.concat(name, F.lit("@Mat.1.1; Mat.2.2"), F.when(name.endswith("9"), " (?)").otherwise(""))
    text = F.concat_ws(" + ", raw(F.col("s_name")), raw(F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))))
    items = s.select("s_suppkey", F.posexplode(X.relation_items(text)).alias("at", "i"))
    return items.select("s_suppkey", F.col("i.key").alias("key"), F.col("i.uncertain").alias("uncertain"), F.size("i.refs").alias("n_refs"), (F.col("at") + 1).alias("pos"))


HOLDERS = ["son_of_x", "SonOfX", "mother", "Mother_Teresa", "unnamed#1", "the_wife2_of_y", "Person_of_z", "daughter in law of w", ""]


@query(f"SELECT c_custkey, {one_of_sql('c_custkey', HOLDERS)} AS name, c_custkey % 9 IN (0, 1, 4, 5, 7) AS placeholder FROM customer")
def placeholder_names(spark, sf_dir):
    name = one_of(F.col("c_custkey"), HOLDERS)
    return t(spark, sf_dir, "customer").select("c_custkey", name.alias("name"), X.is_placeholder(name).alias("placeholder"))


HAN = ["a 摩西 b", "​大城", "亚伯  拉罕1", "x", "伊信", "海边"]


@query(f"""SELECT p_partkey, {one_of_sql('p_partkey', ['摩西', '大城', '亚伯拉罕', '', '伊信', '海边'])} AS word, p_partkey % 6 IN (1, 4) AS geographic,
{one_of_sql('p_partkey', ['a摩西b', '大城', '亚伯拉罕1', 'x', '伊信', '海边'])} AS bare FROM part""")
def han_words(spark, sf_dir):
    raw = one_of(F.col("p_partkey"), HAN)
    return t(spark, sf_dir, "part").select("p_partkey", X.clean_han(raw).alias("word"), X.is_geographic(X.clean_han(raw)).alias("geographic"), X.bare_word(raw).alias("bare"))


@query(r"""WITH m AS (SELECT doc_id, '\v 1 ' || coalesce(text, '') || '\f + \ft note ' || doc_id || '\f* {x} <b>end' AS m FROM documents)
SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(m, '\\[a-z0-9*]+', ' ', 'gi'), '\{[^}]*\}', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[\x00-\x08\x0b\x0c\x0e-\x1f]', ' ', 'g'), '\s+', ' ', 'g'))) AS plain,
md5(regexp_replace(m, '(?s)\\f.*?\\f\*', '', 'g')) AS no_notes FROM m""")
def marker_strip(spark, sf_dir):
    m = F.concat(F.lit("\\v 1 "), F.coalesce("text", F.lit("")), F.lit("\\f + \\ft note "), F.col("doc_id").cast("string"), F.lit("\\f* {x} <b>end"))
    return t(spark, sf_dir, "documents").select("doc_id", F.md5(X.stripped_usfm(m).cast("binary")).alias("plain"), F.md5(X.stripped_notes(m).cast("binary")).alias("no_notes"))


LABELS = ["亚当", "塞特", "大卫", "约押"]
PARENTS = ["@a的儿子@b说", "@b是@a的女儿", "@a儿子@b王", "@b的儿子@a", "@a和@b", "@a的儿子@b族，@b女儿@a"]
WAYS = ["ab", "ab", None, "ba", None, "ba"]
VERBS = ["@a杀了@b", "@b背叛@a", "@a攻击@b的儿子", "@a爱@b", "@b逼迫@a人，@a反对@b"]
VERB_WAYS = ["ab", "ba", None, None, "ab"]


def _case(key: str, values) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v) + " END"


@query(f"""SELECT o_orderkey, {_case('o_orderkey', WAYS)} AS parent, {_case('o_custkey', VERB_WAYS)} AS hostile FROM orders""")
def relation_phrases(spark, sf_dir):
    a, b = one_of(F.col("o_orderkey"), LABELS[:2]), one_of(F.col("o_orderkey"), LABELS[2:])
    fill = lambda c: F.replace(F.replace(c, F.lit("@a"), a), F.lit("@b"), b)
    return t(spark, sf_dir, "orders").select(
        "o_orderkey", X.parent_phrase(fill(one_of(F.col("o_orderkey"), PARENTS)), a, b).alias("parent"), X.verb_phrase(fill(one_of(F.col("o_custkey"), VERBS)), a, b, *X.HOSTILE).alias("hostile")
    )


@query(f"""WITH s AS (SELECT o_custkey % 20 AS a, o_custkey % 20 + 20 AS b, o_orderkey, {_case('o_orderkey', WAYS)} AS way FROM orders WHERE o_orderkey % 6 IN (0, 1, 2) OR (o_custkey % 20 >= 15))
SELECT a, b, min(way) AS way, count(*) AS n, array_to_string(list_sort(list(o_orderkey))[1:3], ',') AS first FROM s WHERE way IS NOT NULL GROUP BY a, b HAVING count(DISTINCT way) = 1""")
def relation_proposals(spark, sf_dir):
    from weft.operators.matching import proposals

    o = t(spark, sf_dir, "orders").filter("o_orderkey % 6 IN (0, 1, 2) OR o_custkey % 20 >= 15")
    la, lb = one_of(F.col("o_orderkey"), LABELS[:2]), one_of(F.col("o_orderkey"), LABELS[2:])
    text = F.replace(F.replace(one_of(F.col("o_orderkey"), PARENTS), F.lit("@a"), la), F.lit("@b"), lb)
    rows = o.select((F.col("o_custkey") % 20).alias("a"), (F.col("o_custkey") % 20 + 20).alias("b"), F.col("o_orderkey").alias("passage"), X.parent_phrase(text, la, lb).alias("way"))
    p = proposals(rows, ["a", "b"], "way", "passage")
    return p.select("a", "b", "way", F.size("passages").cast("long").alias("n"), strings(F.slice("passages", 1, 3).cast("array<string>")).alias("first"))


MENTIONS = ["犹大说话", "犹大支派", "以色列众民和犹大", "犹大地", "犹大国", "犹大去了", "没有名字", "犹大往北", "祭司犹大家"]


@query("SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN 'person' WHEN 1 THEN 'tribe' WHEN 2 THEN 'people_group' WHEN 3 THEN 'place' WHEN 4 THEN 'nation' WHEN 5 THEN 'person' WHEN 6 THEN NULL WHEN 8 THEN 'person' ELSE CASE WHEN c_custkey % 2 = 0 THEN 'person' ELSE 'tribe' END END AS kind FROM customer")
def mention_kinds(spark, sf_dir):
    text, k = one_of(F.col("c_custkey"), MENTIONS), F.col("c_custkey")
    return t(spark, sf_dir, "customer").select("c_custkey", X.mention_kind(text, F.lit("犹大"), F.lit("tribe"), k % 2 == 0, F.lit(False)).alias("kind"))


QUERY_NAMES = ["O’Neil_x  y", "x", "Anna-Lee", "9lives", "Ann ", " d'Arc", "Müller"]


@query(f"""SELECT c_custkey, CASE WHEN c_custkey % 7 IN (0, 2, 4, 5) THEN {one_of_sql('c_custkey', ["O'Neil x y", 'x', 'Anna-Lee', '9lives', 'Ann', "d'Arc", 'x'])} END AS q,
array_to_string(CASE WHEN c_custkey % 3 = 0 THEN ['H' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') || 'A'] ELSE [] END, ',') AS codes FROM customer""")
def name_queries(spark, sf_dir):
    k = F.col("c_custkey")
    code = F.concat(F.lit("H"), F.lpad((k % 10000).cast("string"), 4, "0"))
    note = F.concat(F.when(k % 3 == 0, F.concat(F.lit('x referred to as <strong="'), code, F.lit('A">'))).otherwise("no"), F.lit('<br> son of <strong="H9999">'))
    return t(spark, sf_dir, "customer").select("c_custkey", X.name_query(one_of(k, QUERY_NAMES)).alias("q"), strings(X.own_codes(note)).alias("codes"))


WORDS = ["λόγος Ἀβραάμ", "בְּרֵאשִׁית", "摩西 John", "plain"]


@query(f"""SELECT p_partkey, {one_of_sql('p_partkey', ['greek', 'hebrew', 'han', 'latin'])} AS script, {one_of_sql('p_partkey', ['', '', 'John', 'plain'])} AS latin, {one_of_sql('p_partkey', ['', 'בראשית', '', ''])} AS consonants,
regexp_extract('Alpha@Mat=' || p_partkey, '^([^@=|]*)', 1) AS label, 'H' || lpad((p_partkey % 10000)::VARCHAR, 4, '0') AS code FROM part""")
def scripts_and_labels(spark, sf_dir):
    w, k = one_of(F.col("p_partkey"), WORDS), F.col("p_partkey")
    return t(spark, sf_dir, "part").select(
        "p_partkey", X.script(w).alias("script"), strings(X.script_tokens(w, "Latin")).alias("latin"), X.skeleton(w).alias("consonants"), X.label_base(F.concat(F.lit("Alpha@Mat="), k.cast("string"))).alias("label"),
        X.base_code(F.concat(F.lit("H"), F.lpad((k % 10000).cast("string"), 4, "0"), F.when(k % 2 == 0, "B").otherwise(""))).alias("code"),
    )


@query("""WITH c AS (SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN ['ot'] WHEN 1 THEN ['nt'] WHEN 2 THEN ['ot', 'nt'] ELSE [] END AS t,
CASE c_custkey % 5 WHEN 0 THEN ['MAT'] WHEN 1 THEN ['GEN', 'ROM'] WHEN 2 THEN ['rom'] WHEN 4 THEN ['exo'] ELSE [] END AS b, CASE WHEN c_custkey % 7 = 0 THEN 'lived in   the Exodus' ELSE c_name END AS n FROM customer)
SELECT k, CASE WHEN k % 4 = 0 THEN '旧约背景' WHEN k % 7 = 0 THEN '旧约背景' WHEN k % 5 = 0 THEN '耶稣时期' WHEN k % 4 IN (1, 2) THEN '使徒时期' WHEN k % 5 IN (1, 4) THEN '旧约背景' WHEN k % 5 = 2 THEN '使徒时期' ELSE '时代待审' END AS era FROM c""")
def era_classes(spark, sf_dir):
    k = F.col("c_custkey")
    arr = lambda *x: F.array(*[F.lit(y) for y in x]).cast("array<string>")
    told = F.when(k % 4 == 0, arr("ot")).when(k % 4 == 1, arr("nt")).when(k % 4 == 2, arr("ot", "nt")).otherwise(arr())
    books = F.when(k % 5 == 0, arr("MAT")).when(k % 5 == 1, arr("GEN", "ROM")).when(k % 5 == 2, arr("rom")).when(k % 5 == 4, arr("exo")).otherwise(arr())
    return t(spark, sf_dir, "customer").select(k.alias("k"), P.era(told, books, F.when(k % 7 == 0, "lived in   the Exodus").otherwise(F.col("c_name"))).alias("era"))


RAW_LEVELS = ["Inference OT", "Ancient source", "modern note", "OT book", "旧约 x", "NT text", "other", ""]


@query(f"""SELECT o_orderkey, {one_of_sql('o_orderkey', ['inference', 'ancient', 'modern', 'ot_text', 'ot_text', 'nt_text', 'ot_text', 'modern'])} AS level,
CASE WHEN contains(lower(o_orderpriority), 'ot') THEN 'ot_text' WHEN contains(lower(o_orderpriority), 'nt') THEN 'nt_text' ELSE 'modern' END AS of_priority FROM orders""")
def evidence_levels(spark, sf_dir):
    return t(spark, sf_dir, "orders").select("o_orderkey", P.evidence_level(one_of(F.col("o_orderkey"), RAW_LEVELS)).alias("level"), P.evidence_level(F.col("o_orderpriority")).alias("of_priority"))


KINDS = ["kinship", "Kinship", "mentor", "host", "legal", "covenant", "foo", "candidate", "", "military"]
SUBTYPES = [*P.KIN_LABELS, "unheard", ""]
_LABEL = (
    f"CASE WHEN kind = 'kinship' THEN '亲属关系-' || CASE sub {' '.join(f'WHEN {chr(39)}{k}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in P.KIN_LABELS.items())} ELSE '其他' END "
    + " ".join(f"WHEN kind IN ({', '.join(repr(x) for x in v)}) THEN '{k}'" for k, v in P.TYPE_LABELS.items())
    + " WHEN ed IN ('pending', 'review') OR kind IN ('candidate', '') THEN '候选关系' ELSE '关系-' || kind END"
)


@query(f"""WITH r AS (SELECT p_partkey, lower({one_of_sql('p_partkey', KINDS)}) AS kind, {one_of_sql('p_partkey // 10', SUBTYPES)} AS sub, CASE WHEN p_size % 5 = 0 THEN 'pending' ELSE 'done' END AS ed, p_size FROM part)
SELECT p_partkey, {_LABEL} AS label, CASE WHEN kind = 'kinship' AND sub <> '' THEN kind || ':' || sub WHEN kind <> '' THEN kind ELSE 'relation' END AS raw, CASE WHEN p_size % 3 = 0 THEN 'incoming' ELSE 'outgoing' END AS direction FROM r""")
def relation_labels(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    kind, sub = one_of(k, KINDS), one_of(F.floor(k / 10), SUBTYPES)
    return t(spark, sf_dir, "part").select(
        "p_partkey", P.relation_label(kind, sub, F.when(size % 5 == 0, "pending").otherwise("done")).alias("label"), P.raw_type(kind, sub).alias("raw"), P.direction(F.when(size % 3 == 0, "incoming").otherwise("x")).alias("direction")
    )


@query("""SELECT l_orderkey, max(l_quantity / 50) AS most, min(l_quantity / 50) AS least, CASE WHEN l_orderkey % 5 = 0 OR max(l_quantity / 50) < 0.75 THEN 'reviewed_uncertain' ELSE 'confirmed' END AS state,
100 + CASE l_orderkey % 3 WHEN 0 THEN 30 WHEN 1 THEN 28 ELSE 8 END + CASE WHEN max(l_quantity / 50) >= 0.85 THEN 3 WHEN max(l_quantity / 50) >= 0.65 THEN 2 ELSE 1 END AS priority FROM lineitem GROUP BY l_orderkey""")
def review_states(spark, sf_dir):
    e = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct((F.col("l_quantity") / 50).alias("certainty"))).alias("e"))
    most, k = P.most_certain(F.col("e")), F.col("l_orderkey")
    level = F.when(k % 3 == 0, "nt_text").when(k % 3 == 1, "ot_text").otherwise("inference")
    return e.select("l_orderkey", most.alias("most"), P.least_certain(F.col("e")).alias("least"), P.review_state(k % 5 == 0, most).alias("state"), P.priority(F.lit(P.KIN + P.OTHER_KIN), level, X.bucket(most)).alias("priority"))


PLACES = ["STEP:MAT 1:1", "1KI 2:3", "", "step:Gen 4", " ROM 5:1"]


@query(f"""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'person-00' || lpad((s_suppkey % 10000)::VARCHAR, 4, '0') ELSE 's-' || s_suppkey END AS id, {one_of_sql('s_suppkey', ['MAT', '1KI', '新约', 'Gen', 'ROM'])} AS book FROM supplier""")
def legacy_ids_and_books(spark, sf_dir):
    k = F.col("s_suppkey")
    raw = F.when(k % 2 == 0, F.concat(F.lit("nt-people-"), F.lpad((k % 10000).cast("string"), 4, "0"))).otherwise(F.concat(F.lit("s-"), k.cast("string")))
    return t(spark, sf_dir, "supplier").select("s_suppkey", P.canonical_id(raw).alias("id"), P.passage_book(one_of(k, PLACES)).alias("book"))


REPORTS = {
    '{"status": true}': True, '{"status": "true"}': False, '{"status": "in Review"}': True, '{"status": {"draft": "TRUE"}}': True, '{"status": {"draft": null, "pending": true}}': True,
    '{"editorial_review_required": true}': True, '{"summary": {"review_required": "false"}, "status": "pending"}': False, "{}": False, '{"status": false, "summary": {"review_required": true}}': False, '{"status": "Draft 2"}': True,
}


@query(f"""SELECT event_id, CASE WHEN json_type(j, '$.status') = 'BOOLEAN' THEN json_extract_string(j, '$.status') = 'true' WHEN json_extract_string(j, '$.status.draft') IS NOT NULL THEN lower(json_extract_string(j, '$.status.draft')) = 'true'
WHEN json_extract_string(j, '$.status.pending') IS NOT NULL THEN lower(json_extract_string(j, '$.status.pending')) = 'true' WHEN json_type(j, '$.editorial_review_required') = 'BOOLEAN' THEN json_extract_string(j, '$.editorial_review_required') = 'true'
WHEN json_extract_string(j, '$.summary.review_required') IS NOT NULL THEN lower(json_extract_string(j, '$.summary.review_required')) = 'true'
WHEN json_type(j, '$.status') = 'VARCHAR' THEN regexp_matches(lower(json_extract_string(j, '$.status')), 'review|pending|draft|candidate|incomplete') ELSE false END AS required
FROM (SELECT event_id, {one_of_sql('event_id', list(REPORTS))}::JSON AS j FROM events)""")
def report_flags(spark, sf_dir):
    return t(spark, sf_dir, "events").select("event_id", P.review_required(one_of(F.col("event_id"), list(REPORTS))).alias("required"))


@query("""SELECT o_orderkey, '{"custkey":' || o_custkey || ',"key":' || o_orderkey || ',"priority":' || CASE WHEN o_orderpriority = '5-LOW' THEN 'null' ELSE '"' || o_orderpriority || '"' END || '}' AS whole,
'{"custkey":' || o_custkey || ',"key":' || o_orderkey || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE ',"priority":"' || o_orderpriority || '"' END || '}' AS short FROM orders""")
def stable_rows(spark, sf_dir):
    fields = {"priority": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")), "key": F.col("o_orderkey"), "custkey": F.col("o_custkey")}
    return t(spark, sf_dir, "orders").select("o_orderkey", P.stable_json(fields).alias("whole"), P.stable_json(fields, nulls=False).alias("short"))


@query("""WITH g AS (SELECT l_orderkey, count(DISTINCT l_suppkey) > 3 AS shared, count(*) > 4 AS several, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN shared AND several THEN 'shared_token_and_multi' WHEN shared THEN 'shared_token' WHEN several THEN 'multi_token' ELSE 'none' END AS level,
n >= 2 AND l_orderkey % 3 = 0 AND l_orderkey % 1001 >= 900 AND NOT several AS clear FROM g""")
def candidate_flags(spark, sf_dir):
    k = F.col("l_orderkey")
    g = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.countDistinct("l_suppkey") > 3).alias("shared"), F.count("*").alias("n"))
    several, share = F.col("n") > 4, (k % 1001) / 1000
    clear = P.high_confidence((k % 3 + 1), F.col("n"), share, share, share, F.lit(0.15), several)
    return g.select("l_orderkey", P.ambiguity(F.col("shared"), several).alias("level"), clear.alias("clear"))
