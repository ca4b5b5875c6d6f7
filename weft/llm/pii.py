"""Personal data: detected entities get keyed surrogates of their kind.

Detection is one regular expression for e-mail addresses, IPv4 addresses, phone,
card, social security and bank account numbers, keys and tokens, and names after
a form of address. Each different entity (kind and canonical form) gets one
surrogate in the whole corpus: digits become digits, letters letters of the same
script (of others than Latin, Cyrillic and Greek: Latin ones), cards keep their first digit and whether their check digit is right,
addresses fall in ranges that belong to nobody, names are built of syllables of
the same script with an ending for the gender that forms of address tell of the name in the whole
corpus (none, if they tell both). It
is drawn by a keyed hash, so without the key it tells nothing, and it is the same
wherever the entity occurs, in whatever spelling, as given name or surname: coreference stays. Each word of a name
that a text has after a form of address is found again in that text without one, as it is and in capitals. Draws that
meet another entity's surrogate, or any entity of the corpus, are made again until none do, from
a wider pool after ``NARROW`` draws: distinctness stays. Should a pool be full, it raises.

Only DataFrame expressions are used. Texts are searched once, and written with what was found; those without
entities are not moved. Texts
with entities are joined once to their replacements, one row for each different
text on that side, so copies of a text can be split; entities are
deduplicated before the shuffle.

Defined results: null stays null and empty stays empty; what is not an entity
stays as it is, byte by byte; repeated rows give repeated results. All other columns pass through, whatever their names.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, table, written

#: Words that begin sentences and end a name before them.
NO_NAMES = (
    "The They He She It We You His Her Their Our Its This That These Those There Then When While After Before But And Or If In On At By For From To With As A An Was Is Are Were Has Had Who What "
    "Der Die Das Er Sie Es Wir Ein Eine Und Aber Im Am Bei Nach Vor Mit Le La Les Un Une Il Elle Ils Elles Et Mais Dans El Los Las Una Ella Ellos Pero En Con Y"
).split()
_WORD = r"\p{Lu}[\p{L}'’\-]{1,30}"
_NO_NAME = "|".join(x for w in NO_NAMES for x in sorted({w, w.upper()}))
_NEXT = rf"(?!(?:{_NO_NAME})(?![\p{{L}}'’\-])){_WORD}"
#: Forms of address, with a dot and without; in capitals too.
_DOTTED = "Mrs?|Ms|Dr|Prof|Sra?|Srta|Mme|Mlle"
_PLAIN = "Mister|Miss|Herr|Frau|Monsieur|Madame|Señora?|Señorita|Господин|Госпожа|Κύριος|Κυρία"
_ADDRESS = rf"(?:{_DOTTED}|{_DOTTED.upper()})\.|{_PLAIN}|{_PLAIN.upper()}|ΚΥΡΙΟΣ|ΚΥΡΙΑ"
#: Kinds in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)+",
    "ip": r"(?<![\p{N}.])(?:\d{1,3}\.){3}\d{1,3}(?!\p{N})",
    "ssn": r"(?<![\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{N}\-])",
    "card": r"(?<![\p{N}+])\d(?:[ \-]?\d){12,18}(?!\p{N})",
    "phone": r"(?<!\p{N})(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .\-]\d{3,4}[ .\-]\d{3,4}(?!\p{N})|\+\d{9,14}(?!\p{N})",
    "iban": r"(?<![\p{L}\p{N}])[A-Za-z]{2}\d{2}(?: ?[A-Za-z0-9]{4}){3,7}(?: ?[A-Za-z0-9]{1,3})?(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-fA-F]{32,}|(?:AKIA|ASIA)[A-Z0-9]{16}|(?:sk|pk|ghp|gho|xoxb|xoxp)[_\-][A-Za-z0-9_\-]{16,})(?![\p{L}\p{N}])",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?:{_ADDRESS}) {_WORD}(?: {_NEXT}){{0,2}}",
}
FEMALE = r"(?iu)^(?:Mrs|Ms|Sra|Srta|Mme|Mlle|Miss|Frau|Madame|Señora|Señorita|Госпожа|Κυρία|Κυρια)(?!\p{L})"
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Cheap first look: texts without any of these have no entity. Keys are known by what ends their prefix, or by a run of 32.
MAYBE = r"(?=[@0-9MDPSHFГΚ])(?:[@0-9]|(?<!\p{L})(?:Mr|Ms|Dr\.|Prof\.|Sr|Mme|Mlle|Mis|Herr |Frau |Monsieur |Madame |Señor|Господин|Госпожа|Κύρι|Κυρία|MR|MS|DR\.|PROF\.|SR|MME|MLLE|MIS|HERR |FRAU |MONSIEUR |MADAME |SEÑOR|ГОСПОДИН|ГОСПОЖА|ΚΎΡΙ|ΚΥΡ))|(?<=sk|pk|ghp|gho|xoxb|xoxp)[_\-]|A[KS]IA|[a-fA-F]{32}"
#: Kinds that may stand right after a letter or digit, as far as their own look-behinds allow.
_GLUED = "|".join(f"(?:{PATTERNS[k]})" for k in ("ip", "ssn", "card", "phone"))
#: The same hits as PATTERN, cheaper: within a word only kinds that may stand there are tried, and only at a digit, plus or bracket.
PATTERN_FAST = rf"(?<![\p{{L}}\p{{N}}])(?:{PATTERN})|(?=[0-9+(])(?:{_GLUED})"


SYLLABLES = {
    "latin": "ba be bo da de do fa fe ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo za ze zo".split(),
    "cyrillic": "ба бе бо да де до ва ве во га ка ке ко ла ле ло ма ме мо на не но па пе ра ре ро са се со та те то за зе зо ха хо ша".split(),
    "greek": "βα βε βο δα δε δο κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε το φα φε φο χα χε χο θα θε".split(),
}
ENDINGS = {
    ("latin", "f"): "lia", ("latin", "m"): "ron", ("latin", ""): "sen",
    ("cyrillic", "f"): "лия", ("cyrillic", "m"): "рон", ("cyrillic", ""): "нов",
    ("greek", "f"): "λια", ("greek", "m"): "ρων", ("greek", ""): "δης",
}
_LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
#: Draws after which surrogates come from a wider pool, and after which a pool counts as full.
NARROW, ROUNDS = 8, 200


def kind_of(hit: Column) -> Column:
    """The first kind whose pattern takes the whole hit."""
    out = F.lit("person")
    for kind, pattern in reversed(PATTERNS.items()):
        # what stands before and after the hit was looked at when it was found
        whole = pattern if kind == "phone" else f"(?:{pattern})"
        out = F.when(hit.rlike(f"^(?:{whole})$"), kind).otherwise(out)
    return out


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def _script(c: Column) -> Column:
    return F.when(c.rlike(r"\p{IsCyrillic}"), "cyrillic").when(c.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def units(hit: Column) -> Column:
    """What is replaced in a hit, as an array of (kind, canon, surface, gender); "lit" stays as it is.

    A name is taken word by word: its last word is a surname, the others are given
    names of the gender that the form of address tells ("" where it tells none).
    """
    kind = kind_of(hit)
    canon = (
        F.when(kind == "phone", F.when(F.length(_digits(hit)) > 10, F.substr(_digits(hit), F.length(_digits(hit)) - 9)).otherwise(_digits(hit)))
        .when(kind.isin("card", "ssn"), _digits(hit))
        .when(kind == "iban", F.lower(F.replace(hit, F.lit(" "), F.lit(""))))
        .when((kind == "secret") & ~hit.rlike("^[0-9a-fA-F]+$"), hit)
        .otherwise(F.lower(hit))
    )
    one = F.array(F.struct(kind.alias("kind"), canon.alias("canon"), hit.alias("surface"), F.lit("").alias("gender")))
    words = F.split(hit, " ")
    gender = F.when(hit.rlike(FEMALE), "f").when(hit.rlike("(?i)^(?:Dr|Prof)"), "").otherwise("m")

    def word(w: Column, i: Column) -> Column:
        part = F.when(i == 0, "lit").otherwise(F.concat(F.lit("name:"), _script(w)))
        return F.struct(part.alias("kind"), F.lower(w).alias("canon"), w.alias("surface"), F.when((i > 0) & (i < F.size(words) - 1), gender).otherwise("").alias("gender"))

    return F.when(kind == "person", F.transform(words, word)).otherwise(one)


def surrogate(key: str, kind: Column, canon: Column, gender: Column, attempt: Column) -> Column:
    """The canonical surrogate of an entity, drawn by a keyed hash; from ``NARROW`` attempts on of a wider pool."""
    narrow = attempt < NARROW

    def draw(i: Column, of: int) -> Column:
        h = F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"), i.cast("string")), 256)
        return (F.conv(F.substring(h, 1, 12), 16, 10).cast("long") % of).cast("int")

    def digit(i: Column) -> Column:
        return draw(i, 10).cast("string")

    def run_of(n: int, tag: int) -> Column:
        return F.concat(*[digit(F.lit(tag + k)) for k in range(n)])

    def char(c: Column, i: Column) -> Column:
        out = F.when(c.rlike(r"\p{N}"), digit(i))
        for script, letters in _LETTERS.items():
            at = F.lit(letters)
            is_script = {"latin": r"\p{IsLatin}", "cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}[script]
            got = F.substr(at, draw(i, len(letters)) + 1, F.lit(1))
            out = out.when(c.rlike(is_script), F.when(c == F.lower(c), got).otherwise(F.upper(got)))
        # letters of any other script become Latin ones; only marks stay
        other = F.substr(F.lit(_LETTERS["latin"]), draw(i, 26) + 1, F.lit(1))
        return out.when(c.rlike(r"\p{L}"), F.when(c == F.lower(c), other).otherwise(F.upper(other))).otherwise(c)

    def same_form(c: Column) -> Column:
        return F.array_join(F.transform(F.split(c, ""), char), "")

    local = F.regexp_extract(canon, "^([^@]*)@", 1)
    label = F.regexp_extract(canon, r"@([^.]*)", 1)
    top = F.regexp_extract(canon, r"\.(com|org|net)$", 1)
    host = F.array_join(F.transform(F.split(label, ""), lambda c, i: char(c, i + 1000)), "")
    # short local parts grow by a letter with each draw from the wider pool
    more = F.when(narrow, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(NARROW), F.greatest(attempt, F.lit(NARROW))), lambda i: F.substr(F.lit(_LETTERS["latin"]), draw(i + 2000, 26) + 1, F.lit(1))), ""))
    email = F.concat(same_form(local), more, F.lit("@"), host, F.lit(".example."), F.when(top == "", "com").otherwise(top))
    ip = F.concat(F.when(narrow, "10").otherwise((draw(F.lit(4), 16) + 240).cast("string")), F.lit("."), draw(F.lit(1), 256).cast("string"), F.lit("."), draw(F.lit(2), 256).cast("string"), F.lit("."), (draw(F.lit(3), 254) + 1).cast("string"))
    phone = F.when(
        F.length(canon) == 10, F.concat((draw(F.lit(1), 8) + 2).cast("string"), run_of(2, 2), F.when(narrow, "555").otherwise(F.concat((draw(F.lit(11), 8) + 2).cast("string"), run_of(2, 12))), run_of(4, 7))
    ).otherwise(same_form(canon))
    ssn = F.concat(F.lit("9"), run_of(8, 1))

    def luhn(number: Column) -> Column:
        """Sum of the digits, every second from the right doubled, modulo 10."""
        d = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
        return F.aggregate(d, F.lit(0), lambda a, x: a + x) % 10

    body = F.concat(F.substring(canon, 1, 1), F.array_join(F.transform(F.split(F.substr(canon, F.lit(2), F.length(canon) - 2), ""), char), ""))
    right = (10 - luhn(F.concat(body, F.lit("0")))) % 10
    wrong = (right + 1 + draw(F.lit(99), 9)) % 10
    card = F.concat(body, F.when(luhn(canon) == 0, right).otherwise(wrong).cast("string"))
    iban = F.concat(F.substring(canon, 1, 2), same_form(F.substr(canon, F.lit(3))))
    hexa = F.array_join(F.transform(F.split(canon, ""), lambda c, i: F.lower(F.conv(draw(i, 16).cast("string"), 10, 16))), "")
    out = (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "ssn", ssn).when(kind == "card", card).when(kind == "iban", iban)
        .when((kind == "secret") & canon.rlike("^[0-9a-f]+$"), hexa).when(kind == "secret", F.concat(F.regexp_extract(canon, r"^(AKIA|ASIA|[a-z]+[_\-])", 1), same_form(F.regexp_replace(canon, r"^(?:AKIA|ASIA|[a-z]+[_\-])", ""))))
    )

    def name_of(syllables: list[str], ending: str) -> Column:
        some = F.array(*[F.lit(x) for x in syllables])
        # more syllables with each draw: names never run out
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), attempt + 1), lambda i: F.get(some, draw(i, len(syllables)))), ""), F.lit(ending))

    gender_ = F.coalesce(gender, F.lit(""))
    for (script, gender), ending in ENDINGS.items():
        name = name_of(SYLLABLES[script], ending)
        out = out.when((kind == f"name:{script}") & (gender_ == gender), name)
    return out.otherwise(same_form(canon))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) of distinct (kind, canon): no two alike, and none an entity that occurs.

    ``entities`` is (kind, canon, gender), any number of rows of an entity; a name's gender is what all of them tell.
    """
    pool = F.when(F.col("kind").startswith("name:"), "name").otherwise(F.col("kind"))
    tells = lambda g: F.bool_or(F.col("gender") == g)
    base = entities.groupBy("kind", "canon").agg(F.when(tells("f") & ~tells("m"), "f").when(tells("m") & ~tells("f"), "m").otherwise("").alias("gender"))
    base = written(base.withColumn("pool", pool))
    of = surrogate(key, F.col("kind"), F.col("canon"), F.col("gender"), F.col("attempt"))
    drawn = written(base.withColumn("attempt", F.lit(0)).withColumn("surrogate", of))
    for _ in range(ROUNDS):
        first = drawn.groupBy("pool", "surrogate").agg(F.min(F.struct("attempt", "kind", "canon")).alias("first"), F.count("*").alias("n"))
        real = base.select("pool", F.col("canon").alias("surrogate")).distinct().withColumn("real", F.lit(True))
        met = written(first.join(real, ["pool", "surrogate"], "left").filter("n > 1 OR real"))
        if met.isEmpty():
            return drawn.select("kind", "canon", "surrogate")
        again = drawn.join(met, ["pool", "surrogate"], "left")
        keeps = F.col("n").isNull() | (F.col("real").isNull() & (F.col("first.kind") == F.col("kind")) & (F.col("first.canon") == F.col("canon")))
        again = again.select("kind", "canon", "gender", "pool", F.when(keeps, F.col("attempt")).otherwise(F.col("attempt") + 1).alias("attempt"), F.when(keeps, F.col("surrogate")).alias("old"))
        drawn = written(again.select("kind", "canon", "gender", "pool", "attempt", F.coalesce("old", of).alias("surrogate")))
    raise ValueError(f"no surrogates are left after {ROUNDS} draws: {[(r.pool, r.n) for r in met.groupBy('pool').agg(F.count('*').alias('n')).collect()]}")


def poured(kind: Column, surface: Column, made: Column) -> Column:
    """The surrogate in the surface's spelling: its punctuation for numbers, its capitals for the rest."""
    n = F.length(_digits(surface))
    number = F.concat(F.substr(_digits(surface), F.lit(1), F.greatest(n - F.length(made), F.lit(0))), made)
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def step(acc: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(acc["out"], F.when(is_digit, F.substr(number, acc["k"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            F.when(is_digit, acc["k"] + 1).otherwise(acc["k"]).alias("k"),
        )

    filled = F.aggregate(F.split(surface, ""), state, step)
    numbered = F.concat(filled["out"], F.substr(number, filled["k"] + 1))
    spaced = F.regexp_replace(made, "(.{4})(?=.)", "$1 ")
    upper = (surface == F.upper(surface)) & (surface != F.lower(surface))
    cased = F.when(upper, F.upper(made)).when(kind.startswith("name:"), F.initcap(made)).otherwise(made)
    return (
        F.when(kind == "lit", surface)
        .when(kind.isin("phone", "card", "ssn"), numbered)
        .when((kind == "iban") & surface.contains(" "), F.when(upper, F.upper(spaced)).otherwise(spaced))
        .otherwise(cased)
    )


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with every entity in ``text`` replaced; the same columns in the same order."""
    t = columns([text])[0]
    cols = columns(docs.columns)
    none = F.array().cast("array<string>")
    found = F.when(t.rlike(MAYBE), F.regexp_extract_all(t, F.lit(PATTERN_FAST), 0)).otherwise(none)
    # columns get plain names for the way through the file
    away = [f"__pii_{i}" for i in range(len(docs.columns))]
    t_away = F.col(away[docs.columns.index(text)])
    marked = written(docs.select(*[c.alias(a) for c, a in zip(cols, away, strict=True)], F.coalesce(found, none).alias("__pii_hits")))
    clean = marked.filter(F.size("__pii_hits") == 0).select(*away)
    dirty = marked.filter(F.size("__pii_hits") > 0).withColumn("__pii_key", F.sha2(t_away.cast("binary"), 256))
    texts = dirty.select("__pii_key", "__pii_hits").dropDuplicates(["__pii_key"])
    hits = texts.select("__pii_key", F.posexplode("__pii_hits").alias("h", "hit"))
    parts = hits.select("__pii_key", "h", F.posexplode(units(F.col("hit"))).alias("u", "unit")).select("__pii_key", "h", "u", "unit.*")
    parts = written(parts)
    names = surrogates(parts.filter("kind <> 'lit'").select("kind", "canon", "gender").distinct(), key)
    made = parts.join(names, ["kind", "canon"], "left").select("__pii_key", "h", "u", "kind", "surface", poured(F.col("kind"), F.col("surface"), F.col("surrogate")).alias("new"))
    unit = F.sort_array(F.collect_list(F.struct("h", "u", "kind", "surface", "new")))
    per_text = made.groupBy("__pii_key").agg(unit.alias("__pii_units"))
    # a hit's units stand side by side: the first begins it, the others follow after a space
    joined = F.transform("__pii_units", lambda x: F.concat(F.when(x["u"] > 0, " ").otherwise("\u0000"), x["new"]))
    # words of names, which the text may have without the form of address and in capitals: as they stand and as they become
    names_ = F.filter("__pii_units", lambda x: F.startswith(x["kind"], F.lit("name:")) & ~F.upper(x["surface"]).isin([w.upper() for w in NO_NAMES]))
    spelt = lambda x, f: F.struct(F.length(x["surface"]).alias("n"), f(x["surface"]).alias("old"), f(x["new"]).alias("new"))
    bare = F.array_distinct(F.concat(F.transform(names_, lambda x: spelt(x, lambda c: c)), F.transform(names_, lambda x: spelt(x, F.upper)), F.transform(names_, lambda x: spelt(x, F.initcap))))
    per_text = per_text.select("__pii_key", F.slice(F.split(F.array_join(joined, ""), "\u0000"), 2, F.lit(1 << 30)).alias("__pii_new"), F.sort_array(bare, False).alias("__pii_bare"))
    done = dirty.join(per_text, "__pii_key")
    between = F.split(t_away, PATTERN_FAST, -1)

    def again(c: Column) -> Column:
        """The names of the text found again in what stands between its hits, the longest first."""
        return F.aggregate("__pii_bare", c, lambda acc, n: F.regexp_replace(acc, F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), n["old"], F.lit(r"\E(?![\p{L}\p{N}])")), n["new"]))

    whole = F.array_join(F.zip_with(F.transform(between, lambda c: again(c)), F.col("__pii_new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    done = done.select(*[whole.alias(a) if c == text else F.col(a) for c, a in zip(docs.columns, away, strict=True)])
    return clean.unionByName(done).toDF(*docs.columns)


def entities(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``entities``, all that ``text`` has, as an array of (kind, canon, surface, gender)."""
    t = columns([text])[0]
    return df.withColumn("entities", F.flatten(F.transform(F.coalesce(F.regexp_extract_all(t, F.lit(PATTERN_FAST), 0), F.array().cast("array<string>")), units)))


KEY = "weft"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, KEY)


QUERIES = {"op3_pii": op3_pii}
ORACLE_SQL: dict[str, str] = {}
