"""Names, references and markup as column expressions. Only Unicode normalisation needs Python."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(form: str, drop: str | None = None):
    """A function for a Unicode normal form; characters of the class ``drop`` go. Null stays null.

    Rows go to Python a hundred at a time and not in Arrow's batches of ten thousand, so what it holds does not grow with the texts' number.
    """
    dropped = re.compile(f"[{drop}]") if drop else None

    def run(s: str | None) -> str | None:
        out = s if s is None else unicodedata.normalize(form, s)
        return dropped.sub("", out) if dropped and out else out

    return F.udf(run, "string", useArrow=False)


def folded(c: Column) -> Column:
    """NFKD without marks, lower case; what is no letter, digit or space parts words, which single spaces join."""
    plain = normalized("NFKD", r"\u200d\u0300-\u036f")(c)
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(plain, r"[^\p{L}\p{N}\s]", " "), r"\s+", " ")))


def bare_word(c: Column) -> Column:
    """NFKC without zero-width characters, quotes, brackets, stops and white space."""
    plain = normalized("NFKC", r"\u200b\u200c\u200d\ufeff")(c)
    return F.regexp_replace(plain, r"[《》“”‘’`'\"，。！？；：、\-—()\[\]【】\s]", "")


def skeleton(c: Column) -> Column:
    """Hebrew consonants alone: NFD without points, accents and anything else."""
    return F.regexp_replace(normalized("NFD", r"\u0591-\u05c7")(c), r"[^\x{05d0}-\x{05ea}]", "")


def clean_token(c: Column) -> Column:
    """Without a byte order mark and round or square brackets; white space as single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"^\x{FEFF}", ""), r"[()\[\]]", ""), r"\s+", " "))


def clean_name(c: Column) -> Column:
    """Without bracketed parts, a leading ``>`` and tags; white space as single spaces."""
    for pattern, to in ((r"\(.*?\)", ""), (r"^\s*>\s*", ""), (r"<[^>]*>", ""), (r"\s+", " ")):
        c = F.regexp_replace(c, pattern, to)
    return F.trim(c)


def identity_key(c: Column) -> Column:
    """A name as key: cleaned, without ``=...`` and question marks at its end, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(clean_name(c), r"=\S+$", ""), r"\?+$", "")))


def clean_han(c: Column) -> Column:
    """A word from its first Han character to its last, without white space and zero-width characters."""
    plain = F.regexp_replace(F.regexp_replace(c, r"[\x{200b}\x{200c}\x{200d}\x{feff}]", ""), r"\s+", "")
    return F.regexp_replace(plain, r"^[^\x{4e00}-\x{9fff}]+|[^\x{4e00}-\x{9fff}]+$", "")


#: Endings and words of places and titles.
GEOGRAPHIC = r"(地$|城$|山$|海$|河$|城|位间$|人群$|^伊信$)"


def is_geographic(c: Column) -> Column:
    return F.coalesce(c.rlike(GEOGRAPHIC), F.lit(False))


def label_base(c: Column) -> Column:
    """What stands before the first of @, = and |."""
    return F.trim(F.regexp_extract(c, r"^([^@=|]*)", 1))


def plain_reference(c: Column) -> Column:
    """A reference without the mark of the Greek version, white space, ``ff``, a trailing book and zero-width characters."""
    for pattern in (r"(?i)^LXX\s*", r"\s+", r"(?i)ff$", r"-[A-Za-z]+$", r"[\x{200b}-\x{200d}]"):
        c = F.regexp_replace(c, pattern, "")
    return F.trim(c)


def reference(c: Column, books: Column) -> Column:
    """``Mat.4.21a`` as a struct of book, chapter, verse, passage (``MAT 4:21``) and lxx; null if it is none.

    ``books`` maps lower-case names to codes; a book it lacks, or verse 0, makes no reference.
    A range counts as its first verse (``-2``), the mark ``LXX`` before the book is told by ``lxx``.
    """
    token = F.regexp_replace(F.regexp_replace(plain_reference(c), r"[,;]+", ""), r"-[·•\d]$", "")
    form = r"(?i)^([1-3]?[A-Z]+)\.(\d+)\.(\d+)[a-z]?$"
    part = lambda k: F.regexp_extract(token, form, k)
    book, chapter, verse = F.element_at(books, F.lower(part(1))), part(2).try_cast("int"), part(3).try_cast("int")
    passage = F.concat(book, F.lit(" "), chapter.cast("string"), F.lit(":"), verse.cast("string"))
    ok = token.rlike(form) & book.isNotNull() & (verse > 0)
    return F.when(ok, F.struct(book.alias("book"), chapter.alias("chapter"), verse.alias("verse"), passage.alias("passage"), c.rlike(r"(?i)^LXX").alias("lxx")))


def references(c: Column) -> Column:
    """A list of references parted by semicolons, commas or spaces."""
    return F.filter(F.transform(F.split(c, r"[;,\s]+"), lambda x: F.trim(x)), lambda x: x != "")


def relation_items(c: Column) -> Column:
    """Relation lists (``A@Mat.1.1 + B(?), C``) as an array of (key, uncertain, raw, refs)."""
    items = F.filter(F.transform(F.split(c, r"\s+\+\s*|\s*,\s*"), lambda x: F.trim(x)), lambda x: (x != "") & (clean_name(x) != ""))

    def item(raw: Column) -> Column:
        name = clean_name(raw)
        tail = F.regexp_extract(name, r"^[^@]*@(.*)$", 1)
        return F.struct(
            clean_name(F.regexp_extract(name, r"^([^@]*)", 1)).alias("key"), F.contains(raw, F.lit("(?)")).alias("uncertain"), raw.alias("raw"), references(tail).alias("refs")
        )

    return F.transform(items, item)


#: Relations that stand for a name.
PLACEHOLDERS = (
    "father mother daughter son husband wife a_wife brother sister child parent spouse relative "
    "mother_in_law father_in_law son_in_law daughter_in_law"
).split()


def is_placeholder(c: Column) -> Column:
    """Names that only tell a relation, as ``son_of_x`` or ``SonOfX``, or are numbered as unnamed."""
    snake = F.regexp_replace(F.lower(F.trim(F.regexp_replace(c, r"([a-z])([A-Z])", "$1_$2"))), r"\s+", "_")
    relation = F.regexp_replace(F.regexp_replace(F.regexp_extract(snake, r"^(.*?)_of_", 1), r"^the_", ""), r"\d+$", "")
    return F.coalesce(F.startswith(snake, F.lit("unnamed#")) | (F.contains(snake, F.lit("_of_")) & relation.isin(PLACEHOLDERS)), F.lit(False))


def name_query(c: Column) -> Column:
    """A name to search for: NFKC, straight quotes, spaces for underscores; null if it is not Latin letters with `` .'-``, two at least."""
    plain = F.regexp_replace(F.regexp_replace(F.translate(normalized("NFKC")(c), "’`_", "'' "), r"\s+", " "), r"^ +| +$", "")
    return F.when(plain.rlike(r"^[A-Za-z][A-Za-z .'\-]*[A-Za-z]$"), plain)


def script(c: Column) -> Column:
    return F.when(c.rlike(r"\p{IsGreek}"), "greek").when(c.rlike(r"\p{IsHebrew}"), "hebrew").when(c.rlike(r"\p{IsHan}"), "han").when(c.rlike(r"\p{IsLatin}"), "latin")


def script_tokens(c: Column, name: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(rf"\p{{Is{name}}}+"), 0))


def stemmed(c: Column, endings: Sequence[str], least: int = 3) -> Column:
    """The word without the first of the endings that leaves ``least`` letters."""
    out = c
    for e in reversed(endings):
        out = F.when(c.endswith(e) & (F.length(c) - len(e) >= least), F.substr(c, F.lit(1), F.length(c) - len(e))).otherwise(out)
    return out


def stripped_markup(c: Column) -> Column:
    """Text without comments, scripts, styles, tags and entities; white space as single spaces."""
    for pattern in (r"(?s)<!--.*?-->", r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>", r"<[^>]*>", r"&[a-zA-Z#0-9]+;", r"[\x00-\x1f]"):
        c = F.regexp_replace(c, pattern, " ")
    return F.trim(F.regexp_replace(c, r" +", " "))


def stripped_usfm(c: Column) -> Column:
    """Text without backslash markers, braces, tags and control characters; white space as single spaces."""
    for pattern in (r"(?i)\\[a-z0-9*]+", r"\{[^}]*\}", r"<[^>]*>", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", r"\s+"):
        c = F.regexp_replace(c, pattern, " ")
    return F.trim(c)


def stripped_notes(c: Column) -> Column:
    """Text without footnotes and cross references between their markers."""
    for marker in ("f", "x", "fr", "fk", "ft", "fv", "fqa"):
        c = F.regexp_replace(c, rf"(?s)\\{marker}.*?\\{marker}\*", "")
    return F.regexp_replace(c, r"\\f\*", "")


def snippet(c: Column, most: int) -> Column:
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most - 1)), F.lit("…"))).otherwise(c)


def cue_types(c: Column, cues: dict[str, Sequence[str]]) -> Column:
    """The types of which the text has a cue, in the given order."""
    hit = lambda terms: F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(c, t))
    return F.array_compact(F.array(*[F.when(hit(terms), F.lit(name)) for name, terms in cues.items()]))


def only_collective(c: Column, label: str, suffix: str) -> Column:
    """Whether the label occurs, and each time with the suffix of a group."""
    n = F.regexp_count(c, F.lit(rf"\Q{label}\E"))
    return (n > 0) & (n == F.regexp_count(c, F.lit(rf"\Q{label}{suffix}\E")))


def first_phrase(text: Column, groups: Sequence[tuple[str, Sequence[Column]]], forbidden: str, look: int) -> Column:
    """The label of the first group with a phrase in the text; a group counts if what follows its first phrase is not ``forbidden``.

    ``forbidden`` is a regular expression for the beginning of the next ``look`` characters.
    """
    out = F.lit(None).cast("string")
    for label, phrases in reversed(groups):
        phrase = F.coalesce(*[F.when(F.contains(text, p), p) for p in phrases])
        after = F.substr(text, F.instr(text, phrase) + F.length(phrase), F.lit(look))
        out = F.when(phrase.isNotNull() & ~after.rlike(forbidden), label).otherwise(out)
    return out


def parent_phrase(text: Column, a: Column, b: Column) -> Column:
    """``ab`` where the text calls b a child of a, ``ba`` the other way round, else null."""
    def of(p: Column, c: Column) -> list[Column]:
        # fixed values: how a text names a child
        return [F.concat(p, F.lit(x), c) for x in ("的儿子", "儿子", "的女儿", "女儿")] + [F.concat(c, F.lit("是"), p, F.lit(x)) for x in ("的儿子", "的女儿")]

    return first_phrase(text, [("ab", of(a, b)), ("ba", of(b, a))], "^(王|人|支派|国|省|族)", 2)


#: Verbs that make a relation, and what may not follow the person acted upon.
COMMISSION = ("差遣 托付 委派 指派 任命 膏立".split(), "^(人|人的|支派|族|的子孙|子孙|的后裔|后裔)")
HOSTILE = ("杀了 击杀 杀死 攻击 逼迫 反对 控告 背叛".split(), "^(的儿子|的女儿|儿子|女儿|的子孙|子孙|的后裔|后裔|人|支派|族)")


def verb_phrase(text: Column, a: Column, b: Column, verbs: Sequence[str], forbidden: str) -> Column:
    """``ab`` where a does what a verb says to b, ``ba`` the other way round, by the first verb that fits."""
    groups = [(way, [F.concat(x, F.lit(v), y)]) for v in verbs for way, x, y in (("ab", a, b), ("ba", b, a))]
    return first_phrase(text, groups, forbidden, 4)


#: Kinds of context around an alias (``@``), in the order in which they are tried.
CONTEXTS = (
    ("tribe", "@.{0,6}支派|支派.{0,6}@"),
    ("people_group", "@(?:家|族|人|民|众人|军兵|长老|会众|百姓|子孙|后裔|后代)|(?:我的民|我民|全|众|诸).{0,3}@"),
    ("place", "@(?:地|省|山地|城)|(?:地|省|山地|城).{0,4}@"),
    ("nation", "@(?:国|王国|王)"),
)
#: Grammar of a single person.
PERSONAL = (
    "(?:先知|祭司|大祭司|王|将军|省长|士师|使徒|门徒)@",
    "@(?:说|回答|问|吩咐|打发|起来|去了|来到|生了|死了|作王|登基|娶|嫁|听见|看见)",
    "@的(?:儿子|女儿|父亲|母亲|兄弟|姊妹|妻子|丈夫)",
    "(?:儿子|女儿|父亲|母亲|兄弟|姊妹|妻子|丈夫)@",
)


def around(pattern: str, alias: Column) -> Column:
    """The pattern with the alias, as it is written, in place of ``@``."""
    quoted = F.concat(F.lit("\\Q"), F.replace(alias, F.lit("\\E"), F.lit("")), F.lit("\\E"))
    return F.replace(F.lit(pattern), F.lit("@"), quoted)


def context_kind(text: Column, alias: Column, contexts: Sequence[tuple[str, str]] = CONTEXTS) -> Column:
    """The first kind of context in which the alias stands, else null."""
    return F.coalesce(*[F.when(F.regexp_like(text, around(p, alias)), kind) for kind, p in contexts])


def personal_grammar(text: Column, alias: Column, patterns: Sequence[str] = PERSONAL) -> Column:
    """Whether the alias stands as a single person does."""
    out = F.lit(False)
    for p in patterns:
        out = out | F.regexp_like(text, around(p, alias))
    return F.coalesce(out, F.lit(False))


def mention_kind(text: Column, alias: Column, eponym: Column, first_book: Column, genealogy: Column) -> Column:
    """Person, tribe, people_group, place or nation: personal grammar, then context, then what is known of the name.

    ``eponym`` is tribe or people_group for names that also mean descendants, else null; in the
    first book, and in genealogies that name the person's own code, such a name is the person's.
    """
    return F.when(
        F.contains(text, alias),
        F.when(personal_grammar(text, alias), "person").otherwise(F.coalesce(context_kind(text, alias), F.when(eponym.isNull() | first_book | genealogy, "person"), eponym)),
    )


def own_codes(note: Column) -> Column:
    """Codes that a note gives for its own person: after "referred to as", up to where it names relatives."""
    own = F.regexp_extract(note, r"(?is)referred to as(.*?)(?:<br>\s*(?:son|daughter|father|mother|brother|sister|husband|wife|with|a descendant)|$)", 1)
    return F.array_distinct(F.regexp_extract_all(own, F.lit(r'<strong="(H\d{4}[A-Z]?)">'), 1))


def base_code(c: Column) -> Column:
    return F.regexp_replace(c, r"^([A-Z]\d{4})[A-Z]$", "$1")


def bucket(c: Column) -> Column:
    """High from .85, medium from .65 and for what is no number, else low."""
    return F.when(c.isNull() | F.isnan(c), "medium").when(c >= 0.85, "high").when(c >= 0.65, "medium").otherwise("low")


def testament(book: Column, old: Sequence[str], new: Sequence[str]) -> Column:
    """ot or nt; null for a book of neither."""
    return F.when(book.isin(list(old)), "ot").when(book.isin(list(new)), "nt")
