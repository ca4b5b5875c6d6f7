"""What a name means in its passage: a grammar of tags, windows and kinds of context, as column expressions.

A verse is text with markup; ``aliases`` are the names that a person is known by in its language. Rules are tables: a
kind, a reason, and when it holds. They are tried in order, alias by alias, and the first that holds decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from weft.functions.text import CONTEXTS, PERSONAL, around, personal_grammar, stripped_notes

#: Names of ancestors that also mean a tribe, and those that also mean a people.
TRIBES = "犹大 流便 吕便 西缅 利未 以萨迦 西布伦 便雅悯 但 拿弗他利 迦得 亚设 约瑟 以法莲 玛拿西".split()
PEOPLES = "以扫 以东 以实玛利 摩押 亚扪 亚玛力 米甸 迦南 玛吉 赫 亚衲".split()
#: The ancestor of them all, by each of his names; the third is of poems alone.
PATRIARCH = ("雅各", "以色列", "耶书仑")
#: Names that are never taken for a person's without a mark.
EPONYMS = [*TRIBES, *PATRIARCH[:2], "以东", "以扫", "摩押", "亚扪", "亚玛力", "米甸", "迦南"]
#: Words that make what stands beside them a group or a place.
CONTEXT_TAGS = "支派 族 民族 部族 国家 国 地点 省 王国 后裔 子孙 后代 人群 百姓 同胞 会众 军队 全地 乡 城 家 地 山 河 海".split()
BEFORE_GROUP = "(?:属|属於|属于|之于|中|属下|是|者|于|该|此|其)$"
AFTER_GROUP = "^(?:者|之|属|属下|的|中|之下|所|为|便|者|等|诸|后裔|子孙|后代|家|省|省份)"
#: What may not stand before and after a marked name of a person.
BEFORE_MARK = "(?:属|支派|国|地|城|山|河|海|省|谷|门|家)$"
AFTER_MARK = "^(?:人|族|支派|国|地|城|山|河|海|省|谷|门|家|王|列王|子孙|后裔|众人|百姓|会众|军队|中|全地|各支派)"
#: Reasons of the kinds of context, in their order.
CONTEXT_REASONS = {"tribe": "polysemous_tribal_context", "people_group": "polysemous_collective_context", "place": "polysemous_place_context", "nation": "polysemous_national_context"}
#: Kinship, birth and death around an alias (``@``).
LIFE = "@.{0,10}(?:生|父亲|母亲|儿子|女儿|兄弟|妻子|丈夫|死|葬|坟墓|骸骨|年日|年岁)|(?:生给|生了|父亲|母亲|儿子|女儿|兄弟|妻子|丈夫).{0,10}@"
#: What tells the patriarch himself, and books in which his name is the people's.
PATRIARCH_SELF = "(?:亚伯拉罕|以撒).{0,24}雅各|雅各.{0,24}(?:亚伯拉罕|以撒)|雅各的神|雅各.{0,8}(?:儿子|父亲|生|死|葬|骸骨|年日)"
POETIC_BOOKS = "PSA ISA JER LAM EZE HOS JOL AMO OBA MIC NAH ZEP ZEC MAL".split()

_TAG = r"(?i)\\[a-z0-9*+]+"
_MARKED = r"\\\+?pn\s+(.+?)\\\+?pn\*"


def plain(verse: Column) -> Column:
    """A verse without tags and white space."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(verse, F.lit("")), _TAG, ""), r"\s+", "")


def _first(aliases: Column, of) -> Column:
    """What ``of`` gives for the first alias for which it is not null."""
    some = F.filter(F.coalesce(aliases, F.array().cast("array<string>")), lambda a: F.length(a) > 0)
    return F.get(F.filter(F.transform(some, of), lambda x: x.isNotNull()), F.lit(0))


def _sense(kind: str, reason: str) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(reason).alias("reason"))


def _decided(rules: Sequence[tuple[Column, str, str]]) -> Column:
    """(kind, reason) of the first rule that holds, else null."""
    return F.coalesce(*[F.when(when, _sense(kind, reason)) for when, kind, reason in rules])


def marked_names(verse: Column) -> Column:
    r"""The names marked ``\pn .. \pn*`` of a verse, as (name, before, after): with 32 characters on either side, without their tags."""
    raw, names, between = F.regexp_extract_all(verse, F.lit(_MARKED), 0), F.regexp_extract_all(verse, F.lit(_MARKED), 1), F.split(verse, _MARKED, -1)
    rows = F.zip_with(F.zip_with(raw, names, lambda r, n: F.struct(r.alias("raw"), n.alias("name"))), F.slice(between, 1, F.greatest(F.size(raw), F.lit(1))), lambda x, gap: F.struct(x["raw"].alias("raw"), x["name"].alias("name"), gap.alias("gap")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<name: string, begin: int, end: int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(F.coalesce(x["gap"], F.lit("")))
        end = begin + F.length(x["raw"])
        return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(x["name"].alias("name"), begin.cast("int").alias("begin"), end.cast("int").alias("end"))).alias("out"))

    placed = F.aggregate(F.filter(rows, lambda x: x["raw"].isNotNull()), start, step, lambda acc: acc["out"])
    low = lambda x: F.greatest(x["begin"] - 32, F.lit(0))
    return F.transform(placed, lambda x: F.struct(
        F.regexp_replace(x["name"], r"\s+", "").alias("name"), plain(F.substr(verse, low(x) + 1, x["begin"] - low(x))).alias("before"), plain(F.substr(verse, x["end"] + 1, F.lit(32))).alias("after"),
    ))


def named_alone(verse: Column, aliases: Column, eponyms: Sequence[str] = EPONYMS) -> Column:
    """Whether a marked name of the verse is one of the aliases and stands in no group, land or house."""
    own = F.coalesce(aliases, F.array().cast("array<string>"))
    fits = F.exists(marked_names(verse), lambda m: F.array_contains(own, m["name"]) & ~m["name"].isin(list(eponyms)) & ~m["before"].rlike(BEFORE_MARK) & ~m["after"].rlike(AFTER_MARK))
    return F.coalesce(fits, F.lit(False))


def in_group_or_place(before: Column, after: Column, tags: Sequence[str] = CONTEXT_TAGS) -> Column:
    """Whether the characters around a name make it a group's or a place's."""
    tagged = F.concat(before, F.lit("|"), after).rlike(rf"(?:^|[^\p{{L}}\p{{N}}])(?:{'|'.join(tags)})(?:[^\p{{L}}\p{{N}}]|$)")
    return ((F.length(before) > 0) | (F.length(after) > 0)) & (tagged | before.rlike(BEFORE_GROUP) | after.rlike(AFTER_GROUP))


def explicit_name(verse: Column, aliases: Column, eponyms: Sequence[str] = EPONYMS) -> Column:
    """(alias, snippet) of the first alias that the verse has as a word of its own, without a mark and in no group or place; else null."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(stripped_notes(verse), r"\\\+?pn\*?", ""), _TAG, ""), r"[\s\x{3000}]+", "")

    def of(a: Column) -> Column:
        at = F.regexp_instr(bare, F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), a, F.lit(r"\E(?![\p{L}\p{N}])")))
        n = F.length(a)
        near = lambda k: F.substr(bare, F.greatest(at - k, F.lit(1)), at - F.greatest(at - k, F.lit(1)))
        fits = (at > 0) & ~a.isin(list(eponyms)) & ~in_group_or_place(near(8), F.substr(bare, at + n, F.lit(8)))
        return F.when(fits, F.struct(a.alias("alias"), F.concat(near(12), F.substr(bare, at, n + 12)).alias("snippet")))

    return _first(aliases, of)


def group_sense(text: Column, aliases: Column, contexts: Sequence[tuple[str, str]] = CONTEXTS) -> Column:
    """(kind, reason) of a name that also means a group or land, by the first context around the first alias that has one."""
    return _first(aliases, lambda a: F.when(F.contains(text, a), _decided([(F.regexp_like(text, around(p, a)), kind, CONTEXT_REASONS[kind]) for kind, p in contexts])))


def patriarch_sense(text: Column, book: Column, names: Sequence[str] = PATRIARCH) -> Column:
    """(kind, reason) of the ancestor whose names are the people's too."""
    first, second, poetic = (F.contains(text, F.lit(n)) for n in names)
    return F.when(first | second | poetic, _decided([
        (book == "GEN", "person", "jacob_genesis_person_context"), (poetic | (first & second), "people_group", "jacob_israel_poetic_collective"),
        (first & text.rlike(PATRIARCH_SELF), "person", "jacob_historical_person_reference"), (first & ~book.isin(POETIC_BOOKS), "person", "jacob_narrative_person_reference"),
        (first, "people_group", "jacob_prophetic_collective"), (F.lit(True), "people_group", "israel_collective_after_genesis"),
    ]))


def residual_sense(text: Column, book: Column, chapter: Column, aliases: Column, label: Column, own_token: Column) -> Column:
    """(kind, reason) of an ancestor's name where no context tells: by life's grammar, by book and chapter, else as its tribe or people.

    ``own_token``: whether both tagged texts have the person's own code in the verse.
    """
    present = _first(aliases, lambda a: F.when(F.contains(text, a), a)).isNotNull()
    lives = _first(aliases, lambda a: F.when(F.contains(text, a) & F.regexp_like(text, around(LIFE, a)), a)).isNotNull()
    return F.when(present, _decided([
        (lives, "person", "ot_eponym_explicit_person_grammar"), (book == "GEN", "person", "genesis_eponym_person_context"),
        ((book == "1CH") & chapter.between(1, 9) & own_token, "person", "chronicles_genealogy_person_token"),
        (label.isin(TRIBES), "tribe", "ot_residual_tribal_eponym"), (label.isin(PEOPLES), "people_group", "ot_residual_people_eponym"),
    ]))


def mention_sense(verse: Column, passage: Column, aliases: Column, label: Column, own_token: Column, endpoint: Column, patriarch: Column, old: Column) -> Column:
    """(kind, reason) of a mention, null where the text tells none.

    ``endpoint``: the person is an end of a reviewed relation at this passage; ``old``: the passage is of the older books. Names of one person
    alone are judged by grammar and marks, names that also mean a group by their context first.
    """
    text = plain(verse)
    book, chapter = F.element_at(F.split(passage, " "), 1), F.coalesce(F.nullif(F.regexp_extract(passage, r"\s(\d+):", 1), F.lit("")).cast("int"), F.lit(0))
    many = label.isin(sorted({*TRIBES, *PEOPLES, *PATRIARCH[:2], *EPONYMS}))
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(verse, r"\\\+?pn\*?", ""), r"(?i)\\[a-z0-9*]+", ""), r"[\s\x{3000}]+", "")
    grammar = _first(aliases, lambda a: F.when(~a.isin(list(EPONYMS)) & F.contains(bare, a) & personal_grammar(bare, a, PERSONAL), a)).isNotNull()
    return F.coalesce(
        F.when(endpoint, _sense("person", "reviewed_direct_assertion_endpoint")), F.when(grammar & ~many, _sense("person", "cuv_explicit_personal_grammar")),
        F.when(named_alone(verse, aliases) & ~many, _sense("person", "cuv_unambiguous_person_token")), F.when(many, group_sense(text, aliases)),
        F.when(patriarch, patriarch_sense(text, book)), F.when(many & old, residual_sense(text, book, chapter, aliases, label, own_token)),
    )
