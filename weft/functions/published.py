"""What published rows carry: eras, evidence levels, review states, labels, flags, stable JSON; as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Books, eras and how a note tells an early era.
OLD_BOOKS = (
    "GEN EXO LEV NUM DEU JOS JDG RUT 1SA 2SA 1KI 2KI 1CH 2CH EZR NEH EST JOB PSA PRO "
    "ECC SNG ISA JER LAM EZE DAN HOS JOL AMO OBA JON MIC NAH HAB ZEP HAG ZEC MAL"
).split()
GOSPELS = ("MAT", "MRK", "LUK", "JHN")
ERAS = ("旧约背景", "耶稣时期", "使徒时期", "时代待审")
OLD_ERA_NOTE = (
    "(?i)before the Flood|before Israel['’]s Monarchy|the Patriarchs|Egypt and Wilderness|the Exodus|the Conquest|"
    "the Judges|United Monarchy|Divided Monarchy|Exile and Return|the Exile|the Return"
)


def era(testaments: Column, books: Column, note: Column, old_books: Sequence[str] = OLD_BOOKS, gospels: Sequence[str] = GOSPELS, old_note: str = OLD_ERA_NOTE) -> Column:
    """A person's era, by declared testaments, the note and the books of the mentions, in this order."""
    declares = lambda x: F.coalesce(F.array_contains(testaments, x), F.lit(False))
    among = lambda some: F.coalesce(F.exists(books, lambda b: F.upper(b).isin(list(some))), F.lit(False))
    early, gospel, later, unknown = ERAS
    return (
        F.when(declares("ot") & ~declares("nt"), early)
        .when(F.regexp_replace(note, r"\s+", " ").rlike(old_note), early)
        .when(among(gospels), gospel)
        .when(declares("nt"), later)
        .when(among(old_books), early)
        .when(F.size(F.coalesce(books, F.array().cast("array<string>"))) > 0, later)
        .otherwise(unknown)
    )


#: An evidence level is the first of which its raw text has a part.
LEVELS = (("inference", "inference"), ("ancient", "ancient"), ("modern", "modern"), ("ot", "ot_text"), ("旧约", "ot_text"), ("nt", "nt_text"))


def evidence_level(raw: Column) -> Column:
    """The published evidence level; ``modern`` for what tells none, null too. "ot" is looked for after the longer words that hold it."""
    low = F.lower(raw)
    return F.coalesce(*[F.when(F.contains(low, F.lit(part)), level) for part, level in LEVELS], F.lit("modern"))


# Labels of relations.
KIN_LABELS = {
    "parent": "父母", "child": "子女", "sibling": "手足", "spouse": "配偶", "partner": "配偶", "concubine_partner": "妾／妃", "grandparent": "祖父母", "grandchild": "孙辈",
    "uncle_aunt": "叔伯姑舅姨", "nephew_niece": "侄甥", "cousin": "堂表亲", "parent_in_law": "岳父母/公婆", "child_in_law": "儿媳/女婿", "sibling_in_law": "姻亲手足",
    "step_parent": "继父母", "step_child": "继子女", "other_specified": "其他（已标明）",
}
KIN, OTHER_KIN, CANDIDATE, RELATION = "亲属关系-", "其他", "候选关系", "关系-"
TYPE_LABELS = {
    "师徒": ("teacher_student", "mentor", "discipleship"), "长期同工": ("collegial", "collaboration"), "差派": ("commission",), "接待": ("host", "hospitality"),
    "政治权属": ("political", "authority"), "司法行为": ("legal", "judicial"), "明确敌对": ("hostile", "hostility", "adversarial"), "王位或职分继承": ("succession",),
    "政治/军事同盟": ("alliance",), "军事指挥或明确交战": ("military",), "先知警告、责备或膏立": ("prophetic_confrontation",), "盟约": ("covenant",), "友谊": ("friendship",),
}


def relation_label(kind: Column, subtype: Column, editorial: Column) -> Column:
    """A relation's label; types without one are candidates while under review, else named by their type."""
    kind, subtype = F.lower(F.coalesce(kind, F.lit(""))), F.lower(F.coalesce(subtype, F.lit("")))
    kin = F.coalesce(*[F.when(subtype == k, v) for k, v in KIN_LABELS.items()], F.lit(OTHER_KIN))
    out = F.when(kind == "kinship", F.concat(F.lit(KIN), kin))
    for label, kinds in TYPE_LABELS.items():
        out = out.when(kind.isin(list(kinds)), label)
    out = out.when(editorial.isin("pending", "review") | kind.isin("candidate", ""), CANDIDATE)
    return out.otherwise(F.concat(F.lit(RELATION), kind))


def raw_type(kind: Column, subtype: Column) -> Column:
    """``kinship:subtype`` for kinship, else the type, else ``relation``."""
    kind, subtype = F.lower(F.coalesce(kind, F.lit(""))), F.lower(F.coalesce(subtype, F.lit("")))
    return F.when((kind == "kinship") & (subtype != ""), F.concat_ws(":", kind, subtype)).when(kind != "", kind).otherwise("relation")


def direction(raw: Column) -> Column:
    return F.when(raw.isin("undirected", "incoming", "bidirectional"), raw).otherwise("outgoing")


def most_certain(evidence: Column, field: str = "certainty") -> Column:
    """The greatest certainty of an array of evidence; 0 without any."""
    return F.greatest(F.coalesce(F.array_max(F.transform(evidence, lambda e: F.coalesce(e[field], F.lit(0.0)))), F.lit(0.0)), F.lit(0.0))


def least_certain(evidence: Column, field: str = "certainty") -> Column:
    """The least certainty of an array of evidence; null without any."""
    return F.array_min(F.transform(evidence, lambda e: e[field]))


def review_state(inferred: Column, certainty: Column) -> Column:
    """Confirmed, unless inferred or below .75."""
    return F.when(F.coalesce(inferred, F.lit(False)) | (F.coalesce(certainty, F.lit(0.0)) < 0.75), "reviewed_uncertain").otherwise("confirmed")


def shown_review_state(level: Column, levels: Column, certainty: Column) -> Column:
    """The state of a row without one: uncertain by inference or by low certainty."""
    inferred = (level == "inference") | F.array_contains(levels, "inference")
    return F.when(F.coalesce(inferred, F.lit(False)) | F.coalesce(certainty == "low", F.lit(False)), "reviewed_uncertain").otherwise("confirmed")


def priority(kind: Column, level: Column, certainty: Column) -> Column:
    """Which of parallel edges is shown: kinship first, then evidence, then certainty."""
    by = lambda c, values: F.coalesce(*[F.when(c == k, v) for k, v in values.items()], F.lit(0))
    # fixed values: the weights
    return (
        F.when(F.startswith(kind, F.lit("亲属关系")), 100).otherwise(0)
        + by(level, {"nt_text": 30, "ot_text": 28, "ancient": 20, "modern": 10, "inference": 8})
        + by(certainty, {"high": 3, "medium": 2, "low": 1})
    )


def canonical_id(c: Column) -> Column:
    """Ids of the former form ``nt-people-0001`` as ``person-000001``; others stay."""
    return F.when(c.rlike(r"(?i)^nt-people-\d{4}$"), F.concat(F.lit("person-00"), F.right(c, F.lit(4)))).otherwise(c)


def passage_book(c: Column, default: str = "新约") -> Column:
    """The first word of a passage, without the mark of its source."""
    found = F.regexp_extract(F.regexp_replace(F.trim(c), r"(?i)^STEP:", ""), r"^([A-Za-z0-9]+)\b", 1)
    return F.when(found != "", found).otherwise(default)


def ambiguity(shared: Column, several: Column) -> Column:
    """Of a candidate token: whether its passages name several persons, and whether they hold it several times."""
    return F.when(shared & several, "shared_token_and_multi").when(shared, "shared_token").when(several, "multi_token").otherwise("none")


def high_confidence(rank: Column, support: Column, score: Column, precision: Column, coverage: Column, margin: Column, twin: Column, unit: float = 1.0) -> Column:
    """First of its key, supported twice, and clear in all measures, which are in ``unit``; never one of twins."""
    # fixed values: the limits
    clear = (support >= 2) & (score >= 0.9 * unit) & (precision >= 0.9 * unit) & (coverage >= 0.9 * unit)
    return (rank == 1) & clear & (margin >= 0.15 * unit) & ~twin


#: Words of a state that asks for review.
OPEN_STATES = "review|pending|draft|candidate|incomplete"


def review_required(report: Column) -> Column:
    """Whether a report (JSON text) asks for review: by a flag in its status, beside it or in its summary, else by the status's words."""
    v = F.try_parse_json(report)

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(v, path, "variant"))

    def flag(path: str) -> Column:
        text = F.try_variant_get(v, path, "string")
        return F.when(kind(path).isin("BOOLEAN", "STRING"), F.lower(text) == "true")

    def first(top: str, names: Sequence[str]) -> Column:
        """The first of the fields that is there decides, if it is a flag."""
        out = F.lit(None).cast("boolean")
        for n in reversed(names):
            there = kind(f"{top}.{n}")
            out = F.when(there.isNotNull() & (there != "VOID"), flag(f"{top}.{n}")).otherwise(out)
        return out

    status = F.when(kind("$.status") == "BOOLEAN", F.try_variant_get(v, "$.status", "boolean"))
    nested = first("$.status", ("editorial_review_required", "editorialReviewRequired", "review_required", "draft", "pending"))
    beside = F.when(kind("$.editorial_review_required") == "BOOLEAN", F.try_variant_get(v, "$.editorial_review_required", "boolean"))
    summary = first("$.summary", ("editorial_review_required", "editorialReviewRequired", "review_required"))
    words = F.when(kind("$.status") == "STRING", F.lower(F.try_variant_get(v, "$.status", "string")).rlike(OPEN_STATES))
    return F.coalesce(status, nested, beside, summary, words, F.lit(False))


def stable_json(fields: dict[str, Column], nulls: bool = True) -> Column:
    """The fields as JSON in the order of their names; null fields stay, or go."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": str(not nulls).lower()})
