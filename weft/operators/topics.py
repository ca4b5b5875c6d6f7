"""Stored queries by topic, and the state of a view as a query string: what a link shows, another reader sees."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from urllib.parse import parse_qs, urlencode

from weft.functions.published import KIN, KIN_LABELS, OTHER_KIN
from weft.operators.graph import GraphQuery

#: Levels of evidence, scopes, and what marks a candidate's label.
EVIDENCE = ("nt_text", "ot_text", "ancient", "modern", "inference")
SCOPES = ("bible", "nt", "ot")
CANDIDATE_MARK = "候选"
#: Relations of topics, as they are labelled.
DISCIPLESHIP, TEAM, ACTS = ("师徒", "差派"), ("长期同工",), ("长期同工", "师徒", "差派", "接待", "司法行为")
ACTS_KIN = ("父母", "子女", "手足", "配偶", "其他")
#: A query that shows nothing for lack of any level of evidence.
NO_EVIDENCE = ("none",)


def with_candidates(labels: Sequence[str]) -> tuple[str, ...]:
    """Each label and that of its candidates, once."""
    out: dict[str, None] = {}
    for x in labels:
        out[x] = out[x if x.startswith(CANDIDATE_MARK) else CANDIDATE_MARK + x] = None
    return tuple(out)


def kinship_labels() -> tuple[str, ...]:
    """Labels of the kinds of kinship that topics list, the unspecified last."""
    return tuple(dict.fromkeys([*(KIN + x for k, x in KIN_LABELS.items() if k != "concubine_partner"), KIN + OTHER_KIN]))


def presets(members: Mapping[str, Sequence[str]] | None = None) -> dict[str, GraphQuery]:
    """Queries by topic. ``members`` gives the nodes of topics that are about some alone (dynasty, discipleship, team); without them these show no one."""
    who = lambda topic: tuple((members or {}).get(topic, ())) or ("",)
    read = EVIDENCE[:4]
    return {
        "all": GraphQuery(), "dynasty": GraphQuery(types=kinship_labels(), evidence=read, nodes=who("dynasty"), family=True),
        "family": GraphQuery(types=with_candidates(kinship_labels()), evidence=EVIDENCE, family=True),
        "discipleship": GraphQuery(types=with_candidates(DISCIPLESHIP), evidence=read, nodes=who("discipleship")), "team": GraphQuery(types=with_candidates(TEAM), evidence=read, nodes=who("team")),
        "acts": GraphQuery(types=with_candidates([*ACTS, *(CANDIDATE_MARK + KIN + x for x in ACTS_KIN)]), evidence=read, books=("ACT",)),
    }


@dataclass(frozen=True)
class View:
    """What is shown: a topic's query with the reader's own choices; ``custom`` where the reader's facets replace the topic's."""

    query: GraphQuery = field(default_factory=GraphQuery)
    topic: str = "all"
    identity: str = "conservative"
    person: str = ""
    direct: bool = True
    paths: bool = False


def to_query_string(view: View) -> str:
    """The view as parameters; what is as by default is left out. Facets are told for custom views alone, as a topic has its own."""
    q = view.query
    shown = set(q.evidence) or set(EVIDENCE)
    levels = ",".join(sorted(shown & set(EVIDENCE))) or "none"
    custom = view.topic == "custom"
    told = [
        ("q", q.term, ""), ("topic", view.topic, "all"), ("identity", view.identity, "conservative"), ("person", view.person, ""), ("scope", q.scope or "bible", "bible"),
        ("direct", "1" if view.direct else "0", "1"), ("paths", "1" if view.paths else "0", "0"), ("evidence", levels, ",".join(sorted(EVIDENCE))),
        *[(name, ",".join(sorted(some)) if custom else "", "") for name, some in (("eras", q.eras), ("books", q.books), ("types", q.types))],
    ]
    return urlencode([(k, v) for k, v, default in told if v and v != default])


def from_query_string(text: str, topics: Mapping[str, GraphQuery] | None = None) -> View:
    """The view of parameters; unknown topics, scopes and levels count as not given. Facets make a view custom, unless a topic is asked for."""
    topics = topics if topics is not None else presets()
    given = {k: v[-1] for k, v in parse_qs(text.lstrip("?"), keep_blank_values=True).items()}
    listed = lambda k: tuple(x for x in given.get(k, "").split(",") if x)
    topic = given.get("topic", "all")
    topic = topic if topic in topics else "all"
    q = topics[topic]
    levels = tuple(x for x in listed("evidence") if x in EVIDENCE)
    if given.get("evidence") == "none":
        q = replace(q, evidence=NO_EVIDENCE)
    elif levels:
        q = replace(q, evidence=levels)
    scope = given.get("scope", "bible")
    q = replace(q, term=given.get("q", ""), scope=scope if scope in SCOPES[1:] else "")
    facets = {k: listed(k) for k in ("eras", "books", "types")}
    if topic == "all" and any(facets.values()):
        q, topic = replace(q, **facets), "custom"
    identity = given.get("identity", "")
    return View(q, topic, identity if identity == "traditional" else "conservative", given.get("person", ""), given.get("direct") != "0", given.get("paths") == "1")
