"""People of a sectioned file: boundaries of records, relations told twice, people of one name."""

from weft.operators import ingest as G
from weft.sources import tables as S


def read(spark, tmp_path, rows):
    (tmp_path / "names.txt").write_text("\n".join(rows))
    p = G.people(G.sectioned_people(S.read_lines(spark, str(tmp_path / "names.txt"))))
    return p, *G.relations(p)


def row(key, parents="", siblings="", partners="", offspring=""):
    return "\t".join([key, "", parents, siblings, partners, offspring, "", "", "Male"])


def named(name, how="named", ref="Mat.1.1"):
    return f"– {how}\tx\t{name}\t\t\t{ref}"


def test_children_stay_with_their_header(spark, tmp_path):
    p, edges, lost = read(spark, tmp_path, [
        row("Before@X"), named("Before"), "$========== PERSON", row("Alpha@ESV"), named("Alpha"), "@Article= Ancient note", named("SkipperAlias", ref="Mat.2.1"), row("Beta@ESV"), named("Beta"), named("Beta", "Name", "Mat.3.2; Mat.3.3"),
        row("Founder@ESV"), named("Founder"), named("People", "Group"), row("Inferred@ESV"), named("Inferred", "Mentioned"), "$========== PLACE", row("Town@ESV"), named("Town"), "$========== OTHER", row("Thing@ESV"), named("Thing"),
    ])
    assert {(r.name, r.forms, r.refs) for r in p.collect()} == {("Alpha", 1, 1), ("Beta", 1, 3)}
    assert edges.count() == lost.count() == 0


def test_relations_told_by_both_ends_are_one(spark, tmp_path):
    _, edges, lost = read(spark, tmp_path, ["$========== PERSON", row("James@ESV", siblings="Zebedee", offspring="Peter"), named("James"), row("Peter@ESV", parents="James (?)"), named("Peter"), row("Zebedee@ESV", siblings="James", partners="No One"), named("Zebedee")])
    assert {tuple(e) for e in edges.collect()} == {("parent", "James@ESV", "Peter@ESV", False), ("sibling", "James@ESV", "Zebedee@ESV", False)}
    assert [tuple(x) for x in lost.collect()] == [("Zebedee@ESV", "partners", "No One", "missing_label")]


def test_people_of_one_name_are_told_by_reference(spark, tmp_path):
    _, edges, lost = read(spark, tmp_path, [
        "$========== PERSON", row("James@Mat.4.21=G1", "Zebedee@Mat.4.21", "John@Mat.4.21"), named("James"), row("James@Mat.10.3=G2", "Alphaeus@Mat.10.3"), named("James"), row("Zebedee@Mat.4.21=G3", offspring="James@Mat.4.21"), named("Zebedee"),
        row("John@Mat.4.21=G4", siblings="James@Mat.4.21 + James"), named("John"), row("Alphaeus@Mat.10.3=G5", offspring="James@Mat.10.3"), named("Alphaeus"),
    ])
    assert {tuple(e)[:3] for e in edges.collect()} == {("parent", "Zebedee@Mat.4.21", "James@Mat.4.21"), ("parent", "Alphaeus@Mat.10.3", "James@Mat.10.3"), ("sibling", "James@Mat.4.21", "John@Mat.4.21")}
    assert [tuple(x) for x in lost.collect()] == [("John@Mat.4.21", "siblings", "James", "ambiguous_label")]
