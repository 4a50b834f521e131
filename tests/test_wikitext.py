"""Parsing of wiki pages and the strict selection rules."""

import pytest

from cantorel.operators import wikitext as W

REJECT = "accordion bass cello flute guitar piano violin viola voice lute harp".split()
CATEGORIES = [
    ("For guitar", "original", ["^guitar$"], [], REJECT),
    ("For 3 guitars (arr)", "arrangement", ["^3 guitars$"], [r"^for 3 guitars(?: \((?P<annotation>[^()]*)\))?$"], REJECT),
]
C_SCHEMA = "name string, kind string, instrumentation_patterns array<string>, heading_patterns array<string>, annotation_reject_tokens array<string>"


def page(body, scored="guitar", names=("For guitar", "For 3 guitars (arr)")):
    return (list(names), f"intro\n| *****FILES***** =\n{body}\n| *****WORK INFO***** =\n|Instrumentation={scored}\n")


def fte(name, file_id=None, n=1):
    ident = f"|File ID {n}={file_id}\n" if file_id else ""
    return "{{" + W.FILE_TEMPLATE + "\n|File Name " + f"{n}={name}\n{ident}" + "}}\n"


A = "=====Arrangements and Transcriptions=====\n"
S = "=====Scores and Parts=====\n"


@pytest.fixture(scope="module")
def decide(spark):
    from cantorel.session import ship

    ship(spark)
    cats = spark.createDataFrame(CATEGORIES, C_SCHEMA)

    def run(*pages, scores=None, asked=None):
        rows = [(str(i + 1), "7", names, text) for i, (names, text) in enumerate(pages)]
        df = spark.createDataFrame(rows, "page_id string, revision_id string, category_names array<string>, wikitext string")
        s = None if scores is None else spark.createDataFrame(scores, "page_id string, page_revision_id string, file_id string, filename string")
        r = None if asked is None else spark.createDataFrame(asked, "page_id string, category_name string")
        got = W.extract(df, cats, s, r).collect()
        return {(r.page_id, r.category_name, r.filename): (r.disposition, r.reason_code, r.source_id) for r in got}

    return run


def test_gates(decide):
    got = decide(
        page(A + "====For 3 guitars====\n" + fte("three.pdf", 1) + fte("three.mscz", 2)),
        page(A + "====For 3 guitars and bass====\n" + fte("mixed.pdf", 3)),
        page(S + fte("original.pdf", 4) + A + "====For piano====\n" + fte("piano.pdf", 5)),
        page(S + fte("work.pdf", 6), "3 guitars"), page(S + fte("work.pdf", 6), "3 guitars, piano"),
        page(A + "====For 3 guitars (with violin)====\n" + fte("note.pdf", 8)),
        page(A + "====For 3 guitars====\n=====With Bass Guitar=====\n" + fte("child.pdf", 9)),
        page(fte("lost.pdf", 10) + S + fte("gone.pdf", 11), names=("For guitar",)),
        page(S + fte("noid.pdf")),
    )
    three = "For 3 guitars (arr)"
    assert got["3", "For guitar", "original.pdf"][:2] == ("selected", "exact_original_instrumentation")
    assert got["4", three, "work.pdf"][:2] == ("selected", "work_level_exact_instrumentation")
    assert got["5", three, "work.pdf"][:2] == ("manual_review", "work_level_instrumentation_not_exact")
    assert ("8", three, "gone.pdf") not in got
    other = decide(page(S + fte("gone.pdf", 11), names=("For guitar",)), asked=[("1", three), ("9", three)])
    assert other["1", three, "gone.pdf"][:2] == ("excluded", "page_not_in_category")
    assert got["8", "For guitar", "lost.pdf"][:2] == ("excluded", "branch_not_allowed")
    assert got["8", "For guitar", "gone.pdf"][2] == "source:f11@r7"
    assert got["9", "For guitar", "noid.pdf"][:2] == ("manual_review", "file_metadata_missing")


def test_arrangement_headings(decide):
    a = "==Arrangements and Transcriptions==\n"
    three = "For 3 guitars (arr)"
    got = decide(
        page(a + "===For 3 guitars===\n" + fte("three.pdf", 1) + fte("three.mscz", 2)), page(a + "===For 3 guitars and bass===\n" + fte("mixed.pdf", 3)),
        page(a + "===For 3 Guitars (with violin)===\n" + fte("note.pdf", 8)), page(a + "===For 3 guitars===\n====With Bass Guitar====\n" + fte("child.pdf", 9)),
        page(a + "===For 4 hands===\n" + fte("other.pdf", 12)), page(a + "===For 3 guitars (Smith)===\n" + fte("ok.pdf", 13)),
    )
    assert [got[str(i + 1), three, f][:2] for i, f in enumerate(["three.pdf", "mixed.pdf", "note.pdf", "child.pdf", "other.pdf", "ok.pdf"])] == [
        ("selected", "exact_arrangement_heading"), ("excluded", "mixed_instrument_heading"), ("excluded", "annotation_contains_instrument"),
        ("excluded", "mixed_instrument_heading"), ("excluded", "heading_not_exact"), ("selected", "exact_arrangement_heading"),
    ]
    assert got["1", three, "three.mscz"][1] == "not_pdf"
    assert got["1", "For guitar", "three.pdf"][1] == "branch_not_allowed"


def test_metadata_association(decide):
    body = "==Scores and Parts==\n" + fte("a.pdf", 1) + fte("b.pdf") + fte("c.pdf", 3) + fte("d.pdf") + fte("e.pdf") + fte("e.pdf")
    scores = [("1", "7", "1", "a.pdf"), ("1", "7", "2", "b.pdf"), ("1", "7", "3", "other.pdf"), ("1", "7", "5", "e.pdf")]
    got = decide(page(body), scores=scores)
    reason = {f: got["1", "For guitar", f][1:] for f in ("a.pdf", "b.pdf", "c.pdf", "d.pdf", "e.pdf")}
    assert reason["a.pdf"] == ("exact_original_instrumentation", "source:f1@r7")
    assert reason["b.pdf"] == ("exact_original_instrumentation", "source:f2@r7")
    assert reason["c.pdf"][0] == "file_metadata_conflict"
    assert reason["d.pdf"][0] == "file_metadata_missing"
    assert reason["e.pdf"][0] == "file_metadata_ambiguous"


def test_parse_errors_and_comments():
    assert W.parse_page("nothing")["error"] == "files_region_invalid"
    assert W.parse_page(page("{{" + W.FILE_TEMPLATE + "\n|File Name 1=x.pdf")[1])["error"] == "unbalanced_template"
    assert W.parse_page(page("{{" + W.FILE_TEMPLATE + "}}")[1])["error"] == "file_template_missing_filename"
    got = W.parse_page(page("<!-- ==A==\n" + fte("x.pdf") + "-->\n==B==\n" + fte("y &amp; z.pdf", 4))[1])
    assert [(n["raw"], [a["filename"] for a in n["attachments"]]) for n in got["nodes"]] == [(None, []), ("B", ["y & z.pdf"])]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("For '''3''' [[Guitar|guitars]]", "for 3 guitars"), ("{{LinkArr|a|Smith}} <b>x</b>", "smith x"), ("A&nbsp;B <!-- c -->", "a b"), ("{{x}}[http://a.b text]", "text"), ("Straße É", "strasse é")],
)
def test_heading_normal_form(raw, want):
    assert W.normal_heading(raw) == want


def test_pages_with_errors_do_not_vanish(spark, decide):
    broken = page("{{" + W.FILE_TEMPLATE + "\n|File Name 1=x.pdf")
    got = decide(page(S + fte("a.pdf", 1)), broken, (["For guitar"], "nothing"))
    assert got["2", None, None] == ("invalid_page", "unbalanced_template", None) and got["3", None, None][1] == "files_region_invalid"
    assert got["1", "For guitar", "a.pdf"][0] == "selected"
    bad = spark.createDataFrame([("2", "7", "invalid_page", "unbalanced_template")], "page_id string, revision_id string, disposition string, reason_code string")
    assert [(r.rule, r.key, r.detail) for r in W.page_violations(bad).collect()] == [("invalid_page", "2@7", "unbalanced_template")]


def test_section_spans(spark):
    levels = [2, 3, 4, 4, 3, 2, 6, 1]
    rows = spark.createDataFrame([("1", "7", i + 1, n) for i, n in enumerate(levels)] + [("2", "7", 1, 3)], "page_id string, revision_id string, node_ord int, level int")
    got = {(r.page_id, r.node_ord): r.end_ord for r in W.section_spans(rows).collect()}
    want = {("1", i + 1): next((k + 1 for k in range(i + 1, len(levels)) if levels[k] <= n), None) for i, n in enumerate(levels)} | {("2", 1): None}
    assert got == want
