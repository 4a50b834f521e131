import json

import pytest
from pyspark.sql import functions as F

from cantorel.functions import rules
from cantorel.functions import text as T
from cantorel.operators import classify as C
from cantorel.operators import entities as E
from cantorel.operators import ordering, paths
from cantorel.operators import production as P

BRIDGE = "id string, category_id int, title_en string, title_zh string, composer_en string, composer_zh string, source_url string"


def bridge(spark, *more):
    u = "https://scores.example/wiki/X"
    rows = [("10", 0, "Étude", "《练习曲》", "Sor", "索尔", u), ("10", 1, "Étude", "《练习曲》", "Sor", "索尔", u), ("9", 1, "Air", "《曲》", "Bach", "巴赫", u), *more]
    return spark.createDataFrame(rows, BRIDGE)


def test_works_are_deduplicated(spark):
    from cantorel.session import ship

    ship(spark)
    done, drift = E.works(bridge(spark))
    assert drift.count() == 0
    assert [(r.id, r.category_ids) for r in E.ordered(done).collect()] == [("9", [1]), ("10", [0, 1])]
    _, drift = E.works(bridge(spark, ("9", 0, "Other", "《曲》", "Bach", "巴赫", "u")))
    assert [(r.rule, r.key) for r in drift.collect()] == [("identity_drift", "9")]
    cats = E.categories(spark.createDataFrame([("For lute and guitar", "x", "plucked", "original"), ("For guitar (arr)", "y", "guitar", "arrangement"), ("For guitar", "z", "guitar", "original")], "name string, name_zh string, family string, kind string"))
    assert [r.name for r in cats.orderBy("id").collect()] == ["For guitar", "For guitar (arr)", "For lute and guitar"]
    s = E.summary(cats, done).first()
    assert (s.categories, s.memberships, s.unique_works, s.shared_works) == (3, 3, 2, 1)


def test_catalogue_constraints(spark):
    done, _ = E.works(bridge(spark))
    done = ordering.numbered(done.withColumn("k", F.struct("composer_en", "title_en", "id")), "k", "ord").drop("k")
    cats = spark.createDataFrame([(0, "a", 1), (1, "b", 2)], "id int, name string, work_count int")
    assert E.violations(cats, done, "scores.example").count() == 0
    bad = E.violations(cats.withColumn("work_count", F.lit(5)), done.withColumn("source_url", F.lit("http://scores.example.evil/wiki/")).withColumn("ord", -F.col("ord")), "scores.example")
    assert {r.rule for r in bad.collect()} == {"work_count_differs", "link_not_allowed", "not_sorted"}
    with pytest.raises(rules.ViolationError):
        rules.assert_empty(bad)


def test_conflicts_overrides_and_lookups(spark):
    rows = spark.createDataFrame([("Bach", "巴赫"), ("Bach", "巴哈"), ("Sor", "索尔")], "composer_en string, composer_zh string")
    none = rows.limit(0)
    one = spark.createDataFrame([("Bach", "巴赫")], rows.schema)
    assert [r.variants for r in E.composer_conflicts(rows, none).collect()] == [["巴哈", "巴赫"]] and E.composer_conflicts(rows, one).count() == 0
    assert {r.composer_zh for r in E.with_overrides(rows, one).filter("composer_en = 'Bach'").collect()} == {"巴赫"}
    assert {r.status for r in E.reconcile(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "name string, page_count int"), spark.createDataFrame([("a", 1), ("b", 3), ("c", 0)], "name string, members int")).collect()} == {"keep", "adjust", "remove", "unverified"}
    assert sorted((r.rule, r.key) for r in E.exact_match(spark.range(3), spark.range(1, 4), "id").collect()) == [("missing", "0"), ("unexpected", "3")]


def test_numbering_and_neighbours(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    assert ordering.numbered(df, "k").filter("k <> n").count() == 0
    assert ordering.with_previous(df.withColumn("v", F.col("k")), "k", "v").filter("previous <> v - 1").count() == 0


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("For flute and guitar", (None, "woodwinds", "长笛、吉他·原作")), ("For 2 violins and 3 guitars (arr)", (None, "strings", "2把小提琴、3把吉他·改编")), ("For violin, flute and guitar", (None, "mixed_chamber", None)),
        ("For guitar", ("pure_guitar", None, None)), ("For voice and guitar", ("voice_or_chorus", None, None)), ("For electric guitar and piano", ("non_classical_guitar", None, None)),
        ("For alto saxophone and guitar", (None, "woodwinds", None)), ("For guitar and orchestra", ("large_ensemble", None, None)), ("For piano or guitar", ("alternative_solo", None, None)),
        ("For guitar and tape", ("electronic_or_tape", None, None)), ("For guitar and kazoo", ("no_supported_partner_instrument", None, None)), ("For guitar?x", ("malformed_or_unrelated", None, None)),
    ],
)
def test_classifier(spark, name, want):
    df = spark.createDataFrame([(name, 3, 1, 0)], "name string, page_count int, file_count int, subcategory_count int")
    r = C.classify(df).first()
    assert (r.reason, r.display_group) == want[:2] and (want[2] is None or r.name_zh == want[2])


def test_classifier_counts(spark):
    df = spark.createDataFrame([("For 2 violins and 3 guitars (arr)", 3, 1, 0), ("For flute and guitar", 0, 1, 0)], "name string, page_count int, file_count int, subcategory_count int")
    got = {r.name: r for r in C.classify(df).collect()}
    assert got["For 2 violins and 3 guitars (arr)"].guitar_count == 3 and got["For 2 violins and 3 guitars (arr)"].kind == "arrangement"
    assert got["For flute and guitar"].reason == "empty"


SOURCES = "kind string, original string, stable_id string"


def mapped(spark, *rows):
    first = {(r.kind, r.original, r.stable_id): (r.mapped, r.collision_reason) for r in paths.path_map(spark.createDataFrame(rows, SOURCES)).collect()}
    assert first == {(r.kind, r.original, r.stable_id): (r.mapped, r.collision_reason) for r in paths.path_map(spark.createDataFrame(rows[::-1], SOURCES)).collect()}
    return [first[r] for r in rows]


def test_paths(spark):
    clean, cut, late = paths.REASONS
    assert mapped(spark, ("work", "普通作品", "p7")) == [("普通作品", None)]
    assert mapped(spark, ("work", "A/B", "p7"), ("work", "A_B", "p8")) == [("A_B__p7", clean), ("A_B__p8", clean)]
    assert mapped(spark, ("work", "Etude", "7"), ("work", "etude", "p8")) == [("Etude__p7", clean), ("etude__p8", clean)]
    assert mapped(spark, ("composer", "Same", "x"), ("work", "Same", "p7"), ("composer", "Same", "y")) == [("Same", None)] * 3
    long = mapped(spark, ("work", "曲" * 80 + "甲", "p7"), ("work", "曲" * 80 + "乙", "p8"))
    assert [m[-4:] for m, _ in long] == ["__p7", "__p8"] and {r for _, r in long} == {cut} and all(len(m.encode()) <= 180 for m, _ in long)
    assert mapped(spark, ("work", "A/B", "p7"), ("work", "A_B", "p8"), ("work", "A_B__p7", "p9")) == [("A_B__p7", clean), ("A_B__p8", clean), ("A_B__p7__p9", late)]
    assert mapped(spark, ("file", "x.pdf", "f1"), ("file", "X.PDF", "2")) == [("x__f1.pdf", clean), ("X__f2.PDF", clean)]
    name, reason = mapped(spark, ("file", "é" * 200 + ".pdf", "3"))[0]
    assert len(name.encode()) <= 180 and name.endswith(".pdf") and reason is None
    two = mapped(spark, ("composer", "Name/Here", "i"), ("composer", "Name_Here", "j"))
    assert all(len(m.rsplit("__c", 1)[1]) == 10 for m, _ in two) and two[0] != two[1]
    assert mapped(spark, ("work", " . ", "p1"), ("work", "a\tb. ", "p2")) == [(" .".rstrip(" .") or "Untitled", None), ("a_b", None)]


def test_paths_that_cannot_be_told_apart(spark):
    with pytest.raises(paths.PathCollisionError):
        paths.path_map(spark.createDataFrame([("work", "A/B", "p7"), ("work", "A_B", "7")], SOURCES))
    for bad in (("work", "A", "bad"), ("file", "A", "f"), ("work", "A", "p007"), ("file", "A", "00"), ("other", "A", "1")):
        with pytest.raises(rules.ViolationError):
            paths.path_map(spark.createDataFrame([bad], SOURCES))
    with pytest.raises(rules.ViolationError):
        paths.path_map(spark.createDataFrame([("work", "A", "p7")] * 2, SOURCES))
    two = paths.unique_paths(spark.createDataFrame([("a.pdf", 1), ("A.pdf", 2), ("a__da4b9237.pdf", 9)], "path string, id int"), "path", "id").orderBy("id").collect()
    assert two[0].path == "a.pdf" and two[1].path.startswith("A__") and two[1].path.endswith(".pdf") and len({r.path.lower() for r in two}) == 3
    same = paths.unique_paths(spark.createDataFrame([("a", 1), ("A", 1), ("a", 1)], "path string, id int"), "path", "id")
    assert len({r.path.lower() for r in same.collect()}) == 3


def test_path_manifest(spark):
    made = paths.manifest(paths.path_map(spark.createDataFrame([("work", "b", "p8"), ("work", "a", "p7")], SOURCES)))
    assert [i["stable_id"] for i in json.loads(made.first().value)["items"]] == ["p7", "p8"] and paths.manifest_violations(made).count() == 0
    bad = spark.createDataFrame([('{"schema_version": 2, "model_type": "PathMapManifest", "items": []}',), ('{"schema_version": 1, "model_type": "PathMapManifest", "items": [{"kind": "x"}]}',)], "value string")
    assert sorted(r.rule for r in paths.manifest_violations(bad).collect()) == ["invalid_envelope", "invalid_item"]


def test_id_order_and_maps(spark):
    df = spark.createDataFrame([("10",), ("9",), ("x",), ("010",)], "i string").orderBy(ordering.id_key(F.col("i")))
    assert [r.i for r in df.collect()] == ["x", "9", "010", "10"]
    m = spark.range(1).select(rules.overridden(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2)), F.create_map(F.lit("b"), F.lit(5), F.lit("c"), F.lit(7))).alias("m")).first().m
    assert list(m.items()) == [("a", 2), ("b", 5), ("c", 7)]


def test_file_tags(spark):
    names = {
        "x_-_celesta_1.pdf": "file_tag", "x_-_keyboard,1.pdf": "file_tag", "x_-_harfe.pdf": "file_tag", "x_-_3_violinen_a.pdf": "file_tag", "x_-_sopran-sax_1.pdf": "file_tag",
        "x(piano).pdf": "file_tag", "x%28piano%29.pdf": "file_tag", "x-ensemble.pdf": "file_tag", "x_-_duett_gitarren.pdf": "file_tag", "Romanza al Violoncello.pdf": None, "x_-_guitar_1.pdf": None,
        "own-viola.pdf": None, "100%.pdf": None,
    }
    rows = spark.createDataFrame([(n, "", "", "s", "guitar") for n in names], "filename string, file_heading string, description string, section string, work_instrumentation string")
    got = {r.filename: r.reason for r in P.exclusion_reason(rows, P.Target("guitar"), exempt_tags=["own-viola.pdf"]).collect()}
    assert got == names
    two = {r.filename: r.reason for r in P.exclusion_reason(rows, P.Target("2 guitars", 2), exempt_tags=["own-viola.pdf"]).collect()}
    assert two == names | {"x_-_duett_gitarren.pdf": None}


def test_fallback_keys(spark):
    want = {
        "Suite in d minor": "组曲 d小调", "Sonata in C-Sharp minor and in D major": "奏鸣曲 C-Sharp小调 and in D major", "Fugue in B-flat major, No.2 and No.3": "赋格 降B大调, 第2号 and 第3号",
        "Air IN F-sharp MINOR": "Air 升F小调", "Air no.3": "暂无通行中译（原题：Air no.3）",
    }
    got = spark.createDataFrame([(t,) for t in want], "t string").select("t", P.fallback_title(F.col("t")).alias("z")).collect()
    assert {r.t: r.z for r in got} == want


def test_production_rules(spark):
    t = P.Target("guitar")
    df = spark.createDataFrame([("For guitar",), ("Piano",), ("Scores",), ("Harp guitar",), ("Guitar duet",), ("Viola da mano",), ("violão",)], "h string")
    assert [r.s for r in df.select(P.heading_state(F.col("h"), t).alias("s")).collect()] == ["target", "non-target", "generic", "target", "non-target", "non-target", "target"]
    mixed = P.Target("flute and guitar", mixed=True)
    got = spark.createDataFrame([("For guitar and flute",), ("For flute, violin and guitar",), ("For piano",), ("For flute, voice and guitar",)], "h string").select(P.target_heading(F.col("h"), mixed, []).alias("x"))
    assert [r.x for r in got.collect()] == [True, True, False, False]
    two = spark.createDataFrame([("For 2 guitars",), ("For 2 6-string guitars (Smith)",), ("For 2 guitars (with flute)",), ("For 3 guitars",)], "h string")
    assert [r.x for r in two.select(P.target_heading(F.col("h"), P.Target("2 guitars", 2), ["flute"]).alias("x")).collect()] == [True, True, False, False]
    files = [("a.pdf", "", "Complete score", "s", "guitar"), ("b.pdf", "Violin", "", "s", "guitar"), ("c.pdf", "", "For violin", "s", "guitar"), ("d-piano.pdf", "", "", "s", "guitar"), ("e.pdf", "", "guitar duet", "s", "guitar, piano")]
    rows = spark.createDataFrame(files, "filename string, file_heading string, description string, section string, work_instrumentation string")
    assert {r.filename: r.reason for r in P.exclusion_reason(rows, t).collect()} == {"a.pdf": None, "b.pdf": "heading", "c.pdf": "description", "d-piano.pdf": "file_tag", "e.pdf": "several_guitars"}
    scored = spark.createDataFrame([("guitar", False), ("cello (or guitar)", False), ("guitar, flute", True), ("2 guitars", True), ("", False), ("various", True)], "s string, want boolean")
    assert scored.filter(P.mixed_work(F.col("s"), t) != F.col("want")).count() == 0


def test_urls_titles_and_keys(spark):
    df = spark.createDataFrame([("https://scores.example/wiki/A", True), ("https://x.scores.example/wiki/A", True), ("http://scores.example/wiki/A", False), ("https://scores.example.evil/wiki/", False), ("https://u@scores.example/wiki/A", False), (None, False), ("nonsense", False)], "u string, want boolean")
    assert df.filter(T.allowed_url(F.col("u"), "scores.example", "/wiki/") != F.col("want")).count() == 0
    t = spark.createDataFrame([("Air (Bach, J. S.)",), ("Air",)], "s string").select(T.page_title(F.col("s")).alias("p")).collect()
    assert [tuple(r.p) for r in t] == [("Air", "Bach, J. S."), ("Air", "Unknown")]
    k = spark.createDataFrame([("For 12 guitars",), ("For 2 guitars",)], "s string").orderBy(T.numeric_key(F.col("s"))).collect()
    assert [r.s for r in k] == ["For 2 guitars", "For 12 guitars"]
    e = spark.createDataFrame([("a b/ü(1).pdf",)], "s string").select(T.percent_encoded(F.col("s")).alias("e")).first()
    assert e.e == "a%20b/%C3%BC%281%29.pdf"
