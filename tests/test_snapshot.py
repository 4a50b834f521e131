import hashlib
import json

from pyspark.sql import functions as F

from cantorel.operators import production as P
from cantorel.operators import review as R
from cantorel.operators import snapshot as S

MEMBERS = "category string, page_id int, title string"
REVISIONS = "page_id int, title string, revision_id int, wikitext string"


def test_freeze_and_bindings(spark):
    members = spark.createDataFrame([("a", 1, "X"), ("b", 1, "X"), ("a", 2, "Y")], MEMBERS)
    rev = spark.createDataFrame([(1, "X", 11, "t"), (2, "Y", 22, "u")], REVISIONS)
    pages, cats, bad = S.freeze(members, rev)
    assert bad.count() == 0
    assert {r.page_id: (r.category_names, r.wikitext_sha256) for r in pages.collect()}[1] == (["a", "b"], hashlib.sha256(b"t").hexdigest())
    assert S.binding_violations(pages, cats).count() == 0 and S.thawed(pages, rev).count() == 0
    assert [r.rule for r in S.binding_violations(pages, cats.filter("name = 'a'")).collect()] == ["only_in_pages"]
    assert {r.rule for r in S.thawed(pages, spark.createDataFrame([(1, "X", 11, "changed")], REVISIONS)).collect()} == {"text_differs", "revision_missing"}
    _, _, bad = S.freeze(members, spark.createDataFrame([(1, "Z", 11, "t"), (3, "Q", 33, "v")], REVISIONS))
    assert sorted(r.rule for r in bad.collect()) == ["revision_missing", "revision_unexpected", "title_differs"]


def test_reviews_are_bound_to_decisions(spark):
    d = spark.createDataFrame([("c", "1", "7", "s1", "f.pdf", "manual_review", "file_metadata_missing", None, ("x",))], "category_name string, page_id string, revision_id string, source_id string, filename string, disposition string, reason_code string, selection_reason string, evidence struct<branch: string>")
    text = {"source_id": "s1", "filename": "f.pdf", "disposition": "manual_review", "reason_code": "file_metadata_missing", "selection_reason": None, "evidence": {"branch": "x"}}
    sha = hashlib.sha256(json.dumps(text, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    kind = "category_name string, page_id string, revision_id string, source_id string, decision string, extraction_decision_sha256 string, reason string"
    out, bad = S.apply_reviews(d, spark.createDataFrame([("c", "1", "7", "s1", "exclude", sha, "r")], kind))
    assert bad.count() == 0 and out.first().disposition == "excluded" and out.first().reason_code == "manual_review_excluded"
    out, bad = S.apply_reviews(d, spark.createDataFrame([("c", "1", "7", "s1", "exclude", "0" * 64, "r"), ("c", "2", "7", "s9", "exclude", sha, "r")], kind))
    assert sorted(r.rule for r in bad.collect()) == ["decision_changed_since_review", "review_without_decision"] and out.first().disposition == "manual_review"


def test_config_choice_and_display(spark):
    kind = "name string, url string, kind string, guitar_count string, instrumentation_patterns array<string>, heading_patterns array<string>"
    u = "https://scores.example/wiki/Category:"
    good = [("For guitar", u + "For_guitar", "original", "1", ["^guitar$"], []), ("For guitar (arr)", u + "For_guitar_(arr)", "arrangement", "1", ["^guitar$"], ["^for guitar$"])]
    assert S.config_violations(spark.createDataFrame(good, kind), "https://scores.example").count() == 0
    bad = spark.createDataFrame([("For guitar", u, "arrangement", "99", ["guitar"], [])], kind)
    assert len({r.rule for r in S.config_violations(bad, "https://scores.example").collect()}) == 4
    conf = spark.createDataFrame([(i, n, k) for i, (n, k) in enumerate([("a", "original"), ("b", "arrangement"), ("c", "original")])], "ord int, name string, kind string")
    assert [r.name for r in S.choose(conf, "original", limit=1).collect()] == ["a"]
    assert [r.name for r in S.choose(conf, names=["c", "b"]).collect()] == ["b", "c"]
    shown = spark.createDataFrame([("For 3 guitars",), ("For guitar (arr)",), ("For 10-string guitar",), ("For 2 and 3 guitars",), ("For guitar ensemble",), ("Zzz",)], "n string")
    got = [(r.n, r.d.zh) for r in shown.withColumn("d", S.category_display(F.col("n"))).orderBy("d.sort").collect()]
    assert got == [("For guitar (arr)", "1把吉他·改编"), ("For 10-string guitar", "10弦吉他·原作"), ("For 2 and 3 guitars", "2或3把吉他·原作"), ("For 3 guitars", "3把吉他·原作"), ("For guitar ensemble", "吉他合奏·原作"), ("Zzz", "纯吉他分类")]

    mixed = spark.createDataFrame([("For flute and guitar", "长笛、吉他·原作", "woodwinds"), ("For 05 guitars (ARR)", None, None), ("for guitar orchestra (arr)", None, None)], "n string, z string, g string")
    got = [(r.n, r.d.zh, r.d.family) for r in mixed.withColumn("d", S.category_display(F.col("n"), F.col("z"), F.col("g"))).orderBy("d.sort").collect()]
    assert got == [("For 05 guitars (ARR)", "5把吉他·改编", "多把吉他"), ("for guitar orchestra (arr)", "吉他乐团·改编", "吉他合奏与乐团"), ("For flute and guitar", "长笛、吉他·原作", "吉他与木管")]


def test_forbidden_state_and_rank(spark):
    check = S.forbidden({"local_path"}, [r"^/home/"])
    df = spark.createDataFrame([('{"a": [{"local_path": 1}]}', True), ('{"a": ["/home/x"]}', True), ('{"a": {"b": "c"}}', False), (None, False)], "s string, want boolean")
    assert df.filter(check("s") != F.col("want")).count() == 0
    state = spark.createDataFrame([("a b&c", "strings", "all", None)], "q string, f string, k string, c string").select(S.url_state(*map(F.col, "qfkc")).alias("s"))
    assert state.first().s == "q=a+b%26c&family=strings"
    back = state.select(S.read_url_state(F.col("s"), ["strings"], ["original"], ["1"]).alias("r")).first().r
    assert tuple(back) == ("a b&c", "strings", "all", "all")
    ranks = spark.createDataFrame([("Air", "air"), ("Air in C", "air"), ("My air", "air"), ("Other", "air")], "t string, q string")
    assert [r.r for r in ranks.select(S.master_rank(F.col("q"), F.col("t"), F.col("t")).alias("r")).collect()] == [0, 1, 2, None]


def test_title_flags(spark):
    rows = [
        ("6 Etudes", "《6首研究》", ["etude_as_research"], []), ("Sonatina in C major, Op.5", "《C大调奏鸣曲》", ["sonatina_as_sonata"], ["opus_number_missing"]), ("Étude No.3", "《第三号练习曲》", [], []),
        ("Waltz in B-flat minor, BWV 999", "《b小调圆舞曲》，BWV999", [], ["key_mismatch"]), ("Air No.25", "《曲》", [], ["work_number_missing"]), ("Suite, BWV 812", "《组曲》", [], ["catalog_number_missing"]),
        ("Suite in E-flat major, Op.7 No.2", "《降E大调组曲》，Op.7，第2首", [], []),
    ]
    df = spark.createDataFrame(rows, "en string, zh string, q array<string>, i array<string>")
    got = df.select("en", R.quality_flags(df.en, df.zh).alias("q"), R.identity_flags(df.en, df.zh).alias("i")).collect()
    assert [(r.en, r.q, r.i) for r in got] == [(e, q, i) for e, _, q, i in rows]
    f = spark.createDataFrame([("《《a》",), ("《a, b》",), ("《a for b》",), ("《好》",)], "z string")
    assert [r.f for r in f.select(R.format_flags(F.col("z")).alias("f")).collect()] == [["nested_book_titles"], ["ascii_comma"], ["raw_for"], []]


def test_fallback_titles_and_sections(spark):
    rows = [("Pavan", "帕凡舞曲"), ("Trio Sonata No.2 in A-flat minor", "三重奏鸣曲 第2号 降A小调"), ("Piece for Guitar", "Piece 为吉他而作"), ("Zzz", "暂无通行中译（原题：Zzz）")]
    got = spark.createDataFrame(rows, "t string, w string").select(P.fallback_title(F.col("t")).alias("g"), "w").collect()
    assert [r.g for r in got] == [r.w for r in got]
    from cantorel.operators import wikitext as W

    fte = lambda n: "{{" + W.FILE_TEMPLATE + "\n|File Name 1=" + n + "\n|File ID 1=1\n}}\n"
    page = "| *****FILES***** =\n==Scores==\n" + fte("own.pdf") + "==Arrangements and Transcriptions==\n===For 2 guitars===\n====Smith====\n" + fte("two.pdf") + "===For piano===\n" + fte("p.pdf") + "| *****WORK INFO***** =\n|Instrumentation=guitar\n"
    h = W.headings(spark.createDataFrame([("1", "1", page)], "page_id string, revision_id string, wikitext string"))
    names = lambda t: sorted((r.attachment.filename, r.section) for r in P.sections(h, t, ["piano"]).collect())
    assert names(P.Target("guitar")) == [("own.pdf", "original")]
    assert names(P.Target("2 guitars", 2, "arrangement")) == [("two.pdf", "For 2 guitars")]
    assert [n for n, s in names(P.Target("guitar", 1, "arrangement")) if s == "work level"] == ["own.pdf", "p.pdf", "two.pdf"]
    keys = spark.createDataFrame([("A_b%20c&amp;d.PDF",)], "s string").select(P.filename_key(F.col("s")).alias("k")).first()
    assert keys.k == "a b c&d.pdf"


def test_reviewed_tables_and_shards(spark):
    kind = "work_id string, title_en string, title_zh string, status string, basis string, reason string, reviewer string, source_refs array<string>"
    good = ("1", "A", "《甲》", "accepted", "corpus_review", "r", "me", [])
    bad = [good, ("2", "B", "乙", "accepted", "common_name", "r", "me", []), ("3", " ", "《丙》", "other", None, "r", "me", None), ("1", "A", "《甲》", "corrected", "common_name", "r", "me", ["x"])]
    assert R.table_violations(spark.createDataFrame([good], kind)).count() == 0
    assert sorted((r.rule, r.key) for r in R.table_violations(spark.createDataFrame(bad, kind)).collect()) == [
        ("duplicate_work", "1"), ("empty_field", "3"), ("source_refs_not_a_list", "3"), ("title_not_displayable", "2"), ("unknown_basis", "3"), ("unknown_status", "3"),
    ]
    corpus = spark.createDataFrame([(str(i),) for i in range(1, 12)], "work_id string")
    heads = lambda *rows: spark.createDataFrame(rows, "shard int, audited_count int")
    fixed = spark.createDataFrame([("10", 1), ("2", 2)], "work_id string, shard int")  # in the order of the numbers
    assert R.shard_violations(heads((1, 4), (2, 4), (3, 3)), corpus, fixed, 3).count() == 0
    wrong = R.shard_violations(heads((1, 4), (2, 5), (2, 5)), corpus, spark.createDataFrame([("3", 1)], "work_id string, shard int"), 3)
    assert {(r.rule, r.key) for r in wrong.collect()} == {("duplicate_shard", "2"), ("shard_missing", "3"), ("audited_count_differs", "2"), ("correction_of_other_shard", "3")}
    tables = spark.createDataFrame([("1", "A"), ("1", "Z"), ("9", "Q")], "work_id string, title_en string")
    assert [(r.key, r.detail) for r in R.title_violations(tables, spark.createDataFrame([good], kind)).collect()] == [("1", "A")]
