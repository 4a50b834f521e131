import random

from cantorel.operators import drift as D
from cantorel.operators import review as R
from cantorel.operators import attempts as A
from cantorel.streaming.attempts import advance
from pyspark.sql import functions as F


def test_filter_reasons(spark):
    rows = [
        ("For 3 guitars", 5, None), ("For 2 electric guitars", 5, "electric_guitar"), ("For bass guitar (arr)", 5, "bass_guitar"), ("For guitar, voice", 5, "mixed_instrumentation"),
        ("For guitar and piano", 5, "mixed_instrumentation"), ("For guitar?search=bad", 5, "malformed_name"), ("For guitar orchestra (arr)", 0, "zero_members"), ("For lute", 5, "not_guitar"),
        ("For 3-guitars (arr)", 5, None), ("For  guitar", 5, "malformed_name"), ("For guitar band", 5, "unsupported_guitar_structure"), ("for guitar", 5, "malformed_name"),
    ]
    df = spark.createDataFrame(rows, "name string, size int, want string")
    assert df.filter(~D.filter_reason(df.name, df["size"], df["size"]).eqNullSafe(df.want)).count() == 0


def test_compare(spark):
    allow = spark.createDataFrame([("For 3 guitars (arr)",), ("For guitar",), ("For 2 guitars",)], "name string")
    kinds = "name string, size int, page_count int, file_count int, subcategory_count int"
    live = spark.createDataFrame([("For 3-guitars (arr)", 4, 4, 0, 0), ("For lute", 1, 1, 0, 0), ("For 2 guitars", 3, 3, 0, 0)], kinds)
    info = spark.createDataFrame([("For 3 guitars (arr)", False, 0, 0, 0), ("For guitar", True, 0, 0, 0), ("For 2 guitars", False, 3, 0, 0)], "name string, missing boolean, page_count int, file_count int, subcategory_count int")
    frozen = spark.createDataFrame([("For 3 guitars (arr)", 5), ("For guitar", 2), ("For 2 guitars", 3)], "name string, member_count int")
    members = "name string, page_id int"
    got = D.compare(allow, live, info, frozen, spark.createDataFrame([("For 3-guitars (arr)", i) for i in (1, 2, 3, 4)], members), spark.createDataFrame([("For 3 guitars (arr)", i) for i in (1, 2, 3, 4, 5)], members))
    assert [tuple(r) for r in got["empty_categories"].collect()] == [("For 3 guitars (arr)", 5)]
    assert [tuple(r) for r in got["deleted_categories"].collect()] == [("For guitar", 2)]
    assert [r.name for r in got["member_count_changes"].collect()] == ["For 3 guitars (arr)", "For guitar"]
    assert [tuple(r) for r in got["possible_renames"].collect()] == [("For 3 guitars (arr)", "For 3-guitars (arr)", 0, 0.8, 5, 4)]
    assert [(r.name, r.reason) for r in got["filtered_candidates"].collect()] == [("For lute", "not_guitar")]
    assert D.report_violations(got, allow).count() == 0


def test_review(spark):
    corpus = spark.createDataFrame([("1", "Studies", "《练习曲》"), ("2", "Waltz in A minor, Op.3", "《轻微》"), ("3", "Air", "《曲》")], "work_id string, title_en string, title_zh string")
    fixes = spark.createDataFrame([("2", "Waltz in A minor, Op.3", "《轻微》", "《a小调圆舞曲，作品3》", "b", "r")], "work_id string, title_en string, old_title_zh string, new_title_zh string, basis string, reason string")
    merged, bad = R.merge(corpus, fixes)
    assert bad.count() == 0 and {r.work_id: r.title_zh for r in merged.collect()}["2"] == "《a小调圆舞曲，作品3》"
    _, stale = R.merge(corpus, fixes.withColumn("old_title_zh", F.lit("x")))
    assert [r.rule for r in stale.collect()] == ["stale_correction"]
    out, bad = R.supplement(merged, spark.createDataFrame([("1", "《练习曲》", "《研究》", "x", "y"), ("3", "《别》", "《歌》", "x", "y")], "work_id string, current_title_zh string, new_title_zh string, reviewer string, reason string"))
    assert [(r.rule, r.key) for r in bad.collect()] == [("current_title_differs", "3")]
    metrics = {r.metric: r.value for r in R.audit(out, corpus).collect()}
    assert metrics["records"] == 3 and metrics["etude_as_research"] == 1 and metrics["missing"] == 0
    assert sorted((r.work_id, r.shard) for r in R.deal(corpus.select("work_id"), "work_id", 2).collect()) == [("1", 1), ("2", 2), ("3", 1)]


LOG = "source_id string, attempt_number int, started_at timestamp, completed_at timestamp, status string, retry_after int"


def log(spark, rows):
    df = spark.createDataFrame(rows, "source_id string, attempt_number int, s string, c string, status string, retry_after int")
    return df.select("source_id", "attempt_number", F.to_timestamp("s").alias("started_at"), F.to_timestamp("c").alias("completed_at"), "status", "retry_after")


def test_attempt_log(spark):
    rows = log(spark, [
        ("a", 1, "2026-01-01 00:00:00", "2026-01-01 00:00:05", "retryable", None), ("a", 2, "2026-01-01 00:00:06", "2026-01-01 00:00:07", "downloaded_verified", None),
        ("b", 1, "2026-01-01 00:00:00", "2026-01-01 00:00:05", "deleted", None), ("b", 3, "2026-01-01 00:00:01", "2026-01-01 00:00:09", "retryable", None),
        ("c", 1, "2026-01-01 00:00:00", "2026-01-01 00:00:05", "membership_wait_pending", 60), ("c", 2, "2026-01-01 00:00:20", "2026-01-01 00:00:25", "retryable", None),
    ])
    assert sorted((r.key, r.rule) for r in A.violations(rows).collect()) == [
        ("b", "attempt_after_terminal"), ("b", "number_not_contiguous"), ("b", "started_before_previous_end"), ("c", "wait_not_respected"),
    ]
    assert {r.source_id: r.status for r in A.latest(rows, "source_id", ["attempt_number"]).collect()} == {"a": "downloaded_verified", "b": "retryable", "c": "retryable"}
    groups = A.targets(spark.createDataFrame([(s, "For guitar", f"m{s}{i}") for s in "abcd" for i in (2, 1)], "source_id string, category_name string, membership_id string"))
    now = F.to_timestamp(F.lit("2026-01-02"))
    assert [r.source_id for r in A.selected(groups, rows, now).collect()] == ["c", "d"]
    assert [r.source_id for r in A.selected(groups, rows, now, limit=1).collect()] == ["c"]
    assert [r.source_id for r in A.selected(groups, rows, now, sources=["d", "a"]).collect()] == ["d"]
    assert {r.source_id: r.next_number for r in A.next_numbers(rows).collect()} == {"a": 3, "b": 4, "c": 3}


def test_access_pages(spark):
    pages = [
        ("<h1>Please verify you are human</h1>", "human_verification_required", None), ("<p>Please log in to download</p>", "login_required", None), ("Your download will continue in 60 seconds.", "membership_wait_pending", 60),
        ("available to members only.", "membership_required", None), ("not public domain", "copyright_restricted", None), ("not available in your country", "region_restricted", None),
        ("is available for purchase", "commercial_only", None), ("The requested file has been deleted.", "deleted", None), ("This response is not a PDF.", "manual_review", None),
    ]
    df = spark.createDataFrame(pages, "body string, want string, wait int").withColumn("s", A.access_status(F.col("body")))
    assert df.filter("not (s.status <=> want) or not (s.wait_seconds <=> wait)").count() == 0


def test_state_machine():
    end, retry = frozenset({"ok"}), frozenset({"err"})
    assert advance(0, "not_started", ["err", "err", "ok", "x"], end, retry, 3) == (2, "ok", 3, 1)
    assert advance(2, "err", ["err", "ok"], end, retry, 3) == (3, "retry_exhausted", 1, 1)


def test_blockers(spark):
    kind = "source_id string, attempt_number int, phase string, status string, completed_at string, retry_after int, review_status string"
    wait = ("w", 1, "finished", "membership_wait_pending", "2026-01-01 00:00:00", 60, None)
    rows = [
        ("a", 1, "started", "not_started", None, None, None), ("a", 2, "finished", "downloaded_verified", "2026-01-01 00:00:00", None, "resolved"), ("b", 1, "started", "not_started", None, None, None),
        wait, ("h", 1, "finished", "downloaded_verified", "2026-01-01 00:00:00", None, "pending"), ("m", 1, "finished", "manual_review", "2026-01-01 00:00:00", None, "pending"),
        ("r", 1, "finished", "retryable", "2026-01-01 00:00:00", None, None), ("d", 1, "finished", "manual_review", "2026-01-01 00:00:00", None, "resolved"),
    ]

    def found(rows, now):
        df = spark.createDataFrame(rows, kind).withColumn("completed_at", F.to_timestamp("completed_at"))
        return A.blockers(df, F.to_timestamp(F.lit(now))).first().blockers

    assert found(rows, "2026-01-01 00:00:59") == ["download_incomplete", "manual_review_pending", "membership_wait_pending", "source_hash_review_pending"]
    assert found([wait], "2026-01-01 00:01:00") == ["membership_wait_elapsed_unretried"]
    assert found([r for r in rows if r[0] in "ard" and r[1] != 3], "2026-01-01 00:01:00") == [] and found([], "2026-01-01 00:01:00") == []


def test_restored_associations(spark):
    groups = A.targets(spark.createDataFrame([("s", "b", "m2"), ("t", "b", "m3")], "source_id string, category_name string, membership_id string"))
    log = spark.createDataFrame([("s", 1, ["x"], ["m9"]), ("s", 2, ["a", "b"], ["m1", "m2"])], "source_id string, attempt_number int, category_names array<string>, membership_ids array<string>")
    got = {r.source_id: [tuple(a) for a in r.associations] for r in A.restored(groups, log).collect()}
    assert got == {"s": [("a", "m1"), ("b", "m2")], "t": [("b", "m3")]}


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_close_names_match_brute_force(spark):
    rng = random.Random(2)
    names = {"", "a", "ab", "ba", "abc"} | {"".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(60)}
    names |= {n[:3] + rng.choice("abcd") + n[3:] for n in list(names)}
    df = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    for limit in (0, 1, 3):
        want = {(a, b, lev(a, b)) for a in names for b in names if lev(a, b) <= limit}
        assert {tuple(r) for r in D.close_names(df, df, limit).collect()} == want


def test_renames_match_brute_force(spark):
    rng = random.Random(3)
    sets = {i: {0} | set(rng.sample(range(1, 40), rng.randint(1, 12))) for i in range(40)}
    for i in range(20):
        sets[100 + i] = {m for m in sets[i] if rng.random() < 0.9} | {rng.randrange(1, 40)}
    rows = spark.createDataFrame([(i, f"n{i}", m) for i, ms in sets.items() for m in ms], "name_id int, name string, member int")
    for t in (0.3, 0.8):
        got = {(r.source_name, r.candidate_name, r.overlap) for r in D.rename_candidates(rows, rows, 9, t, ordered=True).collect()}
        want = {(f"n{a}", f"n{b}", len(sets[a] & sets[b])) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9}
        assert got == want and want
