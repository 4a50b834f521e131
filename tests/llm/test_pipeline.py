import random

import corpus_pipeline
from cantorel.llm import queries

from .helpers import rows


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(1)
    text = lambda n: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))
    item = text(30)
    docs, labels = [], []
    for i in range(400):
        toxic = i % 8 == 0
        t = text(40) + (f" vile{rng.randint(0, 3)} " if toxic else " ") + text(10)
        docs.append((i, t, "en", f"s{i % 3}", len(t)))
        labels.append((i, 1, int(toxic)))
    docs += [(900, docs[1][1], "en", "s0", 1), (901, text(20) + " " + item, "en", "s0", 1), (902, text(20) + " mail a@b.org", "en", None, 1), (903, None, "en", "s0", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = table.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, str(tmp_path))
        assert table.columns == columns
        table.write.parquet(f"{tmp_path}/{name}")
        table = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id for r in table.collect()}
    clean = {i for i in range(400) if i % 8}
    assert seen["toxicity"] == clean | {900, 901, 902, 903}
    assert seen["simhash"] == clean | {901, 902, 903}
    assert seen["decontamination"] == clean | {902, 903}
    assert table.filter("doc_id = 902").first().text.endswith(" mail [EMAIL]")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {r[0] for r in rows(got, "doc_id")} == clean | {902, 903}


def folder(spark, path, docs, labels=(), items=()):
    spark.createDataFrame(list(docs), "doc_id long, text string, source string, __keep string, fp string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_stages_on_empty_tables(spark, tmp_path):
    docs = folder(spark, tmp_path, [])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_on_nulls_ties_and_clashing_columns(spark, tmp_path):
    rows = [(None, None, None, "k", None), (None, "a text without an id", "s", "k", "x"), (1, "one text", "s", None, "x"), (1, "one text", "s", None, "x"), (1, "quite another text under it", "t", "k", "y"), (2, "", "s", "k", "z"), (3, " ", None, "k", "z")]
    docs = folder(spark, tmp_path, rows, [(1, 1, 0), (None, 1, 1), (2, None, None)], [(0, None), (1, "!")])
    left = {"toxicity": 7, "simhash": 4, "decontamination": 4, "pii": 4}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "source", "__keep", "fp"] and docs.count() == left[name]
    assert {(r.doc_id, (r.text or "").strip()) for r in docs.collect()} == {(None, "a text without an id"), (1, "one text"), (1, "quite another text under it"), (2, "")}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 4


def test_every_operator_has_its_query():
    assert sorted({int(n[2:].split("_")[0]) for n in queries.queries()}) == list(range(1, 11))
    assert set(queries.oracle_sql()) <= set(queries.queries())
