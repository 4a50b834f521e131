"""Every catalogue query against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from cantorel.operators import paths
from cantorel.plans import catalogue

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_oracle(spark, duck, name):
    got = catalogue.queries()[name](spark, D)
    cols = sorted(got.columns)
    want = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert plain(tuple(r) for r in got.select(*cols).collect()) == plain(tuple(r[i] for i in order) for r in want.fetchall())


def test_every_query_has_its_oracle():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


def test_path_collision_equals_its_oracle_where_suffixes_meet(spark, tmp_path):
    # the digests of 224076 and 1036256 begin with the same eight digits
    parts = [(1, "large bolt"), (224076, "Large Bolt"), (1036256, "large bolt"), (1036257, "LARGE bolt"), (2, "new ring")]
    spark.createDataFrame(parts, "p_partkey long, p_name string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    want = con.execute(f"SELECT p_partkey, path FROM ({catalogue.oracle_sql()['q_path_collision']})").fetchall()
    got = [tuple(r) for r in catalogue.queries()["q_path_collision"](spark, str(tmp_path)).select("p_partkey", "path").collect()]
    assert sorted(got) == sorted(want)
    assert dict(got)[224076] == "Large Bolt__d04d6ffc" and dict(got)[1036256] == "large bolt__d04d6ffc"
    named = spark.createDataFrame(parts, "id long, path string")
    assert len({r.path.lower() for r in paths.unique_paths(named, "path", "id").collect()}) == len(parts)


def test_wikitext_parse_reads_whole_lines(spark, tmp_path):
    lines = ["Short  One", "Words " * 30 + "END", "x" * 39 + "AB tail", "Last ÄÖ " * 900, "again a heading that goes on beyond forty characters"]
    docs = {1: lines, 2: lines[::-1]}
    spark.createDataFrame([(i, "\n".join(t)) for i, t in docs.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in docs.items():
        path = []
        for k, line in enumerate(text):
            name = " ".join(line.split()).casefold()
            path = path[: k % 3] + [name]
            want.append((str(i), k + 1, 2 + k % 3, name, " > ".join(path)))
    got = catalogue.queries()["q_wikitext_parse"](spark, str(tmp_path)).collect()
    assert sorted((r.page_id, r.node_ord, r.level, r.normalized, r.ancestry) for r in got) == want


def test_entry_imports():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
