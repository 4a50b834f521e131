"""Search behaviour on a small catalogue of seven works."""

import random

import pytest

from cantorel.functions import text as T
from cantorel.operators import search as S

WORKS = [
    ("1", "Recuerdos de la Alhambra", "《阿尔罕布拉宫的回忆》", "Tárrega, Francisco", "弗朗西斯科·泰雷加", [0, 1]),
    ("2", "The Seasons, Op.37a", "《四季》", "Tchaikovsky, Pyotr", "柴可夫斯基", [1]),
    ("3", "Nocturne, Op.9 No.2", "《夜曲》", "Chopin, Frédéric", "肖邦", [1]),
    ("4", "Etudes, Op.60", "《练习曲》", "Sor, Fernando", "费尔南多·索尔", [0]),
    ("5", "Sor Variations", "《变奏曲》", "Bach, Johann", "巴赫", [0]),
    ("6", "Bourree", "《布列舞曲》", "Bach, Johann", "巴赫", [0]),
    ("7", "Nocturne, Op.27", "《夜曲》", "Chopin, Frédéric", "肖邦", [0]),
]
CATEGORIES = [(0, "For guitar", "吉他·原作", "guitar", "original"), (1, "For flute and guitar (arr)", "长笛、吉他·改编", "woodwinds", "arrangement")]
COMPOSERS = [("Tárrega, Francisco", "塔雷加"), ("Sor, Fernando", "费尔南多·梭尔"), ("Chopin, Frédéric", "萧邦")]


@pytest.fixture(scope="module")
def index(spark):
    works = spark.createDataFrame(WORKS, "id string, title_en string, title_zh string, composer_en string, composer_zh string, category_ids array<int>")
    cats = spark.createDataFrame(CATEGORIES, "id int, name string, name_zh string, family string, kind string")
    comp = spark.createDataFrame(COMPOSERS, "composer string, alias string")
    made = S.create_index(works, cats, comp, spark.createDataFrame([], "id string, alias string"))
    return S.Index(*(getattr(made, x).cache() for x in ("docs", "bridge", "categories", "vocabulary"))), comp


ASKED = [
    ("塔雷加", None, None, ["1"]), ("费尔南多 梭尔", None, None, ["4"]), ("蕭邦 夜曲", None, None, ["3", "7"]), ("CHOPIN op9 no2", None, None, ["3"]),
    ("Chopin op9 no4", None, None, []), ("Tchaikovky", None, None, ["2"]), ("Tchaikvosky", None, None, ["2"]), ("Bcah", None, None, ["5", "6"]),
    ("B cah", None, None, []), ("Chpo in", None, None, []), ("柴可夫斯机 四季", None, None, ["2"]), ("柴可夫斯机 夜曲", None, None, []),
    ("Sor", None, None, ["4", "5"]), ("99", None, None, []), ("zz", None, None, []), ("", None, None, ["1", "2", "3", "4", "5", "6", "7"]),
    ("Tchaikovky", "woodwinds", "original", []), ("Tchaikovky", "woodwinds", "arrangement", ["2"]),
]


def asked(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "query_id int, text string, family string, kind string, category string")


def test_search(spark, index):
    got = S.search(asked(spark, [(t, f, k, None) for t, f, k, _ in ASKED]), index[0]).collect()
    for i, (text, _, _, want) in enumerate(ASKED):
        assert sorted(r.id for r in got if r.query_id == i) == want, text
    assert {r.mode for r in got if r.query_id == 12} == {"exact"} and {r.match_type for r in got if r.query_id == 0} == {"alias"}
    assert [r.categories for r in got if r.query_id == 17] == [[1]]
    ranks = sorted((r.rank, r.score, r.id) for r in got if r.query_id == 12)
    assert ranks[0][2] == "5" or ranks[0][1] <= ranks[1][1]


def test_suggest_browse_and_view(spark, index):
    q = asked(spark, [("chopin", None, None, None), ("c", None, None, None), ("Tchaikovky", None, None, None), ("", "woodwinds", "arrangement", None)])
    got = sorted(S.suggest(q, *index).collect())
    assert [(r.kind, r.suggestion) for r in got if r.query_id == 0] == [("composer", "Chopin, Frédéric"), ("work", "Nocturne, Op.27 Chopin, Frédéric"), ("work", "Nocturne, Op.9 No.2 Chopin, Frédéric")]
    assert not [r for r in got if r.query_id == 1]
    assert [r.label for r in got if r.query_id == 2] == ["柴可夫斯基", "四季"]
    cats, works = S.browse(q, index[0])
    assert [(r.id, r.n) for r in cats.filter("query_id = 3").collect()] == [(1, 1)]
    assert [r.id for r in cats.filter("query_id = 0").orderBy("n").collect()] == [0, 1]
    assert {r.query_id: r.work_count for r in works.collect()}[3] == 3
    assert [r.view for r in S.catalog_view(q).orderBy("query_id").collect()] == ["works", "works", "works", "categories"]


def brute_osa(a, b):
    d = {}
    for i in range(-1, len(a)):
        d[i, -1] = i + 1
    for j in range(-1, len(b)):
        d[-1, j] = j + 1
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_osa():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choices("abc", k=rng.randint(1, 6))) for _ in range(2))
        assert T.osa(a, b) == brute_osa(a, b)
    assert T.osa("ca", "abc") == 3 and T.osa("bcah", "bach") == 1 and T.osa("机", "柴可夫斯基", True) == 1


def test_normalize(spark):
    rows = ["Frédéric", "弗朗西斯科·泰雷加", "Op.9No2", "Æther Łódź ß", "蕭邦", None, "  a--b  "]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    got = [r.n for r in df.select("i", T.normalize(df.s).alias("n")).orderBy("i").collect()]
    assert got == ["frederic", "弗朗西斯科泰雷加", "op 9 no 2", "aether lodz ss", "萧邦", "", "a b"]
