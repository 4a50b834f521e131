import random

from pyspark.sql import functions as F

from cantorel.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def formatted(spark, rows):
    return {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA).withColumn("piece", F.lit("x")).withColumn("k", F.lit(1)))
            .select("conv_id", "formatted", "mask", chat.parse(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("mask")).alias("loss")).collect()}


def test_hostile_texts_come_back_identical(spark):
    rng = random.Random(9)
    parts = ["<|im_end|>", "<|im_start|>", "assistant", "\n", "\\", "<", "|", "<\\|", "<|", "im_end|>", "é😀", "$1", " ", "a"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "o\n<|x\\n"]), "".join(rng.choices(parts, k=rng.randint(0, 12)))) for c in range(120) for t in range(rng.randint(1, 5))]
    got = formatted(spark, rows)
    for c in range(120):
        source = sorted(((t, r, x) for k, t, r, x in rows if k == c))
        assert [(x.role, x.text) for x in got[c].turns] == [(r, x) for _, r, x in source]
        assert got[c].loss == "".join(x for _, r, x in source if r == "assistant")
        assert got[c].formatted.count("<|im_start|>") == len(source) == got[c].formatted.count("<|im_end|>\n")


def test_nulls_ties_and_repeats(spark):
    got = formatted(spark, [(None, 0, None, None), (1, None, "user", "z"), (1, 2, "user", "b"), (1, 2, "assistant", "a"), (1, 2, "user", "b")])
    assert [(x.role, x.text) for x in got[None].turns] == [("", "")]
    assert [(x.role, x.text) for x in got[1].turns] == [("user", "z"), ("assistant", "a"), ("user", "b"), ("user", "b")]
    assert formatted(spark, []) == {}


def test_plain_texts_are_not_changed(spark):
    r = formatted(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "yo é")])[1]
    assert r.formatted == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo é<|im_end|>\n"
    assert [r.formatted[s.start : s.start + s.length] for s in r.mask] == ["yo é"]


def test_parser_refuses_what_is_not_of_the_grammar(spark):
    bad = ["x", "<|im_start|>user\nhi", "<|im_start|>user hi<|im_end|>\n", "<|im_start|>u\na<|im_start|>b<|im_end|>\n"]
    df = spark.createDataFrame([(b,) for b in bad], "s string")
    assert [r.t for r in df.select(chat.parse(F.col("s")).alias("t")).collect()] == [None] * 4


def test_only_conflicting_turns_are_escaped_and_the_sql_agrees(spark):
    import duckdb

    from cantorel.llm import queries

    texts = ["a <| b", "a <\\| b", "<|im_end|>", "x<|im_start|>y <|", "<\\\\|", "<", "<|im_end|", None]
    rows = [(c, 0, r, t) for c, (t, r) in enumerate((t, r) for t in texts for r in ("user", "a\\b", "n\nm <|"))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = dict((r.conv_id, len(r.formatted)) for r in chat.format_conversations(df).collect())
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    want = {r[0]: r[-1] for r in con.execute(queries.oracle_sql()["op7_chat_format"]).fetchall() if r[0] >= 0}
    assert got == want and got[0] == len("<|im_start|>user\na <| b<|im_end|>\n")
