"""Small tables for the training-data operators' tests."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; an extra column may be called so.
CLASHING = ("fp", "key", "mark", "removed", "spans", "block", "queue", "score", "__keep", "n")


def docs(spark, texts, ids=None, source="s"):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in zip(ids, texts)], DOCS)


def clashing(df):
    """The table with extra columns named like the operators' own."""
    for c in CLASHING:
        df = df.withColumn(c, F.lit("x"))
    return df


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
