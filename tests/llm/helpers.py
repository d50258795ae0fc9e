"""Small document tables with awkward rows."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def docs(spark, rows, clash=()):
    """Rows (doc_id, text[, source]) as a documents table, with extra columns of the given names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for c in clash:
        df = df.withColumn(c, F.lit("clash"))
    return df


AWKWARD = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "a b c d"), (None, "no id at all here"),
           (6, "same text here twice"), (7, "same text here twice"), (7, "same text here twice"), (8, LONG),
           (9, "emoji \U0001F600 and é nbsp \x1c sep")]
