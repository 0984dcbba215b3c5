"""Small tables with the awkward cases, as Spark DataFrames."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, source)."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows], DOCS)


def awkward(spark, texts):
    """The texts as documents, with nulls, empties, a repeated row and columns
    whose names operators might use themselves."""
    rows = [(k, t, f"s{k % 3}") for k, t in enumerate(texts)]
    rows += [(900, None, None), (901, "", "s0"), (902, None, "s1"), (None, "orphan text here", "s2"), (903, " \t\n ", "s1"), rows[0]]
    from pyspark.sql import functions as F
    df = documents(spark, rows)
    for name in ("id", "n", "t", "size", "fp", "mass", "key", "score", "ids", "v", "y", "x", "pre", "len", "keep", "src", "pick_id"):
        df = df.withColumn(name, F.lit("clash"))
    return df, rows


def empty(df):
    return df.limit(0)
