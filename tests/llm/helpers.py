"""Small tables with the awkward rows every operator has to take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, fingerprint string, row_number string"


def docs(spark, texts, first=0):
    """Documents with ids from ``first`` and extra columns whose names clash with internal ones."""
    rows = [(first + i, t, None, "s", None, "x", "y", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
