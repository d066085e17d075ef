"""Small tables with awkward rows."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int, row string, n int, words string"


def docs(spark, texts, ids=None):
    """documents with extra columns whose names operators use themselves."""
    rows = [(i, t, "en" if i is None or i % 2 else None, None if i == 3 else "s", None if t is None else len(t), 7, "r", 1, "w") for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


AWKWARD = [None, "", " \n\t\n ", "One two three.", "One two three.", "x" * 70_000, "word " * 30_000, "\x00\x1f é \U0001f642 ẞ İ", "\n\n\n", "a\r\nb\r\n"]
