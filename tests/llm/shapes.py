"""Small tables with every odd row the operators define a result for."""

LONG = " ".join(f"word{i % 97}x{i}" for i in range(4000))
TEXT = "The quick brown fox jumps over the lazy dog\nand runs far away from the river bank\nat noon"


def odd_documents(spark, text=TEXT):
    """Nulls in any column, empty and blank and very long texts, ties, repeated rows, extra
    columns whose names clash with the operators' own."""
    rows = [
        (1, text, "en", "a", 10),
        (1, text, "en", "a", 10),
        (2, text, None, "b", None),
        (2, text + " indeed", "en", "b", 3),
        (3, None, "en", "a", 0),
        (4, "", "fr", None, 0),
        (5, " \n\t ", None, None, 3),
        (None, text, "en", None, 1),
        (None, None, None, None, None),
        (6, LONG, "en", "a", len(LONG)),
        (7, "eins", "de", "c", 4),
        (8, "12345 67", "de", "c", 4),
        (9, "Été à l'ombre 漢字 🙂", "fr", "c", 4),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for name in ("row", "kept", "n", "size", "site", "h", "cid", "key", "text_sha256", "keep_id"):
        docs = docs.selectExpr("*", f"'{name}' AS {name}")
    return docs


def empty_documents(spark):
    return odd_documents(spark).where("false")
