"""Awkward documents that every corpus operator must take."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, item_id string, n_tokens string"


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns that clash with outputs."""
    long = "The cat sat on the mat. " * 4000
    rows = [
        (1, None, "en", "a", 1, "x", "y"),
        (2, "", "en", "a", 0, None, "y"),
        (3, "   \n\t ", None, None, None, "x", None),
        (4, "one", "en", "a", 3, "x", "y"),
        (5, "one", "en", "a", 3, "x", "y"),
        (5, "one", "en", "a", 3, "x", "y"),
        (6, long, "en", "b", len(long), "x", "y"),
        (7, long + "end", "en", "b", len(long), "x", "y"),
        (8, "Ünïcode ß déjà vu 😀 ź   nbsp \x1c fs <|endoftext|> don't 123 +++", "de", "b", 5, "x", "y"),
        (None, "no id here", "en", "a", 5, "x", "y"),
        (9, "call +1 (555) 123-4567 or mail a.b@c.example now 10.0.0.1 and 4539 1488 0343 6467", "en", "a", 5, "x", "y"),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
