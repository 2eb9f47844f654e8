"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing extra columns."""

EXTRA = ", row bigint, part int, slot bigint, score double, id bigint, digest string, document string, before string"
FILL = (7, 7, 7, 7.0, 7, "x", "x", "x")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint" + EXTRA


def documents(spark, texts, lang="en", source="s"):
    """A table of documents numbered from 1, or ``(id, text)`` pairs; with columns whose names clash."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts, 1)]
    rows = [(i, t, lang, source, len(t or ""), *FILL) for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One two"), (6, "one two three four five six seven"), (6, "another text under this id"),
    (7, "same text again and again here"), (7, "same text again and again here"), (8, "same text again and again here"), (None, "no id at all"),
    (None, None), (9, "long " * 60_000), (10, "é" * 70_000), (11, "0123 !!"), (12, "a\n\nb\n"),
]
