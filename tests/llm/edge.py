"""Rows with nulls, empty and long texts, ties, repeats and extra columns."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size int, copies string, "
    "component_id long, fp string, severity string, piece int"
)


def documents(spark, rows=None):
    if rows is None:
        long = " ".join(f"word{i % 97}" for i in range(30_000))
        rows = [
            (1, "one two three four five six seven", "en", "a"),
            (2, "one two three four five six seven", "en", "a"),
            (2, "one two three four five six seven", "en", "a"),
            (3, None, None, None),
            (4, "", "en", "b"),
            (5, " \t\n", "en", "b"),
            (None, "one two three four five six seven", None, None),
            (None, None, None, None),
            (6, long, "en", "c"),
            (7, long + " end", "en", "c"),
            (8, "x", "en", "é"),
            (8, "another text under the same id", "en", "é"),
            (9, "call +1 (017) 555-7713 or mail to und.34@mail7.example.com", "de", "a"),
        ]
    full = [(*r, len(r[1]) if r[1] is not None else None, 1, "2", 3, "f", "s", 0) for r in rows]
    return spark.createDataFrame(full, SCHEMA)
