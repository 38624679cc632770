"""Small frames with every awkward case: NULLs, empty and long texts, repeated rows, clashing extra columns."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, size string, row string"


def documents(spark, texts, sources=None):
    """Documents 0, 1, ... with the given texts; further columns clash with names the operators use."""
    rows = [
        (i, t, "en", (sources[i] if sources else f"src{i % 3}"), None if t is None else len(t), 1, "s", "r")
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def odd_documents(spark):
    """NULL, empty, blank, very long, repeated rows, a NULL id."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    texts = [None, "", "   \n\t", long, "one two three four five six", "one two three four five six", "x"]
    rows = [(i, t, None, None, None, 1, "s", "r") for i, t in enumerate(texts)]
    rows += [rows[4], (None, "no id here at all", "en", "a", 1, 1, "s", "r"), (50, None, None, "a", None, 1, "s", "r")]
    return spark.createDataFrame(rows, SCHEMA)
