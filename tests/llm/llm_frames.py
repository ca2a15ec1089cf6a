"""Documents that several test modules build."""

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use themselves
CLASHES = ("row", "doc", "fp", "size", "rate", "shard", "depth", "word", "class", "score", "value", "node", "u", "at", "text_len")


def frame(spark, rows):
    """Documents from (doc_id, text), (doc_id, text, lang) or (doc_id, text, lang, source)."""
    full = [(*r, *("en", "src0")[len(r) - 2 :], len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, COLUMNS)


def clashing(docs):
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


LONG = " ".join(f"w{i * i % 9973}" for i in range(60_000))
EDGES = [
    (1, "the quick brown fox jumps over the lazy dog"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, "the quick brown fox jumps over the lazy dog"),
    (5, LONG),
    (6, "One line.\nOne line.\nOne line.", None, None),
    (6, "One line.\nOne line.\nOne line.", None, None),
    (6, "Other text of the same id", "de", "src1"),
    (7, "  ünïcode   \U0001f600 中文 x\x0by  ", "fr", "src2"),
    (None, None, None, None),
]
