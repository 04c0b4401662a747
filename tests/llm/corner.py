"""Rows that every operator over documents must bear."""

LONG = " ".join(f"word{i % 997} and{i % 31}" for i in range(60_000))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int, hits string, key string, bands string, node long, stays string, _id int, _key string, _d int, _k int, _mine int, `__text` string, `__made` int, `__found` string"


def documents(spark, more=()):
    """Nulls in every column, an empty and a blank text, a very long one, repeated rows, clashing extra columns."""
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, LONG), (6, "the same words in these two rows here"),
        (6, "the same words in these two rows here"), (7, "the same words in these two rows here"), (None, "a text without any id at all"), (None, None), *more,
    ]
    return spark.createDataFrame([(i, t, None, "s", None, "x", 3, "y", "k", "b", 9, "s", 1, "a", 2, 3, 4, "t", 5, "f") for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
