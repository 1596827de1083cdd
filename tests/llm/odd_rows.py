"""Documents with every odd case: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, score string, size string, spans string, places string, rank string, block string, host string, digest string"
LONG = " ".join(f"word{k % 9973}x{k % 7}" for k in range(30_000))


def odd_documents(spark):
    extra = ("i", "s", "z", "p", "q", "r", "b", "h", "d")
    row = lambda i, t, source="a": (i, t, "en", source, None if t is None else len(t), *extra)
    same = "the quick brown fox jumps over the lazy dog and then it runs far away from all of us again"
    rows = [
        row(1, same), row(1, same), row(2, same, None), row(3, None), row(4, ""), row(5, " \t\n "), row(6, "é ü ñ 漢字 🙂 A.B"),
        row(None, same), row(None, None, None), row(7, LONG), row(8, "x" * 50_000), row(9, same.upper()), (10, "two words", None, None, None, *[None] * 9),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
