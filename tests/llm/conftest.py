import pytest

WORDS = "and the of river stone light water green over under small house long road winter summer quiet paper door hand".split()


@pytest.fixture
def frame(spark):
    """Documents with columns whose names operators might use themselves."""

    def make(rows):
        rows = [(i, t, (lang + ["en"])[0], (src + ["s"])[0]) for i, t, lang, src in ((r[0], r[1], list(r[2:3]), list(r[3:4])) for r in rows)]
        schema = "doc_id long, text string, lang string, source string"
        clash = {c: "7" for c in ("row", "n", "size", "kept", "matches", "document", "given", "a", "b", "spans", "score", "bands", "text_")}
        from pyspark.sql import functions as F

        return spark.createDataFrame(rows, schema).withColumns({c: F.lit(v) for c, v in clash.items()})

    return make


@pytest.fixture
def edge_rows():
    """NULLs, empty and blank texts, repeated rows, equal ids, a very long text."""
    long = " ".join(WORDS[(i * i + i // 7) % len(WORDS)] + str(i % 97) for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t \n"), (None, "a text without an id but with some words in it"), (4, "..."), (5, "é"),
        (6, "the same row twice over and over, word for word"), (6, "the same row twice over and over, word for word"),
        (7, "an id that two rows share"), (7, "an id that two rows share, not the text"), (8, long), (9, None, None, None),
    ]
