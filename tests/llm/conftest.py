import pytest

WORDS = "the a of and river stone light carries under small garden winter letter answers while nobody counts slow green bridges over quiet water near old town where seven lamps burn until morning comes again with bread salt".split()


def prose(seed: int, n: int) -> str:
    """n words that follow from a seed."""
    state, out = seed * 7919 + 17, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[(state >> 8) % len(WORDS)] + ("" if state % 7 else "."))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """NULLs in every column, empty and long texts, repeated ids and rows, ties, and columns whose names operators use themselves."""
    rows = [
        (1, prose(1, 200), "en", "a"), (1, prose(1, 200), "en", "a"), (1, prose(2, 60), "en", "a"), (2, prose(1, 200).upper(), None, None), (3, None, "en", "a"), (4, "", "fr", "b"),
        (5, "", None, "b"), (None, prose(3, 90), "fr", None), (None, None, None, None), (None, prose(3, 90), "fr", None), (6, "x" * 300_000, "en", "a"), (7, "wort " * 60_000, "de", "a"),
        (8, "...!?", "de", "c"), (9, "Two words", "en", "c"), (10, "Two words", "en", "c"), (11, "1" * 50_000, "en", "c"), (12, "é中\U0001f600 " * 40, "fr", "c"),
    ]
    extras = ", ".join(f"{c} string" for c in ("_row", "_id", "_hash", "_bucket", "_hashed", "key", "score", "class_id", "held_out", "n_hit", "slice", "term", "slot", "shard", "size"))
    made = [(*r, "x", "y", "z", "0", "1", "k", "s", "c", "h", "n", "sl", "t", "so", "sh", "si") for r in rows]
    return spark.createDataFrame(made, f"doc_id long, text string, lang string, source string, {extras}")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="session")
def small(spark):
    """The smallest given documents, as a table and as {id: text}."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
